"""Running aggregates over ordered groups, without one task for a whole long group.

While no group is long, they are plain windows: all scans of one order share a single shuffle and sort. Where a group
is long (a document may hold a third of all rows), its rows are cut into blocks of consecutive positions; every block is
scanned on its own, and what the blocks before it amount to is added from a small table of one row a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.runtime import materialize

BLOCK = 20_000

_RUNNING = {"sum": F.sum, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}
_JOIN = {
    "sum": lambda a, c: F.coalesce(a, F.lit(0)) + F.coalesce(c, F.lit(0)),
    "min": lambda a, c: F.least(a, c),
    "last": lambda a, c: F.coalesce(a, c),
}


def is_long(df: DataFrame, pos: str, block: int = BLOCK) -> bool:
    """Whether some position lies beyond one block, so that scans have to be cut."""
    most = df.agg(F.max(pos)).first()[0]
    return most is not None and most >= block


def scan(
    df: DataFrame, key: str, pos: str, out: dict[str, tuple[str, Column]], before: bool = False, long: bool = False, block: int = BLOCK
) -> DataFrame:
    """Add running aggregates over ``key`` in the order of the integer column ``pos``.

    ``out`` maps a name to ('sum' | 'min' | 'last', expression); 'last' is the last non-null value. With ``before`` a
    row's own value doesn't count. ``pos`` must be unique within ``key``; null values of an expression are skipped, and
    where nothing counts the result is null (0 for sums).
    """
    if not long:
        w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        run = {n: _RUNNING[kind](c).over(w) for n, (kind, c) in out.items()}
        return df.withColumns({n: F.coalesce(c, F.lit(0)) if out[n][0] == "sum" else c for n, c in run.items()})
    d = df.withColumns({"_blk": F.floor(F.col(pos) / block)} | {f"_v_{n}": c for n, (_, c) in out.items()})
    d = materialize(d, "scan")  # it is read twice below
    local = Window.partitionBy(key, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    total = {"sum": F.sum, "min": F.min, "last": lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(pos)))}
    blocks = d.groupBy(key, "_blk").agg(*[total[kind](F.col(f"_v_{n}")).alias(f"_t_{n}") for n, (kind, _) in out.items()])
    earlier = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = [_RUNNING[kind](F.col(f"_t_{n}")).over(earlier).alias(f"_c_{n}") for n, (kind, _) in out.items()]
    carried = blocks.select(F.col(key).alias("_key"), F.col("_blk").alias("_b"), *carry).where("_b > 0")
    at = (F.col(key) == F.col("_key")) & (F.col("_blk") == F.col("_b"))
    joined = d.withColumns({f"_l_{n}": _RUNNING[kind](F.col(f"_v_{n}")).over(local) for n, (kind, _) in out.items()}).join(carried, at, "left")
    joined = joined.withColumns({n: _JOIN[kind](F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n, (kind, _) in out.items()})
    return joined.drop("_blk", "_key", "_b", *[f"{p}{n}" for n in out for p in ("_v_", "_l_", "_c_")])


def numbered(df: DataFrame, key: str, pos: str, name: str, long: bool = False, block: int = BLOCK) -> DataFrame:
    """Add the rank of a row in ``key`` by ``pos``, from 0."""
    return scan(df, key, pos, {name: ("sum", F.lit(1))}, long=long, block=block).withColumn(name, (F.col(name) - 1).cast("int"))
