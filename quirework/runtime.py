"""Session-level helpers: shared storage, lineage cuts and skew-safe joins."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCRATCH: dict[str, str] = {}

#: No more than this many groups can each hold a 1/HOT_GROUPS share of the rows.
HOT_GROUPS = 1000


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and the master is local, one of our own.

    On a cluster without the setting this raises: a machine-local folder would lose
    the data with its machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="quirework-")
            spark.conf.set("spark.checkpoint.dir", base)
        _SCRATCH[app] = f"{base.rstrip('/')}/quirework-{uuid.uuid4().hex[:12]}"
        atexit.register(_remove, spark, _SCRATCH[app])
    return _SCRATCH[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may already be gone
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, where its files make fewer: such a table is small."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hot_keys(groups: DataFrame, key: str, count: str, total: int, floor: int = 10_000) -> DataFrame:
    """Keys of the groups with at least max(floor, total / HOT_GROUPS) rows: never more than HOT_GROUPS."""
    return groups.where(F.col(count) >= max(floor, total // HOT_GROUPS)).select(key).distinct()


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int, salts: int = 64) -> DataFrame:
    """Inner join of ``rows`` with the few rows per ``key`` in ``groups``, safe for hot keys.

    ``count`` says how many of the ``rows`` have the key. The hot keys (at most HOT_GROUPS of them) are
    broadcast as keys only; their rows are salted and their group rows are repeated once per salt. All
    other keys join unsalted.
    """
    hot = hot_keys(groups, key, count, total).withColumn("_hot", F.lit(True))
    left = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.floor(F.rand(7) * salts)).otherwise(0).cast("int")
    ).drop("_hot")
    right = groups.join(F.broadcast(hot), key, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    ).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")
