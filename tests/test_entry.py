"""The driver contract, with and without the subpackage for training data."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import DATA, ROOT


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_llm():
    for folder, _, files in os.walk(f"{ROOT}/quirework"):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                assert "quirework.llm" not in open(os.path.join(folder, f)).read(), f


def test_entry_without_llm():
    code = "import sys; sys.modules['quirework.llm'] = None\nimport __spark_entry__ as e\nassert 'p3_found' in e.queries() and not any(k.startswith('p4') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


FAST = ["p3_found", "incremental_split", "chunk_size_report", "structure_state", "heading_paths", "toc_flags", "global_dedupe", "quality_scores", "char_coverage"]


@pytest.mark.parametrize("name", FAST)
def test_against_sql(spark, name):
    d = f"{DATA}/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(d):
        con.execute(f"create view {f.split('.')[0]} as select * from '{d}/{f}'")
    want = con.execute(entry.oracle_sql()[name])
    cols = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in cols]
    norm = lambda x: round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    b = sorted((tuple(norm(r[i]) for i in order) for r in want.fetchall()), key=str)
    df = entry.queries()[name](spark, d)
    assert sorted(df.columns) == cols
    a = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=str)
    assert a == b


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
