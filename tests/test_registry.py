"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from foliospark.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def norm(v):
    return "None" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    got = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    assert sorted(tuple(norm(r[names.index(c)]) for c in columns) for r in got.fetchall()) == rows


def test_entry_module_without_training_data_operators(spark):
    import __spark_entry__

    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    if os.path.isdir(DATA):
        assert __spark_entry__.entry(spark).count() > 0


def test_one_scan_for_many_queries(spark):
    """A topic scan reads the text once, however many topics it has."""
    if os.path.isdir(DATA):
        plan = registry._hits(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        assert "embedding" not in plan


def test_preference_dedupe_reads_all_events(spark, tmp_path):
    """Users of any id take part, not only those below 200."""
    rows = [(1, 300, "click"), (2, 300, "view"), (3, 300, "click"), (4, 301, "view"), (5, 301, "error"), (6, 302, "signup"), (7, 303, "click"), (8, 303, "error"), (9, 4, "click")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(r) for r in registry.QUERIES["preference_dedupe"](spark, str(tmp_path)).collect())
    only, chosen = "only-candidate", "explicit-preference"
    assert got == [(4, "click", 9, only, 0), (300, "click", 1, chosen, 1), (301, "view", 4, chosen, 1), (302, "signup", 6, only, 0)]


def test_preference_dedupe_keeps_a_null_user(spark, tmp_path):
    """Events without a user are one group, of which the preferred one stays, and no fault."""
    rows = [(1, None, "click"), (2, None, "view"), (3, None, "view"), (4, None, "error"), (5, 7, "view"), (6, 7, "error"), (7, 8, "signup")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in registry.QUERIES["preference_dedupe"](spark, str(tmp_path)).collect()}
    only, chosen = "only-candidate", "explicit-preference"
    assert got == {(None, "view", 2, chosen, 2), (7, "view", 5, chosen, 1), (8, "signup", 7, only, 0)}
