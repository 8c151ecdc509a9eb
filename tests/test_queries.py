"""Every registered query against its SQL in DuckDB, or for rows where there is no SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from furlens_suite import learn_queries, registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Full-size model runs take minutes; test_models fits the same learners with less work.
SLOW = {
    "ml_boosted_trees",
    "ml_mlp",
    "ml_random_forest",
    "ml_svm",
    "ml_svm_probability",
    "ml_sweep_sequential",
    "ml_sweep_parallel",
    "ml_sweep_levels",
    "ml_sweep_scores",
}
# what the optional subpackage registers is tested in its own folder
QUERIES = {n: q for n, q in entry_module.queries().items() if n in registry.REGISTERED}
SQL = {n: s for n, s in entry_module.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v + 0.0:.9g}"
    return str(v)


def table(columns, rows):
    order = sorted(columns)
    at = [list(columns).index(c) for c in order]
    return order, sorted(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert table(df.columns, rows) == table(columns, cursor.fetchall())


def test_entry(spark):
    assert {r["label"] for r in entry_module.entry(spark).collect()} == {0, 1}


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_sweep_figures_of_closed_forms(spark, duck, sf_dir):
    """The sweep queries' figures that SQL knows, from a sweep of these two models alone."""
    train, test = learn_queries.D.train_test(spark, sf_dir)
    models = [m for m in learn_queries.M.default_models() if m.name in learn_queries._EXACT]
    got = learn_queries._outcome(spark, [learn_queries.sweep.run_sweep(models, train, test, 1)])
    want = duck.sql(SQL["ml_sweep_sequential"])
    assert got.columns == want.columns
    exact = [r for r in want.fetchall() if r[1] in learn_queries._EXACT]
    assert sorted(map(tuple, got.collect())) == sorted(exact) and len(exact) == 2
