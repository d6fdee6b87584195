"""Catalogue queries against their DuckDB oracles on the sf0.001 tables (fast subset + flagship)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from reelstat.plans import catalog

FAST = ["movie_summary", "movie_summary_sparse", "split_route", "split_report", "positional_zip", "split_dump",
        "center_ratings", "merge_duplicates", "run_groups", "epoch_bias_model", "epoch_full_batch",
        "rmse_probe", "gradient_user", "bias_minibatch_step", "score_clamped", "text_roundtrip", "first_biases",
        "user_major_epoch", "epoch_cell_bias", "total_error", "sparse_difference", "report_append", "prediction_file",
        "summary_csv", "narrowed_records", "day_stamps", "bias_fit_stop"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ("lineitem", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    """The rating queries all have SQL; the corpus queries are checked in tests/llm."""
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["movie_id", "ratings", "rating_mean"]
