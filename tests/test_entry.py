"""Driver contract: entry() runs on sf0.001, and a sample of queries equals its oracle there."""
import duckdb
import pytest

import __spark_entry__ as E
from featureflow.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) >= {"split", "churn", "n"}


def test_every_query_has_a_callable_and_most_have_sql():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 70 and len(o) >= 65


@pytest.mark.parametrize("name", ["training_summary", "pit_lookup", "metrics_by_split", "profile_metrics",
                                  "feature_upsert", "metric_violation", "choose_champion", "roc_points"])
def test_oracle_matches_small(spark, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    key = sorted(cols)

    def norm(rows, names):
        idx = [names.index(c) for c in key]
        return sorted((tuple(repr(r[i]) if not isinstance(r[i], float) else repr(round(r[i], 9)) for i in idx)
                       for r in rows), key=repr)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(cur.fetchall(), cols)
