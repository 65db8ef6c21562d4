"""Every registered query that has a DuckDB statement, against it at sf0.001."""

from __spark_entry__ import oracle_sql
from compare import compare

from paths import SMALL


def test_all_queries_match_duckdb(spark):
    res = compare(spark, SMALL, keys=sorted(oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad
    assert len(res) >= 70


def test_user_dimensions_cover_the_whole_events_table(spark):
    from audival.plans.queries import registry
    rows = registry()["report_users_all_days"](spark, SMALL).collect()
    assert sum(r["eventCount"] for r in rows) == spark.read.parquet(f"{SMALL}/events.parquet").count()
    got = compare(spark, SMALL, keys=["report_users", "report_users_all_days"], verbose=False)
    assert len(got) == 2 and all(v.startswith("ok") for v in got.values()), got
