import duckdb

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL

CHEAP = ["readings_classified", "temp_agg_1min", "window_agg_daily", "latest_reading_per_device",
         "temperature_stats_24h", "window_activity_7d", "window_cycles_first_close", "window_pair_counts",
         "quality_quarantine", "retention_metric", "retention_run", "replay_sample", "csv_load_counts", "temp_agg_1min_amended",
         "window_agg_hourly_amended", "bus_offset_summary", "window_cycles_stream_timers"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "reading_count" in df.columns


def test_every_query_has_an_oracle():
    from sensorlake.plans.catalog import QUERIES
    from sensorlake.plans.oracle import ORACLE
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_queries_match_duckdb_on_small_data(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    for name in CHEAP:
        got = entry_mod.queries()[name](spark, SF_SMALL).toPandas()
        exp = con.sql(entry_mod.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(exp.columns), name
        cols = sorted(got.columns)
        norm = lambda d: sorted(map(repr, d[cols].round(6).astype(str).itertuples(index=False)))
        assert norm(got) == norm(exp), name
