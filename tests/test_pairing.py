import random

from pyspark.sql import functions as F

from sensorlake.operators.ordered import later_targets
from sensorlake.operators.pairing import first_close_pairs, pair_pattern_counts
from tests.conftest import ts

SCHEMA = "event_id long, object_code int, object_name string, event_type string, event_timestamp timestamp"


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, code, f"window_{code}", kind, ts(t)) for i, (code, kind, t) in enumerate(rows)], SCHEMA)


def test_first_close_and_all_pairs_counts(spark):
    ev = _events(spark, [
        (1, "opened", "2024-01-01 10:00:00"),
        (1, "opened", "2024-01-01 10:01:00"),
        (1, "closed", "2024-01-01 10:02:00"),
        (1, "closed", "2024-01-01 10:40:00"),
    ])
    pairs = sorted((r.opened_at.minute, r.closed_at.minute) for r in first_close_pairs(ev).collect())
    assert pairs == [(0, 2), (1, 2)]
    counts = {r.usage_pattern: (r.pair_count, r.unusual_count) for r in pair_pattern_counts(ev).collect()}
    # all pairs: 10:00-10:02, 10:00-10:40, 10:01-10:02, 10:01-10:40
    assert counts == {"BRIEF_OPENING": (2, 0), "MEDIUM_OPENING": (2, 0)}


def test_same_instant_never_pairs_and_subsecond_is_zero(spark):
    ev = _events(spark, [
        (2, "opened", "2024-01-01 10:00:00"),
        (2, "closed", "2024-01-01 10:00:00"),
        (3, "opened", "2024-01-01 00:00:10.200000"),
        (3, "closed", "2024-01-01 00:00:10.900000"),
    ])
    rows = first_close_pairs(ev).collect()
    assert [(r.object_code, r.duration_seconds) for r in rows] == [(3, 0)]


def test_end_before_start_gives_no_pair(spark):
    ev = _events(spark, [(4, "opened", "2024-01-01 23:30:00"), (4, "closed", "2024-01-01 00:30:00")])
    assert first_close_pairs(ev).count() == 0


def test_unusual_boundary(spark):
    ev = _events(spark, [
        (5, "opened", "2024-01-01 00:00:00"),
        (5, "closed", "2024-01-01 05:00:00"),     # exactly 300 min: not unusual
        (6, "opened", "2024-01-01 00:00:00"),
        (6, "closed", "2024-01-01 05:00:01"),     # 300.0166 min: unusual
    ])
    got = {r.object_code: r.is_unusual for r in first_close_pairs(ev).collect()}
    assert got == {5: False, 6: True}
    counts = {(r.object_code, r.usage_pattern): r.unusual_count for r in pair_pattern_counts(ev).collect()}
    assert counts == {(5, "LONG_OPENING"): 0, (6, "LONG_OPENING"): 1}


def test_later_targets_matches_brute_force_with_hot_key(spark):
    """One key holds most rows and spans many range partitions; ties included."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if rnd.random() < 0.6 else rnd.randint(1, 20)
        rows.append((key, rnd.randint(0, 400), i, rnd.random() < 0.5))
    probes = spark.createDataFrame([(k, o, i) for k, o, i, p in rows if p], "k int, o long, pid long")
    targets = spark.createDataFrame([(k, o, i) for k, o, i, p in rows if not p], "k int, o long, pid long")
    got = {r.pid: (r.later_count, r.later_min)
           for r in later_targets(probes, targets, ["k"], "o", tie="pid", n_partitions=11).collect()}
    tgt = [(k, o) for k, o, i, p in rows if not p]
    for k, o, i, p in rows:
        if not p:
            continue
        later = [to for tk, to in tgt if tk == k and to > o]
        assert got[i] == (len(later), min(later) if later else None), (k, o, i)


def test_pair_counts_match_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(400):
        code = rnd.choice([1, 1, 1, 2, 3])
        kind = rnd.choice(["opened", "closed"])
        sec = rnd.randint(0, 6 * 3600 * 3)
        rows.append((code, kind, f"2024-01-01 00:00:00.{rnd.randint(0, 999999):06d}", sec))
    ev = spark.createDataFrame(
        [(i, c, f"window_{c}", k, ts(t), s) for i, (c, k, t, s) in enumerate(rows)],
        SCHEMA + ", s long").withColumn("event_timestamp", F.col("event_timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.col("s"))).drop("s")
    local = [(r.object_code, r.event_type, r.event_timestamp) for r in ev.collect()]
    expect = {}
    for c1, k1, t1 in local:
        if k1 != "opened":
            continue
        for c2, k2, t2 in local:
            if k2 == "closed" and c2 == c1 and t2 > t1:
                d = int(t2.timestamp() // 1) - int(t1.timestamp() // 1)
                m = d / 60
                pat = ("BRIEF_OPENING" if m < 5 else "SHORT_OPENING" if m < 30
                       else "MEDIUM_OPENING" if m < 120 else "LONG_OPENING")
                n, u = expect.get((c1, pat), (0, 0))
                expect[(c1, pat)] = (n + 1, u + (m > 300))
    got = {(r.object_code, r.usage_pattern): (r.pair_count, r.unusual_count)
           for r in pair_pattern_counts(ev, n_partitions=5).collect()}
    assert got == expect


def test_one_key_with_all_rows_is_spread_over_partitions(spark):
    """The skew claim: a single object holding every event is split by the range bounds."""
    from sensorlake.operators.ordered import scan_table
    ev = spark.range(20000).select(
        F.col("id").alias("event_id"), F.lit(7).alias("object_code"),
        (F.col("id") * 1000).alias("_us"), (F.col("id") % 2 == 0).alias("is_open"))
    opens = ev.filter("is_open").select("object_code", "_us", "event_id")
    closes = ev.filter("not is_open").select("object_code", "_us", "event_id")
    table = scan_table(opens, closes, ["object_code"], "_us", tie="event_id", n_partitions=8)
    sizes = [r["count"] for r in table.filter("_k = 1").groupBy("_pid").count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 0.3 * sum(sizes)
    got = {r.event_id: (r.later_count, r.later_min)
           for r in later_targets(opens, closes, ["object_code"], "_us", tie="event_id", n_partitions=8)
           .filter("event_id in (0, 9998, 19998)").collect()}
    assert got == {0: (10000, 1000), 9998: (5001, 9999000), 19998: (1, 19999000)}
