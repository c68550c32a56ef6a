"""Deep pages, long sessions, stored partitions, stored sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from turnwise.operators import query as Q, redact as O, rollups as G, sessions as S

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    rnd = random.Random(2)
    times = [T0 + dt.timedelta(days=rnd.randrange(3), milliseconds=rnd.randrange(4000)) for _ in range(300)] + [T0] * 200 + [None] * 50
    rows = [(i, "n", t, "x") for i, t in enumerate(times)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id bigint, namespace string, inserted_at timestamp, _range string")


@pytest.mark.parametrize("offset", [0, 1, 250, 299, 300, 420, 499, 500, 520, 549, 550, 9999])
def test_deep_page_is_the_sorted_page(spark, records, offset):
    rows, df = records
    order = sorted(rows, key=lambda r: (r[2] is None, -(r[2] - T0).total_seconds() if r[2] else 0, r[0]))
    got = [r.id for r in Q.deep_page(df, "inserted_at", "id", 40, offset).collect()]
    assert got == [r[0] for r in order[offset:offset + 40]]


def test_deep_offsets_are_counted_not_sorted(spark, records, monkeypatch):
    rows, df = records
    monkeypatch.setattr(Q, "NEAR_ROWS", 100)
    page, total = Q.query_records(df, "n", limit=20, offset=270)
    assert "TakeOrderedAndProject" not in page._jdf.queryExecution().executedPlan().toString()
    near = df.orderBy(F.col("inserted_at").desc(), "id").offset(270).limit(20)
    assert [r.id for r in page.collect()] == [r.id for r in near.collect()] and total.first()[0] == 550


def _sessions(spark, rows):
    return spark.createDataFrame(rows, "namespace string, user_id string, session_id string, created_at timestamp, last_activity timestamp")


def test_a_session_of_any_length_is_one_row_or_two(spark):
    lengths = [dt.timedelta(0), dt.timedelta(seconds=59), dt.timedelta(hours=1), dt.timedelta(hours=2), dt.timedelta(days=1), dt.timedelta(days=365),
               dt.timedelta(days=365 * 30)]
    rows = [("n", f"u{i}", f"s{i}", T0 + dt.timedelta(minutes=7 * i), T0 + dt.timedelta(minutes=7 * i) + length) for i, length in enumerate(lengths)]
    cells = S.session_cells(_sessions(spark, rows), F.unix_micros("created_at"), F.unix_micros("last_activity"))
    assert all(r["count"] <= 2 for r in cells.groupBy("session_id").count().collect())
    assert cells.select("session_id").distinct().count() == len(lengths)


@pytest.mark.parametrize("timeout", [0, 30])
def test_events_meet_sessions_of_mixed_lengths(spark, timeout):
    rnd = random.Random(timeout)
    rows, k = [], 0
    for user in ("hot", "b", None):
        at = T0
        for length in [0, 10, 3600, 7200, 86400 * 3, 86400 * 400, 5, 90000]:
            rows.append(("n", user, f"s{k}", at, at + dt.timedelta(seconds=length)))
            at += dt.timedelta(seconds=length + 100 + rnd.randrange(5000))
            k += 1
    end = max(r[4] for r in rows)
    events = [(i, "n", rnd.choice(["hot", "hot", "b", None, "other"]), T0 + dt.timedelta(seconds=rnd.randrange(int((end - T0).total_seconds()) + 500)))
              for i in range(400)]
    events += [(1000 + i, "n", r[1], t) for i, (r, t) in enumerate((r, t) for r in rows for t in (
        r[3], r[4], r[4] + dt.timedelta(seconds=29.999999), r[4] + dt.timedelta(seconds=30), r[3] - dt.timedelta(microseconds=1)))]
    got = S.attach_session(spark.createDataFrame(events, "event_id bigint, namespace string, user_id string, ts timestamp"), _sessions(spark, rows), timeout=timeout)
    want = {}
    for i, _, user, ts in events:
        want[i] = next((r[2] for r in rows if r[1] == user and r[3] <= ts and (ts < r[4] + dt.timedelta(seconds=30) if timeout else ts <= r[4])), None)
    assert {r.event_id: r.session_id for r in got.collect()} == want


def test_only_drifted_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "stored")
    rows = [("a", "2024-01-01", 1, 2, "secret one"), ("a", "2024-01-01", 2, 2, "two"), ("a", "2024-01-02", 3, 1, "secret three"), ("a", "2024-01-02", 4, 3, "secret four"),
            ("b", "2024-01-01", 5, 0, "secret five"), ("c", "2024-01-01", 6, None, "secret six")]
    df = spark.createDataFrame(rows, "namespace string, dt string, id int, anonymization_version int, text string").withColumn("dt", F.to_date("dt"))
    df.write.partitionBy("namespace", "dt").parquet(path)
    rules = O.compile_rules(spark, spark.createDataFrame([("a", 2, {}, [("s", "secret", "<s>")]), ("b", 0, {}, [("s", "secret", "<s>")])], O.RULES_DDL))
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "stored").rglob("*.parquet")}
    before = files()
    done = O.reapply_stored(spark, path, rules, message="text")
    assert [(r.namespace, str(r.dt)) for r in done.collect()] == [("a", "2024-01-02")]
    after = files()
    untouched = {p for p in before if "a/dt=2024-01-02" not in str(p)}
    assert all(after[p] == before[p] for p in untouched) and not any(p in after for p in set(before) - untouched)
    got = {r.id: (r.text, r.anonymization_version) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("secret one", 2), 2: ("two", 2), 3: ("<s> three", 2), 4: ("secret four", 3), 5: ("secret five", 0), 6: ("secret six", None)}
    assert O.reapply_stored(spark, path, rules, message="text").count() == 0


def test_merged_sketches_stay_within_their_error(spark):
    calls = spark.range(200000).selectExpr("timestamp_micros(1704067200000000 + id * 860000) AS ts", "'m' AS model",
                                           "IF(id % 10 = 0, NULL, CAST(pow(id % 9973, 1.3) AS BIGINT)) AS latency_ms")
    hourly = G.latency_sketches(calls)
    assert hourly.agg(F.max(F.length("sketch"))).first()[0] < 20000
    probs = {f"p{p}": p / 100 for p in (1, 25, 50, 90, 99)}
    merged = G.merge_latency(hourly, "30 days", probs=probs).collect()
    values = sorted(r.latency_ms for r in calls.where("latency_ms IS NOT NULL").collect())
    assert sum(r.calls for r in merged) == 200000 and len(merged) == 1
    for name, p in probs.items():
        import bisect
        low, high = (f(values, merged[0][name]) / len(values) for f in (bisect.bisect_left, bisect.bisect_right))
        assert low <= p + 0.01 and high >= p - 0.01
    nothing = G.merge_latency(G.latency_sketches(calls.where("latency_ms IS NULL").limit(5)), "30 days").first()
    assert nothing.p50_ms is None and nothing.calls == 5


def test_user_sketches_unite_and_intersect(spark):
    rows = spark.range(60000).selectExpr("timestamp_micros(1704067200000000 + id * 10000000) AS ts", "concat('u', id % 20000) AS external_user_id", "concat('c', id % 2) AS channel")
    daily = G.user_sketches(rows)
    got = {r.channel: r.users for r in G.distinct_users(daily, ["channel"]).collect()}
    assert all(abs(n / 10000 - 1) < 0.07 for n in got.values())
    a, b = (G.user_sketches(rows.where(w).withColumn("channel", F.lit("all"))) for w in ("id < 15000", "id >= 10000 AND id < 20000"))
    assert abs(G.shared_users(a, b, ["channel"]).first().users / 5000 - 1) < 0.1
    few = G.user_sketches(rows.where("id % 20000 < 50").withColumn("channel", F.lit("few")))
    assert G.distinct_users(few, ["channel"]).first().users == 50
