import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from turnwise.operators import dedup as D

T0 = dt.datetime(2024, 1, 1)


def rows(spark, items):
    return spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(items)],
                                 "id bigint, key string, ts timestamp")


def test_sixty_second_rule(spark):
    df = rows(spark, [("k", 0), ("k", 30), ("k", 59), ("k", 119), ("k", 180), ("k", 480), ("other", 1), ("k", 0)])
    flags = {r.id: r.is_duplicate for r in D.dedup_within(df, "key").collect()}
    assert flags == {0: False, 1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: True}


def test_random_against_brute_force(spark):
    rnd = random.Random(2)
    items = [("hot" if rnd.random() < 0.4 else rnd.choice("abcdef"), rnd.randrange(20000)) for _ in range(700)]
    want, last = {}, {}
    for i in sorted(range(len(items)), key=lambda i: (items[i][1], i)):
        k, s = items[i]
        want[i] = k in last and s - last[k] <= 60
        last[k] = s
    got = {r.id: r.is_duplicate for r in D.dedup_within(rows(spark, items), "key").collect()}
    assert got == want
    assert D.drop_within(rows(spark, items), "key").count() == sum(not d for d in want.values())


def test_report_and_strict(spark):
    clean = D.dedup_within(rows(spark, [("a", 0)]), "key")
    assert D.dedup_report(clean, strict=True).first().asDict() == {"received": 1, "kept": 1, "dropped": 0, "all_duplicates": False}
    partial = D.dedup_within(rows(spark, [(f"k{min(i, 7)}", i) for i in range(10)]), "key")
    assert D.dedup_report(partial).first().dropped == 2
    with pytest.raises(D.RecordsDiscarded) as e:
        D.dedup_report(partial, strict=True)
    assert (e.value.dropped, e.value.inserted, e.value.received) == (2, 8, 10)
    gone = partial.where("is_duplicate")
    assert D.dedup_report(gone).first().all_duplicates


def test_content_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    assert df.select(D.content_key(F.col("x"), F.col("y")).alias("k")).distinct().count() == 2


def test_set_operations(spark):
    df = rows(spark, [("a", 0), ("a", 1), ("b", 2), ("c", 3)])
    assert {r.id for r in D.distinct_rows(df, "key", "id").collect()} == {0, 2, 3}
    stored = df.where("key = 'a'")
    assert {r.key for r in D.anti_join_existing(df, stored, "key").collect()} == {"b", "c"}
    assert {(r.key, r.change) for r in D.diff_loads(stored, df.where("key != 'a'"), "key").collect()} == {
        ("a", "gone"), ("b", "new"), ("c", "new")}
    assert {r.key for r in D.overlap_loads(stored, df, "key").collect()} == {"a"}


def brute_requests(reqs):
    """Request by request: who is fresh, who repeats, who conflicts."""
    out, live = {}, {}
    for i in sorted(range(len(reqs)), key=lambda i: (reqs[i][3], i)):
        tenant, key, body, at, ok = reqs[i]
        if not key:
            out[i] = ("fresh", None)
            continue
        orig = live.get((tenant, key))
        if orig is None or at >= orig[0] + 86400:
            out[i] = ("fresh", None)
            if ok:
                live[tenant, key] = (at, body, i)
        else:
            out[i] = ("replay" if orig[1] == body else "conflict", orig[2])
    return out


def requests(spark, reqs):
    return spark.createDataFrame([(i, t, k, b, T0 + dt.timedelta(seconds=s), ok) for i, (t, k, b, s, ok) in enumerate(reqs)],
                                 "id bigint, tenant string, request_key string, body_hash string, ts timestamp, is_ok boolean")


def test_idempotency_against_brute_force(spark):
    rnd = random.Random(4)
    reqs = [(rnd.choice("xy"), rnd.choice(["hot", "hot", "hot", "k1", "k2", None, ""]), rnd.choice(["b1", "b2"]),
             rnd.randrange(86400 * 4) // 3600 * 3600, rnd.random() < 0.7) for _ in range(300)]
    got = D.idempotency_classify(requests(spark, reqs), ok=F.col("is_ok"))
    assert {r.id: (r.outcome, r.original_id) for r in got.collect()} == brute_requests(reqs)


def test_idempotency_of_a_year_with_a_hot_key(spark):
    """A key with a third of all rows over a year: hundreds of originals, found in a few rounds."""
    rnd = random.Random(6)
    reqs = [("t", "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", rnd.choice(["b1", "b2"]),
             rnd.randrange(86400 * 365), rnd.random() < 0.9) for i in range(3000)]
    got = {r.id: (r.outcome, r.original_id) for r in D.idempotency_classify(requests(spark, reqs), ok=F.col("is_ok")).collect()}
    want = brute_requests(reqs)
    assert got == want and len({o for i, (_, o) in got.items() if i % 3 == 0}) > 150
