import random

from pyspark.sql import Window, functions as F

from turnwise.operators import query as Q
from turnwise.operators.scan import blocked_scan, exact_percentiles, line_block, lookup_join, solid_join, value_counts


def _rows(seed, n=600):
    rnd = random.Random(seed)
    # One key holds a third of the rows; null keys and gaps in the numbering occur.
    rows, used = [], set()
    for _ in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None, ""])
        line = rnd.randrange(5000)
        if (key, line) in used:
            continue
        used.add((key, line))
        rows.append((key, line, rnd.randrange(10), rnd.choice([None, "x", "y"])))
    return rows


def test_scan_equals_plain_window(spark):
    for seed in (1, 2):
        df = spark.createDataFrame(_rows(seed), "k string, line bigint, v int, s string").repartition(5)
        w = Window.partitionBy("k").orderBy("line")
        want = df.withColumns({"total": F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                               "prev_line": F.lag("line").over(w), "prev_s": F.lag("s").over(w)})
        for size in (1, 37, 10**6):
            got = blocked_scan(df, ["k"], line_block(F.col("line"), size), ["line"], sums={"total": F.col("v")},
                               prev={"prev_line": "line", "prev_s": "s"})
            assert got.count() == df.count()
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_scan_splits_a_hot_key_over_blocks(spark):
    """No window of the plan is partitioned by the key alone over the raw rows."""
    df = spark.range(1000).selectExpr("'hot' AS k", "id AS line", "1 AS v")
    got = blocked_scan(df, ["k"], line_block(F.col("line"), 100), ["line"], sums={"n": F.col("v")})
    assert got.where("n != line + 1").count() == 0
    sizes = df.groupBy("k", line_block(F.col("line"), 100)).count()
    assert sizes.agg(F.max("count")).first()[0] == 100


def test_exact_percentiles(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", None]), rnd.randrange(3000)) for _ in range(501)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    got = {r.k: (r.p50, r.p95) for r in exact_percentiles(value_counts(df, ["k"], "v"), ["k"], "v", {"p50": 0.5, "p95": 0.95}, 100).collect()}
    import math
    for key in ("a", None):
        vals = sorted(v for k, v in rows if k == key)
        assert got[key] == tuple(vals[math.ceil(len(vals) * p) - 1] for p in (0.5, 0.95))


def test_joins(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    assert {(r.k, r.a, r.b) for r in solid_join(a, b, ["k"], "left").collect()} == {(None, 1, 10), ("x", 2, 20), ("y", 3, None)}
    for cap in (0, 10**6):
        assert {(r.a, r.b) for r in lookup_join(a, b, ["k"], max_broadcast_bytes=cap).collect()} == {(1, None), (2, 20), (3, None)}


def test_paginate_and_keyset(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(0, 7200)) for i in range(230)]
    df = spark.createDataFrame(rows, "id bigint, s bigint").select("id", F.timestamp_seconds(F.lit(1700000000) + F.col("s")).alias("inserted_at"))
    want = [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    paged = Q.paginate(df, 50).orderBy("row_no").collect()
    assert [r.id for r in paged] == want
    assert [r.page for r in paged] == [n // 50 for n in range(230)]
    seen, after = [], None
    while True:
        page = Q.next_page(df, 50, after).collect()
        if not page:
            break
        seen += [r.id for r in page]
        after = (page[-1].inserted_at, page[-1].id)
    assert seen == want
