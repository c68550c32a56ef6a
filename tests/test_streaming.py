import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from turnwise.operators import dedup as D, sessions as S
from turnwise.operators.redact import RULES_DDL, RulesNotReady
from turnwise.streaming import jobs, ordered

T0 = dt.datetime(2024, 1, 1)
DDL = "event_id bigint, namespace string, user_id string, ts timestamp, force_new boolean, is_close boolean"


def land(spark, path, batches, ddl):
    """One file per micro-batch, in order, with a closing row far ahead in the last one."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{path}/b{i:02d}")


def stream(spark, path, ddl):
    return (spark.readStream.schema(ddl).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
            .parquet(str(path)))


def _batches(seed, n=240):
    """Events in three batches; within and across batches they are out of order by up to 5 minutes."""
    rnd = random.Random(seed)
    rows = [(i, "n", rnd.choice(["hot", "hot", "a", "b", None, ""]), T0 + dt.timedelta(seconds=rnd.randrange(1, 6000)),
             rnd.random() < 0.05, rnd.random() < 0.05) for i in range(n)]
    rows.sort(key=lambda r: r[3] + dt.timedelta(seconds=rnd.randrange(300)))
    third = n // 3
    out = [rows[:third], rows[third:2 * third], rows[2 * third:]]
    out.append([(-1, "", "", T0 + dt.timedelta(days=30), False, False)])
    return rows, out


def _sessionized(spark, path, **more):
    return ordered.run_ordered(spark, lambda write, state: ordered.stream_sessionize(
        stream(spark, path, DDL), write, state, 60, force_new=F.col("force_new"), close=F.col("is_close"), **more), "t")


def test_sessionize_equals_batch_out_of_order(spark, tmp_path):
    rows, batches = _batches(1)
    land(spark, tmp_path / "in", batches, DDL)
    got = {r.event_id: r.session_id for r in _sessionized(spark, tmp_path / "in").where("event_id >= 0").collect()}
    want = S.sessionize(spark.createDataFrame(rows, DDL), 60, force_new=F.col("force_new"), close=F.col("is_close"))
    assert got == {r.event_id: r.session_id for r in want.collect()}


def test_state_is_forgotten(spark, tmp_path):
    ddl = "id bigint, key string, ts timestamp"
    land(spark, tmp_path / "in", [[(i, f"k{i}", T0 + dt.timedelta(seconds=1 + i)) for i in range(50)],
                                  [(98, "x", T0 + dt.timedelta(days=1))], [(99, "y", T0 + dt.timedelta(days=2))]], ddl)
    ordered.stream_dedup(stream(spark, tmp_path / "in", ddl), ordered.into(str(tmp_path / "out")), str(tmp_path / "c"), "key").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).where("id < 50").count() == 50
    folders = sorted(p.name for p in (tmp_path / "c" / "ordered").iterdir() if not p.name.startswith("."))
    assert len(folders) == 2  # what a replay needs, and no more
    assert spark.read.parquet(str(tmp_path / "c" / "ordered" / folders[-1] / "carried")).count() <= 1
    assert spark.read.parquet(str(tmp_path / "c" / "ordered" / folders[-1] / "waiting")).count() == 1


def test_hot_key_is_spread(spark, tmp_path):
    """A key with a third of all rows is cut into blocks: no task has all of it, and no Python runs."""
    rows = [(i, "n", "hot" if i % 3 == 0 else f"u{i % 97}", T0 + dt.timedelta(seconds=i * 20), False, False) for i in range(9000)]
    land(spark, tmp_path / "in", [rows, [(-1, "", "", T0 + dt.timedelta(days=30), False, False)]], DDL)
    seen = []

    def write(df, number):
        df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={number}")
        parts = df.where("user_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append(([p["count"] for p in parts], "Python" in plan or "Pandas" in plan or "Arrow" in plan))
    ordered.stream_sessionize(stream(spark, tmp_path / "in", DDL), write, str(tmp_path / "c"), 60).awaitTermination()
    got = {r.event_id: r.session_id for r in spark.read.parquet(f"{tmp_path}/out").where("event_id >= 0").collect()}
    want = S.sessionize(spark.createDataFrame(rows, DDL), 60)
    assert got == {r.event_id: r.session_id for r in want.collect()}
    assert not any(python for _, python in seen)


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    """Batches in runs of their own; one fails after its output and is replayed."""
    rows, batches = _batches(5)
    out, failing = str(tmp_path / "out"), [True]

    def write(df, number):
        ordered.into(out)(df, number)
        if number == 1 and failing.pop():
            raise RuntimeError("lost")
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, DDL).coalesce(1).write.parquet(f"{tmp_path}/in/b{i:02d}")
        for attempt in range(2 if i == 1 else 1):
            if i == 1 and attempt == 0:
                failing[:] = [True]
            query = ordered.stream_sessionize(stream(spark, tmp_path / "in", DDL), write, str(tmp_path / "c"), 60,
                                              force_new=F.col("force_new"), close=F.col("is_close"))
            try:
                query.awaitTermination()
            except Exception as lost:
                assert "lost" in str(lost)
            failing[:] = [False]
    got = [(r.event_id, r.session_id) for r in spark.read.parquet(out).where("event_id >= 0").collect()]
    want = S.sessionize(spark.createDataFrame(rows, DDL), 60, force_new=F.col("force_new"), close=F.col("is_close"))
    assert sorted(got) == sorted((r.event_id, r.session_id) for r in want.collect())


def test_late_rows_get_a_table_of_their_own(spark, tmp_path):
    ddl = "id bigint, key string, ts timestamp"
    at = lambda m: T0 + dt.timedelta(minutes=m)
    land(spark, tmp_path / "in", [[(1, "a", at(0)), (2, "a", at(60))], [(3, "a", at(49)), (4, "a", at(50)), (5, "a", None)],
                                  [(6, "a", at(10)), (7, "a", at(9999))]], ddl)
    kept, late = str(tmp_path / "kept"), str(tmp_path / "late")
    ordered.split_late(stream(spark, tmp_path / "in", ddl), ordered.into(kept), ordered.into(late), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(kept).collect()) == [1, 2, 4]
    got = {r.id: r.watermark for r in spark.read.parquet(late).collect()}
    assert got == {3: at(50), 5: at(50), 6: at(50)}


def test_sessions_equal_batch(spark, tmp_path):
    rows, batches = _batches(2)
    # A gap of exactly the timeout must split here too.
    extra = [(900, "n", "z", T0, False, False), (901, "n", "z", T0 + dt.timedelta(seconds=60), False, False)]
    batches[0] = batches[0] + extra
    land(spark, tmp_path / "in", batches, DDL)
    got = jobs.run_available(jobs.stream_sessions(stream(spark, tmp_path / "in", DDL), 60), "t").where("user_id <> ''")
    want = S.sessions_table(S.sessionize(spark.createDataFrame(rows + extra, DDL), 60))
    cols = ["namespace", "user_id", "session_id", "created_at", "last_activity", "events"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()


def test_dedup_equals_batch(spark, tmp_path):
    rnd = random.Random(3)
    ddl = "id bigint, key string, ts timestamp"
    rows = [(i, rnd.choice(["hot", "hot", "a", "b", "c"]), T0 + dt.timedelta(seconds=rnd.randrange(1, 9000))) for i in range(200)]
    shuffled = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rnd.randrange(300)))
    land(spark, tmp_path / "in", [shuffled[:90], shuffled[90:], [(-1, "", T0 + dt.timedelta(days=30))]], ddl)
    got = ordered.run_ordered(spark, lambda write, state: ordered.stream_dedup(
        stream(spark, tmp_path / "in", ddl), write, state, "key"), "t").where("id >= 0")
    want = D.dedup_within(spark.createDataFrame(rows, ddl), "key")
    assert {r.id: r.is_duplicate for r in got.collect()} == {r.id: r.is_duplicate for r in want.collect()}


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    ddl = "model string, latency_ms bigint, tokens bigint, ts timestamp"
    at = lambda m: T0 + dt.timedelta(minutes=m)
    land(spark, tmp_path / "in", [[("m", 1, 1, at(5)), ("m", 2, 2, at(200))], [("m", 4, 4, at(300))], [("m", 8, 8, at(6))],
                                  [("", 0, 0, at(9999))]], ddl)
    out = jobs.stream_rollups(stream(spark, tmp_path / "in", ddl), "1 hour", late="10 minutes")
    query = (out.writeStream.format("memory").queryName("late").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = {str(r.window_start): r.tokens for r in spark.table("late").where("model = 'm'").collect()}
    assert got == {"2024-01-01 00:00:00": 1, "2024-01-01 03:00:00": 2, "2024-01-01 05:00:00": 4}
    assert jobs.late_rows_dropped(query) == 1


def test_incremental_files(spark, tmp_path):
    from test_transcripts import TEXT, reply, user, write
    from turnwise.operators.turns import group_turns
    from turnwise.sources.transcripts import parse_claude_lines
    src, seen = tmp_path / "in", []

    def run():
        jobs.stream_incremental(spark, str(src), lambda raw: group_turns(parse_claude_lines(raw), "claude"),
                                lambda df, _: seen.extend(r.session_id for r in df.collect()), str(tmp_path / "c")).awaitTermination()
    write(src / "p" / "one.jsonl", user("q"), reply(TEXT))
    run()
    write(src / "p" / "two.jsonl", user("q"), reply(TEXT), user("q"), reply(TEXT))
    run()
    assert seen == ["one", "two", "two"]


def test_rules_cache(spark):
    rules = spark.createDataFrame([("n", 1, {}, [])], RULES_DDL)
    now, fail, reads = [0.0], [True], [0]

    def load():
        reads[0] += 1
        if fail[0]:
            raise OSError("down")
        return rules
    cache = jobs.RulesCache(load, ttl=300, clock=lambda: now[0])
    with pytest.raises(RulesNotReady):
        cache.get()
    fail[0] = False
    first = cache.get()
    now[0] = 299
    assert cache.get() is first and reads[0] == 2
    now[0], fail[0] = 301, True
    assert cache.get() is first and reads[0] == 3
    fail[0] = False
    assert cache.get() is not first
