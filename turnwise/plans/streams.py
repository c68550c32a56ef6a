"""Queries that run a stream over the given tables to completion and return its output."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwise.plans import views as V
from turnwise.plans.activity import _flagged
from turnwise.plans.privacy import _redacted, docs, docs_of, text_records
from turnwise.plans.registry import query
from turnwise.session import scratch_path
from turnwise.streaming import jobs, ordered

_ST = V.STAMP.format


def _source(spark, sf, name):
    """A given table, one file or a folder of files, as a file stream.

    The file source takes a folder's path as the base of its partitions, which a single file cannot
    be; a pattern has no base, so the name is given as one that only this table matches.
    """
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def _stream(spark, sf, name, view):
    """A table as a stream in a view's shape, plus one closing row far in the future.

    The closing row drives the watermark past the last real row, so everything is emitted.
    """
    batch = view(V.table(spark, sf, name))
    closing = scratch_path(spark, "closing")
    blank = {"string": F.lit(""), "bigint": F.lit(-1).cast("bigint"), "boolean": F.lit(False)}
    batch.agg(F.max("ts").alias("ts")).select(
        *[(F.col("ts") + F.expr("INTERVAL 30 DAYS") if c == "ts" else blank[t]).cast(t).alias(c)
          for c, t in batch.dtypes]).write.parquet(closing)
    return view(_source(spark, sf, name)).unionByName(spark.readStream.schema(batch.schema).parquet(closing))


@query("r1_stream_sessions", f"""WITH {V.sessionized(1800)} SELECT namespace, user_id, session_id, {_ST('created_at')} AS created_at,
  {_ST('last_activity')} AS last_activity, events FROM sessions""")
def r1(spark, sf):
    out = jobs.run_available(jobs.stream_sessions(_stream(spark, sf, "events", V.activity_of), 1800), "sessions")
    return out.where("namespace <> ''").select("namespace", "user_id", "session_id", V.stamp("created_at"), V.stamp("last_activity"), "events")


@query("r2_stream_sessionize", f"WITH {V.sessionized(1800, forced=True, closing=True)} SELECT event_id, session_id FROM sessionized")
def r2(spark, sf):
    stream = _stream(spark, sf, "events", V.activity_of)
    out = ordered.run_ordered(spark, lambda write, state: ordered.stream_sessionize(
        stream, write, state, 1800, force_new=F.col("force_new"), close=F.col("is_close")), "sessionized")
    return out.where("event_id >= 0").select("event_id", "session_id")


@query("r3_stream_dedup_60s", f"WITH {_flagged(60)} SELECT id, is_duplicate FROM flagged")
def r3(spark, sf):
    stream = _stream(spark, sf, "documents", V.dups_of)
    out = ordered.run_ordered(spark, lambda write, state: ordered.stream_dedup(stream, write, state, "key"), "dedup")
    return out.where("id >= 0").select("id", "is_duplicate")


# Four deliveries by time; every tenth event comes with a later one, every fiftieth with the one after.
_DELIVERY = "CAST(floor((day(ts) - 1) / 8) AS BIGINT) + CASE WHEN event_id % 50 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END"


@query("r7_late_rows", f"""WITH d AS (SELECT event_id, ts, {_DELIVERY} AS delivery FROM events),
  seen AS (SELECT delivery, max(max(ts)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS watermark
           FROM d GROUP BY delivery),
  marked AS (SELECT event_id, delivery, watermark, coalesce(ts < watermark, false) AS late FROM d JOIN seen USING (delivery))
  SELECT delivery, late, {_ST('max(CASE WHEN late THEN watermark END)')} AS watermark, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids,
         min(event_id) AS first_id FROM marked GROUP BY delivery, late""")
def r7(spark, sf):
    """Events delivered in several loads, each a run of the same stream; late rows go to their own table."""
    source, state = scratch_path(spark, "deliveries"), scratch_path(spark, "late-state")
    kept, late = scratch_path(spark, "in-time"), scratch_path(spark, "late")
    events = V.table(spark, sf, "events").selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", f"{_DELIVERY} AS delivery")
    deliveries = [r[0] for r in events.select("delivery").distinct().orderBy("delivery").collect()]
    for number in [*deliveries, None]:
        # A last load far in the future lets all that waits go on.
        load = events.where(F.col("delivery") == number) if number is not None else events.agg(
            F.lit(-1).cast("bigint").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"), F.lit(-1).cast("bigint").alias("delivery"))
        load.write.parquet(f"{source}/load-{'end' if number is None else number}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(source)
        ordered.split_late(stream, ordered.into(kept), ordered.into(late), state, "ts", 2 * 86400).awaitTermination()
    in_time = spark.read.parquet(kept).select("event_id", "delivery", F.lit(False).alias("late"), F.lit(None).cast("timestamp").alias("watermark"))
    rejected = spark.read.parquet(late).select("event_id", "delivery", F.lit(True).alias("late"), "watermark")
    return in_time.unionByName(rejected).groupBy("delivery", "late").agg(
        F.max("watermark").alias("_w"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.min("event_id").alias("first_id")).select(
        "delivery", "late", V.stamp("_w", "watermark"), "n", "ids", "first_id")


def _calls(events):
    return events.where("event_type = 'view'").selectExpr(
        "ts", "concat('model', event_id % 3) AS model", "cast(floor(value) AS bigint) AS latency_ms", "event_id % 50 AS tokens")


@query("r6_stream_rollups", f"""SELECT {_ST("date_trunc('hour', ts)")} AS window_start, 'model' || (event_id % 3) AS model, count(*) AS calls,
  CAST(sum(event_id % 50) AS BIGINT) AS tokens, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS latency_ms, max(CAST(floor(value) AS BIGINT)) AS max_ms
  FROM events WHERE event_type = 'view' GROUP BY 1, 2""")
def r6(spark, sf):
    out = jobs.run_available(jobs.stream_rollups(_stream(spark, sf, "events", _calls), "1 hour"), "rollups")
    return out.where("model <> ''").withColumn("window_start", V.stamp("window_start"))


def _write_files(root: str, share: float = 1.0):
    """Of (path, line, value) sorted by path and line: one file per path below ``root``, its first bytes only.

    A file is written anew with what it held before and more, so a task that is run again leaves the same.
    """
    from turnwise.sources.growing import open_path

    def run(batches):
        import pyarrow as pa
        store, folder = open_path(root)
        now, body, paths, made = None, [], [], set()

        def close():
            if now is not None:
                data = "".join(f"{v or ''}\n" for v in body).encode()
                name = f"{folder}{now}"
                place = name.rsplit("/", 1)[0]
                if place not in made:
                    store.create_dir(place, recursive=True)
                    made.add(place)
                with store.open_output_stream(f"{name}.part") as out:
                    out.write(data[:int(len(data) * share)])
                store.move(f"{name}.part", name)
                paths.append(name)
        for batch in batches:
            for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                if path != now:
                    close()
                    now, body = path, []
                body.append(value)
        close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])
    return run


def _land_files(spark, lines, root, share=1.0):
    """Write (path, line, value) as files below ``root``.

    Writing a file costs the same however short it is, so the tasks are as many as the session's
    shuffle partitions; a number of its own would be merged by bytes into few.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines.select("path", "line", "value").repartition(tasks, "path").sortWithinPartitions("path", "line").mapInArrow(
        _write_files(root, share), "path string").write.format("noop").mode("overwrite").save()


@query("r4_stream_growing", f"""WITH {V.LINES}, l AS (SELECT session_id, line, role, text, conv_id,
    sum((role = 'user')::INT) OVER (PARTITION BY session_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS t FROM lines WHERE role IN ('user', 'assistant')),
  turns AS (SELECT session_id, t, count(*) FILTER (role = 'assistant') AS replies, max(t) OVER (PARTITION BY session_id) AS last,
    sum(length(text)) FILTER (role = 'user') AS asked FROM l WHERE t > 0 GROUP BY session_id, t)
  SELECT session_id, CAST(t AS BIGINT) AS turn_no, t = last AS is_open, CAST(asked AS BIGINT) AS asked FROM turns WHERE replies > 0""")
def r4_growing(spark, sf):
    """Transcript files that grow between runs of one stream, cut in the middle of lines."""
    from turnwise.operators.turns import group_turns
    from turnwise.sources.transcripts import parse_claude_lines
    root, state, out = scratch_path(spark, "transcripts"), scratch_path(spark, "growing-state"), scratch_path(spark, "growing-turns")
    group = lambda lines: group_turns(lines, "claude")
    for share in (0.6, 1.0):
        _land_files(spark, V.claude_raw(spark, sf), root, share)
        jobs.stream_growing(spark, root, parse_claude_lines, group, ordered.into(out), state, F.col("role") == "user").awaitTermination()
    asked = F.length(F.col("msg")[0]["content"]).cast("bigint").alias("asked")
    done = spark.read.parquet(out).select("session_id", "turn_no", F.lit(False).alias("is_open"), asked)
    rest = jobs.open_turns(spark, state, parse_claude_lines, group)
    return done.unionByName(rest.select("session_id", "turn_no", F.lit(True).alias("is_open"), asked))


@query("r4_stream_incremental", """WITH l AS (SELECT 'conv-' || conv_id AS session_id, turn, role,
    sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS t FROM conversations WHERE role IN ('user', 'assistant')),
  turns AS (SELECT session_id, t FROM l WHERE t > 0 GROUP BY session_id, t HAVING count(*) FILTER (role = 'assistant') > 0)
  SELECT session_id, count(*) AS turns FROM turns GROUP BY session_id""")
def r4(spark, sf):
    """Transcripts landed as files, picked up by a file stream, grouped into turns per micro-batch.

    A transcript is one file by its format, so landing one is one task's work; reading it is not.
    """
    from turnwise.operators.turns import group_turns
    from turnwise.sources.transcripts import parse_claude_lines
    land, out = scratch_path(spark, "transcripts"), scratch_path(spark, "turns")
    # A file per session in its project's folder; lines of no session are one too. The mark lets no name begin as a hidden one.
    named = F.coalesce(F.regexp_replace("path", "([^/]+)$", "session=$1"), F.lit("/session=__HIVE_DEFAULT_PARTITION__.jsonl"))
    _land_files(spark, V.claude_raw(spark, sf).withColumn("path", named), land)

    def parse(raw):
        return group_turns(parse_claude_lines(raw.withColumn("path", F.regexp_replace("path", "session=([^/]+)$", "$1"))), "claude")

    jobs.stream_incremental(spark, land, parse, lambda df, _: df.select("session_id", "turn_no").write.mode("append").parquet(out),
                            scratch_path(spark, "transcripts-state")).awaitTermination()
    return spark.read.parquet(out).groupBy("session_id").agg(F.count(F.lit(1)).alias("turns"))


@query("r5_stream_redact")
def r5(spark, sf):
    """Documents as a stream, redacted with the tenants' rules; the phone class keeps it from a SQL form."""
    return _stream_redacted(spark, sf, F.create_map().cast("map<string,boolean>"))


@query("r5_stream_redact_nophone", f"""SELECT doc_id, md5(regexp_replace({_redacted('text')}, 'the', '<the>', 'g')) AS redacted,
  CAST(1 AS INTEGER) AS anonymization_version FROM documents""")
def r5_nophone(spark, sf):
    """As above with the phone class off."""
    return _stream_redacted(spark, sf, F.create_map(F.lit("brazilian_phone"), F.lit(False)))


def _stream_redacted(spark, sf, toggles):
    rules = jobs.RulesCache(lambda: docs(spark, sf).select(
        F.col("namespace").alias("tenant"), F.lit(1).alias("version"), toggles.alias("toggles"),
        F.expr("array(named_struct('name', 'the', 'pattern', 'the', 'replacement', '<the>'))").alias("custom")).dropDuplicates(["tenant"]))
    out = scratch_path(spark, "redacted")
    stream = text_records(docs_of(_source(spark, sf, "documents")))
    jobs.stream_redact(stream, rules, lambda df, _: df.select(
        "doc_id", F.md5(F.try_variant_get(F.col("msg")[0]["content"], "$", "string")).alias("redacted"),
        "anonymization_version").write.mode("append").parquet(out), scratch_path(spark, "redact-state")).awaitTermination()
    return spark.read.parquet(out)
