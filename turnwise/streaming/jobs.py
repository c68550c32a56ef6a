"""Structured Streaming forms of sessions, dedup, loading, redaction and roll-ups."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnwise.operators.redact import RulesNotReady, compile_rules, redact_messages
from turnwise.operators.sessions import known_keys, session_id
from turnwise.session import remove_path, scratch_path
from turnwise.sources.growing import read_growing_lines
from turnwise.sources.transcripts import file_stem


def stream_sessions(stream: DataFrame, timeout: float = 120, keys: Sequence[str] = ("namespace", "user_id"),
                    ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Inactivity sessions of a stream, emitted once the watermark passes their end.

    A session window merges events exactly one gap apart, where the batch form opens a new
    session, so the gap is a microsecond short of the timeout.
    """
    micros = int(round(timeout * 1_000_000)) - 1
    timed = (stream.withColumns({**known_keys(list(keys)), "_ts": F.col(ts).cast("timestamp")})
             .withWatermark("_ts", delay))
    sessions = timed.groupBy(*keys, F.session_window("_ts", f"{micros} microseconds")).agg(
        F.min("_ts").alias("created_at"), F.max("_ts").alias("last_activity"), F.count(F.lit(1)).alias("events"))
    return sessions.select(*keys, session_id([F.col(k) for k in keys], F.col("created_at")).alias("session_id"),
                           "created_at", "last_activity", "events")


def stream_rollups(stream: DataFrame, grain: str = "1 hour", slide: str | None = None, late: str = "10 minutes",
                   by: Sequence[str] = ("model",), ts: str = "ts") -> DataFrame:
    """Calls, tokens and latency per window; later rows than ``late`` are dropped and counted."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    window = F.window("_ts", grain, slide) if slide else F.window("_ts", grain)
    return timed.groupBy(window.alias("_w"), *by).agg(
        F.count(F.lit(1)).alias("calls"), F.sum("tokens").alias("tokens"),
        F.sum("latency_ms").alias("latency_ms"), F.max("latency_ms").alias("max_ms"),
    ).select(F.col("_w")["start"].alias("window_start"), *by, "calls", "tokens", "latency_ms", "max_ms")


def late_rows_dropped(query) -> int:
    """Rows a finished or running query dropped as too late, over the progress it still holds."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def run_available(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return its output as a table."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    query = (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def stream_incremental(spark: SparkSession, source: str, parse: Callable[[DataFrame], DataFrame],
                       write: Callable[[DataFrame, int], None], checkpoint: str, pattern: str = "*.jsonl"):
    """Parse transcript files that arrived since the last run and hand them to ``write``.

    For files that are complete when they arrive (immutable or rotated): the file source
    never reads a file twice. Growing files need :mod:`turnwise.operators.incremental`.
    """
    from turnwise.sources.transcripts import _ROW_IN_TASK, file_path
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_TASK))

    def batch(df: DataFrame, batch_id: int) -> None:
        raw = df.select("path", (F.col("block_start") + row).alias("line"), "value")
        write(parse(raw), batch_id)

    stream = (spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(source)
              .select(file_path(F.col("_metadata.file_path")).alias("path"),
                      F.col("_metadata.file_block_start").alias("block_start"), "value"))
    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _followed(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/open-{number:012d}"


def stream_growing(spark: SparkSession, source: str, parse: Callable[[DataFrame], DataFrame], group: Callable[[DataFrame], DataFrame],
                   write: Callable[[DataFrame, int], None], checkpoint: str, opens: Column, session: Column | None = None,
                   pattern: str = "*.jsonl", max_bytes: int = 1 << 33, split_bytes: int = 1 << 26):
    """Turns of transcripts that go on growing, each handed to ``write`` once it is complete.

    ``parse`` makes lines of (path, line, value), ``opens`` tells the lines that open a turn, and
    ``group`` makes turns with ``session_id`` and ``turn_no``; ``session`` is the session of a
    ``path``, the file's name if not given. A turn is complete when the next one opens. The lines of
    a session's last, open turn are written with the micro-batch's state and join the lines of the
    next one; nothing older is read again. Turn numbers go on over micro-batches. :func:`open_turns`
    gives the rest once no file grows any more.

    A folder of lines per micro-batch is all the state besides Spark's checkpoint and the log of
    admitted ranges below it; a replayed micro-batch replaces its own, and ``write`` must too.
    """
    checkpoint = checkpoint.rstrip("/")
    state = f"{checkpoint}/turns"
    session = file_stem(F.col("path")) if session is None else session

    def batch(df: DataFrame, number: int) -> None:
        held = df.select("path", "line", "value", session.alias("_session"), F.lit(0).cast("bigint").alias("_before"))
        schema = held.schema
        if number:
            held = held.unionByName(spark.read.schema(schema).parquet(_followed(state, number - 1)))
        path = f"{state}/lines-{number:012d}"
        held.write.mode("overwrite").parquet(f"{path}/held")
        held = spark.read.schema(schema).parquet(f"{path}/held")
        lines = parse(held.select("path", "line", "value"))
        # Per session: the line that opens its last turn, the turns opened here and those before.
        heads = lines.where(opens).groupBy(F.col("session_id").alias("_session")).agg(F.max("line").alias("_open"), F.count(F.lit(1)).alias("_opened"))
        heads = held.groupBy("_session").agg(F.max("_before").alias("_known")).join(heads, "_session")
        heads.write.mode("overwrite").parquet(f"{path}/heads")
        heads = spark.read.schema(heads.schema).parquet(f"{path}/heads")
        turns = group(lines).join(heads.withColumnRenamed("_session", "session_id"), "session_id").where("turn_no < _opened")
        write(turns.withColumn("turn_no", F.col("turn_no") + F.col("_known")).drop("_open", "_opened", "_known"), number)
        kept = held.join(heads, "_session", "left").where(F.col("_open").isNull() | (F.col("line") >= F.col("_open")))
        kept = kept.withColumn("_before", F.coalesce(F.col("_known") + F.col("_opened") - 1, F.col("_before")))
        kept.select(schema.names).write.mode("overwrite").parquet(_followed(state, number))
        remove_path(spark, path)
        if number >= 2:
            remove_path(spark, _followed(state, number - 2))

    stream = read_growing_lines(spark, source, f"{checkpoint}/files", pattern=pattern, maxBytesPerTrigger=max_bytes, splitBytes=split_bytes)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_turns(spark: SparkSession, checkpoint: str, parse: Callable[[DataFrame], DataFrame], group: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The turns that :func:`stream_growing` still holds back, for when no file grows any more."""
    state = f"{checkpoint.rstrip('/')}/turns"
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(state)
    number = names.agg(F.max(F.regexp_extract("path", "/open-([0-9]+)/", 1).try_cast("bigint"))).first()[0]
    held = spark.read.parquet(_followed(state, number))
    known = held.groupBy(F.col("_session").alias("session_id")).agg(F.max("_before").alias("_known"))
    turns = group(parse(held.select("path", "line", "value"))).join(known, "session_id")
    return turns.withColumn("turn_no", F.col("turn_no") + F.col("_known")).drop("_known")


class RulesCache:
    """Rules re-read at most every ``ttl`` seconds; the last good ones serve when a read fails.

    Rules that are too large to apply are an error, not a failed read: they are never ignored.

    Before the first good read nothing may pass: :class:`RulesNotReady` is raised.
    """

    def __init__(self, load: Callable[[], DataFrame], ttl: float = 300, clock: Callable[[], float] = time.monotonic):
        self._load, self._ttl, self._clock = load, ttl, clock
        self._rules: DataFrame | None = None
        self._read_at = 0.0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._rules is not None and now - self._read_at < self._ttl:
            return self._rules
        try:
            raw = self._load()
            # Read and compiled here, once; what is kept is a small local table.
            rules = compile_rules(raw.sparkSession, raw)
        except (PySparkException, OSError) as exc:
            if self._rules is None:
                raise RulesNotReady("rules were never loaded") from exc
            return self._rules
        self._rules, self._read_at = rules, now
        return rules


def stream_redact(stream: DataFrame, rules: RulesCache, write: Callable[[DataFrame, int], None], checkpoint: str,
                  tenant: str = "namespace"):
    """Redact each micro-batch with the rules of that moment, then hand it to ``write``."""
    def batch(df: DataFrame, batch_id: int) -> None:
        write(redact_messages(df, rules.get(), tenant), batch_id)
    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
