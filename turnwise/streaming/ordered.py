"""Ordered work on streams: per-event sessions, exact 60-second dedup, rows that come too late.

Rows of a key reach a micro-batch in any order. They wait in a written table until the
watermark has passed them; then all that may precede them is known, and the batch operators
decide on them, which cut every key into time blocks. What one micro-batch hands to the next is
one row per key, dropped as soon as nothing that can still come is affected by it. So a key
with a third of all rows is spread over tasks like in a batch job, nothing is held in Python,
and no key's rows are ever one list.

State is a folder per micro-batch: waiting rows, carried rows and the watermark. A micro-batch
reads the folder of the one before and writes its own anew, so a replay after a failure comes
to the same state and output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnwise.operators.dedup import dedup_within
from turnwise.operators.sessions import known_keys, session_id, sessionize
from turnwise.session import remove_path, scratch_path

Write = Callable[[DataFrame, int], None]

FAR_PAST = -(2**62)


class Ready(NamedTuple):
    """Rows of a micro-batch that the watermark has passed, what was carried, and the watermark."""

    rows: DataFrame
    carried: DataFrame | None
    watermark: int
    folder: str

    def once(self, df: DataFrame) -> DataFrame:
        """``df`` written with the micro-batch's state, since it is both handed out and carried from."""
        df.write.mode("overwrite").parquet(f"{self.folder}/done")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.folder}/done")


def into(path: str) -> Write:
    """A writer of one folder per micro-batch below ``path``; a replayed one replaces its own."""
    return lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def start_ordered(stream: DataFrame, ts: str, delay: float, checkpoint: str,
                  step: Callable[[Ready, int], DataFrame | None], late: Write | None = None):
    """Run ``step`` on each micro-batch's ready rows; it returns the rows to carry on.

    The watermark is the largest time seen in earlier micro-batches and this one less ``delay``
    seconds. A row older than the watermark that the micro-batch before ended with is late: it
    goes to ``late`` if that is given and is left out of the rest. A row without a time is late.
    """
    micros = int(round(delay * 1_000_000))
    state = f"{checkpoint.rstrip('/')}/ordered"

    def folder(batch: int) -> str:
        return f"{state}/batch-{batch:012d}"

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        timed = df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
        before, waiting, carried = FAR_PAST, None, None
        if number:
            before = spark.read.parquet(f"{folder(number - 1)}/watermark").first()[0]
            waiting = spark.read.schema(timed.schema).parquet(f"{folder(number - 1)}/waiting")
            carried = spark.read.parquet(f"{folder(number - 1)}/carried")
        in_time = F.coalesce(F.col("_at") >= F.lit(before), F.lit(False))
        if late is not None:
            late(timed.where(~in_time).withColumn("watermark", F.when(F.lit(before) > F.lit(FAR_PAST), F.timestamp_micros(F.lit(before)))).drop("_at"), number)
        # The waiting rows are written first: they are read for the watermark, the release and what waits on.
        fresh = timed.where(in_time)
        held = fresh if waiting is None else waiting.unionByName(fresh)
        path = f"{folder(number)}/held"
        held.write.mode("overwrite").parquet(path)
        held = spark.read.schema(timed.schema).parquet(path)
        latest = held.agg(F.max("_at")).first()[0]
        now = before if latest is None else max(before, latest - micros)
        ready = held.where(F.col("_at") < F.lit(now))
        keep = step(Ready(ready, carried, now, folder(number)), number)
        (keep if keep is not None else spark.createDataFrame([], "nothing int")).write.mode("overwrite").parquet(f"{folder(number)}/carried")
        held.where(F.col("_at") >= F.lit(now)).write.mode("overwrite").parquet(f"{folder(number)}/waiting")
        spark.range(1).select(F.lit(now).cast("bigint").alias("watermark")).write.mode("overwrite").parquet(f"{folder(number)}/watermark")
        remove_path(spark, path)
        if number >= 2:
            # A replay needs the folder before its own only.
            remove_path(spark, folder(number - 2))

    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_sessionize(stream: DataFrame, write: Write, checkpoint: str, timeout: float = 120,
                      keys: Sequence[str] = ("namespace", "user_id"), ts: str = "ts", tie: str = "event_id",
                      force_new: Column | None = None, close: Column | None = None, delay: float = 600,
                      late: Write | None = None):
    """Hand every event with its session to ``write``, as :func:`turnwise.operators.sessions.sessionize`.

    Rows written: the keys, ``tie``, ``ts`` and ``session_id``.
    """
    keys = list(keys)
    micros = int(round(timeout * 1_000_000))
    flags = {"_force": force_new, "_close": close}
    rows = stream.select(*[c.alias(k) for k, c in known_keys(keys).items()], F.col(ts).cast("timestamp").alias(ts), F.col(tie).cast("bigint").alias(tie),
                         *[F.coalesce(F.lit(False) if c is None else c, F.lit(False)).alias(n) for n, c in flags.items()])

    def step(ready: Ready, number: int) -> DataFrame:
        events = ready.rows.drop("_at").withColumn("_carried", F.lit(False))
        if ready.carried is not None:
            # A key's last event so far goes before its new ones and opens nothing anew.
            last = ready.carried.select(*keys, ts, tie, F.lit(False).alias("_force"), "_close", F.lit(True).alias("_carried"))
            events = events.unionByName(last)
        done = sessionize(events, timeout, keys, ts, tie, F.col("_force"), F.col("_close"))
        if ready.carried is not None:
            # What continues the carried event's session started where that one did.
            begun = ready.carried.select(*keys, F.col("_start").alias("_begun"))
            done = done.join(begun, keys, "left").withColumn(
                "session_start", F.when(F.col("session_no") == 1, F.coalesce("_begun", "session_start")).otherwise(F.col("session_start")))
        done = ready.once(done.withColumn("session_id", session_id([F.col(k) for k in keys], F.col("session_start")))
                          .select(*keys, tie, ts, "_close", "_carried", "session_start", "session_id"))
        write(done.where(~F.col("_carried")).select(*keys, tie, ts, "session_id"), number)
        last = F.max_by(F.struct(ts, tie, "_close", F.col("session_start").alias("_start")), F.struct(ts, tie))
        kept = done.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
        return kept.where(F.unix_micros(ts) + F.lit(micros) >= F.lit(ready.watermark))

    return start_ordered(rows, ts, delay, checkpoint, step, late)


def stream_dedup(stream: DataFrame, write: Write, checkpoint: str, key: str, seconds: float = 60, ts: str = "ts",
                 tie: str = "id", delay: float = 600, late: Write | None = None):
    """Hand every row with ``is_duplicate`` to ``write``, as the batch 60-second rule decides it."""
    micros = int(round(seconds * 1_000_000))
    rows = stream.select(F.col(key).cast("string").alias(key), F.col(ts).cast("timestamp").alias(ts), F.col(tie).cast("bigint").alias(tie))

    def step(ready: Ready, number: int) -> DataFrame:
        new = ready.rows.drop("_at").withColumn("_carried", F.lit(False))
        if ready.carried is not None:
            new = new.unionByName(ready.carried.withColumn("_carried", F.lit(True)))
        done = ready.once(dedup_within(new, key, ts, tie, seconds))
        write(done.where(~F.col("_carried")).select(key, tie, ts, "is_duplicate"), number)
        kept = done.groupBy(key).agg(F.max(F.struct(ts, tie)).alias("_last")).select(key, "_last.*")
        return kept.where(F.unix_micros(ts) + F.lit(micros) >= F.lit(ready.watermark))

    return start_ordered(rows, ts, delay, checkpoint, step, late)


def split_late(stream: DataFrame, write: Write, late: Write, checkpoint: str, ts: str = "ts", delay: float = 600):
    """The late data policy by itself: rows in time to ``write`` once the watermark passed them, others to ``late``.

    A late row comes with the ``watermark`` it missed, null where it has no time.
    """
    def step(ready: Ready, number: int) -> None:
        write(ready.rows.drop("_at"), number)

    return start_ordered(stream, ts, delay, checkpoint, step, late)


def run_ordered(spark: SparkSession, start: Callable[[Write, str], object], label: str) -> DataFrame:
    """Run an ordered job over what is there now and return what it wrote."""
    path = scratch_path(spark, label)
    start(into(path), scratch_path(spark, f"{label}-state")).awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


def stream_dedup_approx(stream: DataFrame, key: str, seconds: int = 60, ts: str = "ts") -> DataFrame:
    """Cheaper dedup that may also drop a copy that comes later than the window."""
    timed = stream.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", f"{seconds} seconds")
    return timed.dropDuplicatesWithinWatermark([key]).drop("_event_time")
