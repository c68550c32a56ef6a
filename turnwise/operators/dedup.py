"""Duplicate handling: exact, within 60 seconds, against stored rows, by request key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnwise.operators.scan import blocked_scan, time_block
from turnwise.session import landed


class RecordsDiscarded(ValueError):
    """Raised in strict mode when duplicates were dropped; carries the counts."""

    def __init__(self, dropped: int, inserted: int, received: int):
        super().__init__(f"{dropped}/{received} records are duplicates")
        self.dropped, self.inserted, self.received = dropped, inserted, received


def content_key(*parts: Column) -> Column:
    """Hash of the parts that make two records the same; null and empty differ."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]),
                            {"ignoreNullFields": "false"}), 256)


def record_key() -> Column:
    """Key of a stored record: namespace, agent, session and message JSON."""
    return content_key(F.col("namespace"), F.col("agent"), F.col("session_id"), F.to_json("msg"))


def dedup_within(df: DataFrame, key: str, ts: str = "ts", tie: str = "id",
                 seconds: float = 60) -> DataFrame:
    """Add ``prev_ts`` and ``is_duplicate``: an identical row came at most ``seconds`` before.

    The row before counts whether or not it was itself dropped, so a steady stream of
    copies keeps one row until it pauses for longer than the window.
    """
    scanned = blocked_scan(df, [key], time_block(F.col(ts)), [ts, tie], prev={"prev_ts": ts})
    gap = F.timestamp_diff("MICROSECOND", F.col("prev_ts"), F.col(ts))
    return scanned.withColumn("is_duplicate",
                              F.coalesce(gap <= int(round(seconds * 1_000_000)), F.lit(False)))


def drop_within(df: DataFrame, key: str, ts: str = "ts", tie: str = "id", seconds: float = 60) -> DataFrame:
    """Only the rows :func:`dedup_within` keeps."""
    return dedup_within(df, key, ts, tie, seconds).where(~F.col("is_duplicate")).drop("prev_ts", "is_duplicate")


def distinct_rows(df: DataFrame, key: str, tie: str) -> DataFrame:
    """The first row (by ``tie``) of every key.

    ``min_by`` combines on the map side, so a key with a third of all rows reaches its
    reducer as one row per map task.
    """
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.col(tie))
    return df.groupBy(F.col(key).alias("_key")).agg(row.alias("_row")).select("_row.*")


def anti_join_existing(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """New rows whose key is not stored yet.

    The stored side is cut to distinct keys, combined map-side, and struck off the new rows by
    a left anti join, where AQE can split a partition full of copies because the other side is
    one row per key.
    """
    return new.join(stored.select(key).distinct(), key, "left_anti")


def dedup_report(flagged: DataFrame, by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Received, kept and dropped rows, and whether everything was a duplicate.

    ``strict`` raises :class:`RecordsDiscarded` when any row was dropped.
    """
    report = flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col("is_duplicate")).alias("kept"),
        F.count_if(F.col("is_duplicate")).alias("dropped"),
    ).withColumn("all_duplicates", (F.col("received") > 0) & (F.col("kept") == 0))
    if strict:
        total = report.agg(F.sum("dropped"), F.sum("kept"), F.sum("received")).first()
        if total[0]:
            raise RecordsDiscarded(int(total[0]), int(total[1]), int(total[2]))
    return report


def _in_loads(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Each key once, with whether it is in the old and in the new load: one scan of each side."""
    tagged = old.select(key, F.lit(False).alias("_new")).unionByName(new.select(key, F.lit(True).alias("_new")))
    return tagged.groupBy(key).agg(F.bool_or(~F.col("_new")).alias("_in_old"), F.bool_or("_new").alias("_in_new"))


def diff_loads(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys only in one of two loads, tagged ``new`` or ``gone``."""
    return (_in_loads(old, new, key).where(F.col("_in_old") != F.col("_in_new"))
            .select(key, F.when(F.col("_in_new"), "new").otherwise("gone").alias("change")))


def overlap_loads(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys present in both loads."""
    return _in_loads(old, new, key).where(F.col("_in_old") & F.col("_in_new") & F.col(key).isNotNull()).select(key)


# --- request keys -----------------------------------------------------------------------

BY_KEY = ("_tenant", "_key")


def _successors(ok: DataFrame, micros: int) -> DataFrame:
    """(tenant, key, id, next): the first request at least ``micros`` later, where there is one.

    The time of an answer is looked up in its block (a 24th of the window) of the same key,
    else it is the first request of the next block that has any. Windows over requests are per
    block; the one per key is over block summaries only.
    """
    width = max(micros // 24, 1)
    block = F.floor(F.col("_t") / F.lit(width)).alias("_block")
    rows = ok.select(*BY_KEY, F.col("_at").alias("_t"), F.lit(1).alias("_real"), "_id").unionByName(
        ok.select(*BY_KEY, (F.col("_at") + F.lit(micros)).alias("_t"), F.lit(0).alias("_real"), "_id")).select("*", block)
    # From the end, so that the nearest one after a row is the last one seen: a running value, where
    # a frame that reaches to the end of its partition would be gone through again for every row.
    back = Window.partitionBy(*BY_KEY, "_block").orderBy(F.desc("_t"), F.desc("_real"), F.desc("_id"))
    onwards = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = F.when(F.col("_real") == 1, F.col("_id"))
    here = rows.withColumn("_here", F.last(real, ignorenulls=True).over(onwards)).where("_real = 0")
    blocks = rows.groupBy(*BY_KEY, "_block").agg(F.min_by(real, F.when(F.col("_real") == 1, F.struct("_t", "_id"))).alias("_first"))
    later = Window.partitionBy(*BY_KEY).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    after = blocks.select(*BY_KEY, "_block", F.last("_first", ignorenulls=True).over(later).alias("_after"))
    return (here.join(after.hint("merge"), [*BY_KEY, "_block"])
            .select(*BY_KEY, "_id", F.coalesce("_here", "_after").alias("_next")).where("_next IS NOT NULL"))


def _originals(keyed: DataFrame, micros: int) -> DataFrame:
    """The originals of all keys: the first good request, and always the first one a window later.

    They are followed by doubling: once the first 2^k of every key are known, one join with the
    2^k-fold successor gives as many more. Rounds are the logarithm of the time span over the
    window, for all keys at once; each is a written table, so a lost executor repeats little.
    """
    spark = keyed.sparkSession
    ok = landed(spark, keyed.where("_ok").select(*BY_KEY, "_at", "_id", "_body"), "requests")
    jump = landed(spark, _successors(ok, micros), "successors")
    step = landed(spark, ok.groupBy(*BY_KEY).agg(F.min(F.struct("_at", "_id")).alias("_o")).select(*BY_KEY, "_o._id"), "originals")
    found = step
    while True:
        step = landed(spark, found.join(jump, [*BY_KEY, "_id"]).select(*BY_KEY, F.col("_next").alias("_id")), "originals")
        if step.isEmpty():
            break
        found = found.unionByName(step)
        further = jump.select(*BY_KEY, F.col("_id").alias("_next"), F.col("_next").alias("_further"))
        jump = landed(spark, jump.join(further, [*BY_KEY, "_next"]).select(*BY_KEY, "_id", F.col("_further").alias("_next")),
                      "successors")
    return ok.join(found, [*BY_KEY, "_id"], "left_semi")


def idempotency_classify(
    requests: DataFrame,
    tenant: str = "tenant",
    key: str = "request_key",
    body: str = "body_hash",
    ts: str = "ts",
    tie: str = "id",
    ok: Column | None = None,
    hours: float = 24,
) -> DataFrame:
    """Add ``outcome``: ``fresh``, ``replay`` or ``conflict``, and ``original_id``.

    Within ``hours`` of the original request of a (tenant, key) the same body is a replay
    and another body a conflict; a missing key, or a request after that time, is fresh. A
    failed request is never an original. ``tie`` is unique within a key. There is one plan for
    keys of any size, and no key is ever gathered.
    """
    micros = int(round(hours * 3600 * 1_000_000))
    kept = requests.columns
    rows = requests.withColumns({
        "_tenant": F.coalesce(F.col(tenant).cast("string"), F.lit("")), "_key": F.col(key).cast("string"),
        "_body": F.col(body).cast("string"), "_at": F.unix_micros(F.col(ts).cast("timestamp")),
        "_id": F.col(tie).cast("bigint"), "_ok": F.coalesce(F.lit(True) if ok is None else ok, F.lit(True)),
    })
    keyed = rows.where(F.col("_key").isNotNull() & (F.col("_key") != ""))
    originals = _originals(keyed, micros)

    # An original covers [at, at + hours): it is listed under every bucket (a 24th of that
    # time) it touches, and a request looks in its own. Originals of a key lie `hours` apart,
    # so a request meets at most two, and the bucket spreads a hot key.
    width = max(micros // 24, 1)
    spans = originals.select(
        F.col("_tenant"), F.col("_key"), F.col("_at").alias("_o_at"), F.col("_id").alias("_o_id"),
        F.col("_body").alias("_o_body"),
        F.explode(F.sequence(F.floor(F.col("_at") / F.lit(width)),
                             F.floor((F.col("_at") + F.lit(micros)) / F.lit(width)))).alias("_bucket"))
    r = rows.withColumn("_bucket", F.floor(F.col("_at") / F.lit(width))).alias("r")
    s = spans.alias("s")
    after = F.struct(F.col("r._at"), F.col("r._id")) > F.struct(F.col("s._o_at"), F.col("s._o_id"))
    joined = r.join(s, (F.col("r._tenant") == F.col("s._tenant")) & (F.col("r._key") == F.col("s._key"))
                    & (F.col("r._bucket") == F.col("s._bucket"))
                    & after & (F.col("r._at") < F.col("s._o_at") + F.lit(micros)), "left")
    outcome = (F.when(F.col("s._o_id").isNull(), F.lit("fresh"))
               .when(F.col("r._body").eqNullSafe(F.col("s._o_body")), F.lit("replay"))
               .otherwise(F.lit("conflict")))
    return joined.select(*[F.col(f"r.{c}") for c in kept], outcome.alias("outcome"),
                         F.col("s._o_id").alias("original_id"))
