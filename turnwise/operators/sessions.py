"""Inactivity sessions: boundaries, ids, expiry, lookup of an event's session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnwise.operators.scan import SECONDS_PER_BLOCK, time_block
from turnwise.session import landed

ANONYMOUS = "anonymous"


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1_000_000.0)


def known_keys(keys: Sequence[str]) -> dict[str, Column]:
    """The keys as sessions name them: text, the last one (the user) ``anonymous`` where missing."""
    user = keys[-1]
    return {**{k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys[:-1]},
            user: F.coalesce(F.nullif(F.col(user).cast("string"), F.lit("")), F.lit(ANONYMOUS))}


def session_id(keys: Sequence[Column], start: Column) -> Column:
    """``{namespace}-{user}-{yyyyMMdd-HHmmss-ffffff}`` of the first event."""
    parts = [k.cast("string") for k in keys]
    return F.concat_ws("-", *parts, F.date_format(start, "yyyyMMdd-HHmmss-SSSSSS"))


def sessionize(
    events: DataFrame,
    timeout: float = 120,
    keys: Sequence[str] = ("namespace", "user_id"),
    ts: str = "ts",
    tie: str = "event_id",
    force_new: Column | None = None,
    close: Column | None = None,
    block_seconds: int = SECONDS_PER_BLOCK,
) -> DataFrame:
    """Add ``session_start``, ``session_no`` and ``session_id`` to every event.

    A session starts at a key's first event, after a gap of ``timeout`` seconds or more,
    on ``force_new``, and after a ``close`` event. A missing last key (the user) counts as
    ``anonymous``. Keys are cut into blocks of time (see :mod:`turnwise.operators.scan`), so a
    user with a third of all events is spread over as many tasks as it has blocks.
    """
    keys = list(keys)
    kept = events.columns
    micros = int(round(timeout * 1_000_000))
    rows = events.withColumns({
        **known_keys(keys), "_block": F.coalesce(time_block(F.col(ts), block_seconds), F.lit(-(2**63))),
        "_force": F.coalesce(F.lit(False) if force_new is None else force_new, F.lit(False)),
        "_close": F.coalesce(F.lit(False) if close is None else close, F.lit(False)),
    })

    def opens(before_ts: Column, before_close: Column, at: Column, forced: Column) -> Column:
        return forced | before_close | (F.timestamp_diff("MICROSECOND", before_ts, at) >= micros)

    inside = Window.partitionBy("_block", *keys).orderBy(ts, tie)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        "_at": F.row_number().over(inside),
        "_opens": opens(F.lag(ts).over(inside), F.lag("_close").over(inside), F.col(ts), F.col("_force")),
    })
    # Whether a block's first event opens a session is not known yet.
    rows = rows.withColumn("_opens", (F.col("_at") > 1) & F.col("_opens"))
    rows = rows.withColumns({
        "_local_start": F.max(F.when(F.col("_opens"), F.col(ts))).over(upto),
        "_local_no": F.sum(F.col("_opens").cast("bigint")).over(upto),
    })

    # One summary row per (key, block): its first and last event and its inner starts.
    edge = F.struct(F.col(ts), F.col(tie))
    summary = rows.groupBy("_block", *keys).agg(
        F.min_by(F.struct(F.col(ts).alias("ts"), F.col("_force").alias("force")), edge).alias("_first"),
        F.max_by(F.struct(F.col(ts).alias("ts"), F.col("_close").alias("close")), edge).alias("_last"),
        F.max(F.when(F.col("_opens"), F.col(ts))).alias("_inner_start"),
        F.sum(F.col("_opens").cast("bigint")).alias("_inner_n"),
    )
    by_key = Window.partitionBy(*keys).orderBy("_block")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lag("_last").over(by_key)
    carry = summary.withColumn("_before", before).select(
        *keys, "_block", "_inner_n",
        F.col("_first")["ts"].alias("_first_ts"),
        "_inner_start",
        F.coalesce(opens(F.col("_before")["ts"], F.col("_before")["close"],
                         F.col("_first")["ts"], F.col("_first")["force"]), F.lit(True)).alias("_first_opens"),
    ).withColumns({
        "_carry_start": F.max(F.coalesce(F.col("_inner_start"),
                                         F.when(F.col("_first_opens"), F.col("_first_ts")))).over(earlier),
        "_carry_no": F.coalesce(F.sum(F.col("_inner_n") + F.col("_first_opens").cast("bigint")).over(earlier),
                                F.lit(0)),
    }).drop("_inner_n", "_inner_start")

    start = F.coalesce(F.col("_local_start"), F.when(F.col("_first_opens"), F.col("_first_ts")),
                       F.col("_carry_start"))
    joined = rows.join(carry, ["_block", *keys])
    return joined.select(
        *[F.col(c) for c in kept],
        start.alias("session_start"),
        (F.col("_carry_no") + F.col("_first_opens").cast("bigint") + F.col("_local_no")).alias("session_no"),
        session_id([F.col(k) for k in keys], start).alias("session_id"),
    )


def sessions_table(events: DataFrame, keys: Sequence[str] = ("namespace", "user_id"),
                   ts: str = "ts") -> DataFrame:
    """One row per session of sessionized events: first and last activity and event count."""
    return events.groupBy(*keys, "session_id").agg(
        F.min(ts).alias("created_at"), F.max(ts).alias("last_activity"),
        F.count(F.lit(1)).alias("events"))


def expired_sessions(sessions: DataFrame, as_of: Column, timeout: float = 120) -> DataFrame:
    """Sessions idle for *more* than ``timeout`` seconds at ``as_of``.

    Idle for exactly the timeout is not expired, though :func:`sessionize` would open a
    new session for an event at that moment.
    """
    return sessions.where(F.timestamp_diff("MICROSECOND", F.col("last_activity"), as_of)
                          > int(round(timeout * 1_000_000)))


def session_info(sessions: DataFrame, as_of: Column, timeout: float | None = None) -> DataFrame:
    """Age and idle seconds of every session still held at ``as_of``.

    With a ``timeout``, expired sessions are left out first.
    """
    if timeout is not None:
        sessions = sessions.where(F.timestamp_diff("MICROSECOND", F.col("last_activity"), as_of)
                                  <= int(round(timeout * 1_000_000)))
    return sessions.withColumns({
        "duration": seconds_between(F.col("created_at"), as_of),
        "inactive_for": seconds_between(F.col("last_activity"), as_of),
    })


def latest_sessions(sessions: DataFrame, as_of: Column, timeout: float = 120,
                    keys: Sequence[str] = ("namespace", "user_id")) -> DataFrame:
    """The most recent session per user that an event at ``as_of`` would still reuse."""
    live = sessions.where(F.timestamp_diff("MICROSECOND", F.col("last_activity"), as_of)
                          < int(round(timeout * 1_000_000)))
    newest = F.max_by(F.struct("session_id", "created_at", "last_activity", "events"),
                      F.struct("last_activity", "session_id"))
    return live.groupBy(*keys).agg(newest.alias("_s")).select(*keys, "_s.*")


def _cell_micros(bucket_seconds: int) -> list[int]:
    """Widths of the cells that sessions are listed under: each 16 times the one before, up to 2^62."""
    widths = [bucket_seconds * 1_000_000]
    while widths[-1] < 2**58:
        widths.append(widths[-1] * 16)
    return widths


def session_cells(sessions: DataFrame, start: Column, end: Column, bucket_seconds: int = 3600) -> DataFrame:
    """``sessions`` listed under (``_level``, ``_cell``): one row or two, however long a session is.

    A session goes to the narrowest level whose cells are as wide as it is long, so it touches two
    of them at most.
    """
    length, widths = end - start, _cell_micros(bucket_seconds)
    level, width = F.lit(len(widths) - 1), F.lit(widths[-1])
    for i in range(len(widths) - 2, -1, -1):
        fits = length <= widths[i]
        level, width = F.when(fits, F.lit(i)).otherwise(level), F.when(fits, F.lit(widths[i])).otherwise(width)
    return sessions.withColumns({"_level": level, "_width": width}).withColumn("_cell", F.explode(F.array_distinct(F.array(
        F.floor(start / F.col("_width")), F.floor(end / F.col("_width")))))).drop("_width")


def attach_session(events: DataFrame, sessions: DataFrame,
                   keys: Sequence[str] = ("namespace", "user_id"), ts: str = "ts",
                   timeout: float = 0, bucket_seconds: int = 3600) -> DataFrame:
    """Session id of every event that falls within a stored session of its user.

    An interval join made an equi-join: a session is listed under one or two cells of time of the
    level that fits its length (:func:`session_cells`), and an event looks into its cell of each
    level that sessions are listed at; the range is checked there. The cell is part of the join key,
    so a hot user is spread over its cells, and hot cells can be split, since few sessions share one.
    Sessions of one user do not overlap, so an event meets at most one. Missing users are named as in
    :func:`sessionize`, on both sides. A session is open from its first event up to, not including,
    ``timeout`` seconds after its last; with ``timeout=0`` up to and including its last event.
    """
    micros = int(round(timeout * 1_000_000))
    end = F.unix_micros(F.col("last_activity").cast("timestamp")) + F.lit(micros)
    names = [f"_k{i}" for i in range(len(keys))]
    spans = sessions.select(
        *[c.alias(n) for n, c in zip(names, known_keys(keys).values())], "session_id",
        F.unix_micros(F.col("created_at").cast("timestamp")).alias("_from"), end.alias("_to"))
    spans = landed(sessions.sparkSession, session_cells(spans, F.col("_from"), F.col("_to"), bucket_seconds), "session-cells")
    levels, widths = sorted(r[0] for r in spans.select("_level").distinct().collect()), _cell_micros(bucket_seconds)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    upper = F.col("_at") < F.col("_to") if micros else F.col("_at") <= F.col("_to")
    probe = events.withColumns({"_at": at, **dict(zip(names, known_keys(keys).values()))})
    by = [*names, "_level", "_cell"]
    if len(levels) == 1:
        # The usual case: every event looks into one cell, and keeps its row without a session.
        probe = probe.withColumns({"_level": F.lit(levels[0]), "_cell": F.floor(F.col("_at") / F.lit(widths[levels[0]]))})
        e, s = probe.alias("e"), spans.alias("s")
        cond = (F.col("_at") >= F.col("_from")) & upper
        for name in by:
            cond = (F.col(f"e.{name}") == F.col(f"s.{name}")) & cond
        return e.join(s, cond, "left").select(*[F.col(f"e.{c}") for c in events.columns], F.col("s.session_id").alias("session_id"))
    # Several levels, or none: an event is a row per level there, put together again by its own number.
    probe = landed(events.sparkSession, probe.withColumn("_row", F.monotonically_increasing_id()), "session-probes")
    cells = F.array(*[F.struct(F.lit(i).alias("_level"), F.floor(F.col("_at") / F.lit(widths[i])).alias("_cell")) for i in levels])
    if not levels:
        return probe.select(*events.columns, F.lit(None).cast("string").alias("session_id"))
    looks = probe.select("_row", "_at", *names, F.inline(cells))
    found = looks.join(spans, by).where((F.col("_at") >= F.col("_from")) & upper).select("_row", "session_id")
    return probe.join(found, "_row", "left").select(*events.columns, "session_id")
