"""Filtered, sorted, paged queries over stored records and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnwise.session import landed

MAX_LIMIT = 1000


def _filtered(df: DataFrame, ts: str, equal: dict, start, end) -> DataFrame:
    # An empty filter value means no filter; the range is [start, end).
    for name, value in equal.items():
        if value:
            df = df.where(F.col(name) == value)
    # A stored table is also partitioned by day, which prunes whole folders.
    by_day = "dt" in df.columns
    if start:
        at = F.lit(start).cast(dict(df.dtypes)[ts])
        df = df.where(F.col(ts) >= at)
        df = df.where(F.col("dt") >= F.to_date(at)) if by_day else df
    if end:
        at = F.lit(end).cast(dict(df.dtypes)[ts])
        df = df.where(F.col(ts) < at)
        df = df.where(F.col("dt") <= F.to_date(at)) if by_day else df
    return df


def filter_records(df: DataFrame, namespace: str, agent=None, session_id=None, start_date=None, end_date=None) -> DataFrame:
    return _filtered(df, "inserted_at", {"namespace": namespace, "agent": agent, "session_id": session_id},
                     start_date, end_date)


def filter_logs(df: DataFrame, namespace: str, level=None, resource_id=None, start_date=None, end_date=None) -> DataFrame:
    return _filtered(df, "timestamp", {"namespace": namespace, "level": level, "resource_id": resource_id},
                     start_date, end_date)


# Up to here the rows before a page are kept in one top-k; deeper pages are found by counting first.
NEAR_ROWS = 10_000
# Ranges of time that are counted, each within what the one before left.
GRAINS = (86400 * 1_000_000, 60 * 1_000_000, 1_000)


def _page(df: DataFrame, ts: str, tie: str, limit: int, offset: int) -> DataFrame:
    if not 1 <= limit <= MAX_LIMIT or offset < 0:
        raise ValueError(f"limit must be 1..{MAX_LIMIT} and offset not negative")
    if offset + limit > NEAR_ROWS:
        return deep_page(df, ts, tie, limit, offset)
    return df.orderBy(F.col(ts).desc(), F.col(tie)).offset(offset).limit(limit)


def deep_page(df: DataFrame, ts: str, tie: str, limit: int, offset: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit``, newest first, without sorting the rows before them.

    Rows are counted by day, then by minute, then by millisecond, each time only within the ranges
    that hold the page; a count is one number per range and task. What is left, a few milliseconds,
    is numbered in ranges of (time, id), so rows of one time are spread by id. Rows without a time
    come last.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rest, skip = df, offset
    for grain in GRAINS:
        counts = rest.groupBy(F.floor(at / F.lit(grain)).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
        held, before = [], 0
        for row in sorted(counts.collect(), key=lambda r: (r._range is None, -(r._range or 0))):
            if before + row._n > skip and before < skip + limit:
                held.append((row._range, before))
            before += row._n
        if not held:
            return df.limit(0)
        skip -= held[0][1]
        known = [r for r, _ in held if r is not None]
        inside = (at >= F.lit(min(known) * grain)) & (at < F.lit((max(known) + 1) * grain)) if known else F.lit(False)
        if any(r is None for r, _ in held):
            inside = F.coalesce(inside, F.lit(False)) | F.col(ts).isNull()
        rest = rest.where(inside)
    rows = paginate(rest, 1, ts, tie).where((F.col("row_no") >= skip) & (F.col("row_no") < skip + limit))
    return rows.orderBy("row_no").select(df.columns)


def query_records(df: DataFrame, namespace: str, agent=None, session_id=None, start_date=None, end_date=None,
                  limit: int = 100, offset: int = 0, tie: str = "id") -> tuple[DataFrame, DataFrame]:
    """(page of records newest first, one-row total ``count``)."""
    hits = filter_records(df, namespace, agent, session_id, start_date, end_date)
    return _page(hits, "inserted_at", tie, limit, offset), hits.agg(F.count(F.lit(1)).alias("count"))


def query_logs(df: DataFrame, namespace: str, level=None, resource_id=None, start_date=None, end_date=None,
               limit: int = 100, offset: int = 0, tie: str = "id") -> tuple[DataFrame, DataFrame]:
    hits = filter_logs(df, namespace, level, resource_id, start_date, end_date)
    return _page(hits, "timestamp", tie, limit, offset), hits.agg(F.count(F.lit(1)).alias("count"))


def paginate(df: DataFrame, page_size: int, ts: str = "inserted_at", tie: str = "id") -> DataFrame:
    """Add ``row_no`` (newest first, from 0) and ``page`` to every row.

    Rows are dealt into ranges of (time, id), sorted and numbered inside their range, and the
    ranges' counts, one number each, are added up. No task sorts the whole table, and rows of
    the same time, or without one (these come last), are split by id.
    """
    order = [F.col(ts).desc(), F.col(tie)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = landed(df.sparkSession, ranged.withColumn("_at", F.monotonically_increasing_id()), "pages")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # As many rows as ranges, which the number of shuffle partitions bounds.
    offsets = F.broadcast(counts.select("_part", before.alias("_before")))
    numbered = rows.withColumn("_part", part).join(offsets, "_part").withColumn("row_no", F.col("_before") + place)
    return numbered.select(*df.columns, "row_no", F.floor(F.col("row_no") / F.lit(page_size)).cast("bigint").alias("page"))


def next_page(df: DataFrame, page_size: int, after: tuple | None = None, ts: str = "inserted_at",
              tie: str = "id") -> DataFrame:
    """The page after ``after = (ts, id)``, newest first: a filter and a top-k, at any depth."""
    if after is not None:
        at, last = F.lit(after[0]).cast(dict(df.dtypes)[ts]), F.lit(after[1])
        df = df.where((F.col(ts) <= at) & ((F.col(ts) < at) | (F.col(tie) > last)))
    return df.orderBy(F.col(ts).desc(), F.col(tie)).limit(page_size)


def filter_by(df: DataFrame, **equal) -> DataFrame:
    """Rows matching every given column: ``source=``, ``external_user_id=``, ``external_user_channel=``, ``model=``."""
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    return df


def filter_by_source(df: DataFrame, source: str) -> DataFrame:
    return filter_by(df, source=source)


def filter_by_user(df: DataFrame, user: str) -> DataFrame:
    return filter_by(df, external_user_id=user)


def filter_by_channel(df: DataFrame, channel: str) -> DataFrame:
    return filter_by(df, external_user_channel=channel)


def filter_by_model(df: DataFrame, model: str) -> DataFrame:
    return filter_by(df, model=model)


def search_user_name(df: DataFrame, text: str, column: str = "external_user_name") -> DataFrame:
    """Rows whose user name contains ``text``, whatever the case."""
    needle: Column = F.lower(F.lit(text))
    return df.where(F.contains(F.lower(F.col(column)), needle))
