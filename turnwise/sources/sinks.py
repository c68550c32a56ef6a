"""Writing stored tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from turnwise.schemas import LOG_EXPORT_COLUMNS, RECORD_EXPORT_COLUMNS


def _append(df: DataFrame, path: str, ts: str, mode: str) -> dict:
    seen = Observation()
    dated = df.withColumn("dt", F.to_date(F.coalesce(F.col(ts), F.current_timestamp())))
    # Rebalance instead of repartition: files near the target size, and a namespace or day
    # with a third of the rows is split over many writers.
    out = dated.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", "namespace", "dt")
    out.write.mode(mode).partitionBy("namespace", "dt").parquet(path)
    rows = seen.get["rows"]
    return {"total_inserted": rows, "total_records": rows, "failures": []}


def write_records(df: DataFrame, path: str, mode: str = "append") -> dict:
    """Append records, partitioned by namespace and day; returns the counts."""
    return _append(df, path, "inserted_at", mode)


def write_logs(df: DataFrame, path: str, mode: str = "append") -> dict:
    result = _append(df, path, "timestamp", mode)
    return {"total_inserted": result["total_inserted"], "total_logs": result["total_records"], "failures": []}


def _export_frame(df: DataFrame, columns: Sequence[str], json_columns: Sequence[str]) -> DataFrame:
    def col(name: str):
        if name not in df.columns:
            return F.lit(None).cast("string").alias(name)
        if name in json_columns and dict(df.dtypes)[name] != "string":
            return F.to_json(name).alias(name)
        return F.col(name)
    return df.select(*[col(c) for c in columns])


def records_export(df: DataFrame) -> DataFrame:
    """The 16 export columns in order, messages and transfers as JSON text."""
    return _export_frame(df, RECORD_EXPORT_COLUMNS, ("msg", "transfers"))


def logs_export(df: DataFrame) -> DataFrame:
    return _export_frame(df, LOG_EXPORT_COLUMNS, ("custom_object",))


def _export(frame: DataFrame, fmt: str, path: str, cap: int | None) -> None:
    if fmt not in ("json", "csv"):
        raise ValueError(f"unsupported format {fmt!r}")
    if cap is not None:
        frame = frame.limit(cap)
    # The writers' own formats end at milliseconds.
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    writer = frame.write.mode("errorifexists").options(timestampFormat=f"{micros}XXX", timestampNTZFormat=micros)
    if fmt == "json":
        writer.json(path)
    else:
        writer.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def export_records(df: DataFrame, path: str, fmt: str = "json", cap: int | None = None, **filters) -> None:
    """Write all matching records; ``cap`` bounds the rows only when asked for."""
    from turnwise.operators.query import filter_records
    _export(records_export(filter_records(df, **filters)), fmt, path, cap)


def export_logs(df: DataFrame, path: str, fmt: str = "json", cap: int | None = None, **filters) -> None:
    from turnwise.operators.query import filter_logs
    _export(logs_export(filter_logs(df, **filters)), fmt, path, cap)


def ingest_summary(df: DataFrame, status: str = "status", by: Sequence[str] = ("namespace",)) -> DataFrame:
    """Received, inserted, dropped (duplicate) and rejected rows per namespace."""
    s = F.col(status)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"), F.count_if(s == "inserted").alias("inserted"),
        F.count_if(s == "duplicate").alias("dropped"), F.count_if(s == "rejected").alias("rejected"))
