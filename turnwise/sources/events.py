"""Mixed trace events: validation with partial success."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Event types and the fields each must have.
REQUIRED = {
    "llm": ("session_id",),
    "tool": ("session_id", "tool_name"),
    "handoff": ("session_id", "from_agent", "to_agent"),
    "log": ("message",),
}
# The name an accepted event is reported under.
TRACE_TYPES = {"llm": "llm_call", "tool": "tool_call", "handoff": "handoff", "log": "log"}


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def check_events(events: DataFrame) -> DataFrame:
    """Add each item's result: ``status`` (``ok`` or ``error``), ``error_code``, ``error_message``,
    and for accepted items ``trace_type`` and, of LLM calls, the token counts they came with.

    Columns an event type does not use may be absent from the frame.
    """
    for name in {f for fields in REQUIRED.values() for f in fields} | {"namespace"}:
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("string"))
    missing: Column = F.lit(None).cast("string")
    kind = F.col("type")
    for event_type, fields in reversed(REQUIRED.items()):
        first: Column = F.lit(None).cast("string")
        if event_type == "log":
            first = F.when(_empty("session_id") & _empty("namespace"), F.lit("session_id or namespace"))
        for field in reversed(fields):
            first = F.when(_empty(field), F.lit(field)).otherwise(first)
        missing = F.when(kind == event_type, first).otherwise(missing)
    unknown = ~F.coalesce(kind.isin(*REQUIRED), F.lit(False))
    for name in ("input_tokens", "output_tokens"):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("bigint"))
    accepted = ~unknown & F.col("_missing").isNull()
    names = F.create_map(*[F.lit(x) for pair in TRACE_TYPES.items() for x in pair])
    return (events.withColumn("_missing", missing).withColumns({
        "trace_type": F.when(accepted, names[kind]),
        **{f"result_{n}": F.when(accepted & (kind == "llm"), F.col(n)) for n in ("input_tokens", "output_tokens")},
        "status": F.when(unknown | F.col("_missing").isNotNull(), F.lit("error")).otherwise(F.lit("ok")),
        "error_code": F.when(kind.isNull() | F.col("_missing").isNotNull(), F.lit("missing_field"))
                       .when(unknown, F.lit("invalid_type")),
        "error_message": F.when(F.col("_missing").isNotNull(), F.concat("_missing", F.lit(" is required")))
                          .when(kind.isNull(), F.lit("type is required"))
                          .when(unknown, F.concat(F.lit("unknown type "), "type")),
    }).drop("_missing"))


def ingest_trace_batch(events: DataFrame, batch: str = "batch_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted events, rejected events, summary per batch) of mixed events."""
    checked = check_events(events)
    summary = checked.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count_if(F.col("status") == "error").alias("failed"),
    ).withColumn("success", F.col("failed") == 0)
    return checked.where("status = 'ok'"), checked.where("status = 'error'"), summary
