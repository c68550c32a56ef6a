"""Wire format of records, events as records, pooled sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from turnwise.functions import content as C, tokens as T
from turnwise.schemas import TRANSFERS_DDL

WIRE_OPTIONAL = ("session_id", "inserted_at", "user_id", "user_whatsapp", "external_user_id",
                 "external_user_name", "external_user_channel", "source", "model")


def _truthy_array(v: Column) -> Column:
    return F.when(F.size(C.as_array(v)) > 0, v)


def wire_messages(msg: Column) -> Column:
    """Stored messages with only the fields that are sent; empty ones are null."""
    def text(c: Column) -> Column:
        return F.nullif(c, F.lit(""))
    return F.transform(msg, lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"),
        _truthy_array(m["tool_calls"]).alias("tool_calls"),
        text(m["tool_call_id"]).alias("tool_call_id"), text(m["tool_name"]).alias("tool_name"),
        F.when(m["is_internal_tool"], F.lit(True)).alias("is_internal_tool"),
        text(m["internal_tool_type"]).alias("internal_tool_type")))


def to_wire_format(records: DataFrame) -> DataFrame:
    """The persisted record: zero-filled tokens, no total, empty optionals null.

    Only a whitelist leaves: totals, attachments, senders and channel message ids do not.
    """
    def optional(name: str) -> Column:
        if name not in records.columns:
            return F.lit(None).cast("string").alias(name)
        col = F.col(name)
        return (F.nullif(col, F.lit("")) if dict(records.dtypes)[name] == "string" else col).alias(name)

    tokens = [F.coalesce(F.col(n).cast("bigint"), F.lit(0).cast("bigint")).alias(n) if n in records.columns
              else F.lit(0).cast("bigint").alias(n) for n in T.TOKEN_FIELDS]
    transfers = (F.when(F.size("transfers") > 0, F.col("transfers")) if "transfers" in records.columns
                 else F.lit(None).cast(TRANSFERS_DDL))
    return records.select("namespace", "agent", wire_messages(F.col("msg")).alias("msg"), *tokens,
                          transfers.alias("transfers"), *[optional(n) for n in WIRE_OPTIONAL])


def fill_total(df: DataFrame) -> DataFrame:
    """``total_tokens`` as given, or the sum of the segments where it is null."""
    given = F.col("total_tokens") if "total_tokens" in df.columns else F.lit(None)
    segments = [F.col(n) for n in T.TOKEN_FIELDS if n in df.columns]
    return df.withColumn("total_tokens", T.total_tokens(given, *segments))


def traces_to_records(traces: DataFrame) -> DataFrame:
    """LLM, tool and handoff events in record shape, so both ingest routes share analytics."""
    kind = F.col("type")
    agent = F.coalesce(F.col("agent"), F.col("from_agent"), F.lit("unknown"))
    usage = T.map_llm_usage(F.col("output"))
    zero = F.lit(0).cast("bigint")
    reply = F.try_variant_get(F.col("output"), "$.content", "string")
    said = F.transform(C.as_array(F.try_variant_get(F.col("input"), "$.messages", "variant")),
                       lambda m: C.message(C.get_text(m, "$.role"), C.extract_text(
                           F.try_variant_get(m, "$.content", "variant")), C.get_text(m, "$.role")))
    none = F.array().cast(f"array<{C.MESSAGE_DDL}>")
    llm = F.concat(F.coalesce(said, none), F.when(reply.isNotNull(), F.array(
        C.message(F.lit("assistant"), reply, agent))).otherwise(none))
    call = F.to_json(F.array(F.struct(F.col("tool_name").alias("name"), F.col("arguments").alias("arguments"),
                                      F.col("result").alias("result"))))
    tool = F.array(C.message(F.lit("tool"), F.concat(F.lit("Tool: "), F.col("tool_name")), agent,
                             tool_calls=call, tool_name=F.col("tool_name")))
    from turnwise.operators.folds import handoff_message
    stamp = F.col("ts").cast("string")
    handoff = F.array(handoff_message(F.col("from_agent"), F.col("to_agent"), F.col("reason"), stamp))
    transfers = F.when(kind == "handoff", F.array(F.struct(
        F.col("from_agent"), F.col("to_agent"), F.col("reason"), stamp.alias("timestamp"))))
    return traces.where(kind.isin("llm", "tool", "handoff")).select(
        "namespace", agent.alias("agent"), "session_id",
        F.when(kind == "llm", llm).when(kind == "tool", tool).otherwise(handoff).alias("msg"),
        F.when(kind == "llm", usage["input_tokens"]).otherwise(zero).alias("input_tokens"),
        F.when(kind == "llm", usage["output_tokens"]).otherwise(zero).alias("output_tokens"),
        zero.alias("process_tokens"), zero.alias("memory_tokens"),
        transfers.cast(TRANSFERS_DDL).alias("transfers"), F.col("ts").alias("inserted_at"),
        "external_user_id", "external_user_name", "external_user_channel", "model",
        F.lit("traces").alias("source"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All sources' records in one table; a column a source lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
