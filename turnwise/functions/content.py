"""Polymorphic message content held as VARIANT."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Typed message as it travels through grouping: JSON parts are text, so rows stay orderable.
MESSAGE_DDL = (
    "struct<role:string,content:string,sender:string,tool_calls:string,tool_call_id:string,"
    "tool_name:string,is_internal_tool:boolean,internal_tool_type:string>"
)


def bind(col: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate ``col`` once and use it many times in ``fn``."""
    return F.transform(F.array(col), fn)[0]


def once(col: Column) -> Column:
    """Compute a value in a ``select`` exactly once, however it is used after that.

    A filter on a plain projected column is pushed below it, where the expression is
    repeated (and planned) again. It cannot pass this one-row ``explode``.
    """
    return F.explode(F.array(col))


def as_array(v: Column) -> Column:
    """``array<variant>`` of a JSON array, null for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def get_text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def block_type(block: Column) -> Column:
    return F.coalesce(F.try_variant_get(block, "$.type", "string"), F.lit(""))


def normalize_messages(msg: Column) -> Column:
    """A single message or a list -> ``array<variant>``."""
    return F.when(msg.isNotNull(), F.coalesce(as_array(msg), F.array(msg)))


def text_parts(blocks: Column) -> Column:
    """Strings and ``text`` blocks of a content list, in order."""
    wanted = F.filter(blocks, lambda b: is_string(b) | (block_type(b) == "text"))
    return F.transform(wanted, lambda b: F.when(is_string(b), F.try_variant_get(b, "$", "string"))
                       .otherwise(F.coalesce(get_text(b, "$.text"), F.lit(""))))


def extract_text(content: Column, stringify: bool = False) -> Column:
    """Content -> text: a string as is, a list joined by newlines, anything else empty.

    With ``stringify`` every other block of a list is written as its JSON text.
    """
    def join(blocks: Column) -> Column:
        if not stringify:
            return F.array_join(text_parts(blocks), "\n")
        return F.array_join(F.transform(blocks, lambda b: F.coalesce(
            get_text(b, "$.text"),
            F.when(is_string(b), F.try_variant_get(b, "$", "string")).otherwise(F.to_json(b)))), "\n")
    return (F.when(is_string(content), F.try_variant_get(content, "$", "string"))
            .otherwise(F.coalesce(join(as_array(content)), F.lit(""))))


def extract_tool_calls(content: Column) -> Column:
    """``tool_use`` blocks -> ``array<struct<name,arguments,id>>``; arguments as JSON text."""
    uses = F.filter(F.coalesce(as_array(content), F.array().cast("array<variant>")),
                    lambda b: block_type(b) == "tool_use")
    return F.transform(uses, lambda b: F.struct(
        F.coalesce(get_text(b, "$.name"), F.lit("")).alias("name"),
        F.coalesce(F.to_json(F.try_variant_get(b, "$.input", "variant")), F.lit("{}")).alias("arguments"),
        F.coalesce(get_text(b, "$.id"), F.lit("")).alias("id"),
    ))


def call_json(call: Column) -> Column:
    """One tool call as a JSON object, its arguments nested and not quoted."""
    return F.to_json(F.struct(call["name"].alias("name"),
                              F.try_parse_json(call["arguments"]).alias("arguments"),
                              call["id"].alias("id")))


def calls_json(calls: Column) -> Column:
    """Tool calls as a JSON array; null when there are none."""
    return F.when(F.size(calls) > 0, F.concat(
        F.lit("["), F.array_join(F.transform(calls, call_json), ","), F.lit("]")))


def message(role: Column, content: Column, sender: Column, tool_calls: Column | None = None,
            tool_call_id: Column | None = None, tool_name: Column | None = None,
            internal: Column | None = None, internal_type: Column | None = None) -> Column:
    """Typed message struct; parts that are not given are null, ``internal`` false."""
    def text(c: Column | None) -> Column:
        return F.lit(None).cast("string") if c is None else c.cast("string")
    return F.struct(
        role.alias("role"), text(content).alias("content"), text(sender).alias("sender"),
        text(tool_calls).alias("tool_calls"), text(tool_call_id).alias("tool_call_id"),
        text(tool_name).alias("tool_name"),
        (F.lit(False) if internal is None else internal).alias("is_internal_tool"),
        text(internal_type).alias("internal_tool_type"),
    ).cast(MESSAGE_DDL)


def tool_call_messages(calls: Column, sender: Column, category: bool = False) -> Column:
    """One ``Tool: name`` message per call; ``category`` also tags the tool's category."""
    from turnwise.functions.tokens import classify_tool
    return F.transform(calls, lambda c: message(
        F.lit("tool"), F.concat(F.lit("Tool: "), c["name"]), sender,
        tool_calls=F.concat(F.lit("["), call_json(c), F.lit("]")), tool_name=c["name"],
        internal_type=classify_tool(c["name"]) if category else None))


def assistant_messages(text: Column, calls: Column, sender: Column, tool_sender: Column,
                       always: bool = True, category: bool = False) -> Column:
    """Assistant message plus one tool message per call.

    ``always=False`` leaves the assistant message out when it has no text.
    """
    head = F.array(message(F.lit("assistant"), text, sender, tool_calls=calls_json(calls)))
    if not always:
        head = F.when(text.isNotNull(), head).otherwise(F.array().cast(f"array<{MESSAGE_DDL}>"))
    return F.concat(head, tool_call_messages(calls, tool_sender, category))


def to_variant_messages(messages: Column) -> Column:
    """Typed messages -> stored messages, whose content and tool calls are VARIANT."""
    return F.transform(messages, lambda m: F.struct(
        m["role"].alias("role"), m["content"].cast("variant").alias("content"),
        m["sender"].alias("sender"), F.try_parse_json(m["tool_calls"]).alias("tool_calls"),
        m["tool_call_id"].alias("tool_call_id"), m["tool_name"].alias("tool_name"),
        m["is_internal_tool"].alias("is_internal_tool"),
        m["internal_tool_type"].alias("internal_tool_type"), F.lit(None).cast("string").alias("refusal"),
        *[F.lit(None).cast("variant").alias(n) for n in ("annotations", "audio", "function_call")]))
