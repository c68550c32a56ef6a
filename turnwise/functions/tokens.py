"""Token estimates, usage mappings and small label lookups."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Names other tools read, so they must be spelled exactly like this.
CHANNELS = {"msteams": "teams", "directline": "web", "webchat": "web", "emulator": "emulator"}
LOG_LEVELS = {10: "debug", 20: "info", 30: "warn", 40: "error", 50: "error"}
TOOL_CATEGORIES = {
    "execute_command": "terminal",
    "read_file": "file_read",
    "write_to_file": "file_write",
    "replace_in_file": "file_edit",
    "search_files": "file_search",
    "list_files": "file_list",
    "list_code_definition_names": "code_search",
    "browser_action": "browser",
    "ask_followup_question": "user_interaction",
    "attempt_completion": "completion",
    "use_mcp_tool": "mcp_tool",
    "access_mcp_resource": "mcp_resource",
}
INTERNAL_TOOLS = {
    "web_search_call": "web_search",
    "file_search_call": "file_search",
    "code_interpreter_call": "code_interpreter",
    "computer_call": "computer_use",
}
USER_ROLES = ("human", "user", "question")
ASSISTANT_ROLES = ("bot", "assistant", "answer", "model")

TOKEN_FIELDS = ("input_tokens", "output_tokens", "process_tokens", "memory_tokens")


def _zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0)).cast("bigint")


def tokens_chars4(text: Column) -> Column:
    """Length in code points, whole quarters; null counts as empty."""
    return _zero(F.shiftright(F.length(text), 2))


def tokens_chars4_min1(text: Column, estimate: bool = True) -> Column:
    """Like :func:`tokens_chars4` but at least 1; 0 when estimation is off."""
    return F.greatest(F.lit(1).cast("bigint"), tokens_chars4(text)) if estimate else F.lit(0).cast("bigint")


def tokens_words(text: Column) -> Column:
    """Words times 1.3, cut to a whole number."""
    words = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
    return F.when(text.isNull(), F.lit(0)).otherwise((words * F.lit(1.3)).cast("int")).cast("bigint")


def tokens_payload(payload: Column) -> Column:
    """Length of the JSON text of a struct, map, array or variant, whole quarters."""
    return tokens_chars4(F.to_json(payload))


def map_anthropic_usage(usage: Column) -> Column:
    """Usage variant -> struct of the four segments; cache writes are process, reads memory."""
    def get(name: str) -> Column:
        return _zero(F.try_variant_get(usage, f"$.{name}", "bigint"))
    return F.struct(
        get("input_tokens").alias("input_tokens"),
        get("output_tokens").alias("output_tokens"),
        get("cache_creation_input_tokens").alias("process_tokens"),
        get("cache_read_input_tokens").alias("memory_tokens"),
    )


def map_openai_usage(usage: Column, system_tokens: Column | None = None,
                     context_tokens: Column | None = None) -> Column:
    """Usage variant -> the four segments; system prompt is process, context is memory."""
    return F.struct(
        _zero(F.try_variant_get(usage, "$.input_tokens", "bigint")).alias("input_tokens"),
        _zero(F.try_variant_get(usage, "$.output_tokens", "bigint")).alias("output_tokens"),
        _zero(F.lit(0) if system_tokens is None else system_tokens).alias("process_tokens"),
        _zero(F.lit(0) if context_tokens is None else context_tokens).alias("memory_tokens"),
        F.try_variant_get(usage, "$.requests", "bigint").alias("requests"),
    )


def map_llm_usage(output: Column) -> Column:
    """LLM event output variant -> input and output tokens."""
    return F.struct(
        _zero(F.try_variant_get(output, "$.usage.prompt_tokens", "bigint")).alias("input_tokens"),
        _zero(F.try_variant_get(output, "$.usage.completion_tokens", "bigint")).alias("output_tokens"),
    )


def total_tokens(total: Column, *segments: Column) -> Column:
    """The given total, or the sum of the segments where it is null."""
    acc = F.lit(0).cast("bigint")
    for segment in segments:
        acc = acc + _zero(segment)
    return F.coalesce(total.cast("bigint"), acc)


def lookup(col: Column, table: dict, fallback: Column) -> Column:
    """Value of a small fixed table, else ``fallback``."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), fallback)


def normalize_role(role: Column) -> Column:
    return (F.when(role.isin(*USER_ROLES), F.lit("user"))
            .when(role.isin(*ASSISTANT_ROLES), F.lit("assistant"))
            .otherwise(role))


def infer_channel(channel_id: Column) -> Column:
    """Bot channel id -> channel name; unknown ids lower-cased, empty -> ``unknown``."""
    low = F.lower(channel_id)
    return lookup(low, CHANNELS, F.coalesce(F.nullif(low, F.lit("")), F.lit("unknown")))


def classify_tool(name: Column) -> Column:
    """Coding-assistant tool -> category, hosted tool call -> short name, else itself."""
    return lookup(name, {**TOOL_CATEGORIES, **INTERNAL_TOOLS}, name)


def log_level(levelno: Column) -> Column:
    return lookup(levelno.cast("int"), LOG_LEVELS, F.lit("info"))


def acceptance_rate(accepted: Column, shown: Column) -> Column:
    """Accepted per 100 shown, one decimal (half up); 0 when nothing was shown."""
    return F.when(shown > 0, F.round(F.lit(100.0) * accepted / shown, 1)).otherwise(F.lit(0.0))


def decode_project_path(encoded: Column) -> Column:
    """``-Users-me`` -> ``/Users/me``; a name with a dash of its own cannot be told apart."""
    return F.concat(F.lit("/"), F.replace(F.ltrim(encoded, F.lit("-")), F.lit("-"), F.lit("/")))


def encode_project_path(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("-"))


def number_text(col: Column) -> Column:
    """Rate as text the way a whole zero is written: ``0`` for nothing, else ``12.5``."""
    return F.when(col == 0, F.lit("0")).otherwise(col.cast("string"))


def parse_iso(col: Column) -> Column:
    """ISO-8601 text -> timestamp, null when it is not one."""
    return F.try_to_timestamp(col)
