"""Coding-assistant transcripts -> lines and conversations.

Each source is a thin reader, which adds the file path and the line's place in the file,
over a parser that takes a table with ``path``, ``line`` and ``value`` and so also works on
transcripts that were landed in a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnwise.functions import content as C, tokens as T

_ROW_IN_TASK = (1 << 33) - 1


def file_path(path: Column) -> Column:
    """Path of a file without its URL escapes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def read_text_lines(spark: SparkSession, path, pattern: str | None = None) -> DataFrame:
    """``path, line, value`` of text files, split freely over tasks.

    ``line`` grows along a file: the byte offset of the split plus the row's number in its
    task. A row takes at least a byte, so numbers of different splits do not overlap.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_TASK))
    return reader.text(path).select(
        file_path(F.col("_metadata.file_path")).alias("path"),
        (F.col("_metadata.file_block_start") + row).alias("line"), "value")


def _read_whole(spark: SparkSession, path, name: str) -> DataFrame:
    return (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", name).text(path)
            .select(file_path(F.col("_metadata.file_path")).alias("path"), "value"))


def parse_claude_lines(raw: DataFrame, agent: str = "claude-code") -> DataFrame:
    """Transcript lines; blank and broken lines are skipped.

    The session is the file's name, the project the decoded name of its folder.
    """
    def get(path: str, ddl: str) -> Column:
        return F.try_variant_get("_v", path, ddl)
    encoded = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return (raw.withColumn("_v", C.once(F.try_parse_json(F.trim("value")))).where(F.schema_of_variant("_v").startswith("OBJECT"))
            .select(file_stem(F.col("path")).alias("session_id"), encoded.alias("project_dir"),
                    T.decode_project_path(encoded).alias("project"), "line",
                    F.coalesce(get("$.type", "string"), F.lit("")).alias("role"),
                    get("$.message.content", "variant").alias("content"),
                    get("$.message.model", "string").alias("model"),
                    get("$.message.usage", "variant").alias("usage"), F.lit(agent).alias("agent")))


def read_claude_sessions(spark: SparkSession, path, agent: str = "claude-code") -> DataFrame:
    return parse_claude_lines(read_text_lines(spark, path, "*.jsonl"), agent)


def parse_openclaw_lines(raw: DataFrame, agent: str = "openclaw") -> DataFrame:
    """Gateway transcript lines below ``agents/{id}/sessions``; lines without a message are skipped."""
    message = F.try_variant_get("_v", "$.message", "variant")
    agent_id = F.coalesce(F.nullif(F.regexp_extract("path", r"(?:^|/)agents/([^/]+)(?:/|$)", 1), F.lit("")),
                          F.lit("unknown"))
    return (raw.withColumn("_v", C.once(F.try_parse_json(F.trim("value"))))
            .withColumn("_m", message).where(F.schema_of_variant("_m").startswith("OBJECT"))
            .select(F.concat(F.lit("openclaw-"), file_stem(F.col("path"))).alias("session_id"),
                    agent_id.alias("agent_id"), "line",
                    F.coalesce(F.try_variant_get("_m", "$.role", "string"), F.lit("")).alias("role"),
                    F.try_variant_get("_m", "$.content", "variant").alias("content"),
                    F.concat(F.lit("openclaw/"), agent_id).alias("sender"), F.lit(agent).alias("agent"),
                    F.when(agent_id == "default", F.lit(agent)).otherwise(
                        F.concat(F.lit(f"{agent}/"), agent_id)).alias("agent_label")))


def read_openclaw_sessions(spark: SparkSession, root, agent: str = "openclaw") -> DataFrame:
    return parse_openclaw_lines(read_text_lines(spark, root, "*.jsonl"), agent)


def parse_cline_tasks(raw: DataFrame, agent: str = "cline") -> DataFrame:
    """Task history arrays (``path``, ``value``) -> lines; anything but a list gives none."""
    task = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return (raw.select(task.alias("task_id"), C.as_array(F.try_parse_json("value")).alias("_a"))
            .select("task_id", F.posexplode("_a").alias("line", "_m"))
            .select(F.concat(F.lit("cline-"), F.col("task_id")).alias("session_id"),
                    F.col("line").cast("bigint").alias("line"),
                    F.coalesce(C.get_text(F.col("_m"), "$.role"), F.lit("")).alias("role"),
                    F.try_variant_get("_m", "$.content", "variant").alias("content"),
                    F.lit(agent).alias("agent")))


def read_cline_tasks(spark: SparkSession, root, agent: str = "cline") -> DataFrame:
    return parse_cline_tasks(_read_whole(spark, root, "api_conversation_history.json"), agent)


def parse_copilot_chat(raw: DataFrame) -> DataFrame:
    """Chat history files (``path``, ``value``) -> ``path, conv_id, turns``, one row per conversation."""
    convs = F.coalesce(C.as_array(F.col("_v")), C.as_array(F.try_variant_get("_v", "$.conversations", "variant")))
    def first(a: str, b: str, ddl: str) -> Column:
        return F.coalesce(F.try_variant_get("_c", f"$.{a}", ddl), F.try_variant_get("_c", f"$.{b}", ddl))
    return (raw.select("path", C.once(F.try_parse_json(F.col("value"))).alias("_v")).select("path", F.explode(convs).alias("_c"))
            .select("path", F.coalesce(first("id", "conversationId", "string"), F.lit("")).alias("conv_id"),
                    first("turns", "messages", "array<variant>").alias("turns"))
            .where(F.size("turns") > 0))


def read_copilot_chat(spark: SparkSession, path) -> DataFrame:
    return parse_copilot_chat(_read_whole(spark, path, "conversations.json"))


def list_projects(lines: DataFrame) -> DataFrame:
    """Projects of transcript lines with session and line counts."""
    return lines.groupBy(F.col("project_dir").alias("encoded_name"), F.col("project").alias("decoded_path")).agg(
        F.countDistinct("session_id").alias("session_count"), F.count(F.lit(1)).alias("line_count"))


def list_agents(lines: DataFrame) -> DataFrame:
    """Gateway agents with session counts."""
    return lines.groupBy("agent_id").agg(F.countDistinct("session_id").alias("session_count"))


def list_tasks(lines: DataFrame) -> DataFrame:
    """Tasks with message counts."""
    return lines.groupBy(F.regexp_replace("session_id", "^cline-", "").alias("task_id")).agg(
        F.count(F.lit(1)).alias("message_count"))
