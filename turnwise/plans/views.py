"""Deterministic views of the given tables in the shapes the operators take.

Every view is written once in Spark here and once in SQL, below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnwise.functions import tokens as T
from turnwise.operators.turns import number_turns


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stamp(col: str, name: str | None = None):
    """A timestamp as text with microseconds."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or col)


STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"

# --- conversations as transcript lines ----------------------------------------------------


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").selectExpr(
        "conv_id", "concat('conv-', conv_id) AS session_id", "turn AS line", "role", "text",
        "concat('ns', conv_id % 5) AS namespace", "concat('agent', conv_id % 3) AS agent",
        "concat('u', conv_id % 50) AS user_id", "concat('model-', conv_id % 2) AS model",
        "concat('tool_', turn % 3) AS tool",
        "timestamp_micros(1704067200000000 + conv_id * 600000000 + turn * turn * 15000000) AS ts")


LINES = """lines AS (SELECT conv_id, 'conv-' || conv_id AS session_id, turn AS line, role, text,
  'ns' || (conv_id % 5) AS namespace, 'agent' || (conv_id % 3) AS agent, 'u' || (conv_id % 50) AS user_id,
  'model-' || (conv_id % 2) AS model, 'tool_' || (turn % 3) AS tool,
  make_timestamp(1704067200000000 + conv_id * 600000000 + turn * turn * 15000000) AS ts
  FROM conversations)"""

NUMBERED = LINES + """, numbered AS (SELECT *, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (
  PARTITION BY session_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS BIGINT) AS turn_no
  FROM lines WHERE role IN ('user', 'assistant'))"""


def turn_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record per answered turn: tokens from text lengths, narrow columns only."""
    src = lines(spark, sf).where(F.col("role").isin("user", "assistant"))
    src = src.withColumn("n", T.tokens_chars4(F.col("text"))).drop("text", "tool")
    numbered = number_turns(src, F.col("role") == "user").where("turn_no > 0")
    reply = F.col("role") == "assistant"
    # Grouped by the session's constants too: nothing but numbers is aggregated, by hash.
    return numbered.groupBy("session_id", "turn_no", "namespace", "agent", "user_id", "model", "conv_id").agg(
        F.min("ts").alias("ts"),
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.when(~reply, F.col("n"))), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum(F.when(reply, F.col("n"))), F.lit(0)).alias("output_tokens"),
        F.count_if(reply).alias("process_tokens"),
    ).where("process_tokens > 0").withColumns({
        "memory_tokens": F.col("turn_no"), "id": F.concat_ws("-", "session_id", "turn_no"),
        "source": F.expr("CASE conv_id % 3 WHEN 0 THEN 'cline' WHEN 1 THEN 'claude-code' ELSE 'copilot' END"),
        "channel_id": F.expr("CASE conv_id % 4 WHEN 0 THEN 'msteams' WHEN 1 THEN 'webchat' WHEN 2 THEN 'WhatsApp' ELSE '' END"),
        "external_user_name": F.expr("concat('User ', upper(user_id), ' Name')"),
    })


RECORDS = NUMBERED + """, records AS (SELECT session_id, turn_no, any_value(namespace) AS namespace,
  any_value(agent) AS agent, any_value(user_id) AS user_id, any_value(model) AS model, any_value(conv_id) AS conv_id,
  min(ts) AS ts, count(*) AS messages,
  CAST(coalesce(sum(length(text) // 4) FILTER (role = 'user'), 0) AS BIGINT) AS input_tokens,
  CAST(coalesce(sum(length(text) // 4) FILTER (role = 'assistant'), 0) AS BIGINT) AS output_tokens,
  count(*) FILTER (role = 'assistant') AS process_tokens, turn_no AS memory_tokens,
  session_id || '-' || turn_no AS id,
  CASE any_value(conv_id) % 3 WHEN 0 THEN 'cline' WHEN 1 THEN 'claude-code' ELSE 'copilot' END AS source,
  CASE any_value(conv_id) % 4 WHEN 0 THEN 'msteams' WHEN 1 THEN 'webchat' WHEN 2 THEN 'WhatsApp' ELSE '' END AS channel_id,
  'User ' || upper(any_value(user_id)) || ' Name' AS external_user_name
  FROM numbered WHERE turn_no > 0 GROUP BY session_id, turn_no HAVING count(*) FILTER (role = 'assistant') > 0)"""

# --- raw transcript lines -----------------------------------------------------------------

_TEXT_BLOCK = "named_struct('type', 'text', 'text', text)"
_USE_BLOCK = ("named_struct('type', 'tool_use', 'id', concat('call-', conv_id, '-', line), 'name', tool, "
              "'input', named_struct('q', text, 'n', line))")


def claude_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript lines as JSON text with the path of their file.

    Assistant lines hold a thinking block, a text block and, in every third session, a tool
    call; some user lines hold a block list; usage without output tokens occurs.
    """
    usage = ("named_struct('input_tokens', length(text), 'output_tokens', line % 5, "
             "'cache_creation_input_tokens', conv_id % 7, 'cache_read_input_tokens', line)")
    text, use = f"to_json({_TEXT_BLOCK})", f"to_json({_USE_BLOCK})"
    blocks = (f"concat('[{{\"type\":\"thinking\",\"thinking\":\"hm\"}},', {text}, "
              f"CASE WHEN conv_id % 3 = 0 THEN concat(',', {use}) ELSE '' END, ']')")
    return lines(spark, sf).selectExpr(
        "concat('/data/projects/-Users-', namespace, '-app/', session_id, '.jsonl') AS path", "line",
        f"""CASE role
          WHEN 'user' THEN concat('{{"type":"user","message":{{"role":"user","content":',
            CASE WHEN line % 4 = 2 THEN to_json(array({_TEXT_BLOCK})) ELSE to_json(CAST(text AS VARIANT)) END, '}}}}')
          WHEN 'assistant' THEN concat('{{"type":"assistant","message":{{"role":"assistant","model":"', model,
            '","content":', {blocks}, ',"usage":', to_json({usage}), '}}}}')
          ELSE concat('{{"type":"', role, '","content":', to_json(CAST(text AS VARIANT)), '}}') END AS value""")


def openclaw_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Gateway lines; system lines become compaction entries without a message."""
    block = f"concat('[', to_json({_TEXT_BLOCK}), ',', to_json({_USE_BLOCK}), ']')"
    return lines(spark, sf).selectExpr(
        "concat('/state/agents/', CASE WHEN conv_id % 4 = 0 THEN 'default' ELSE agent END, '/sessions/', session_id, '.jsonl') AS path",
        "line",
        f"""CASE WHEN role = 'system' THEN '{{"type":"compaction"}}' ELSE concat('{{"id":"', line, '","message":{{"role":"', role,
          '","content":', CASE WHEN role = 'assistant' AND conv_id % 3 = 0 THEN {block}
            ELSE to_json(CAST(text AS VARIANT)) END, '}}}}') END AS value""")


def cline_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Task lines: in every second session the later user lines are tool results."""
    result = ("concat('[{\"type\":\"tool_result\",\"tool_use_id\":\"call-', conv_id, '-', line - 1, '\",\"content\":', "
              "to_json(CAST(text AS VARIANT)), '}]')")
    block = f"concat('[', to_json({_TEXT_BLOCK}), ',', to_json({_USE_BLOCK}), ']')"
    return lines(spark, sf).selectExpr(
        "concat('cline-', session_id) AS session_id", "line", "role", "agent",
        f"""try_parse_json(CASE WHEN role = 'user' AND conv_id % 2 = 1 AND line > 1 THEN {result}
          WHEN role = 'assistant' AND conv_id % 3 = 0 THEN {block}
          ELSE to_json(CAST(text AS VARIANT)) END) AS content""")


# --- events as activity, logs, traces, requests -------------------------------------------


def activity(spark: SparkSession, sf: str) -> DataFrame:
    return activity_of(table(spark, sf, "events"))


def activity_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "ts", "concat('ns', user_id % 5) AS namespace", "CASE WHEN user_id % 50 <> 0 THEN cast(user_id AS string) END AS user_id",
        "event_type = 'signup' AS force_new", "event_type = 'error' AS is_close")


ACTIVITY = """activity AS (SELECT event_id, ts, 'ns' || (user_id % 5) AS namespace, CASE WHEN user_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) ELSE 'anonymous' END AS user_id,
  event_type = 'signup' AS force_new, event_type = 'error' AS is_close FROM events)"""


def sessionized(timeout: int, forced: bool = False, closing: bool = False) -> str:
    """SQL of sessionized activity as ``sessionized(event_id, ..., session_id)``."""
    extra = (" OR force_new" if forced else "") + (" OR coalesce(prev_close, false)" if closing else "")
    return ACTIVITY + f""", flagged AS (SELECT *, (prev_ts IS NULL OR ts - prev_ts >= INTERVAL {timeout} SECOND{extra}) AS opens
  FROM (SELECT *, lag(ts) OVER w AS prev_ts, lag(is_close) OVER w AS prev_close FROM activity
    WINDOW w AS (PARTITION BY namespace, user_id ORDER BY ts, event_id))),
  grouped AS (SELECT *, CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY namespace, user_id
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM flagged),
  sessionized AS (SELECT event_id, ts, namespace, user_id, session_no, namespace || '-' || user_id || '-' ||
    strftime(min(ts) OVER (PARTITION BY namespace, user_id, session_no), '%Y%m%d-%H%M%S-%f') AS session_id FROM grouped),
  sessions AS (SELECT namespace, user_id, session_id, min(ts) AS created_at, max(ts) AS last_activity, count(*) AS events
    FROM sessionized GROUP BY ALL)"""


def logs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id AS id", "concat('ns', user_id % 5) AS namespace",
        "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' WHEN 'click' THEN 'debug' ELSE 'info' END AS level",
        "event_type AS message", "concat(event_type, '-', user_id) AS resource_id", "ts AS timestamp",
        "props AS custom_object", "user_id")


LOGS = """logs AS (SELECT event_id AS id, 'ns' || (user_id % 5) AS namespace,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' WHEN 'click' THEN 'debug' ELSE 'info' END AS level,
  event_type AS message, event_type || '-' || user_id AS resource_id, ts AS "timestamp", props AS custom_object, user_id FROM events)"""


def traces(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id", "CASE event_type WHEN 'view' THEN 'llm' WHEN 'click' THEN 'tool' WHEN 'purchase' THEN 'handoff' ELSE 'log' END AS type",
        "concat('s', user_id) AS session_id", "concat('ns', user_id % 5) AS namespace", "ts",
        "cast(floor(value) AS bigint) AS latency_ms", "concat('tool', user_id % 7) AS tool_name",
        "concat('agent', user_id % 3) AS agent", "concat('agent', user_id % 3) AS from_agent",
        "concat('agent', event_id % 4) AS to_agent", "concat('r', event_id % 5) AS reason",
        "concat('model', event_id % 3) AS model", "value > 100 AS is_error", "props")


TRACES = """traces AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'llm' WHEN 'click' THEN 'tool'
  WHEN 'purchase' THEN 'handoff' ELSE 'log' END AS type, 's' || user_id AS session_id, 'ns' || (user_id % 5) AS namespace, ts,
  CAST(floor(value) AS BIGINT) AS latency_ms, 'tool' || (user_id % 7) AS tool_name, 'agent' || (user_id % 3) AS agent,
  'agent' || (user_id % 3) AS from_agent, 'agent' || (event_id % 4) AS to_agent, 'r' || (event_id % 5) AS reason,
  'model' || (event_id % 3) AS model, value > 100 AS is_error, props FROM events)"""


def usage(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(
        F.concat(F.lit("u"), "user_id").alias("user"), F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(
        F.count_if(F.col("event_type") == "view").alias("shown"),
        F.count_if(F.col("event_type") == "purchase").alias("accepted")).withColumn(
        "editor", F.concat(F.lit("editor"), F.length("user")))


USAGE = """usage AS (SELECT 'u' || user_id AS "user", strftime(ts, '%Y-%m-%d') AS date,
  count(*) FILTER (event_type = 'view') AS shown, count(*) FILTER (event_type = 'purchase') AS accepted,
  'editor' || length('u' || user_id) AS editor FROM events GROUP BY 1, 2, 5)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with keys: some without a key, some failed, bodies that change."""
    return table(spark, sf, "events").selectExpr(
        "event_id AS id", "ts", "concat('ns', user_id % 5) AS tenant",
        "CASE WHEN event_id % 10 <> 0 THEN concat('k', user_id % 40) END AS request_key",
        "concat('b', (event_id % 7) DIV 4) AS body_hash", "event_type <> 'error' AS is_ok")


def dups(spark: SparkSession, sf: str) -> DataFrame:
    return dups_of(table(spark, sf, "documents"))


def dups_of(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("id"), F.md5("text").alias("key"),
        F.timestamp_seconds(F.col("doc_id") + 86400).alias("ts"), "lang", "source")


DUPS = "dups AS (SELECT doc_id AS id, md5(text) AS key, make_timestamp((doc_id + 86400) * 1000000) AS ts, lang, source FROM documents)"


def messages_digest(msg):
    """Roles and texts of a message array as one hash."""
    return F.md5(F.array_join(F.transform(msg, lambda m: F.concat(
        m["role"], F.lit(":"), F.coalesce(m["content"], F.lit("-")))), "|"))


