"""Queries over transcript lines: parsing, turns, message shapes, incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwise.functions import content as C, tokens as T
from turnwise.operators import incremental, rollups
from turnwise.operators.turns import chat_records, group_turns
from turnwise.plans import views as V
from turnwise.plans.registry import query
from turnwise.sources import transcripts as S

_KIND = "CASE WHEN role = 'assistant' AND conv_id % 3 = 0"


@query("s4_claude_lines", f"""WITH {V.LINES} SELECT session_id, line, role, '/Users/' || namespace || '/app' AS project,
  CASE WHEN role = 'assistant' THEN model END AS model,
  CASE WHEN role IN ('user', 'assistant') THEN md5(text) ELSE md5('') END AS text_md5 FROM lines""")
def s4(spark, sf):
    parsed = S.parse_claude_lines(V.claude_raw(spark, sf))
    return parsed.select("session_id", "line", "role", "project", "model",
                         F.md5(C.extract_text(F.col("content"))).alias("text_md5"))


@query("s5_openclaw_lines", f"""WITH {V.LINES} SELECT 'openclaw-' || session_id AS session_id, line, role,
  CASE WHEN conv_id % 4 = 0 THEN 'openclaw' ELSE 'openclaw/' || agent END AS agent_label, md5(text) AS text_md5
  FROM lines WHERE role <> 'system'""")
def s5(spark, sf):
    parsed = S.parse_openclaw_lines(V.openclaw_raw(spark, sf))
    return parsed.select("session_id", "line", "role", "agent_label",
                         F.md5(C.extract_text(F.col("content"))).alias("text_md5"))


def _task_files(spark, sf):
    """One task file per conversation line: the line's text asked in halves."""
    half = "CAST(length(text) DIV 2 AS INT)"
    return V.lines(spark, sf).selectExpr(
        "concat('/tasks/', conv_id, '-', line, '/api_conversation_history.json') AS path",
        f"""CASE WHEN line % 5 = 4 THEN '{{"not":"a list"}}' ELSE to_json(array(
          named_struct('role', 'user', 'content', substr(text, 1, {half})),
          named_struct('role', 'assistant', 'content', substr(text, {half} + 1)))) END AS value""")


@query("s6_cline_tasks", f"""WITH {V.LINES} SELECT 'cline-' || conv_id || '-' || line AS session_id, CAST(p AS BIGINT) AS line,
  CASE p WHEN 0 THEN 'user' ELSE 'assistant' END AS role,
  md5(CASE p WHEN 0 THEN substr(text, 1, length(text) // 2) ELSE substr(text, length(text) // 2 + 1) END) AS text_md5
  FROM lines, (VALUES (0), (1)) AS x(p) WHERE line % 5 <> 4""")
def s6(spark, sf):
    return S.parse_cline_tasks(_task_files(spark, sf)).select(
        "session_id", "line", "role", F.md5(C.extract_text(F.col("content"))).alias("text_md5"))


def _chat_files(spark, sf):
    """One chat file per conversation line, in both envelopes and with both sets of field names."""
    half = "CAST(length(text) DIV 2 AS INT)"
    return V.lines(spark, sf).selectExpr(
        "concat('/ws/', conv_id, '/github.copilot-chat/conversations.json') AS path",
        f"""CASE WHEN line % 2 = 0 THEN to_json(array(named_struct('id', concat(conv_id, '-', line), 'turns', array(
            named_struct('role', 'human', 'content', substr(text, 1, {half})),
            named_struct('role', 'bot', 'content', substr(text, {half} + 1)), named_struct('role', 'bot', 'content', '')))))
          ELSE to_json(named_struct('conversations', array(named_struct('conversationId', concat(conv_id, '-', line), 'messages', array(
            named_struct('type', 'question', 'text', substr(text, 1, {half})),
            named_struct('type', 'answer', 'text', substr(text, {half} + 1))))))) END AS value""")


_CHAT = f"""WITH {V.LINES}, chat AS (SELECT 'copilot-' || conv_id || '-' || line AS session_id,
  substr(text, 1, length(text) // 2) AS q, substr(text, length(text) // 2 + 1) AS a FROM lines)
  SELECT session_id, CAST((q <> '')::INT + (a <> '')::INT AS BIGINT) AS messages, CAST(length(q) // 4 AS BIGINT) AS input_tokens,
  CAST(length(a) // 4 AS BIGINT) AS output_tokens, CAST(length(q) // 4 + length(a) // 4 AS BIGINT) AS total_tokens,
  md5(concat_ws('|', CASE WHEN q <> '' THEN 'user:' || q END, CASE WHEN a <> '' THEN 'assistant:' || a END)) AS digest
  FROM chat WHERE q <> '' OR a <> ''"""


@query("s7_copilot_chat", f"""WITH {V.LINES} SELECT conv_id || '-' || line AS conv_id,
  CAST(CASE WHEN line % 2 = 0 THEN 3 ELSE 2 END AS BIGINT) AS turns FROM lines""")
def s7(spark, sf):
    return S.parse_copilot_chat(_chat_files(spark, sf)).select("conv_id", F.size("turns").cast("bigint").alias("turns"))


@query("t4_group_conversation", _CHAT)
def t4(spark, sf):
    rec = chat_records(S.parse_copilot_chat(_chat_files(spark, sf)))
    return rec.select("session_id", F.size("msg").cast("bigint").alias("messages"), "input_tokens", "output_tokens",
                      "total_tokens", V.messages_digest(F.col("msg")).alias("digest"))


@query("s12_list_projects", f"""WITH {V.LINES} SELECT '-Users-' || namespace || '-app' AS encoded_name,
  '/Users/' || namespace || '/app' AS decoded_path, count(DISTINCT session_id) AS session_count, count(*) AS line_count
  FROM lines GROUP BY 1, 2""")
def s12_projects(spark, sf):
    return S.list_projects(S.parse_claude_lines(V.claude_raw(spark, sf)))


@query("s12_list_agents", f"""WITH {V.LINES} SELECT CASE WHEN conv_id % 4 = 0 THEN 'default' ELSE agent END AS agent_id,
  count(DISTINCT session_id) AS session_count FROM lines WHERE role <> 'system' GROUP BY 1""")
def s12_agents(spark, sf):
    return S.list_agents(S.parse_openclaw_lines(V.openclaw_raw(spark, sf)))


@query("s12_list_tasks", f"""WITH {V.LINES} SELECT conv_id || '-' || line AS task_id, CAST(2 AS BIGINT) AS message_count
  FROM lines WHERE line % 5 <> 4""")
def s12_tasks(spark, sf):
    return S.list_tasks(S.parse_cline_tasks(_task_files(spark, sf)))


# --- turns --------------------------------------------------------------------------------

_T1 = f"""WITH {V.NUMBERED} SELECT session_id, turn_no,
  CAST(sum(CASE WHEN role = 'assistant' AND conv_id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS messages,
  CAST(coalesce(arg_max(length(text), line) FILTER (role = 'assistant' AND line % 5 > 0), 0) AS BIGINT) AS input_tokens,
  CAST(coalesce(arg_max(line % 5, line) FILTER (role = 'assistant' AND line % 5 > 0), 0) AS BIGINT) AS output_tokens,
  CAST(coalesce(arg_max(conv_id % 7, line) FILTER (role = 'assistant' AND line % 5 > 0), 0) AS BIGINT) AS process_tokens,
  CAST(coalesce(arg_max(line, line) FILTER (role = 'assistant' AND line % 5 > 0), 0) AS BIGINT) AS memory_tokens,
  any_value(model) AS model,
  md5(string_agg(role || ':' || text || {_KIND} THEN '|tool:Tool: ' || tool ELSE '' END, '|' ORDER BY line)) AS digest
  FROM numbered WHERE turn_no > 0 GROUP BY session_id, turn_no HAVING count(*) FILTER (role = 'assistant') > 0"""


def claude_turns(spark, sf, **kw):
    return group_turns(S.parse_claude_lines(V.claude_raw(spark, sf)), "claude", **kw)


@query("t1_group_turns", _T1)
def t1(spark, sf):
    return claude_turns(spark, sf).select(
        "session_id", "turn_no", F.size("msg").cast("bigint").alias("messages"), *T.TOKEN_FIELDS, "model",
        V.messages_digest(F.col("msg")).alias("digest"))


@query("t2_group_turns_openclaw", f"""WITH {V.NUMBERED} SELECT 'openclaw-' || session_id AS session_id, turn_no,
  CAST(sum({_KIND} THEN 2 ELSE 1 END) AS BIGINT) AS messages,
  CAST(coalesce(sum(length(text) // 4) FILTER (role = 'user'), 0) AS BIGINT) AS input_tokens,
  CAST(coalesce(sum(length(text) // 4) FILTER (role = 'assistant'), 0) AS BIGINT) AS output_tokens,
  CAST(coalesce(sum(length('Tool: ' || tool) // 4) FILTER (role = 'assistant' AND conv_id % 3 = 0), 0) AS BIGINT) AS process_tokens,
  md5(string_agg(role || ':' || text || {_KIND} THEN '|tool:Tool: ' || tool ELSE '' END, '|' ORDER BY line)) AS digest
  FROM numbered WHERE turn_no > 0 AND (role = 'user' OR text <> '' OR conv_id % 3 = 0)
  GROUP BY session_id, turn_no HAVING count(*) FILTER (role = 'assistant') > 0""")
def t2(spark, sf):
    turns = group_turns(S.parse_openclaw_lines(V.openclaw_raw(spark, sf)), "openclaw")
    return turns.select("session_id", "turn_no", F.size("msg").cast("bigint").alias("messages"), "input_tokens",
                        "output_tokens", "process_tokens", V.messages_digest(F.col("msg")).alias("digest"))


_T3 = f"""WITH {V.LINES}, flagged AS (SELECT *, role = 'user' AND conv_id % 2 = 1 AND line > 1 AS is_result
  FROM lines WHERE role IN ('user', 'assistant')), numbered AS (SELECT *, CAST(sum(CASE WHEN role = 'user' AND NOT is_result
  THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS BIGINT) AS turn_no FROM flagged),
  parts AS (SELECT *, '{{"n":' || line || ',"q":' || to_json(text) || '}}' AS args,
    CASE WHEN is_result THEN 'tool:' || substr(text, 1, 500)
      WHEN role = 'assistant' AND conv_id % 3 = 0 THEN 'assistant:' || text || '|tool:Tool: ' || tool
      WHEN role = 'assistant' THEN 'assistant:' || text WHEN text <> '' THEN 'user:' || text END AS part FROM numbered)
  SELECT 'cline-' || session_id AS session_id, turn_no,
  CAST(coalesce(sum(length(text) // 4) FILTER (role = 'user' AND NOT is_result), 0) AS BIGINT) AS input_tokens,
  CAST(coalesce(sum(length(text) // 4) FILTER (role = 'assistant'), 0) AS BIGINT) AS output_tokens,
  CAST(coalesce(sum(length(text) // 4) FILTER (is_result), 0)
    + coalesce(sum(length(args) // 4) FILTER (role = 'assistant' AND conv_id % 3 = 0), 0) AS BIGINT) AS process_tokens,
  md5(string_agg(part, '|' ORDER BY line)) AS digest FROM parts GROUP BY session_id, turn_no HAVING count(part) > 0"""


@query("t3_group_turns_cline", _T3)
def t3(spark, sf):
    turns = group_turns(V.cline_lines(spark, sf), "cline")
    return turns.select("session_id", "turn_no", "input_tokens", "output_tokens", "process_tokens",
                        V.messages_digest(F.col("msg")).alias("digest"))


# --- message parts ------------------------------------------------------------------------

@query("p3_extract_text", f"""WITH {V.LINES} SELECT session_id, line, CASE WHEN role IN ('user', 'assistant')
  THEN text ELSE '' END AS text FROM lines""")
def p3(spark, sf):
    return S.parse_claude_lines(V.claude_raw(spark, sf)).select(
        "session_id", "line", C.extract_text(F.col("content")).alias("text"))


@query("p4_extract_tool_calls", f"""WITH {V.LINES} SELECT session_id, line, tool AS name, 'call-' || conv_id || '-' || line AS id,
  text AS q, line AS n FROM lines WHERE role = 'assistant' AND conv_id % 3 = 0""")
def p4(spark, sf):
    calls = S.parse_claude_lines(V.claude_raw(spark, sf)).select(
        "session_id", "line", F.explode(C.extract_tool_calls(F.col("content"))).alias("c"))
    args = F.try_parse_json("c.arguments")
    return calls.select("session_id", "line", "c.name", "c.id", F.try_variant_get(args, "$.q", "string").alias("q"),
                        F.try_variant_get(args, "$.n", "bigint").alias("n"))


@query("p5_build_messages", f"""WITH {V.NUMBERED}, kept AS (SELECT *, count(*) FILTER (role = 'assistant') OVER (
  PARTITION BY session_id, turn_no) AS replies FROM numbered WHERE turn_no > 0), msgs AS (
  SELECT session_id, turn_no, role, md5(text) AS content_md5, CASE role WHEN 'user' THEN 'user' ELSE model END AS sender,
    CAST(NULL AS VARCHAR) AS tool_name FROM kept WHERE replies > 0
  UNION ALL SELECT session_id, turn_no, 'tool', md5('Tool: ' || tool), 'claude-code', tool FROM kept
    WHERE replies > 0 AND role = 'assistant' AND conv_id % 3 = 0)
  SELECT session_id, turn_no, role, content_md5, sender, tool_name FROM msgs""")
def p5(spark, sf):
    return claude_turns(spark, sf).select("session_id", "turn_no", F.explode("msg").alias("m")).select(
        "session_id", "turn_no", "m.role", F.md5("m.content").alias("content_md5"), "m.sender", "m.tool_name")


@query("p6_anthropic_usage", f"""WITH {V.LINES} SELECT session_id, line, CAST(length(text) AS BIGINT) AS input_tokens,
  line % 5 AS output_tokens, conv_id % 7 AS process_tokens, line AS memory_tokens FROM lines WHERE role = 'assistant'""")
def p6(spark, sf):
    lines = S.parse_claude_lines(V.claude_raw(spark, sf)).where("role = 'assistant'")
    return lines.select("session_id", "line", T.map_anthropic_usage(F.col("usage")).alias("u")).select(
        "session_id", "line", "u.*")


@query("p10_normalize_role", f"""WITH {V.LINES} SELECT session_id, line,
  CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' ELSE role END AS role FROM lines""")
def p10(spark, sf):
    raw = V.lines(spark, sf).withColumn("raw_role", F.expr(
        "CASE role WHEN 'user' THEN element_at(array('human','user','question'), cast(line % 3 + 1 AS int)) "
        "WHEN 'assistant' THEN element_at(array('bot','assistant','answer','model'), cast(line % 4 + 1 AS int)) ELSE role END"))
    return raw.select("session_id", "line", T.normalize_role(F.col("raw_role")).alias("role"))


@query("p11_infer_channel", f"""WITH {V.RECORDS} SELECT id, CASE channel_id WHEN 'msteams' THEN 'teams' WHEN 'webchat' THEN 'web'
  WHEN '' THEN 'unknown' ELSE lower(channel_id) END AS channel FROM records""")
def p11(spark, sf):
    return V.turn_records(spark, sf).select("id", T.infer_channel(F.col("channel_id")).alias("channel"))


_TOOLS = "'read_file', 'execute_command', 'browser_action', 'web_search_call', 'own_tool'"


@query("p12_classify_tool", f"""WITH {V.LINES}, named AS (SELECT session_id, line,
  list_value({_TOOLS})[line % 5 + 1] AS name FROM lines) SELECT session_id, line, CASE name WHEN 'read_file' THEN 'file_read'
  WHEN 'execute_command' THEN 'terminal' WHEN 'browser_action' THEN 'browser' WHEN 'web_search_call' THEN 'web_search'
  ELSE name END AS category FROM named""")
def p12(spark, sf):
    named = V.lines(spark, sf).selectExpr("session_id", "line", f"element_at(array({_TOOLS}), cast(line % 5 + 1 AS int)) AS name")
    return named.select("session_id", "line", T.classify_tool(F.col("name")).alias("category"))


@query("p15_project_paths", f"""WITH {V.LINES} SELECT DISTINCT '-Users-' || namespace || '-app' AS encoded,
  '/Users/' || namespace || '/app' AS decoded, '-Users-' || namespace || '-app' AS again FROM lines""")
def p15(spark, sf):
    enc = V.lines(spark, sf).select(F.concat(F.lit("-Users-"), "namespace", F.lit("-app")).alias("encoded")).distinct()
    dec = enc.withColumn("decoded", T.decode_project_path(F.col("encoded")))
    return dec.withColumn("again", T.encode_project_path(F.col("decoded")))


# --- incremental, pairing -----------------------------------------------------------------

@query("j2_incremental_turns", f"""WITH {V.RECORDS}, n AS (SELECT session_id, conv_id, row_number() OVER (
  PARTITION BY session_id ORDER BY turn_no) AS k FROM records)
  SELECT session_id, count(*) FILTER (k > CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END) AS new_turns,
  count(*) FILTER (k <= CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END) AS skipped FROM n GROUP BY session_id""")
def j2(spark, sf):
    turns = incremental.renumber(V.turn_records(spark, sf).select("session_id", "conv_id", "turn_no"))
    offsets = V.lines(spark, sf).where("conv_id % 2 = 0").select("session_id", F.lit(1).cast("bigint").alias("turns")).distinct()
    return incremental.incremental_report(incremental.mark_new_turns(turns, offsets))


@query("j2_only_closed", f"""WITH {V.RECORDS}, n AS (SELECT session_id, turn_no, row_number() OVER (PARTITION BY session_id
  ORDER BY turn_no) AS k, count(*) OVER (PARTITION BY session_id) AS c FROM records)
  SELECT session_id, CAST(k AS BIGINT) AS turn_no, k < c AS is_new FROM n""")
def j2_closed(spark, sf):
    turns = incremental.renumber(V.turn_records(spark, sf).select("session_id", "turn_no"))
    none = turns.where("false").select("session_id", F.col("turn_no").alias("turns"))
    return incremental.mark_new_turns(turns, none, only_closed=True)


@query("j4_pair_tool_calls", f"""WITH {V.LINES}, c AS (SELECT 'cline-' || session_id AS session_id, 'call-' || conv_id || '-' || line AS call_id,
    tool AS tool_name, line AS call_line FROM lines WHERE role = 'assistant' AND conv_id % 3 = 0),
  r AS (SELECT 'cline-' || session_id AS session_id, 'call-' || conv_id || '-' || (line - 1) AS call_id, line AS result_line, text AS result
    FROM lines WHERE role = 'user' AND conv_id % 2 = 1 AND line > 1)
  SELECT c.session_id, c.call_id, tool_name, call_line, result_line, result, result_line IS NOT NULL AS answered
  FROM c LEFT JOIN r ON c.session_id = r.session_id AND c.call_id = r.call_id""")
def j4(spark, sf):
    lines = V.cline_lines(spark, sf)
    calls = lines.where("role = 'assistant'").select(
        "session_id", "line", F.explode(C.extract_tool_calls(F.col("content"))).alias("c")).select(
        "session_id", F.col("c.id").alias("call_id"), "line", F.col("c.name").alias("tool_name"))
    blocks = F.filter(C.as_array(F.col("content")), lambda b: C.block_type(b) == "tool_result")
    results = lines.where("role = 'user'").select("session_id", "line", F.explode(blocks).alias("b")).select(
        "session_id", C.get_text(F.col("b"), "$.tool_use_id").alias("call_id"), "line",
        C.get_text(F.col("b"), "$.content").alias("text"))
    return rollups.pair_tool_calls(calls, results)


# --- token estimates and scalar functions ---------------------------------------------------

@query("f1_tokens_chars4", f"WITH {V.LINES} SELECT session_id, line, CAST(length(text) // 4 AS BIGINT) AS tokens FROM lines")
def f1(spark, sf):
    return V.lines(spark, sf).select("session_id", "line", T.tokens_chars4(F.col("text")).alias("tokens"))


@query("f2_tokens_chars4_min1", f"""WITH {V.LINES} SELECT session_id, line, CAST(greatest(1, length(text) // 4) AS BIGINT) AS tokens,
  CAST(0 AS BIGINT) AS off FROM lines""")
def f2(spark, sf):
    return V.lines(spark, sf).select("session_id", "line", T.tokens_chars4_min1(F.col("text")).alias("tokens"),
                                     T.tokens_chars4_min1(F.col("text"), estimate=False).alias("off"))


@query("f3_tokens_words", f"""WITH {V.LINES} SELECT session_id, line, CAST(floor(len(list_filter(regexp_split_to_array(text, '\\s+'),
  lambda x: x <> '')) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS tokens FROM lines""")
def f3(spark, sf):
    return V.lines(spark, sf).select("session_id", "line", T.tokens_words(F.col("text")).alias("tokens"))


@query("f4_tokens_payload", "SELECT event_id, CAST(length(replace(props, ' ', '')) // 4 AS BIGINT) AS tokens FROM events")
def f4(spark, sf):
    return V.table(spark, sf, "events").select("event_id", T.tokens_payload(F.try_parse_json("props")).alias("tokens"))


@query("f5_preview", "SELECT doc_id, md5(substr(text, 1, 500)) AS preview, 'Tool result: ' || substr(text, 1, 200) AS result FROM documents")
def f5(spark, sf):
    from turnwise.operators.folds import TOOL_RESULT_PREVIEW
    from turnwise.operators.turns import RESULT_PREVIEW
    return V.table(spark, sf, "documents").select(
        "doc_id", F.md5(F.substring("text", 1, RESULT_PREVIEW)).alias("preview"),
        F.concat(F.lit("Tool result: "), F.substring("text", 1, TOOL_RESULT_PREVIEW)).alias("result"))


@query("f7_resource_ids", """SELECT event_id, 'ns' || (user_id % 5) || '-' || user_id || '-' || strftime(ts, '%Y%m%d-%H%M%S-%f') AS session_id,
  'copilot-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS resource_id FROM events""")
def f7(spark, sf):
    from turnwise.operators.sessions import session_id
    return V.table(spark, sf, "events").withColumn("namespace", F.concat(F.lit("ns"), F.col("user_id") % 5)).select(
        "event_id", session_id([F.col("namespace"), F.col("user_id")], F.col("ts")).alias("session_id"),
        F.concat_ws("-", F.lit("copilot"), "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("resource_id"))


@query("f8_json_values", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS BIGINT) AS missing, replace(props, ' ', '') AS text FROM events")
def f8(spark, sf):
    v = F.try_parse_json("props")
    return V.table(spark, sf, "events").select(
        "event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"),
        F.try_variant_get(v, "$.none", "bigint").alias("missing"), F.to_json(v).alias("text"))


@query("f9_map_lookup", """SELECT event_id, CASE (event_id % 6) * 10 WHEN 10 THEN 'debug' WHEN 20 THEN 'info' WHEN 30 THEN 'warn'
  WHEN 40 THEN 'error' WHEN 50 THEN 'error' ELSE 'info' END AS level FROM events""")
def f9(spark, sf):
    return V.table(spark, sf, "events").select("event_id", T.log_level((F.col("event_id") % 6) * 10).alias("level"))


@query("f10_iso_times", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS hour,
  CAST(NULL AS VARCHAR) AS bad FROM events""")
def f10(spark, sf):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    at = T.parse_iso(iso)
    return V.table(spark, sf, "events").select("event_id", at.alias("parsed"), T.parse_iso(F.col("props")).alias("bad")).select(
        "event_id", V.stamp("parsed"), V.stamp(F.date_trunc("hour", "parsed"), "hour"), F.col("bad").cast("string").alias("bad"))


@query("f11_array_functions", f"""WITH {V.NUMBERED} SELECT session_id, turn_no, CAST(sum({_KIND} THEN 2 ELSE 1 END) AS BIGINT) AS messages,
  bool_or(role = 'assistant' AND conv_id % 3 = 0) AS has_tool, CAST(coalesce(sum(1) FILTER (role = 'assistant' AND conv_id % 3 = 0), 0) AS BIGINT) AS tools,
  any_value('user') AS first_role FROM numbered WHERE turn_no > 0 GROUP BY session_id, turn_no
  HAVING count(*) FILTER (role = 'assistant') > 0""")
def f11(spark, sf):
    is_tool = lambda m: m["role"] == "tool"
    return claude_turns(spark, sf).select(
        "session_id", "turn_no", F.size("msg").cast("bigint").alias("messages"), F.exists("msg", is_tool).alias("has_tool"),
        F.size(F.filter("msg", is_tool)).cast("bigint").alias("tools"), F.slice("msg", 1, 1)[0]["role"].alias("first_role"))
