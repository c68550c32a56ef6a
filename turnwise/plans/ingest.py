"""Queries over loading and storing: validation, usage exports, events, folds, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwise.functions import content as C, tokens as T
from turnwise.operators import folds, normalize as N
from turnwise.operators.query import filter_logs, filter_records
from turnwise.plans import views as V
from turnwise.plans.registry import query
from turnwise.session import scratch_path
from turnwise.sources import events as E, records as R, sinks as K, usage as U

_ST = V.STAMP.format


def _json_records(spark, sf):
    """Every conversation line as one record in JSON; some lack the agent, carry a bad role or bad counts."""
    return V.lines(spark, sf).selectExpr(
        "conv_id", "line",
        """concat('{"namespace":"', namespace, '"', CASE WHEN conv_id % 11 <> 0 THEN concat(',"agent":"', agent, '"') ELSE '' END,
          ',"session_id":"', session_id, '","msg":',
          CASE WHEN line % 7 = 6 THEN '[{"content":"no role"}]'
            WHEN line % 2 = 0 THEN to_json(named_struct('role', role, 'content', text, 'sender', 'x', 'refusal', agent,
              'annotations', array(line), 'audio', named_struct('id', conv_id), 'function_call', named_struct('name', tool)))
            ELSE to_json(array(named_struct('role', role, 'content', text), named_struct('role', 'tool', 'content', 'done'))) END,
          ',"input_tokens":', CASE WHEN conv_id % 13 = 5 THEN '"many"' ELSE CAST(line AS STRING) END,
          ',"output_tokens":', length(text), ',"unknown_field":1,"model":"', model, '"}') AS value""")


_VALID = "conv_id % 11 <> 0 AND line % 7 <> 6 AND conv_id % 13 <> 5"


def stored(spark, sf):
    valid, _ = R.validate_records(R.raw_records(_json_records(spark, sf)))
    return R.parse_records(valid)


_RECORD_SQL = f"""WITH {V.LINES} SELECT namespace, agent, session_id, CAST(CASE WHEN line % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS messages,
  line AS input_tokens, CAST(length(text) AS BIGINT) AS output_tokens, CAST(line + length(text) AS BIGINT) AS total_tokens, md5(text) AS text_md5, model,
  CASE WHEN line % 2 = 0 THEN agent END AS refusal, CASE WHEN line % 2 = 0 THEN line END AS annotation,
  CASE WHEN line % 2 = 0 THEN conv_id END AS audio_id, CASE WHEN line % 2 = 0 THEN tool END AS function_name
  FROM lines WHERE {_VALID}"""


def _record_view(records):
    first = F.col("msg")[0]
    return records.select(
        "namespace", "agent", "session_id", F.size("msg").cast("bigint").alias("messages"), "input_tokens", "output_tokens",
        "total_tokens", F.md5(C.extract_text(first["content"])).alias("text_md5"), "model", first["refusal"].alias("refusal"),
        F.try_variant_get(first["annotations"], "$[0]", "bigint").alias("annotation"),
        F.try_variant_get(first["audio"], "$.id", "bigint").alias("audio_id"),
        F.try_variant_get(first["function_call"], "$.name", "string").alias("function_name"))


@query("s1_read_records", _RECORD_SQL)
def s1(spark, sf):
    return _record_view(stored(spark, sf))


@query("s1_record_files", _RECORD_SQL)
def s1_files(spark, sf):
    """The records as files of JSON lines, read back."""
    path = scratch_path(spark, "record-files")
    _json_records(spark, sf).select("value").write.text(path)
    return _record_view(R.read_records_json(spark, path, lines=True))


@query("s3_validate_records", f"""WITH {V.LINES}, bad AS (SELECT 'missing_agent' AS reason FROM lines WHERE conv_id % 11 = 0
  UNION ALL SELECT 'bad_msg' FROM lines WHERE line % 7 = 6 UNION ALL SELECT 'bad_input_tokens' FROM lines WHERE conv_id % 13 = 5)
  SELECT reason, count(*) AS rows FROM bad GROUP BY reason""")
def s3(spark, sf):
    return R.rejects_by_reason(R.validate_records(R.raw_records(_json_records(spark, sf)))[1])


_LOG_SQL = f"""WITH {V.LOGS} SELECT CASE WHEN id % 4 = 0 THEN 'fallback' ELSE namespace END AS namespace, level, message,
  {_ST('timestamp')} AS "timestamp", resource_id, replace(custom_object, ' ', '') AS custom_object FROM logs WHERE id % 9 <> 0"""


def _json_logs(spark, sf):
    """Every event as one log entry in JSON; some lack the namespace or the level."""
    return V.logs(spark, sf).selectExpr(
        """concat('{"id":', id, CASE WHEN id % 4 = 0 THEN '' ELSE concat(',"namespace":"', namespace, '"') END,
          CASE WHEN id % 9 = 0 THEN '' ELSE concat(',"level":"', level, '"') END, ',"message":"', message,
          '","timestamp":"', date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z","resource_id":"', resource_id,
          '","custom_object":', custom_object, '}') AS value""")


def _log_view(logs):
    return logs.select("namespace", "level", "message", V.stamp("timestamp"), "resource_id",
                       F.to_json("custom_object").alias("custom_object"))


@query("s2_read_logs", _LOG_SQL)
def s2(spark, sf):
    valid, _ = R.validate_logs(R.default_namespace(R.raw_logs(_json_logs(spark, sf)), "fallback"))
    return _log_view(R.parse_logs(valid))


@query("s2_log_files", _LOG_SQL)
def s2_files(spark, sf):
    """The entries as files of JSON lines, read back."""
    path = scratch_path(spark, "log-files")
    _json_logs(spark, sf).write.text(path)
    return _log_view(R.read_logs_json(spark, path, "fallback", lines=True))


@query("s8_org_usage", """WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'view') AS s,
    count(*) FILTER (event_type = 'purchase') AS a, count(DISTINCT user_id) AS u FROM events GROUP BY 1),
  r AS (SELECT *, CASE WHEN s > 0 THEN round(100.0::DOUBLE * a / s, 1) ELSE 0.0::DOUBLE END AS rate FROM d)
  SELECT 'copilot-org-acme-' || day AS resource_id, day AS "timestamp", s AS total_suggestions, a AS total_acceptances, rate AS acceptance_rate,
  'Copilot org usage (acme): ' || u || ' users, ' || CASE WHEN rate = 0 THEN '0' ELSE CAST(rate AS VARCHAR) END || '% acceptance' AS message FROM r""")
def s8(spark, sf):
    days = V.table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count_if(F.col("event_type") == "view").alias("total_suggestions_count"),
        F.count_if(F.col("event_type") == "purchase").alias("total_acceptances_count"),
        F.countDistinct("user_id").alias("total_active_users"))
    logs = U.parse_org_usage(days.select(F.to_json(F.struct("*")).alias("value")), "acme")
    return logs.select("resource_id", "timestamp", "custom_object.total_suggestions", "custom_object.total_acceptances",
                       "custom_object.acceptance_rate", "message")


_USAGE_SQL = f"""WITH {V.USAGE}, r AS (SELECT *, CASE WHEN shown > 0 THEN round(100.0::DOUBLE * accepted / shown, 1) ELSE 0.0::DOUBLE END AS rate FROM usage)
  SELECT 'copilot-' || "user" || '-' || date AS resource_id, shown AS suggestions_shown, accepted AS suggestions_accepted, rate AS acceptance_rate,
  'Copilot usage: ' || "user" || ' (' || editor || ') - ' || CASE WHEN rate = 0 THEN '0' ELSE CAST(rate AS VARCHAR) END || '% acceptance' AS message
  FROM r WHERE shown < 5"""


def _usage_rows(spark, sf):
    """Usage per user and day under other column names; some counts are empty or no numbers."""
    return V.usage(spark, sf).select(
        F.col("date").alias("day"), F.col("user").alias("login"), F.col("editor").alias("ide"),
        F.when(F.col("shown") >= 5, F.lit("many")).when(F.col("shown") == 0, F.lit("")).otherwise(F.col("shown").cast("string")).alias("shown"),
        F.col("accepted").cast("string").alias("accepted"))


def _usage_files(spark, sf):
    """The usage rows as CSV files, read back: (logs, rejects)."""
    path = scratch_path(spark, "usage-files")
    _usage_rows(spark, sf).write.option("header", True).csv(path)
    return U.read_copilot_csv(spark, path)


def _usage_view(logs):
    return logs.select("resource_id", "custom_object.suggestions_shown", "custom_object.suggestions_accepted",
                       "custom_object.acceptance_rate", "message")


@query("s9_usage_rows", _USAGE_SQL)
def s9(spark, sf):
    return _usage_view(U.usage_to_logs(U.resolve_usage_columns(_usage_rows(spark, sf)))[0])


@query("s9_usage_files", _USAGE_SQL)
def s9_files(spark, sf):
    return _usage_view(_usage_files(spark, sf)[0])


@query("s9_usage_rejects", f"""WITH {V.USAGE} SELECT "user", date, editor, 'many' AS suggestions_shown,
  CAST(accepted AS VARCHAR) AS suggestions_accepted FROM usage WHERE shown >= 5""")
def s9_rejects(spark, sf):
    """The rows of the CSV files that are set aside, as they were written."""
    return _usage_files(spark, sf)[1].select("user", "date", "editor", "suggestions_shown", "suggestions_accepted")


def _batch(spark, sf):
    return V.traces(spark, sf).withColumns({
        "batch_id": F.floor(F.col("event_id") / 100), "index": F.col("event_id") % 100,
        "type": F.expr("CASE WHEN event_id % 17 = 0 THEN 'metric' ELSE type END"),
        "from_agent": F.expr("CASE WHEN event_id % 5 <> 0 THEN from_agent END"),
        "tool_name": F.expr("CASE WHEN event_id % 7 <> 0 THEN tool_name ELSE '' END"),
        "message": F.col("props"), "input_tokens": F.col("event_id") % 40, "output_tokens": F.col("event_id") % 9})


_BATCH = V.TRACES + """, checked AS (SELECT event_id // 100 AS batch_id, event_id % 100 AS "index", event_id,
  CASE WHEN event_id % 17 = 0 THEN 'metric' ELSE type END AS type,
  CASE WHEN event_id % 17 = 0 THEN 'invalid_type' WHEN type = 'handoff' AND event_id % 5 = 0 THEN 'missing_field'
    WHEN type = 'tool' AND event_id % 7 = 0 THEN 'missing_field' END AS error_code,
  CASE WHEN event_id % 17 = 0 THEN 'unknown type metric' WHEN type = 'handoff' AND event_id % 5 = 0 THEN 'from_agent is required'
    WHEN type = 'tool' AND event_id % 7 = 0 THEN 'tool_name is required' END AS error_message FROM traces)"""


@query("s10_trace_batch", f"""WITH {_BATCH} SELECT batch_id, "index", type, CASE WHEN error_code IS NULL THEN 'ok' ELSE 'error' END AS status,
  error_code, error_message, CASE WHEN error_code IS NULL THEN CASE type WHEN 'llm' THEN 'llm_call' WHEN 'tool' THEN 'tool_call' ELSE type END END AS trace_type,
  CASE WHEN error_code IS NULL AND type = 'llm' THEN event_id % 40 END AS result_input_tokens,
  CASE WHEN error_code IS NULL AND type = 'llm' THEN event_id % 9 END AS result_output_tokens FROM checked""")
def s10(spark, sf):
    return E.check_events(_batch(spark, sf)).select(
        "batch_id", "index", "type", "status", "error_code", "error_message", "trace_type", "result_input_tokens", "result_output_tokens")


@query("s10_trace_batch_summary", f"""WITH {_BATCH} SELECT batch_id, count(*) AS total, count(*) FILTER (error_code IS NULL) AS succeeded,
  count(error_code) AS failed, count(error_code) = 0 AS success FROM checked GROUP BY batch_id""")
def s10_summary(spark, sf):
    return E.ingest_trace_batch(_batch(spark, sf))[2]


@query("s11_structured_logs", """SELECT 'ns' AS namespace, CASE (event_id % 6) * 10 WHEN 10 THEN 'debug' WHEN 30 THEN 'warn' WHEN 40 THEN 'error'
    WHEN 50 THEN 'error' ELSE 'info' END AS level, event_type AS message, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
  'app' AS logger, event_id AS line, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def s11(spark, sf):
    logs = V.table(spark, sf, "events").selectExpr(
        "'app' AS name", "cast((event_id % 6) * 10 AS int) AS levelno", "event_type AS message", "'m' AS module", "'f' AS func",
        "event_id AS lineno", "1L AS thread", "'main' AS thread_name", "cast(unix_micros(cast(ts AS timestamp)) AS decimal(20, 0)) / 1000000 AS created",
        "cast(null AS string) AS exception", "props AS extra")
    out = U.structured_logs_to_entries(logs, "ns")
    obj = F.col("custom_object")
    return out.select("namespace", "level", "message", V.stamp("timestamp"), F.try_variant_get(obj, "$.logger", "string").alias("logger"),
                      F.try_variant_get(obj, "$.line", "bigint").alias("line"), F.try_variant_get(obj, "$.k", "bigint").alias("k"))


# --- sinks --------------------------------------------------------------------------------

@query("k1_write_records", f"WITH {V.RECORDS} SELECT namespace, count(*) AS rows, CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM records GROUP BY namespace")
def k1(spark, sf):
    path = scratch_path(spark, "records")
    K.write_records(V.turn_records(spark, sf).withColumnRenamed("ts", "inserted_at"), path)
    return spark.read.parquet(path).groupBy("namespace").agg(F.count(F.lit(1)).alias("rows"), F.sum("output_tokens").alias("output_tokens"))


_RECORD_EXPORT_SQL = f"""WITH {V.LINES} SELECT CAST(NULL AS VARCHAR) AS id, namespace, agent, session_id, CAST(NULL AS VARCHAR) AS inserted_at,
  CAST(NULL AS VARCHAR) AS created_at, line AS input_tokens, CAST(length(text) AS BIGINT) AS output_tokens, CAST(NULL AS BIGINT) AS process_tokens,
  CAST(NULL AS BIGINT) AS memory_tokens, CAST(line + length(text) AS BIGINT) AS total_tokens, CAST(NULL AS VARCHAR) AS external_user_id,
  CAST(NULL AS VARCHAR) AS external_user_name, CAST(NULL AS VARCHAR) AS external_user_channel,
  CASE WHEN line % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS msg, CAST(NULL AS VARCHAR) AS transfers FROM lines WHERE namespace = 'ns1' AND {_VALID}"""


@query("k2_export_records", _RECORD_EXPORT_SQL)
def k2(spark, sf):
    out = K.records_export(filter_records(stored(spark, sf), "ns1"))
    return out.withColumns({"msg": F.json_array_length("msg").cast("bigint"), "inserted_at": F.col("inserted_at").cast("string")})


@query("k2_export_files", _RECORD_EXPORT_SQL)
def k2_files(spark, sf):
    """The exported JSON files, read back."""
    path = scratch_path(spark, "record-export")
    records = stored(spark, sf)
    K.export_records(records, path, namespace="ns1")
    back = spark.read.schema(K.records_export(records).schema).json(path)
    return back.withColumns({"msg": F.json_array_length("msg").cast("bigint"), "inserted_at": F.col("inserted_at").cast("string")})


_LOG_EXPORT_SQL = f"""WITH {V.LOGS} SELECT id, namespace, level, message, resource_id, {_ST('timestamp')} AS "timestamp",
  CAST(NULL AS VARCHAR) AS created_at, custom_object FROM logs WHERE namespace = 'ns2' AND level = 'error'"""


@query("k3_export_logs", _LOG_EXPORT_SQL)
def k3(spark, sf):
    out = K.logs_export(filter_logs(V.logs(spark, sf), "ns2", level="error"))
    return out.withColumn("timestamp", V.stamp("timestamp"))


@query("k3_export_files", _LOG_EXPORT_SQL)
def k3_files(spark, sf):
    """The exported CSV files, read back."""
    path = scratch_path(spark, "log-export")
    logs = V.logs(spark, sf)
    K.export_logs(logs, path, "csv", namespace="ns2", level="error")
    back = spark.read.schema(K.logs_export(logs).schema).option("header", True).option("escape", '"').csv(path)
    return back.withColumn("timestamp", V.stamp("timestamp"))


@query("k4_ingest_summary", f"""WITH {V.DUPS}, f AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY key ORDER BY ts, id) <= INTERVAL 300 SECOND, false) AS d FROM dups)
  SELECT source AS namespace, count(*) AS received, count(*) FILTER (NOT d AND lang <> 'en') AS inserted, count(*) FILTER (d AND lang <> 'en') AS dropped,
  count(*) FILTER (lang = 'en') AS rejected FROM f GROUP BY source""")
def k4(spark, sf):
    from turnwise.operators.dedup import dedup_within
    rows = dedup_within(V.dups(spark, sf), "key", seconds=300).withColumns({
        "namespace": F.col("source"),
        "status": F.when(F.col("lang") == "en", "rejected").when(F.col("is_duplicate"), "duplicate").otherwise("inserted")})
    return K.ingest_summary(rows)


# --- normalisation ------------------------------------------------------------------------

@query("p1_wire_format", f"""WITH {V.LINES} SELECT namespace, agent, session_id, line AS input_tokens, CAST(length(text) AS BIGINT) AS output_tokens,
  CAST(0 AS BIGINT) AS process_tokens, CAST(0 AS BIGINT) AS memory_tokens, CAST(NULL AS VARCHAR) AS user_id, model,
  '["role","content"' || ']' AS fields FROM lines WHERE {_VALID}""")
def p1(spark, sf):
    wire = N.to_wire_format(stored(spark, sf))
    first = F.json_object_keys(F.to_json(F.col("msg")[0]))
    return wire.select("namespace", "agent", "session_id", *T.TOKEN_FIELDS, "user_id", "model", F.to_json(first).alias("fields"))


@query("p2_normalize_messages", f"""WITH {V.LINES} SELECT conv_id, line, CAST(CASE WHEN line % 7 = 6 OR line % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS messages FROM lines""")
def p2(spark, sf):
    msg = F.try_variant_get(F.try_parse_json("value"), "$.msg", "variant")
    return _json_records(spark, sf).select("conv_id", "line", F.size(C.normalize_messages(msg)).cast("bigint").alias("messages"))


@query("p7_openai_usage", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS input_tokens, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 50 END AS BIGINT) AS output_tokens,
  CAST(length(event_type) // 4 AS BIGINT) AS process_tokens, CAST(0 AS BIGINT) AS memory_tokens, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(1 AS BIGINT) END AS requests FROM events""")
def p7(spark, sf):
    usage = F.try_parse_json(F.expr("concat('{\"input_tokens\":', get_json_object(props, '$.k'), CASE WHEN event_id % 3 = 0 "
                                    "THEN ',\"output_tokens\":null' ELSE concat(',\"requests\":1,\"output_tokens\":', event_id % 50) END, '}')"))
    return V.table(spark, sf, "events").select("event_id", T.map_openai_usage(usage, T.tokens_chars4(F.col("event_type"))).alias("u")).select("event_id", "u.*")


@query("p8_llm_usage", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS input_tokens, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 50 END AS BIGINT) AS output_tokens FROM events""")
def p8(spark, sf):
    return V.table(spark, sf, "events").select("event_id", T.map_llm_usage(_output()).alias("u")).select("event_id", "u.*")


def _output():
    return F.try_parse_json(F.expr("concat('{\"content\":\"', event_type, '\",\"usage\":{\"prompt_tokens\":', get_json_object(props, '$.k'), "
                                   "CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(',\"completion_tokens\":', event_id % 50) END, '}}')"))


@query("p9_fill_total", f"""WITH {V.RECORDS} SELECT id, CASE WHEN turn_no % 2 = 0 THEN turn_no ELSE input_tokens + output_tokens + process_tokens + memory_tokens END AS total_tokens FROM records""")
def p9(spark, sf):
    rec = V.turn_records(spark, sf).withColumn("total_tokens", F.when(F.col("turn_no") % 2 == 0, F.col("turn_no")))
    return N.fill_total(rec).select("id", "total_tokens")


def _event_rows(spark, sf):
    return V.traces(spark, sf).withColumns({
        "input": F.try_parse_json(F.expr("concat('{\"messages\":[{\"role\":\"user\",\"content\":\"', reason, '\"}]}')")),
        "output": _output_of("model"), "arguments": F.try_parse_json("props"), "result": F.try_parse_json(F.lit("true")),
        **{f"external_user_{n}": F.lit(None).cast("string") for n in ("id", "name", "channel")}})


def _output_of(content: str):
    return F.try_parse_json(F.expr(f"concat('{{\"content\":\"', {content}, '\",\"usage\":{{\"prompt_tokens\":', get_json_object(props, '$.k'), '}}}}')"))


@query("p16_traces_to_records", f"""WITH {V.TRACES} SELECT session_id, agent, {_ST('ts')} AS inserted_at, model,
  CAST(CASE type WHEN 'llm' THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE 0 END AS BIGINT) AS input_tokens,
  CASE type WHEN 'handoff' THEN from_agent || '>' || to_agent END AS transfer,
  md5(CASE type WHEN 'llm' THEN 'user:' || reason || '|assistant:' || model WHEN 'tool' THEN 'tool:Tool: ' || tool_name
    ELSE 'tool:Transferindo conversa para ' || to_agent END) AS digest FROM traces WHERE type <> 'log'""")
def p16(spark, sf):
    rec = N.traces_to_records(_event_rows(spark, sf))
    return rec.select("session_id", "agent", V.stamp("inserted_at"), "model", "input_tokens",
                      F.concat(F.col("transfers")[0]["from_agent"], F.lit(">"), F.col("transfers")[0]["to_agent"]).alias("transfer"),
                      V.messages_digest(F.col("msg")).alias("digest"))


@query("p14_handoff_messages", f"""WITH {V.TRACES} SELECT event_id, 'tool' AS role, 'Transferindo conversa para ' || to_agent AS content, from_agent AS sender,
  'transfer_to_agent' AS tool_name, reason FROM traces WHERE type = 'handoff'""")
def p14(spark, sf):
    hand = V.traces(spark, sf).where("type = 'handoff'").withColumn("transfers", F.array(F.struct(
        "from_agent", "to_agent", "reason", F.col("ts").cast("string").alias("timestamp"))))
    msgs = hand.select("event_id", F.explode(folds.transfers_to_messages(F.col("transfers"))).alias("m"))
    return msgs.select("event_id", "m.role", "m.content", "m.sender", "m.tool_name",
                       F.get_json_object("m.tool_calls", "$[0].arguments.reason").alias("reason"))


@query("u1_union_sources", f"""WITH {V.RECORDS}, {V.TRACES} SELECT source, count(*) AS records, CAST(sum(input_tokens) AS BIGINT) AS input_tokens FROM (
  SELECT source, input_tokens FROM records UNION ALL SELECT 'traces', CASE type WHEN 'llm' THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE 0 END FROM traces WHERE type <> 'log') GROUP BY source""")
def u1(spark, sf):
    both = N.union_sources(V.turn_records(spark, sf), N.traces_to_records(_event_rows(spark, sf)))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.sum("input_tokens").alias("input_tokens"))


# --- lifecycle events ---------------------------------------------------------------------

def _chain_events(spark, sf):
    return V.table(spark, sf, "events").selectExpr(
        "cast(user_id AS string) AS run", "event_id AS seq",
        """CASE event_type WHEN 'view' THEN 'llm_start' WHEN 'signup' THEN 'llm_end' WHEN 'purchase' THEN 'chain_end'
          WHEN 'error' THEN 'tool_end' ELSE CASE WHEN event_id % 2 = 0 THEN 'tool_start' ELSE 'agent_action' END END AS event""",
        "concat('prompt ', props) AS prompt", "CASE WHEN event_id % 2 = 0 THEN cast(floor(value) AS bigint) END AS prompt_tokens",
        "CASE WHEN event_id % 4 = 0 THEN event_id % 9 END AS completion_tokens", "concat('tool', user_id % 7) AS tool",
        "concat('in', props) AS input", "CASE WHEN event_type = 'purchase' AND event_id % 8 = 0 THEN NULL ELSE concat('out ', event_id, props) END AS output",
        "concat('model', event_id % 3) AS model")


_CHAIN = """ev AS (SELECT CAST(user_id AS VARCHAR) AS run, event_id AS seq,
  CASE event_type WHEN 'view' THEN 'llm_start' WHEN 'signup' THEN 'llm_end' WHEN 'purchase' THEN 'chain_end'
    WHEN 'error' THEN 'tool_end' ELSE CASE WHEN event_id % 2 = 0 THEN 'tool_start' ELSE 'agent_action' END END AS event,
  greatest(1, length('prompt ' || props) // 4) AS e_prompt, CASE WHEN event_id % 2 = 0 THEN CAST(floor(value) AS BIGINT) END AS pt,
  CASE WHEN event_id % 4 = 0 THEN event_id % 9 END AS ct, 'tool' || (user_id % 7) AS tool, 'in' || props AS input,
  greatest(1, length('in' || props) // 4) AS e_in,
  CASE WHEN event_type = 'purchase' AND event_id % 8 = 0 THEN NULL ELSE 'out ' || event_id || props END AS output,
  greatest(1, length('out ' || event_id || props) // 4) AS e_out, 'model' || (event_id % 3) AS model FROM events),
  marked AS (SELECT *, event = 'chain_end' AND output IS NOT NULL AS ends, event = 'llm_end' AND pt IS NOT NULL AS reports FROM ev),
  ivl AS (SELECT *, sum(ends::INT) OVER (PARTITION BY run ORDER BY seq ROWS UNBOUNDED PRECEDING) - ends::INT AS i FROM marked),
  lastrep AS (SELECT *, max(seq) FILTER (reports) OVER (PARTITION BY run, i) AS rep FROM ivl)"""


@query("t5_fold_chain_events", f"""WITH {_CHAIN}, done AS (SELECT run, max(seq) FILTER (ends) AS seq, any_value(output) FILTER (ends) AS content,
    coalesce(max(pt) FILTER (seq = rep), 0) + coalesce(sum(e_prompt) FILTER (event = 'llm_start' AND (rep IS NULL OR seq > rep)), 0) AS i_t,
    coalesce(sum(CASE WHEN pt IS NOT NULL THEN coalesce(ct, 0) ELSE e_out END) FILTER (event = 'llm_end'), 0) AS o_t,
    coalesce(sum(e_in) FILTER (event = 'agent_action'), 0) AS a, coalesce(sum(e_in) FILTER (event = 'tool_start'), 0) AS s,
    coalesce(sum(e_out) FILTER (event = 'tool_end'), 0) AS r, arg_max(model, seq) FILTER (event = 'llm_start') AS model
    FROM lastrep GROUP BY run, i HAVING count(*) FILTER (ends) > 0)
  SELECT run, seq, 'chain' AS kind, content, CAST(i_t AS BIGINT) AS input_tokens, CAST(o_t AS BIGINT) AS output_tokens,
    CAST(greatest(a, s) + r AS BIGINT) AS process_tokens, CAST(a + s + r AS BIGINT) AS process_tokens_raw, model FROM done
  UNION ALL SELECT run, seq, 'action', 'Tool: ' || tool || ' | Input: ' || input, 0, 0, e_in, e_in, NULL FROM ev WHERE event = 'agent_action'""")
def t5(spark, sf):
    out = folds.fold_chain_events(_chain_events(spark, sf))
    return out.select("run", "seq", "kind", F.col("msg.content").alias("content"), "input_tokens", "output_tokens",
                      "process_tokens", "process_tokens_raw", "model")


def _agent_events(spark, sf):
    return V.table(spark, sf, "events").selectExpr(
        "concat('s', user_id) AS session_id", "event_id AS seq",
        """CASE event_type WHEN 'signup' THEN 'agent_start' WHEN 'view' THEN 'message' WHEN 'purchase' THEN 'agent_end'
          WHEN 'error' THEN 'handoff' ELSE CASE WHEN event_id % 2 = 0 THEN 'tool_start' ELSE 'tool_end' END END AS event""",
        "concat('agent', event_id % 3) AS agent", "concat('be nice ', event_id) AS instructions",
        "CASE WHEN event_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role", "concat('said ', event_id, ' words') AS content",
        "concat('tool', event_id % 4) AS tool", "props AS payload", "CASE WHEN event_id % 2 = 0 THEN event_id % 100 END AS in_tokens",
        "CASE WHEN event_id % 2 = 0 THEN event_id % 90 END AS out_tokens", "concat('agent', event_id % 5) AS to_agent",
        "concat('r', event_id % 4) AS reason", "cast(event_id AS string) AS ts", "concat('model', event_id % 2) AS model")


_AGENT = """ev AS (SELECT 's' || user_id AS session_id, event_id AS seq,
  CASE event_type WHEN 'signup' THEN 'agent_start' WHEN 'view' THEN 'message' WHEN 'purchase' THEN 'agent_end'
    WHEN 'error' THEN 'handoff' ELSE CASE WHEN event_id % 2 = 0 THEN 'tool_start' ELSE 'tool_end' END END AS event,
  'agent' || (event_id % 3) AS agent, 'be nice ' || event_id AS instructions, CASE WHEN event_id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role,
  'said ' || event_id || ' words' AS content, 'tool' || (event_id % 4) AS tool, props AS payload,
  CASE WHEN event_id % 2 = 0 THEN event_id % 100 END AS in_tokens, CASE WHEN event_id % 2 = 0 THEN event_id % 90 END AS out_tokens,
  'agent' || (event_id % 5) AS to_agent, 'model' || (event_id % 2) AS model FROM events)"""


@query("t6_fold_agent_runs", f"""WITH {_AGENT}, ivl AS (SELECT *, CAST(sum((event = 'agent_end')::INT) OVER (PARTITION BY session_id ORDER BY seq ROWS UNBOUNDED PRECEDING)
    - (event = 'agent_end')::INT AS BIGINT) AS run_no FROM ev),
  parts AS (SELECT *, CASE event WHEN 'message' THEN role || ':' || content WHEN 'tool_start' THEN 'tool:Calling tool: ' || tool
    WHEN 'tool_end' THEN 'tool:' || payload WHEN 'handoff' THEN 'tool:Transferindo conversa para ' || to_agent END AS part FROM ivl),
  runs AS (SELECT session_id, run_no, any_value(agent) FILTER (event = 'agent_end') AS agent, any_value(content) FILTER (event = 'agent_end') AS out_text,
    string_agg(part, '|' ORDER BY seq) AS body, count(*) FILTER (event = 'message' AND role = 'user') AS users,
    count(*) FILTER (event = 'message' AND role = 'assistant') AS replies, arg_min(content, seq) FILTER (event = 'agent_start') AS in_text,
    arg_max(instructions, seq) FILTER (event = 'agent_start') AS instr, count(*) FILTER (event = 'handoff') AS transfers,
    any_value(in_tokens) FILTER (event = 'agent_end') AS it, any_value(out_tokens) FILTER (event = 'agent_end') AS ot,
    any_value(model) FILTER (event = 'agent_end') AS model FROM parts GROUP BY session_id, run_no HAVING count(*) FILTER (event = 'agent_end') > 0)
  SELECT session_id, run_no, agent, model, transfers, CAST(coalesce(it, 0) AS BIGINT) AS input_tokens, CAST(coalesce(ot, 0) AS BIGINT) AS output_tokens,
    CAST(coalesce(length(instr) // 4, 0) AS BIGINT) AS process_tokens, CAST(0 AS BIGINT) AS memory_tokens,
    md5(concat_ws('|', CASE WHEN users = 0 AND in_text IS NOT NULL THEN 'user:' || in_text END, body, CASE WHEN replies = 0 THEN 'assistant:' || out_text END)) AS digest FROM runs""")
def t6(spark, sf):
    return _runs(folds.fold_agent_events(_agent_events(spark, sf)))


def _runs(out):
    return out.select("session_id", "run_no", "agent", "model", F.coalesce(F.size("transfers"), F.lit(0)).cast("bigint").alias("transfers"),
                      *T.TOKEN_FIELDS, V.messages_digest(F.col("msg")).alias("digest"))


@query("t6_fold_agent_framework", f"""WITH {_AGENT}, ivl AS (SELECT *, CAST(sum((event = 'agent_start')::INT) OVER (PARTITION BY session_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_no FROM ev),
  parts AS (SELECT *, CASE event WHEN 'message' THEN role || ':' || content WHEN 'tool_start' THEN 'tool:Executing tool: ' || tool
    WHEN 'tool_end' THEN 'tool:Tool result: ' || substr(payload, 1, 200) WHEN 'handoff' THEN 'tool:Transferindo conversa para ' || to_agent END AS part FROM ivl WHERE run_no > 0),
  ends AS (SELECT session_id, run_no, max(seq) FILTER (event = 'agent_end') AS end_seq FROM parts GROUP BY ALL),
  runs AS (SELECT session_id, run_no, any_value(agent) FILTER (seq = end_seq) AS agent, any_value(model) FILTER (seq = end_seq) AS model,
    count(*) FILTER (event = 'handoff') AS transfers, any_value(in_tokens) FILTER (seq = end_seq) AS it, any_value(out_tokens) FILTER (seq = end_seq) AS ot,
    count(*) FILTER (event = 'message' AND role = 'user') * 3 AS iw, count(*) FILTER (event = 'message' AND role = 'assistant') * 3 AS ow,
    coalesce(sum(length(payload) // 4) FILTER (event IN ('tool_start', 'tool_end')), 0) AS pt, coalesce(string_agg(part, '|' ORDER BY seq), '') AS body
    FROM parts JOIN ends USING (session_id, run_no) WHERE end_seq IS NOT NULL GROUP BY ALL)
  SELECT session_id, run_no, agent, model, transfers, CAST(coalesce(it, iw) AS BIGINT) AS input_tokens, CAST(coalesce(ot, ow) AS BIGINT) AS output_tokens,
    CAST(pt AS BIGINT) AS process_tokens, CAST(3 AS BIGINT) AS memory_tokens, md5(body) AS digest FROM runs""")
def t6_framework(spark, sf):
    return _runs(folds.fold_agent_events(_agent_events(spark, sf), dialect="framework"))


@query("p13_internal_tools", """WITH base AS (SELECT event_id, CAST(user_id AS VARCHAR) AS run, CASE event_type WHEN 'view' THEN 'web_search_call' WHEN 'click' THEN 'file_search_call'
    WHEN 'purchase' THEN 'code_interpreter_call' WHEN 'signup' THEN 'computer_call' ELSE 'message' END AS item_type, 'c' || (event_id % 2000) AS call_id FROM events),
  once AS (SELECT run, call_id, arg_min(item_type, event_id) AS item_type, min(event_id) AS pos FROM base WHERE item_type <> 'message' GROUP BY run, call_id)
  SELECT run, pos, call_id, item_type, CASE item_type WHEN 'web_search_call' THEN 'web_search' WHEN 'file_search_call' THEN 'file_search'
    WHEN 'code_interpreter_call' THEN 'code_interpreter' ELSE 'computer_use' END AS tool_name,
  CASE item_type WHEN 'web_search_call' THEN '{"query":"q' || pos || '","sources":["s"]}' WHEN 'file_search_call' THEN '{"query":"q' || pos || '","file_ids":null}'
    WHEN 'code_interpreter_call' THEN '{"code":"x' || pos || '","language":"python"}' ELSE '{"action_type":"click"}' END AS arguments FROM once""")
def p13(spark, sf):
    items = V.table(spark, sf, "events").selectExpr(
        "cast(user_id AS string) AS run", "event_id AS pos", "'a' AS agent",
        """CASE event_type WHEN 'view' THEN concat('{"type":"web_search_call","id":"c', event_id % 2000, '","action":{"query":"q', event_id, '"},"result":{"results":["s"]}}')
          WHEN 'click' THEN concat('{"type":"tool_call_item","raw_item":{"type":"file_search_call","id":"c', event_id % 2000, '","query":"q', event_id, '"}}')
          WHEN 'purchase' THEN concat('{"type":"code_interpreter_call","id":"c', event_id % 2000, '","code":"x', event_id, '"}')
          WHEN 'signup' THEN concat('{"type":"computer_call","id":"c', event_id % 2000, '","action":{"type":"click"}}')
          ELSE '{"type":"message"}' END AS j""").withColumn("item", F.try_parse_json("j"))
    return folds.internal_tool_messages(items).select("run", "pos", "call_id", "item_type", "tool_name", "arguments")
