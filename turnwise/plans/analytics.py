"""Queries over records, traces, logs and usage: roll-ups, filters, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwise.functions import tokens as T
from turnwise.operators import query as Q, rollups as G
from turnwise.plans import views as V
from turnwise.plans.registry import query
from turnwise.session import landed

_ST = V.STAMP.format
_SUMS = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in T.TOKEN_FIELDS)
_TOTAL = "(" + " + ".join(f"sum({n})" for n in T.TOKEN_FIELDS) + ")"


def _g1(by: str) -> str:
    shares = ", ".join(f"CASE WHEN {_TOTAL} > 0 THEN round(CAST(sum({n}) AS DOUBLE) / CAST({_TOTAL} AS DOUBLE), 6) ELSE 0.0::DOUBLE END AS "
                       + n.replace("_tokens", "_share") for n in T.TOKEN_FIELDS)
    return f"""WITH {V.RECORDS} SELECT {by}, count(*) AS records, {_SUMS}, CAST({_TOTAL} AS BIGINT) AS total_tokens, {shares}
      FROM records GROUP BY ALL"""


@query("g1_token_usage", _g1("namespace, agent, model, source"))
def g1(spark, sf):
    return G.token_usage(V.turn_records(spark, sf))


@query("g1_token_usage_daily", _g1("namespace, agent, strftime(ts, '%Y-%m-%d') AS day"))
def g1_daily(spark, sf):
    out = G.token_usage(V.turn_records(spark, sf), ["namespace", "agent"], day="ts")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def _g2(kind: str) -> str:
    return f"""WITH {V.RECORDS} SELECT namespace, agent, source, CAST(grouping_id(namespace, agent, source) AS BIGINT) AS level,
      count(*) AS records, {_SUMS} FROM records GROUP BY {kind}(namespace, agent, source)"""


@query("g2_token_rollup", _g2("ROLLUP"))
def g2(spark, sf):
    return G.token_rollup(V.turn_records(spark, sf), ["namespace", "agent", "source"])


@query("g2_token_cube", _g2("CUBE"))
def g2_cube(spark, sf):
    return G.token_rollup(V.turn_records(spark, sf), ["namespace", "agent", "source"], cube=True)


@query("g3_session_summary", f"""WITH {V.RECORDS} SELECT session_id, user_id, {_ST('min(ts)')} AS started_at, {_ST('max(ts)')} AS ended_at,
  CAST(sum(messages) AS BIGINT) AS messages, count(*) AS turns, {_SUMS},
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS duration_s,
  (epoch_us(TIMESTAMP '2024-01-01 12:00:00') - epoch_us(max(ts))) / 1000000.0::DOUBLE AS idle_s,
  CASE WHEN TIMESTAMP '2024-01-01 12:00:00' - max(ts) > INTERVAL 3600 SECOND THEN 'expired' ELSE 'active' END AS state
  FROM records GROUP BY session_id, user_id""")
def g3(spark, sf):
    out = G.session_summary(V.turn_records(spark, sf), F.expr("TIMESTAMP '2024-01-01 12:00:00'"), 3600)
    return out.withColumns({"started_at": V.stamp("started_at"), "ended_at": V.stamp("ended_at")})


def _percentiles(keys: str, source: str, where: str, extra: str) -> str:
    """Exact discrete percentiles in SQL: the smallest value whose rank reaches the share."""
    return f"""base AS (SELECT {keys}, {extra} FROM {source} WHERE {where} GROUP BY ALL),
      ranked AS (SELECT {keys}, latency_ms, row_number() OVER (PARTITION BY {keys} ORDER BY latency_ms) AS r,
        count(*) OVER (PARTITION BY {keys}) AS n FROM {source} WHERE {where}),
      pct AS (SELECT {keys}, min(latency_ms) FILTER (r >= ceil(n * 0.5::DOUBLE)) AS p50_ms,
        min(latency_ms) FILTER (r >= ceil(n * 0.95::DOUBLE)) AS p95_ms FROM ranked GROUP BY ALL)"""


@query("g4_tool_usage", f"""WITH {V.TRACES}, {_percentiles("tool_name, agent", "traces", "type = 'tool'",
  "count(*) AS calls, count(*) FILTER (is_error) AS errors, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_ms, count(DISTINCT session_id) AS sessions")} SELECT base.*, p50_ms, p95_ms FROM base JOIN pct USING (tool_name, agent)""")
def g4(spark, sf):
    return G.tool_usage(V.traces(spark, sf).where("type = 'tool'"))


@query("g5_handoff_flow", f"""WITH {V.TRACES} SELECT from_agent, to_agent, count(*) AS handoffs, count(DISTINCT session_id) AS sessions,
  count(DISTINCT reason) AS reasons FROM traces WHERE type = 'handoff' GROUP BY ALL""")
def g5(spark, sf):
    return G.handoff_flow(V.traces(spark, sf).where("type = 'handoff'"))


@query("g6_channel_usage", f"""WITH {V.RECORDS} SELECT CASE channel_id WHEN 'msteams' THEN 'teams' WHEN 'webchat' THEN 'web'
  WHEN '' THEN 'unknown' ELSE lower(channel_id) END AS channel, count(*) AS records, count(DISTINCT user_id) AS users, {_SUMS}
  FROM records GROUP BY 1""")
def g6(spark, sf):
    rec = V.turn_records(spark, sf).withColumnRenamed("user_id", "external_user_id")
    return G.channel_usage(rec, T.infer_channel(F.col("channel_id")))


@query("g7_llm_latency", f"""WITH {V.TRACES}, hourly AS (SELECT *, date_trunc('hour', ts) AS bucket FROM traces),
  {_percentiles("bucket, model", "hourly", "type = 'llm'", "count(*) AS calls, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_ms, max(latency_ms) AS max_ms")}
  SELECT {_ST('bucket')} AS bucket, model, calls, avg_ms, max_ms, p50_ms, p95_ms FROM base JOIN pct USING (bucket, model)""")
def g7(spark, sf):
    out = G.llm_latency(V.traces(spark, sf).where("type = 'llm'"), "1 hour")
    return out.withColumn("bucket", V.stamp("bucket"))


@query("g8_log_level_counts", f"""WITH {V.LOGS} SELECT namespace, {_ST("date_trunc('day', timestamp)")} AS bucket,
  count(*) FILTER (level = 'debug') AS debug, count(*) FILTER (level = 'info') AS info, count(*) FILTER (level = 'warn') AS warn,
  count(*) FILTER (level = 'error') AS error, count(*) AS total FROM logs GROUP BY 1, 2""")
def g8(spark, sf):
    return G.log_level_counts(V.logs(spark, sf)).withColumn("bucket", V.stamp("bucket"))


_RATE = "CASE WHEN sum(shown) > 0 THEN round(100.0::DOUBLE * sum(accepted)::DOUBLE / sum(shown)::DOUBLE, 1) ELSE 0.0::DOUBLE END"


@query("g9_acceptance_rate", f"""WITH {V.USAGE} SELECT "user", editor, CAST(sum(shown) AS BIGINT) AS shown, CAST(sum(accepted) AS BIGINT) AS accepted,
  {_RATE} AS acceptance_rate FROM usage GROUP BY ALL""")
def g9(spark, sf):
    return G.acceptance(V.usage(spark, sf), ["user", "editor"])


@query("f6_acceptance_rate", f"""WITH {V.USAGE} SELECT "user", date, {_RATE.replace('sum(shown)', 'shown').replace('sum(accepted)', 'accepted')} AS acceptance_rate FROM usage""")
def f6(spark, sf):
    return V.usage(spark, sf).select("user", "date", T.acceptance_rate(F.col("accepted"), F.col("shown")).alias("acceptance_rate"))


@query("g11_quota_report", f"""WITH req AS (SELECT ts, 'tk' || (user_id % 3) AS token, CASE event_type WHEN 'view' THEN 'query' WHEN 'click' THEN 'rules'
    WHEN 'purchase' THEN 'bulk_upload' ELSE 'traces' END AS quota FROM events),
  c AS (SELECT token, quota, date_trunc('minute', ts) AS m, count(*) AS requests, max(ts) AS last_ts FROM req GROUP BY ALL)
  SELECT token, quota, {_ST('m')} AS minute, requests, CAST(CASE quota WHEN 'traces' THEN 2 ELSE 1 END AS BIGINT) AS quota_limit,
  greatest(CAST(CASE quota WHEN 'traces' THEN 2 ELSE 1 END AS BIGINT) - requests, 0) AS remaining,
  greatest(requests - CAST(CASE quota WHEN 'traces' THEN 2 ELSE 1 END AS BIGINT), 0) AS over_limit,
  CAST(ceil((epoch_us(m) + 60000000 - epoch_us(last_ts)) / 1000000.0::DOUBLE) AS BIGINT) AS reset_s FROM c""")
def g11(spark, sf):
    req = V.table(spark, sf, "events").selectExpr(
        "ts", "concat('tk', user_id % 3) AS token",
        "CASE event_type WHEN 'view' THEN 'query' WHEN 'click' THEN 'rules' WHEN 'purchase' THEN 'bulk_upload' ELSE 'traces' END AS quota")
    limits = {"traces": 2, "query": 1, "rules": 1, "bulk_upload": 1}
    return G.quota_report(req, limits).withColumn("minute", V.stamp("minute"))


@query("g12_user_activity", f"""WITH {V.RECORDS} SELECT namespace, user_id, count(DISTINCT session_id) AS sessions, count(*) AS records,
  {_ST('min(ts)')} AS first_seen, {_ST('max(ts)')} AS last_seen, {_SUMS} FROM records GROUP BY namespace, user_id""")
def g12(spark, sf):
    out = G.user_activity(V.turn_records(spark, sf))
    return out.withColumns({"first_seen": V.stamp("first_seen"), "last_seen": V.stamp("last_seen")})


@query("w8_turn_deltas", f"""WITH {V.RECORDS} SELECT session_id, turn_no, CAST(sum(input_tokens + output_tokens) OVER w AS BIGINT) AS running_tokens,
  (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000.0::DOUBLE AS seconds_since_prev FROM records
  WINDOW w AS (PARTITION BY session_id ORDER BY turn_no ROWS UNBOUNDED PRECEDING)""")
def w8(spark, sf):
    rec = V.turn_records(spark, sf).selectExpr("session_id", "turn_no", "ts", "input_tokens + output_tokens AS total_tokens")
    return G.turn_deltas(rec).select("session_id", "turn_no", "running_tokens", "seconds_since_prev")


@query("o2_top_tools", f"""WITH {V.TRACES}, c AS (SELECT agent, tool_name, count(*) AS calls FROM traces WHERE type = 'tool' GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY agent ORDER BY calls DESC, tool_name) AS rank FROM c)
  SELECT agent, tool_name, calls, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def o2(spark, sf):
    counts = V.traces(spark, sf).where("type = 'tool'").groupBy("agent", "tool_name").agg(F.count(F.lit(1)).alias("calls"))
    return G.top_k(counts, 3, "calls", ["agent"], ["tool_name"])


@query("o2_top_users", "SELECT user_id, count(*) AS events FROM events GROUP BY user_id ORDER BY events DESC, user_id LIMIT 10")
def o2_users(spark, sf):
    counts = V.table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return G.top_k(counts, 10, "events", tie=["user_id"])


@query("j5_logs_for_sessions", f"""WITH {V.LOGS}, {V.sessionized(1800)} SELECT id, namespace, resource_id FROM logs
  WHERE 's' || user_id IN (SELECT 's' || user_id FROM sessions WHERE events > 2)""")
def j5(spark, sf):
    from turnwise.plans.activity import stored_sessions
    busy = stored_sessions(spark, sf).where("events > 2").select(F.concat(F.lit("s"), "user_id").alias("session_id"))
    logs = V.logs(spark, sf).withColumn("session_id", F.concat(F.lit("s"), "user_id"))
    return G.logs_for_sessions(logs, busy).select("id", "namespace", "resource_id")


# --- filters and pages --------------------------------------------------------------------

def stored(spark, sf):
    return V.turn_records(spark, sf).withColumnRenamed("ts", "inserted_at")


@query("q1_query_records", f"""WITH {V.RECORDS} SELECT id, agent, {_ST('ts')} AS inserted_at, input_tokens FROM records
  WHERE namespace = 'ns1' AND agent = 'agent1' AND ts >= TIMESTAMP '2024-01-01 02:00:00' AND ts < TIMESTAMP '2024-01-08 00:00:00'
  ORDER BY ts DESC, id LIMIT 20 OFFSET 2""")
def q1(spark, sf):
    page, _ = Q.query_records(stored(spark, sf), "ns1", agent="agent1", session_id="", start_date="2024-01-01 02:00:00",
                              end_date="2024-01-08", limit=20, offset=2)
    return page.select("id", "agent", V.stamp("inserted_at"), "input_tokens")


@query("q1_query_records_count", f"WITH {V.RECORDS} SELECT count(*) AS count FROM records WHERE namespace = 'ns1'")
def q1_count(spark, sf):
    return Q.query_records(stored(spark, sf), "ns1")[1]


@query("q2_query_logs", f"""WITH {V.LOGS} SELECT id, level, {_ST('timestamp')} AS "timestamp", resource_id FROM logs
  WHERE namespace = 'ns2' AND level = 'error' AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-20'
  ORDER BY logs.timestamp DESC, id LIMIT 100 OFFSET 10""")
def q2(spark, sf):
    page, _ = Q.query_logs(V.logs(spark, sf), "ns2", level="error", start_date="2024-01-05", end_date="2024-01-20", offset=10)
    return page.select("id", "level", V.stamp("timestamp"), "resource_id")


@query("q3_paginate", f"""WITH {V.LOGS} SELECT id, row_number() OVER (ORDER BY timestamp DESC, id) - 1 AS row_no,
  (row_number() OVER (ORDER BY timestamp DESC, id) - 1) // 100 AS page FROM logs WHERE namespace = 'ns3'""")
def q3(spark, sf):
    return Q.paginate(Q.filter_logs(V.logs(spark, sf), "ns3"), 100, ts="timestamp").select("id", "row_no", "page")


@query("q3_next_page", f"""WITH {V.LOGS} SELECT id, {_ST('timestamp')} AS "timestamp" FROM logs WHERE namespace = 'ns3'
  AND (timestamp < TIMESTAMP '2024-01-15' OR (timestamp = TIMESTAMP '2024-01-15' AND id > 5000)) ORDER BY logs.timestamp DESC, id LIMIT 50""")
def q3_next(spark, sf):
    hits = Q.filter_logs(V.logs(spark, sf), "ns3")
    return Q.next_page(hits, 50, ("2024-01-15 00:00:00", 5000), ts="timestamp").select("id", V.stamp("timestamp"))


@query("q4_dashboard_filters", f"""WITH {V.RECORDS} SELECT id FROM records WHERE source = 'cline' AND user_id = 'u3' AND channel_id = 'msteams' AND model = 'model-1'
  UNION ALL SELECT id FROM records WHERE source = 'copilot' AND model = 'model-0'""")
def q4(spark, sf):
    rec = V.turn_records(spark, sf).withColumnsRenamed({"user_id": "external_user_id", "channel_id": "external_user_channel"})
    a = Q.filter_by_model(Q.filter_by_channel(Q.filter_by_user(Q.filter_by_source(rec, "cline"), "u3"), "msteams"), "model-1")
    b = Q.filter_by(rec, source="copilot", model="model-0")
    return a.select("id").unionAll(b.select("id"))


@query("q5_search_user_name", f"WITH {V.RECORDS} SELECT id, external_user_name FROM records WHERE external_user_name ILIKE '%uSer u1%'")
def q5(spark, sf):
    return Q.search_user_name(V.turn_records(spark, sf), "uSer u1").select("id", "external_user_name")


@query("o1_sort_limit", f"""WITH {V.RECORDS} SELECT id, output_tokens FROM records ORDER BY output_tokens DESC, id LIMIT 25 OFFSET 5""")
def o1(spark, sf):
    return V.turn_records(spark, sf).select("id", "output_tokens").orderBy(F.desc("output_tokens"), "id").offset(5).limit(25)


_MIDDLE = "(SELECT count(*) // 2 FROM logs)"


@query("q2_deep_offset", f"""WITH {V.LOGS}, numbered AS (SELECT *, row_number() OVER (ORDER BY timestamp DESC, id) - 1 AS n FROM logs)
  SELECT id, level, {_ST('timestamp')} AS "timestamp" FROM numbered WHERE n >= {_MIDDLE} AND n < {_MIDDLE} + 1000""")
def q2_deep(spark, sf):
    """The thousand rows after the newest half of all logs."""
    logs = V.logs(spark, sf)
    page = Q.deep_page(logs, "timestamp", "id", 1000, logs.count() // 2)
    return page.select("id", "level", V.stamp("timestamp"))


_SKETCH_ERROR = 0.01


@query("g7_latency_sketches", f"""WITH {V.TRACES} SELECT {_ST("date_trunc('day', ts)")} AS bucket, model, count(*) AS calls,
  CAST(sum(latency_ms) AS BIGINT) AS sum_ms, true AS p50_within, true AS p95_within FROM traces WHERE type = 'llm' GROUP BY 1, 2""")
def g7_sketches(spark, sf):
    """Percentiles per day and model from stored hourly sketches, held against the exact ranks of what they give."""
    calls = V.traces(spark, sf).where("type = 'llm'")
    hourly = landed(spark, G.latency_sketches(calls, "1 hour"), "hourly-sketches")
    daily = landed(spark, G.merge_latency(hourly, "1 day"), "daily-percentiles")
    ranked = calls.withColumn("bucket", F.window("ts", "1 day")["start"]).join(daily.select("bucket", "model", "p50_ms", "p95_ms"), ["bucket", "model"])
    def within(name, p):
        value, n = F.col(f"{name}_ms"), F.count(F.lit(1))
        return ((F.count_if(F.col("latency_ms") < value) / n <= p + _SKETCH_ERROR)
                & (F.count_if(F.col("latency_ms") <= value) / n >= p - _SKETCH_ERROR)).alias(f"{name}_within")
    checked = ranked.groupBy("bucket", "model").agg(within("p50", 0.5), within("p95", 0.95))
    return daily.join(checked, ["bucket", "model"]).select(V.stamp("bucket"), "model", "calls", "sum_ms", "p50_within", "p95_within")


_USERS = """users AS (SELECT 'ns' || (user_id % 5) AS namespace, user_id, ts, event_type FROM events WHERE user_id IS NOT NULL)"""


@query("g12_distinct_users", f"""WITH {_USERS} SELECT namespace, count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (ts >= TIMESTAMP '2024-01-08'
    AND ts < TIMESTAMP '2024-01-15') AS week_users, (SELECT count(*) FROM (SELECT user_id FROM users a WHERE a.namespace = u.namespace AND event_type = 'click'
    INTERSECT SELECT user_id FROM users b WHERE b.namespace = u.namespace AND event_type = 'purchase')) AS click_and_purchase FROM users u GROUP BY namespace""")
def g12_users(spark, sf):
    """Distinct users from stored sketches of days: of all days, of one week, and of two kinds of events. Below 4,096 users a sketch is exact."""
    events = V.table(spark, sf, "events").selectExpr("concat('ns', user_id % 5) AS namespace", "cast(user_id AS string) AS user_id", "ts", "event_type")
    daily = landed(spark, G.user_sketches(events, ["namespace", "event_type"], "user_id", "ts"), "user-sketches")
    whole = G.distinct_users(daily, ["namespace"])
    week = G.distinct_users(daily.where("day >= DATE '2024-01-08' AND day < DATE '2024-01-15'"), ["namespace"]).withColumnRenamed("users", "week_users")
    both = G.shared_users(daily.where("event_type = 'click'"), daily.where("event_type = 'purchase'"), ["namespace"]).withColumnRenamed("users", "click_and_purchase")
    return whole.join(week, "namespace", "left").join(both, "namespace", "left").select(
        "namespace", "users", F.coalesce("week_users", F.lit(0)).alias("week_users"), F.coalesce("click_and_purchase", F.lit(0)).alias("click_and_purchase"))
