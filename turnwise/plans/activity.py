"""Queries over user activity: sessions, duplicates, request keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwise.operators import dedup, sessions as S
from turnwise.plans import views as V
from turnwise.plans.registry import query

_AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"
_ST = V.STAMP.format


def as_of():
    return F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")


def sessionized(spark, sf, timeout, **kw):
    return S.sessionize(V.activity(spark, sf), timeout, **kw)


def stored_sessions(spark, sf, timeout=1800):
    return S.sessions_table(sessionized(spark, sf, timeout))


@query("w1_sessionize_120", f"WITH {V.sessionized(120)} SELECT event_id, session_no, session_id FROM sessionized")
def w1_120(spark, sf):
    return sessionized(spark, sf, 120).select("event_id", "session_no", "session_id")


@query("w1_sessionize_1800", f"WITH {V.sessionized(1800)} SELECT event_id, session_no, session_id FROM sessionized")
def w1_1800(spark, sf):
    return sessionized(spark, sf, 1800).select("event_id", "session_no", "session_id")


@query("w1_sessionize_forced", f"WITH {V.sessionized(1800, forced=True)} SELECT event_id, session_no, session_id FROM sessionized")
def w1_forced(spark, sf):
    return sessionized(spark, sf, 1800, force_new=F.col("force_new")).select("event_id", "session_no", "session_id")


@query("w4_explicit_close", f"WITH {V.sessionized(86400, forced=True, closing=True)} SELECT event_id, session_no, session_id FROM sessionized")
def w4(spark, sf):
    return sessionized(spark, sf, 86400, force_new=F.col("force_new"), close=F.col("is_close")).select(
        "event_id", "session_no", "session_id")


@query("w2_expired_sessions", f"""WITH {V.sessionized(1800)} SELECT namespace, user_id, session_id, {_ST('last_activity')} AS last_activity
  FROM sessions WHERE {_AS_OF} - last_activity > INTERVAL 1800 SECOND""")
def w2(spark, sf):
    return S.expired_sessions(stored_sessions(spark, sf), as_of(), 1800).select(
        "namespace", "user_id", "session_id", V.stamp("last_activity"))


@query("w3_session_info", f"""WITH {V.sessionized(1800)} SELECT session_id,
  CAST(epoch_us({_AS_OF}) - epoch_us(created_at) AS BIGINT) / 1000000.0::DOUBLE AS duration,
  CAST(epoch_us({_AS_OF}) - epoch_us(last_activity) AS BIGINT) / 1000000.0::DOUBLE AS inactive_for FROM sessions""")
def w3(spark, sf):
    return S.session_info(stored_sessions(spark, sf), as_of()).select("session_id", "duration", "inactive_for")


@query("w7_latest_sessions", f"""WITH {V.sessionized(86400)}, live AS (SELECT *, row_number() OVER (PARTITION BY namespace, user_id
  ORDER BY last_activity DESC, session_id DESC) AS r FROM sessions WHERE {_AS_OF} - last_activity < INTERVAL 604800 SECOND)
  SELECT namespace, user_id, session_id, {_ST('last_activity')} AS last_activity, events FROM live WHERE r = 1""")
def w7(spark, sf):
    return S.latest_sessions(stored_sessions(spark, sf, 86400), as_of(), 604800).select(
        "namespace", "user_id", "session_id", V.stamp("last_activity"), "events")


@query("j3_attach_session", f"""WITH {V.sessionized(1800)} SELECT e.event_id, s.session_id FROM sessionized e
  LEFT JOIN (SELECT * FROM sessions WHERE events > 1) s ON e.namespace = s.namespace AND e.user_id = s.user_id
    AND e.ts >= s.created_at AND e.ts <= s.last_activity""")
def j3(spark, sf):
    stored = stored_sessions(spark, sf).where("events > 1")
    return S.attach_session(V.activity(spark, sf), stored).select("event_id", "session_id")


# --- duplicates ---------------------------------------------------------------------------

def _flagged(seconds: int) -> str:
    return f"""{V.DUPS}, flagged AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY key ORDER BY ts, id)
      <= INTERVAL {seconds} SECOND, false) AS is_duplicate FROM dups)"""


@query("w5_dedup_60s", f"WITH {_flagged(60)} SELECT id, is_duplicate FROM flagged")
def w5(spark, sf):
    return dedup.dedup_within(V.dups(spark, sf), "key").select("id", "is_duplicate")


@query("w5_dedup_300s_kept", f"WITH {_flagged(300)} SELECT id, lang FROM flagged WHERE NOT is_duplicate")
def w5_kept(spark, sf):
    return dedup.drop_within(V.dups(spark, sf), "key", seconds=300).select("id", "lang")


@query("g10_dedup_report", f"""WITH {_flagged(300)} SELECT source, count(*) AS received, count(*) FILTER (NOT is_duplicate) AS kept,
  count(*) FILTER (is_duplicate) AS dropped, count(*) FILTER (NOT is_duplicate) = 0 AS all_duplicates FROM flagged GROUP BY source""")
def g10(spark, sf):
    return dedup.dedup_report(dedup.dedup_within(V.dups(spark, sf), "key", seconds=300), ["source"])


@query("u2_distinct", f"WITH {V.DUPS} SELECT min(id) AS id, arg_min(lang, id) AS lang, arg_min(source, id) AS source FROM dups GROUP BY key")
def u2(spark, sf):
    return dedup.distinct_rows(V.dups(spark, sf), "key", "id").select("id", "lang", "source")


def _loads(spark, sf):
    d = V.dups(spark, sf)
    return d.where("id % 2 = 1"), d.where("id % 2 = 0")


@query("j6_anti_join_existing", f"""WITH {V.DUPS} SELECT id, lang FROM dups WHERE id % 2 = 1
  AND key NOT IN (SELECT key FROM dups WHERE id % 2 = 0)""")
def j6(spark, sf):
    new, stored = _loads(spark, sf)
    return dedup.anti_join_existing(new, stored, "key").select("id", "lang")


@query("u3_diff_loads", f"""WITH {V.DUPS}, o AS (SELECT DISTINCT key FROM dups WHERE id % 2 = 0), n AS (SELECT DISTINCT key FROM dups WHERE id % 2 = 1)
  SELECT key, 'new' AS change FROM n WHERE key NOT IN (SELECT key FROM o) UNION ALL SELECT key, 'gone' FROM o WHERE key NOT IN (SELECT key FROM n)""")
def u3_diff(spark, sf):
    new, stored = _loads(spark, sf)
    return dedup.diff_loads(stored, new, "key")


@query("u3_overlap_loads", f"""WITH {V.DUPS} SELECT DISTINCT key FROM dups WHERE id % 2 = 0
  INTERSECT SELECT DISTINCT key FROM dups WHERE id % 2 = 1""")
def u3_overlap(spark, sf):
    new, stored = _loads(spark, sf)
    return dedup.overlap_loads(stored, new, "key")


@query("w6_idempotency", """WITH RECURSIVE req AS (SELECT event_id AS id, ts, 'ns' || (user_id % 5) AS tenant,
    CASE WHEN event_id % 10 <> 0 THEN 'k' || (user_id % 40) END AS request_key, 'b' || ((event_id % 7) // 4) AS body_hash,
    event_type <> 'error' AS is_ok FROM events),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY tenant, request_key ORDER BY ts, id) AS n FROM req WHERE request_key IS NOT NULL),
  walk AS (SELECT tenant, request_key, n, id, 'fresh' AS outcome, CAST(NULL AS BIGINT) AS original_id,
      CASE WHEN is_ok THEN ts END AS o_ts, CASE WHEN is_ok THEN id END AS o_id, CASE WHEN is_ok THEN body_hash END AS o_body
    FROM numbered WHERE n = 1
    UNION ALL SELECT r.tenant, r.request_key, r.n, r.id,
      CASE WHEN w.o_ts IS NULL OR r.ts >= w.o_ts + INTERVAL 24 HOUR THEN 'fresh' WHEN r.body_hash = w.o_body THEN 'replay' ELSE 'conflict' END,
      CASE WHEN w.o_ts IS NULL OR r.ts >= w.o_ts + INTERVAL 24 HOUR THEN NULL ELSE w.o_id END,
      CASE WHEN (w.o_ts IS NULL OR r.ts >= w.o_ts + INTERVAL 24 HOUR) AND r.is_ok THEN r.ts ELSE w.o_ts END,
      CASE WHEN (w.o_ts IS NULL OR r.ts >= w.o_ts + INTERVAL 24 HOUR) AND r.is_ok THEN r.id ELSE w.o_id END,
      CASE WHEN (w.o_ts IS NULL OR r.ts >= w.o_ts + INTERVAL 24 HOUR) AND r.is_ok THEN r.body_hash ELSE w.o_body END
    FROM walk w JOIN numbered r ON r.tenant = w.tenant AND r.request_key = w.request_key AND r.n = w.n + 1)
  SELECT id, outcome, original_id FROM walk UNION ALL SELECT id, 'fresh', NULL FROM req WHERE request_key IS NULL""")
def w6(spark, sf):
    return dedup.idempotency_classify(V.requests(spark, sf), ok=F.col("is_ok")).select("id", "outcome", "original_id")
