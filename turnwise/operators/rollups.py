"""Aggregations over records, traces, logs and usage.

Sums, counts and distinct counts combine on the map side, so no group is too large for
them; percentiles are exact and come from counts per value (see
:func:`turnwise.operators.scan.exact_percentiles`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnwise.functions import tokens as T
from turnwise.operators.scan import blocked_scan, exact_percentiles, line_block, solid_join, value_counts
from turnwise.schemas import LEVELS, QUOTAS

SEGMENTS = T.TOKEN_FIELDS


def _tokens(df: DataFrame) -> list[Column]:
    return [F.sum(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in SEGMENTS]


def token_usage(df: DataFrame, by: Sequence[str] = ("namespace", "agent", "model", "source"),
                day: str | None = None) -> DataFrame:
    """Tokens per segment, total, records and each segment's share of the total."""
    groups = [F.col(c) for c in by] + ([F.to_date(day).alias("day")] if day else [])
    out = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("records"), *_tokens(df))
    total = sum((F.col(n) for n in SEGMENTS[1:]), F.col(SEGMENTS[0]))
    out = out.withColumn("total_tokens", total)
    return out.withColumns({
        n.replace("_tokens", "_share"): F.when(F.col("total_tokens") > 0,
                                               F.round(F.col(n) / F.col("total_tokens"), 6)).otherwise(F.lit(0.0))
        for n in SEGMENTS})


def token_rollup(df: DataFrame, dims: Sequence[str], cube: bool = False) -> DataFrame:
    """Token subtotals along ``dims``; ``level`` has a bit set for every dimension summed away."""
    grouped = df.cube(*dims) if cube else df.rollup(*dims)
    return grouped.agg(F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("records"), *_tokens(df))


def session_summary(records: DataFrame, as_of: Column, timeout: float = 120, ts: str = "ts",
                    keys: Sequence[str] = ("session_id", "user_id")) -> DataFrame:
    """Start, end, length, counts, tokens, idle time and state per session.

    ``records`` has ``messages`` (messages in the row) and the token columns; rows count as
    turns.
    """
    out = records.groupBy(*keys).agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"), F.sum("messages").alias("messages"),
        F.count(F.lit(1)).alias("turns"), *_tokens(records))
    idle = F.timestamp_diff("MICROSECOND", F.col("ended_at"), as_of)
    return out.withColumns({
        "duration_s": F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / F.lit(1e6),
        "idle_s": idle / F.lit(1e6),
        "state": F.when(idle > int(timeout * 1e6), F.lit("expired")).otherwise(F.lit("active"))})


def tool_usage(calls: DataFrame, by: Sequence[str] = ("tool_name", "agent"), approx: bool = False) -> DataFrame:
    """Calls, distinct sessions, errors and latency per tool.

    ``calls`` has ``session_id``, ``is_error`` and ``latency_ms``. ``approx`` replaces exact
    percentiles and distinct counts by sketches of bounded size.
    """
    by = list(by)
    if approx:
        return calls.groupBy(*by).agg(
            F.count(F.lit(1)).alias("calls"), F.count_if("is_error").alias("errors"), F.avg("latency_ms").alias("avg_ms"),
            F.approx_count_distinct("session_id").alias("sessions"),
            F.percentile_approx("latency_ms", 0.5).alias("p50_ms"), F.percentile_approx("latency_ms", 0.95).alias("p95_ms"))
    counts = value_counts(calls, by, "latency_ms", _errors=F.count_if("is_error"))
    base = counts.groupBy(*by).agg(F.sum("_n").alias("calls"), F.sum("_errors").alias("errors"), _mean("latency_ms"))
    sessions = calls.groupBy(*by).agg(F.countDistinct("session_id").alias("sessions"))
    tails = exact_percentiles(counts, by, "latency_ms", {"p50_ms": 0.5, "p95_ms": 0.95})
    return solid_join(solid_join(base, sessions, by, "left"), tails, by, "left")


def _mean(value: str) -> Column:
    """The mean of a counted value; missing values do not count."""
    known = F.when(F.col(value).isNotNull(), F.col("_n"))
    return (F.sum(F.col(value).cast("double") * F.col("_n")) / F.sum(known)).alias("avg_ms")


def handoff_flow(handoffs: DataFrame, by: Sequence[str] = ("from_agent", "to_agent")) -> DataFrame:
    """Edges between agents with counts and distinct reasons."""
    return handoffs.groupBy(*by).agg(F.count(F.lit(1)).alias("handoffs"), F.countDistinct("session_id").alias("sessions"),
                                     F.countDistinct("reason").alias("reasons"))


def record_handoffs(records: DataFrame) -> DataFrame:
    """Transfers of records, one row each."""
    return records.select("session_id", F.explode("transfers").alias("_t")).select("session_id", "_t.*")


def channel_usage(records: DataFrame, channel: Column, approx: bool = False) -> DataFrame:
    """Records, users and tokens per channel."""
    users = F.approx_count_distinct("external_user_id") if approx else F.countDistinct("external_user_id")
    return records.groupBy(channel.alias("channel")).agg(
        F.count(F.lit(1)).alias("records"), users.alias("users"), *_tokens(records))


def llm_latency(calls: DataFrame, grain: str = "1 hour", by: Sequence[str] = ("model",), ts: str = "ts") -> DataFrame:
    """Calls and latency over time per model."""
    rows = calls.withColumn("bucket", F.window(F.col(ts), grain)["start"])
    keys = ["bucket", *by]
    counts = value_counts(rows, keys, "latency_ms")
    base = counts.groupBy(*keys).agg(F.sum("_n").alias("calls"), _mean("latency_ms"), F.max("latency_ms").alias("max_ms"))
    return solid_join(base, exact_percentiles(counts, keys, "latency_ms", {"p50_ms": 0.5, "p95_ms": 0.95}), keys, "left")


# Of a KLL sketch of this size the rank of a given quantile is off by less than 1% (normalised, single
# quantile, 99% of the time 0.7%); merging keeps that.
KLL_SIZE = 400
# Of a theta sketch of 2^12 entries the count is exact below that and has a standard error of 1.6% above.
THETA_LOG_SIZE = 12


def latency_sketches(calls: DataFrame, grain: str = "1 hour", by: Sequence[str] = ("model",), ts: str = "ts") -> DataFrame:
    """Calls, sum and quantile sketch of the latency per time bucket: small rows to store and merge later.

    A sketch is built on the map side and has a bounded size, so a bucket of any size reaches its
    reducer as one row per task. Missing values do not count in it.
    """
    return calls.groupBy(F.window(F.col(ts), grain)["start"].alias("bucket"), *by).agg(
        F.count(F.lit(1)).alias("calls"), F.count("latency_ms").alias("known"), F.sum("latency_ms").alias("sum_ms"),
        F.max("latency_ms").alias("max_ms"), F.kll_sketch_agg_bigint("latency_ms", F.lit(KLL_SIZE)).alias("sketch"))


def merge_latency(sketches: DataFrame, grain: str = "1 day", by: Sequence[str] = ("model",), probs: dict[str, float] | None = None) -> DataFrame:
    """Latency per coarser bucket from stored sketches, for whatever percentiles are asked."""
    probs = probs or {"p50_ms": 0.5, "p95_ms": 0.95}
    merged = sketches.groupBy(F.window("bucket", grain)["start"].alias("bucket"), *by).agg(
        F.sum("calls").alias("calls"), F.sum("known").alias("known"), F.sum("sum_ms").alias("sum_ms"), F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"))
    some = F.when(F.col("known") > 0, F.col("sketch"))
    return merged.select("bucket", *by, "calls", "sum_ms", "max_ms", *[
        F.kll_sketch_get_quantile_bigint(some, F.lit(p)).alias(name) for name, p in probs.items()])


def user_sketches(records: DataFrame, by: Sequence[str] = ("channel",), user: str = "external_user_id", ts: str = "ts") -> DataFrame:
    """A theta sketch of the users per day and group: small rows to store, unite and intersect later."""
    return records.where(F.col(user).isNotNull()).groupBy(F.to_date(ts).alias("day"), *by).agg(
        F.theta_sketch_agg(user, F.lit(THETA_LOG_SIZE)).alias("sketch"))


def distinct_users(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct users per group over whatever days the sketches are of."""
    return sketches.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", F.lit(THETA_LOG_SIZE))).alias("users"))


def shared_users(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Users that two sets of sketches have in common, per group; also the overlap of two loads."""
    a = left.groupBy(*by).agg(F.theta_union_agg("sketch", F.lit(THETA_LOG_SIZE)).alias("_a"))
    b = right.groupBy(*by).agg(F.theta_union_agg("sketch", F.lit(THETA_LOG_SIZE)).alias("_b"))
    return a.join(b, list(by)).select(*by, F.theta_sketch_estimate(F.theta_intersection("_a", "_b")).alias("users"))


def log_level_counts(logs: DataFrame, grain: str = "1 day", by: Sequence[str] = ("namespace",), ts: str = "timestamp") -> DataFrame:
    """Logs per level and time bucket, a column per level."""
    return logs.groupBy(*by, F.window(F.col(ts), grain)["start"].alias("bucket")).agg(
        *[F.count_if(F.col("level") == level).alias(level) for level in LEVELS], F.count(F.lit(1)).alias("total"))


def acceptance(usage: DataFrame, by: Sequence[str]) -> DataFrame:
    """Acceptance rate from summed counts, not from averaged rates."""
    return usage.groupBy(*by).agg(
        F.sum("shown").alias("shown"), F.sum("accepted").alias("accepted"),
    ).withColumn("acceptance_rate", T.acceptance_rate(F.col("accepted"), F.col("shown")))


def quota_report(requests: DataFrame, limits: dict[str, int] | None = None, ts: str = "ts") -> DataFrame:
    """Requests per token, bucket and minute: remaining, over the limit, seconds to reset."""
    counts = requests.groupBy("token", "quota", F.window(F.col(ts), "1 minute").alias("_w")).agg(
        F.count(F.lit(1)).alias("requests"), F.max(ts).alias("_last"))
    limit = T.lookup(F.col("quota"), limits or QUOTAS, F.lit(None).cast("int")).cast("bigint")
    left = F.timestamp_diff("MICROSECOND", F.col("_last"), F.col("_w")["end"]) / F.lit(1e6)
    return counts.select(
        "token", "quota", F.col("_w")["start"].alias("minute"), "requests", limit.alias("quota_limit"),
        F.greatest(limit - F.col("requests"), F.lit(0)).alias("remaining"),
        F.greatest(F.col("requests") - limit, F.lit(0)).alias("over_limit"),
        F.ceil(left).cast("bigint").alias("reset_s"))


def user_activity(records: DataFrame, by: Sequence[str] = ("namespace", "user_id"), ts: str = "ts") -> DataFrame:
    """Sessions, records, first and last activity and tokens per user."""
    return records.groupBy(*by).agg(
        F.countDistinct("session_id").alias("sessions"), F.count(F.lit(1)).alias("records"),
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), *_tokens(records))


def turn_deltas(turns: DataFrame, keys: Sequence[str] = ("session_id",), line: str = "turn_no",
                tokens: str = "total_tokens", ts: str = "ts") -> DataFrame:
    """Running tokens per session and seconds since the turn before."""
    scanned = blocked_scan(turns, keys, line_block(F.col(line)), [line],
                           sums={"running_tokens": F.col(tokens)}, prev={"_prev": ts})
    gap = F.timestamp_diff("MICROSECOND", F.col("_prev"), F.col(ts)) / F.lit(1e6)
    return scanned.withColumn("seconds_since_prev", gap).drop("_prev")


def top_k(counts: DataFrame, k: int, by: str, per: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """The k largest rows, over all or per group; ties break by ``tie``.

    Per group it is a ``row_number`` filter, which Spark also applies before the shuffle.
    """
    order = [F.col(by).desc(), *[F.col(t) for t in tie]]
    if not per:
        return counts.orderBy(*order).limit(k)
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def pair_tool_calls(calls: DataFrame, results: DataFrame, keys: Sequence[str] = ("session_id", "call_id")) -> DataFrame:
    """Each tool call with its result; unanswered calls stay, also those without an id.

    Repeats of one call id are cut to the first call and the first result before the join
    (a map-side ``min_by``), so copies never multiply.
    """
    keys = list(keys)
    blank = F.coalesce(F.col(keys[-1]), F.lit("")) == ""
    calls = calls.withColumn("_own", F.when(blank, F.col("line")))
    results = results.where(~blank)

    def first(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys and c != "_own"]
        groups = [*keys, "_own"] if "_own" in df.columns else keys
        return df.groupBy(*groups).agg(F.min_by(F.struct(*rest), F.col("line")).alias(name))
    joined = first(calls, "_call").join(first(results, "_result"), keys, "left")
    return joined.select(
        *keys, "_call.tool_name", F.col("_call.line").alias("call_line"), F.col("_result.line").alias("result_line"),
        F.col("_result.text").alias("result"), F.col("_result").isNotNull().alias("answered"))


def logs_for_sessions(logs: DataFrame, sessions: DataFrame, key: str = "session_id") -> DataFrame:
    """Logs that belong to one of the given sessions (or namespaces), once each."""
    return logs.join(sessions.select(key).distinct(), key, "left_semi")
