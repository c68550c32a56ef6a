"""Lifecycle events of chains and agents -> records.

Events are rows ordered by ``seq`` within a run or session. Which record an event belongs
to is a running count of boundary events, computed in blocks; everything else is a
grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnwise.functions import content as C, tokens as T
from turnwise.operators.scan import blocked_scan, line_block, solid_join
from turnwise.session import landed

TRANSFER_TOOL = "transfer_to_agent"
TOOL_RESULT_PREVIEW = 200


def fold_chain_events(events: DataFrame, keys: Sequence[str] = ("run",), agent: str = "langchain-agent",
                      estimate: bool = True, token_estimator: Callable[[Column], Column] | None = None) -> DataFrame:
    """Chain callback events -> one assistant record per finished chain, one per agent action.

    Columns: keys, ``seq, event, prompt, prompt_tokens, completion_tokens, tool, input,
    output, model``. Prompts are estimated until the model reports prompt tokens, which
    replace what was counted so far; completions add up. ``process_tokens_raw`` counts an
    action's input again when its tool starts, ``process_tokens`` counts it once.
    ``token_estimator`` replaces the estimate of a text's tokens.
    """
    keys = list(keys)
    ev = F.col("event")
    est = token_estimator if token_estimator and estimate else lambda c: T.tokens_chars4_min1(c, estimate)
    zero = F.lit(0).cast("bigint")
    ends = (ev == "chain_end") & F.col("output").isNotNull()
    reports = (ev == "llm_end") & F.col("prompt_tokens").isNotNull()
    scanned = blocked_scan(events, keys, line_block(F.col("seq")), ["seq"],
                           sums={"_ended": ends.cast("bigint"), "_reported": reports.cast("bigint")})
    rows = scanned.withColumn("interval", F.col("_ended") - ends.cast("bigint"))

    # Within an interval, the part after the last report keeps its estimates.
    parts = rows.groupBy(*keys, "interval", "_reported").agg(
        F.sum(F.when(ev == "llm_start", est(F.col("prompt"))).otherwise(zero)).alias("_prompts"),
        F.max(F.when(reports, F.col("prompt_tokens").cast("bigint"))).alias("_report"),
        F.sum(F.when(ev == "llm_end", F.when(F.col("prompt_tokens").isNotNull(), F.coalesce(
            F.col("completion_tokens").cast("bigint"), zero)).otherwise(est(F.col("output")))).otherwise(zero)
              ).alias("_completions"),
        F.sum(F.when(ev == "agent_action", est(F.col("input"))).otherwise(zero)).alias("_actions"),
        F.sum(F.when(ev == "tool_start", est(F.col("input"))).otherwise(zero)).alias("_starts"),
        F.sum(F.when(ev == "tool_end", est(F.col("output"))).otherwise(zero)).alias("_results"),
        F.max_by(F.when(ev == "llm_start", F.col("model")), F.when(ev == "llm_start", F.col("seq"))).alias("_model"),
        F.max(F.when(ends, F.struct("seq", "output"))).alias("_end"),
    )
    last_model = F.max_by(F.col("_model"), F.when(F.col("_model").isNotNull(), F.col("_reported")))
    done = parts.groupBy(*keys, "interval").agg(
        F.max_by(F.coalesce(F.col("_report"), zero) + F.col("_prompts"), F.col("_reported")).alias("input_tokens"),
        F.sum("_completions").alias("output_tokens"),
        F.sum("_actions").alias("_a"), F.sum("_starts").alias("_s"), F.sum("_results").alias("_r"),
        last_model.alias("model"), F.max("_end").alias("_end"),
    ).where(F.col("_end").isNotNull())
    chains = done.select(
        *keys, F.col("_end.seq").alias("seq"), F.lit(agent).alias("agent"),
        C.message(F.lit("assistant"), F.col("_end.output"), F.lit(agent)).alias("msg"),
        "input_tokens", "output_tokens",
        (F.greatest("_a", "_s") + F.col("_r")).alias("process_tokens"),
        (F.col("_a") + F.col("_s") + F.col("_r")).alias("process_tokens_raw"), "model",
        F.lit("chain").alias("kind"))
    actions = events.where(ev == "agent_action").select(
        *keys, "seq", F.lit(agent).alias("agent"),
        C.message(F.lit("tool"), F.concat(F.lit("Tool: "), F.col("tool"), F.lit(" | Input: "), F.col("input")),
                  F.col("tool")).alias("msg"),
        zero.alias("input_tokens"), zero.alias("output_tokens"),
        est(F.col("input")).alias("process_tokens"), est(F.col("input")).alias("process_tokens_raw"),
        F.lit(None).cast("string").alias("model"), F.lit("action").alias("kind"))
    both = chains.unionByName(actions)
    return both.withColumn("total_tokens", F.col("input_tokens") + F.col("output_tokens") + F.col("process_tokens_raw"))


def handoff_message(from_agent: Column, to_agent: Column, reason: Column, ts: Column) -> Column:
    """A transfer as the ``transfer_to_agent`` tool message shown in a conversation."""
    args = F.struct(from_agent.alias("from_agent"), to_agent.alias("to_agent"),
                    reason.alias("reason"), ts.alias("timestamp"))
    call = F.to_json(F.array(F.struct(F.lit(TRANSFER_TOOL).alias("name"), args.alias("arguments"))))
    return C.message(F.lit("tool"), F.concat(F.lit("Transferindo conversa para "), to_agent), from_agent,
                     tool_calls=call, tool_name=F.lit(TRANSFER_TOOL))


def transfers_to_messages(transfers: Column) -> Column:
    """Each transfer of a record -> a tool message."""
    return F.transform(transfers, lambda t: handoff_message(t["from_agent"], t["to_agent"], t["reason"], t["timestamp"]))


def fold_agent_events(events: DataFrame, keys: Sequence[str] = ("session_id",),
                      dialect: str = "openai") -> DataFrame:
    """Agent hook events -> one record per agent run.

    Columns: keys, ``seq, event, agent, instructions, role, content, tool, payload,
    in_tokens, out_tokens, to_agent, reason, ts, model``; events are ``agent_start,
    message, llm_start, tool_start, tool_end, handoff, agent_end``.

    ``openai``: a run reaches up to its ``agent_end``; instructions count as process tokens
    by length; a missing user message is added from the run's input, a missing assistant
    message from its output. ``framework``: a run starts at ``agent_start``; instructions
    count as memory by words, messages as input and output by words, tools as process, and
    reported usage replaces the estimates.
    """
    keys = list(keys)
    ev, seq = F.col("event"), F.col("seq")
    zero = F.lit(0).cast("bigint")
    openai = dialect == "openai"
    boundary = ev == ("agent_end" if openai else "agent_start")
    scanned = blocked_scan(events, keys, line_block(seq), ["seq"], sums={"run_no": boundary.cast("bigint")})
    if openai:
        rows = scanned.withColumn("run_no", F.col("run_no") - boundary.cast("bigint"))
    else:
        rows = scanned.where(F.col("run_no") > 0)

    # Only finished runs become records. They are found by their end events, so the rows of an
    # unfinished run, however many, never come together.
    rows = landed(events.sparkSession, rows, "agent-events")
    finished = rows.where(ev == "agent_end").select(*keys, "run_no").distinct()
    rows = solid_join(rows, finished, [*keys, "run_no"], "left_semi")

    transfer = handoff_message(F.col("agent"), F.col("to_agent"),
                               F.lit(None).cast("string") if openai else F.col("reason"), F.col("ts").cast("string"))
    call = F.to_json(F.array(F.struct(F.col("tool").alias("name"), F.try_parse_json("payload").alias("arguments"))))
    if openai:
        tool_start = C.message(F.lit("tool"), F.concat(F.lit("Calling tool: "), F.col("tool")), F.col("agent"),
                               tool_name=F.col("tool"))
        tool_end = C.message(F.lit("tool"), F.col("payload"), F.col("agent"), tool_name=F.col("tool"))
        said = F.when(ev == "message", C.message(F.col("role"), F.col("content"),
                                                 F.when(F.col("role") == "user", F.lit("user")).otherwise(F.col("agent"))))
    else:
        tool_start = C.message(F.lit("tool"), F.concat(F.lit("Executing tool: "), F.col("tool")), F.col("agent"),
                               tool_calls=call)
        tool_end = C.message(F.lit("tool"), F.concat(F.lit("Tool result: "), F.substring("payload", 1, TOOL_RESULT_PREVIEW)),
                             F.col("agent"))
        said = F.when(ev == "message", C.message(F.coalesce(F.col("role"), F.lit("user")), F.col("content"), F.col("agent")))
    shaped = rows.withColumn("_m", F.coalesce(
        said, F.when(ev == "tool_start", tool_start).when(ev == "tool_end", tool_end).when(ev == "handoff", transfer)))

    given = ev.isin("agent_start", "llm_start") & F.col("content").isNotNull()
    ends = ev == "agent_end"
    is_user, is_reply = (F.col("_m.role") == "user"), (F.col("_m.role") == "assistant")
    words = T.tokens_words(F.col("content"))
    runs = shaped.groupBy(*keys, "run_no").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_m").isNotNull(), F.struct("seq", F.col("_m").alias("m"))))),
                    lambda p: p["m"]).alias("msg"),
        F.transform(F.array_sort(F.collect_list(F.when(ev == "handoff", F.struct(
            "seq", F.col("agent").alias("from_agent"), F.col("to_agent"), F.col("reason"),
            F.col("ts").cast("string").alias("timestamp"))))),
            lambda p: F.struct(p["from_agent"].alias("from_agent"), p["to_agent"].alias("to_agent"),
                               p["reason"].alias("reason"), p["timestamp"].alias("timestamp"))).alias("transfers"),
        F.count_if(is_user).alias("_users"), F.count_if(is_reply).alias("_replies"),
        F.min_by(F.when(given, F.col("content")), F.when(given, seq)).alias("_input"),
        F.max(F.when(ends, F.struct("seq", "agent", F.coalesce("content", F.lit("")).alias("content"), "in_tokens",
                                    "out_tokens", "model"))).alias("_end"),
        F.max_by(F.when(ev == "agent_start", F.col("instructions")),
                 F.when((ev == "agent_start") & F.col("instructions").isNotNull(), seq)).alias("_instructions"),
        F.sum(F.when((ev == "message") & (F.coalesce("role", F.lit("user")) == "user"), words).otherwise(zero)).alias("_in"),
        F.sum(F.when((ev == "message") & (F.col("role") == "assistant"), words).otherwise(zero)).alias("_out"),
        F.sum(F.when(ev.isin("tool_start", "tool_end"), T.tokens_chars4(F.col("payload"))).otherwise(zero)).alias("_tool"),
    ).where(F.col("_end").isNotNull())

    msg = F.col("msg")
    reported = lambda name: F.col(f"_end.{name}").cast("bigint")
    if openai:
        user = F.array(C.message(F.lit("user"), F.col("_input"), F.lit("user")))
        reply = F.array(C.message(F.lit("assistant"), F.col("_end.content"), F.col("_end.agent")))
        msg = F.when((F.col("_users") == 0) & F.col("_input").isNotNull(), F.concat(user, msg)).otherwise(msg)
        msg = F.when(F.col("_replies") == 0, F.concat(msg, reply)).otherwise(msg)
        tokens = {"input_tokens": F.coalesce(reported("in_tokens"), zero),
                  "output_tokens": F.coalesce(reported("out_tokens"), zero),
                  "process_tokens": T.tokens_chars4(F.col("_instructions")), "memory_tokens": zero}
    else:
        tokens = {"input_tokens": F.coalesce(reported("in_tokens"), F.col("_in")),
                  "output_tokens": F.coalesce(reported("out_tokens"), F.col("_out")),
                  "process_tokens": F.col("_tool"), "memory_tokens": T.tokens_words(F.col("_instructions"))}
    out = runs.withColumns({**tokens, "_msg": msg})
    return out.select(
        *keys, "run_no", F.col("_end.agent").alias("agent"), F.col("_msg").alias("msg"),
        F.when(F.size("transfers") > 0, F.col("transfers")).alias("transfers"), *T.TOKEN_FIELDS,
        T.total_tokens(F.lit(None), *[F.col(n) for n in T.TOKEN_FIELDS]).alias("total_tokens"),
        F.col("_end.model").alias("model"))


def internal_tool_messages(items: DataFrame, keys: Sequence[str] = ("run",), agent: str = "agent") -> DataFrame:
    """Hosted tool calls among response items -> tool messages, one per call id.

    ``items`` has keys, ``pos`` and ``item`` (VARIANT), either the call itself or a wrapper
    with the call under ``raw_item``. A call listed twice (with the same id) is kept once;
    calls without an id are all kept.
    """
    keys = list(keys)
    wrapped = F.try_variant_get(F.col("item"), "$.type", "string") == "tool_call_item"
    call = F.when(wrapped, F.try_variant_get(F.col("item"), "$.raw_item", "variant")).otherwise(F.col("item"))
    rows = items.withColumn("_c", call).withColumn("item_type", C.get_text(F.col("_c"), "$.type"))
    rows = rows.where(F.col("item_type").isin(*T.INTERNAL_TOOLS))

    def part(*paths: str) -> Column:
        return F.coalesce(*[F.to_json(F.try_variant_get(F.col("_c"), p, "variant")) for p in paths])

    def obj(**fields: Column) -> Column:
        pairs = [F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("null"))) for k, v in fields.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))

    kind = F.col("item_type")
    result_list = F.when(C.as_array(F.try_variant_get(F.col("_c"), "$.result", "variant")).isNotNull(), part("$.result"))
    arguments = (F.when(kind == "web_search_call", obj(
                    query=part("$.action.query"),
                    sources=F.coalesce(part("$.action.sources", "$.result.sources", "$.result.results",
                                            "$.result.web_results"), result_list)))
                 .when(kind == "file_search_call", obj(query=part("$.query"), file_ids=part("$.file_ids")))
                 .when(kind == "code_interpreter_call", obj(
                    code=part("$.code"), language=F.coalesce(part("$.language"), F.lit('"python"'))))
                 .otherwise(obj(action_type=part("$.action.type"))))
    result = (F.when(kind == "web_search_call", part("$.result"))
              .when(kind == "file_search_call", part("$.results"))
              .otherwise(part("$.output")))
    rows = rows.withColumns({
        "call_id": C.get_text(F.col("_c"), "$.id"), "tool_name": T.lookup(kind, T.INTERNAL_TOOLS, kind),
        "status": C.get_text(F.col("_c"), "$.status"), "arguments": arguments, "result": result})
    once = rows.groupBy(*keys, F.coalesce("call_id", F.concat(F.lit("#"), F.col("pos"))).alias("_id")).agg(
        F.min_by(F.struct("pos", agent, "item_type", "tool_name", "call_id", "status", "arguments", "result"),
                 F.col("pos")).alias("_r")).select(*keys, "_r.*")
    calls = F.concat(F.lit("["), obj(
        name=F.to_json(F.col("tool_name").cast("variant")), type=F.to_json(F.col("item_type").cast("variant")),
        id=F.to_json(F.col("call_id").cast("variant")), status=F.to_json(F.col("status").cast("variant")),
        arguments=F.col("arguments"), result=F.col("result")), F.lit("]"))
    return once.withColumn("message", C.message(
        F.lit("tool"), F.concat(F.lit("Internal tool: "), F.col("tool_name")), F.col(agent), tool_calls=calls,
        tool_name=F.col("tool_name"), internal=F.lit(True), internal_type=F.col("item_type")))
