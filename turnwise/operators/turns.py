"""Grouping transcript lines into turns and turns into records.

Every function takes *lines*: ``session_id``, ``line`` (an integer unique and increasing
within the session), ``role`` and ``content`` (VARIANT), and optional columns named below;
``namespace``, ``agent`` and other per-session columns ride along as ``keys``.

Message bodies are shuffled once. :func:`blocked_scan` numbers the turns and leaves the lines
partitioned by (session, block), so one session may be any share of the table; turns are
collected there, without another shuffle. Only a turn that reaches over the edge of a block is
put together from its pieces afterwards, at most two a block. The unit collected into one row
is a turn, which is what a record is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnwise.functions import content as C, tokens as T
from turnwise.operators.scan import blocked_scan, line_block

RESULT_PREVIEW = 500


def number_turns(lines: DataFrame, opens: Column, keys: Sequence[str] = ("session_id",), pieces: bool = False) -> DataFrame:
    """Add ``turn_no``: how many opening lines the session has had so far; ``pieces`` for :func:`_collected`."""
    return blocked_scan(lines, keys, line_block(F.col("line")), ["line"],
                        sums={"turn_no": opens.cast("bigint")}, pieces_of="turn_no" if pieces else None)


def _has_block(content: Column, *types: str) -> Column:
    return F.coalesce(F.exists(C.as_array(content), lambda b: C.block_type(b).isin(*types)), F.lit(False))


def _collected(lines: DataFrame, keys: list[str], keep: Column, sums: Mapping[str, Column],
               latest: Mapping[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """One row per turn: ``msg`` (messages of the kept lines in line order), sums, and for each
    of ``latest`` the value of the last line for which its condition holds.
    """
    latest = dict(latest or {})
    solid = [c for c in lines.columns if c.startswith("_k") and c[2:].isdigit()]
    pieces = lines.groupBy("_block", *solid, *keys, "turn_no").agg(
        F.collect_list(F.when(keep, F.struct(F.col("line"), F.col("_messages").alias("m")))).alias("_parts"),
        *[F.sum(value).alias(name) for name, value in sums.items()],
        *[F.max_by(F.when(when, F.struct(F.col("line"), value.alias("value"))), F.when(when, F.col("line"))).alias(name)
          for name, (value, when) in latest.items()],
        F.bool_or("_edge").alias("_edge"))
    names = [*sums, *latest]
    whole = pieces.where("not _edge").select(*keys, "turn_no", "_parts", *names)
    joined = pieces.where("_edge").groupBy(*keys, "turn_no").agg(
        F.flatten(F.collect_list("_parts")).alias("_parts"), *[F.sum(name).alias(name) for name in sums],
        *[F.max_by(name, F.col(name)["line"]).alias(name) for name in latest])
    msg = F.flatten(F.transform(F.array_sort("_parts"), lambda p: p["m"])).alias("msg")
    return whole.unionByName(joined).select(
        *keys, "turn_no", msg, *sums, *[F.col(name)["value"].alias(name) for name in latest])


def group_turns(lines: DataFrame, dialect: str = "claude", keys: Sequence[str] = ("session_id",),
                agent: str = "agent", merge_tool_results: bool = False,
                token_estimator: Callable[[Column], Column] = T.tokens_chars4) -> DataFrame:
    """Turns of a transcript, one row per turn: ``turn_no``, ``msg``, tokens, ``model``.

    ``claude``: every user line opens a turn; a turn counts only with an assistant line
    holding a text or tool block; tokens are the last usage with output tokens, wherever it
    stands; optional columns ``model`` and ``usage`` (VARIANT). A user line that only
    carries tool results opens a turn too, unless ``merge_tool_results`` is set.

    ``openclaw``: as above on message roles; assistants need text or tools; tokens are
    estimated from the text. ``cline``: tool results continue the turn as tool messages,
    turns with a user line only and assistants before the first user line are kept.

    ``agent`` names the column holding the agent's name. ``token_estimator`` makes a text's
    tokens where a dialect reports none.
    """
    shape = {"claude": _claude_lines, "openclaw": _openclaw_lines, "cline": _cline_lines}
    if dialect not in shape:
        raise ValueError(f"unknown dialect {dialect!r}")
    return shape[dialect](lines, list(keys), F.col(agent), merge_tool_results, token_estimator)


def _claude_lines(lines: DataFrame, keys: list[str], agent: Column, merge: bool, estimator: Callable) -> DataFrame:
    content = F.col("content")
    opens = F.col("role") == "user"
    if merge:
        opens = opens & ~_has_block(content, "tool_result")
    model = F.col("model") if "model" in lines.columns else F.lit(None).cast("string")
    usage = F.col("usage") if "usage" in lines.columns else F.lit(None).cast("variant")
    is_user = F.col("_opens")
    is_reply = F.col("role") == "assistant"
    calls = C.extract_tool_calls(content)
    blocks = C.as_array(content)
    reply_text = F.when(F.size(C.text_parts(blocks)) > 0, C.extract_text(content))
    sender = F.coalesce(F.nullif(F.col("_model"), F.lit("")), agent)
    rows = (lines.where(F.col("role").isin("user", "assistant"))
            .withColumns({"_opens": opens, "_model": model, "_usage": T.map_anthropic_usage(usage)}))
    numbered = number_turns(rows, F.col("_opens"), keys, pieces=True).where(F.col("turn_no") > 0)
    shaped = numbered.withColumns({
        "_kept": is_reply & _has_block(content, "text", "tool_use"),
        "_counted": is_reply & (F.col("_usage")["output_tokens"] > 0),
        "_calls": calls,
        "_text": F.when(is_reply, reply_text).otherwise(C.extract_text(content)),
    }).withColumn("_messages", F.when(is_user, F.array(
        C.message(F.lit("user"), F.col("_text"), F.lit("user")))).when(
        F.col("_kept"), C.assistant_messages(F.col("_text"), F.col("_calls"), sender, agent)))
    turns = _collected(
        shaped, keys, is_user | F.col("_kept"), {"_replies": F.col("_kept").cast("bigint")},
        {"_usage": (F.col("_usage"), F.col("_counted")), "model": (F.coalesce(F.col("_model"), F.lit("")), F.col("_kept"))},
    ).where(F.col("_replies") > 0).withColumn("model", F.nullif("model", F.lit("")))
    tokens = {n: F.coalesce(F.col("_usage")[n], F.lit(0).cast("bigint")) for n in T.TOKEN_FIELDS}
    return _finish(turns.withColumns(tokens), keys, "claude-code")


def _openclaw_lines(lines: DataFrame, keys: list[str], agent: Column, merge: bool, estimator: Callable) -> DataFrame:
    content = F.col("content")
    is_user, is_reply = F.col("role") == "user", F.col("role") == "assistant"
    sender = F.col("sender") if "sender" in lines.columns else agent
    rows = lines.where(F.col("role").isin("user", "assistant"))
    numbered = number_turns(rows, is_user, keys, pieces=True).where(F.col("turn_no") > 0)
    shaped = numbered.withColumns({
        "_text": C.extract_text(content), "_calls": C.extract_tool_calls(content),
    }).withColumn("_kept", is_reply & ((F.col("_text") != "") | (F.size("_calls") > 0))).withColumn(
        "_messages", F.when(is_user, F.array(C.message(F.lit("user"), F.col("_text"), F.lit("user")))).when(
            F.col("_kept"), C.assistant_messages(F.col("_text"), F.col("_calls"), sender, agent)))
    said = is_user | F.col("_kept")
    turns = _collected(shaped, keys, said, {
        "_replies": F.col("_kept").cast("bigint"),
        **{name: F.when(said, _role_tokens(F.col("_messages"), role, estimator))
           for name, role in (("input_tokens", "user"), ("output_tokens", "assistant"), ("process_tokens", "tool"))},
    }).where(F.col("_replies") > 0)
    return _finish(turns, keys, "openclaw")


def _role_tokens(messages: Column, role: str, estimator: Callable) -> Column:
    return F.aggregate(F.filter(messages, lambda m: m["role"] == role), F.lit(0).cast("bigint"),
                       lambda a, m: a + estimator(m["content"]))


def _cline_lines(lines: DataFrame, keys: list[str], agent: Column, merge: bool, estimator: Callable) -> DataFrame:
    content = F.col("content")
    no_messages = F.array().cast(f"array<{C.MESSAGE_DDL}>")
    is_user, is_reply = F.col("role") == "user", F.col("role") == "assistant"
    rows = (lines.where(F.col("role").isin("user", "assistant"))
            .withColumn("_result", is_user & _has_block(content, "tool_result")))
    numbered = number_turns(rows, is_user & ~F.col("_result"), keys, pieces=True)

    def result_text(block: Column) -> Column:
        inner = F.try_variant_get(block, "$.content", "variant")
        texts = F.transform(F.filter(C.as_array(inner), lambda b: F.schema_of_variant(b).startswith("OBJECT")),
                            lambda b: F.coalesce(C.get_text(b, "$.text"), F.lit("")))
        return F.coalesce(F.array_join(texts, " "), F.try_variant_get(inner, "$", "string"), F.lit(""))

    results = F.transform(F.filter(C.as_array(content), lambda b: C.block_type(b) == "tool_result"),
                          lambda b: F.struct(result_text(b).alias("text"),
                                             C.get_text(b, "$.tool_use_id").alias("id")))
    plain = C.is_string(content)
    reply_text = F.when(plain, C.extract_text(content)).when(
        F.size(_block_texts(content)) > 0, F.array_join(_block_texts(content), "\n"))
    shaped = numbered.withColumns({
        "_results": F.when(F.col("_result"), results),
        "_text": F.when(is_user & ~F.col("_result"), F.nullif(C.extract_text(content), F.lit("")))
                  .when(is_reply, reply_text),
        "_calls": C.extract_tool_calls(content),
    }).withColumn("_messages", F.coalesce(
        F.when(F.col("_result"), F.transform("_results", lambda r: C.message(
            F.lit("tool"), F.substring(r["text"], 1, RESULT_PREVIEW), F.lit("cline"), tool_call_id=r["id"])))
        .when(is_user & F.col("_text").isNotNull(),
              F.array(C.message(F.lit("user"), F.col("_text"), F.lit("user"))))
        .when(is_reply, C.assistant_messages(F.col("_text"), F.col("_calls"), agent, agent,
                                             always=False, category=True)), no_messages))
    zero = F.lit(0).cast("bigint")
    process = F.coalesce(F.aggregate("_results", zero, lambda a, r: a + estimator(r["text"])), zero) + F.when(
        is_reply, F.aggregate("_calls", zero, lambda a, c: a + estimator(c["arguments"]))).otherwise(zero)
    turns = _collected(shaped, keys, F.size("_messages") > 0, {
        "input_tokens": F.when(is_user & ~F.col("_result"), estimator(F.col("_text"))).otherwise(zero),
        "output_tokens": F.when(is_reply, estimator(F.col("_text"))).otherwise(zero),
        "process_tokens": process,
    }).where(F.size("msg") > 0)
    return _finish(turns, keys, "cline")


def _block_texts(content: Column) -> Column:
    """Texts of the ``text`` blocks only; bare strings in a list do not count here."""
    return F.transform(F.filter(C.as_array(content), lambda b: C.block_type(b) == "text"),
                       lambda b: F.coalesce(C.get_text(b, "$.text"), F.lit("")))


def _finish(turns: DataFrame, keys: list[str], source: str) -> DataFrame:
    def col(name: str, ddl: str) -> Column:
        return F.col(name) if name in turns.columns else F.lit(None).cast(ddl)
    segments = [F.coalesce(col(n, "bigint"), F.lit(0).cast("bigint")) for n in T.TOKEN_FIELDS]
    return turns.select(
        *keys, "turn_no", "msg", *[s.alias(n) for s, n in zip(segments, T.TOKEN_FIELDS)],
        T.total_tokens(F.lit(None), *segments).alias("total_tokens"),
        F.lit(source).alias("source"), col("model", "string").alias("model"))


def chat_records(conversations: DataFrame, agent: Column | None = None,
                 token_estimator: Callable[[Column], Column] = T.tokens_chars4) -> DataFrame:
    """One record per chat conversation (``conv_id``, ``turns array<variant>``).

    A conversation arrives as one JSON array, so nothing is shuffled: roles are normalised,
    empty messages skipped, and a conversation with none left is dropped.
    """
    name = F.lit("copilot") if agent is None else agent

    def first_of(t: Column, *fields: str) -> Column:
        # The first field that is present wins, also when its value is empty.
        return F.coalesce(*[F.try_variant_get(t, f"$.{f}", "variant") for f in fields])

    def shape(t: Column) -> Column:
        role = F.coalesce(T.normalize_role(F.try_variant_get(first_of(t, "role", "type"), "$", "string")), F.lit(""))
        body = first_of(t, "content", "text", "message")
        text = F.when(C.as_array(body).isNotNull(), C.extract_text(body, stringify=True)).otherwise(
            F.try_variant_get(body, "$", "string"))
        return C.message(role, text, F.when(role == "user", F.lit("user")).otherwise(name))

    kept = F.filter(F.transform("turns", shape), lambda m: F.coalesce(m["content"], F.lit("")) != "")
    zero = F.lit(0).cast("bigint")

    def tokens(which) -> Column:
        return F.aggregate(F.filter("msg", which), zero, lambda a, m: a + token_estimator(m["content"]))

    shaped = conversations.withColumn("msg", kept).where(F.size("msg") > 0)
    return shaped.withColumns({
        "session_id": F.when(F.col("conv_id") != "", F.concat(F.lit("copilot-"), F.col("conv_id"))),
        "input_tokens": tokens(lambda m: m["role"] == "user"),
        "output_tokens": tokens(lambda m: m["role"] != "user"),
        "process_tokens": zero, "memory_tokens": zero,
    }).withColumn("total_tokens", F.col("input_tokens") + F.col("output_tokens")).withColumns({
        "source": F.lit("copilot"), "model": F.lit(None).cast("string"),
    }).drop("turns", "conv_id")


def to_records(turns: DataFrame, namespace: str, agent: Column | str) -> DataFrame:
    """Turns -> stored record columns, with the message parts as VARIANT."""
    name = F.lit(agent) if isinstance(agent, str) else agent
    return turns.withColumns({
        "namespace": F.lit(namespace), "agent": name, "msg": C.to_variant_messages(F.col("msg"))})
