import json

import pytest
from pyspark.sql import functions as F

from turnwise.operators import incremental as I, turns as T
from turnwise.operators.normalize import to_wire_format
from turnwise.sources import transcripts as S


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n", encoding="utf-8")
    return path


def user(content):
    return {"type": "user", "message": {"role": "user", "content": content}}


def reply(*blocks, usage=None, model="m-1"):
    return {"type": "assistant", "message": {"model": model, "content": list(blocks), "usage": usage or {}}}


TEXT = {"type": "text", "text": "hello"}
USE = {"type": "tool_use", "id": "call-77", "name": "Read", "input": {"path": "/x", "n": [1, 2]}}
USAGE = {"input_tokens": 31, "output_tokens": 6, "cache_creation_input_tokens": 3, "cache_read_input_tokens": 4}


def turns(spark, path, **kw):
    return T.group_turns(S.read_claude_sessions(spark, str(path)), "claude", **kw).orderBy("session_id", "turn_no").collect()


def test_claude_one_turn(spark, tmp_path):
    write(tmp_path / "-Users-me-app" / "abc.def.jsonl", user("hi"), "", "{broken", reply({"type": "thinking", "thinking": "x"}, TEXT, USE, usage=USAGE))
    [t] = turns(spark, tmp_path)
    assert t.session_id == "abc.def"
    assert [m.role for m in t.msg] == ["user", "assistant", "tool"]
    assert [m.content for m in t.msg] == ["hi", "hello", "Tool: Read"]
    assert [m.sender for m in t.msg] == ["user", "m-1", "claude-code"]
    assert json.loads(t.msg[1].tool_calls) == [{"name": "Read", "arguments": {"path": "/x", "n": [1, 2]}, "id": "call-77"}]
    assert t.msg[2].tool_name == "Read" and t.msg[0].tool_calls is None
    assert (t.input_tokens, t.output_tokens, t.process_tokens, t.memory_tokens, t.total_tokens) == (31, 6, 3, 4, 44)
    assert t.model == "m-1" and t.source == "claude-code"
    projects = S.list_projects(S.read_claude_sessions(spark, str(tmp_path))).collect()
    assert [(p.encoded_name, p.decoded_path, p.session_count) for p in projects] == [("-Users-me-app", "/Users/me/app", 1)]


def test_claude_turn_rules(spark, tmp_path):
    write(tmp_path / "p" / "s.jsonl",
          reply(TEXT),                                           # before any user line: dropped
          user("no reply"), user([{"type": "text", "text": "a"}, "b", {"type": "image"}]),
          reply({"type": "tool_use", "id": "x", "name": "N", "input": {}}, usage={"output_tokens": 5}, model=""),
          reply({"type": "thinking", "thinking": "t"}, usage={"output_tokens": 9, "input_tokens": 1}),
          reply(TEXT, usage={"output_tokens": 0, "input_tokens": 99}, model="m-2"),
          user([{"type": "tool_result", "tool_use_id": "x", "content": "r"}]), reply(TEXT, usage={"output_tokens": 2}),
          {"type": "assistant", "message": {"content": "plain text is not a block list"}})
    first, second = turns(spark, tmp_path)
    assert first.msg[0].content == "a\nb"
    assert [m.content for m in first.msg] == ["a\nb", None, "Tool: N", "hello"]
    assert first.msg[1].sender == "claude-code"
    assert (first.output_tokens, first.input_tokens, first.model) == (9, 1, "m-2")
    assert second.msg[0].content == "" and second.output_tokens == 2
    [merged] = turns(spark, tmp_path, merge_tool_results=True)
    assert merged.output_tokens == 2 and [m.role for m in merged.msg] == ["user", "assistant", "tool", "assistant", "assistant"]


def test_empty_file_and_many_splits(spark, tmp_path):
    write(tmp_path / "a" / "empty.jsonl", "")
    n = 400
    write(tmp_path / "a" / "big.jsonl", *[x for i in range(n) for x in (user(f"q{i}" + "x" * (i % 50)), reply({"type": "text", "text": f"a{i}"}))])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = S.read_claude_sessions(spark, str(tmp_path))
        assert lines.select("line").distinct().count() == 2 * n
        assert S.read_text_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
        got = turns(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert [m.content for t in got for m in t.msg if m.role == "assistant"] == [f"a{i}" for i in range(n)]


def test_openclaw(spark, tmp_path):
    def line(role, content):
        return {"id": "1", "message": {"role": role, "content": content}}
    rows = (line("user", "question"), {"type": "compaction"}, line("system", "x"), line("assistant", ""),
            line("assistant", [TEXT, USE]), line("user", "alone"))
    write(tmp_path / "agents" / "bot" / "sessions" / "s1.jsonl", *rows)
    write(tmp_path / "agents" / "default" / "sessions" / "s2.jsonl", *rows)
    write(tmp_path / "stray" / "s3.jsonl", *rows)
    lines = S.read_openclaw_sessions(spark, str(tmp_path))
    assert {(r.session_id, r.agent_id, r.agent_label) for r in lines.select("session_id", "agent_id", "agent_label").distinct().collect()} == {
        ("openclaw-s1", "bot", "openclaw/bot"), ("openclaw-s2", "default", "openclaw"), ("openclaw-s3", "unknown", "openclaw/unknown")}
    got = {t.session_id: t for t in T.group_turns(lines, "openclaw").collect()}
    t = got["openclaw-s1"]
    assert [(m.role, m.content, m.sender) for m in t.msg] == [
        ("user", "question", "user"), ("assistant", "hello", "openclaw/bot"), ("tool", "Tool: Read", "openclaw")]
    assert (t.input_tokens, t.output_tokens, t.process_tokens, t.total_tokens) == (2, 1, 2, 5)
    assert {(r.agent_id, r.session_count) for r in S.list_agents(lines).collect()} == {("bot", 1), ("default", 1), ("unknown", 1)}


def test_cline(spark, tmp_path):
    long = "y" * 900
    history = [
        {"role": "assistant", "content": "early"},
        {"role": "user", "content": [{"type": "text", "text": "do it"}, "now"]},
        {"role": "assistant", "content": [{"type": "text", "text": "sure"}, {"type": "tool_use", "id": "c1", "name": "read_file", "input": {"p": "/a"}}]},
        {"role": "user", "content": [{"type": "text", "text": "lost"}, {"type": "tool_result", "tool_use_id": "c1", "content": long},
                                     {"type": "tool_result", "tool_use_id": "c2", "content": [{"type": "text", "text": "p"}, {"type": "text", "text": "q"}]}]},
        {"role": "assistant", "content": [{"type": "tool_use", "id": "c3", "name": "own", "input": {}}]},
        {"role": "user", "content": "last"},
        {"role": "user", "content": ""},
    ]
    for task, body in (("job-a", json.dumps(history)), ("job-b", '{"not": "a list"}'), ("job-c", "[broken")):
        write(tmp_path / "tasks" / task / "api_conversation_history.json", body)
    lines = S.read_cline_tasks(spark, str(tmp_path))
    assert {(r.task_id, r.message_count) for r in S.list_tasks(lines).collect()} == {("job-a", 7)}
    got = T.group_turns(lines, "cline").orderBy("turn_no").collect()
    assert [t.session_id for t in got] == ["cline-job-a"] * 3
    early, main, last = got
    assert [(m.role, m.content) for m in early.msg] == [("assistant", "early")]
    assert [(m.role, m.content) for m in main.msg] == [
        ("user", "do it\nnow"), ("assistant", "sure"), ("tool", "Tool: read_file"), ("tool", "y" * 500), ("tool", "p q"), ("tool", "Tool: own")]
    assert main.msg[2].internal_tool_type == "file_read" and main.msg[3].tool_call_id == "c1" and main.msg[3].sender == "cline"
    # 900 and 3 characters of results, the two inputs as JSON.
    assert (main.input_tokens, main.output_tokens, main.process_tokens) == (2, 1, 225 + 0 + len('{"p":"/a"}') // 4 + 0)
    assert [(m.role, m.content) for m in last.msg] == [("user", "last")]


def test_copilot_chat(spark, tmp_path):
    convs = [
        {"id": "a", "turns": [{"role": "human", "content": "question"}, {"role": "model", "content": [{"text": "t"}, {"x": 1}, "s"]}, {"role": "bot", "content": ""}]},
        {"conversationId": "b", "messages": [{"type": "question", "text": "q"}, {"type": "other", "message": "mmmm"}]},
        {"turns": [{"role": "user", "content": "no id"}]},
        {"id": "empty", "turns": [{"role": "user", "content": ""}]}, {"id": "none", "turns": []}]
    write(tmp_path / "w1" / "github.copilot-chat" / "conversations.json", json.dumps(convs))
    write(tmp_path / "w2" / "github.copilot-chat" / "conversations.json", json.dumps({"conversations": convs[:1]}))
    got = T.chat_records(S.read_copilot_chat(spark, str(tmp_path))).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.session_id, []).append(r)
    assert {k: len(v) for k, v in by_id.items()} == {"copilot-a": 2, "copilot-b": 1, None: 1}
    a = by_id["copilot-a"][0]
    assert [(m.role, m.content, m.sender) for m in a.msg] == [("user", "question", "user"), ("assistant", 't\n{"x":1}\ns', "copilot")]
    b = by_id["copilot-b"][0]
    assert [(m.role, m.content) for m in b.msg] == [("user", "q"), ("other", "mmmm")]
    assert (b.input_tokens, b.output_tokens, b.total_tokens) == (0, 1, 1)


def test_incremental_reload(spark, tmp_path):
    src, offsets, out = tmp_path / "src", str(tmp_path / "offsets"), str(tmp_path / "out")
    log = [user("q1"), reply(TEXT), user("unanswered"), user("q2"), reply(TEXT)]

    def load(**kw):
        got = I.renumber(T.group_turns(S.read_claude_sessions(spark, str(src)), "claude"))
        return I.load_incremental(spark, got, offsets, lambda df: df.select("session_id", "turn_no").write.mode("append").parquet(out), **kw)

    write(src / "p" / "s.jsonl", *log)
    assert load(only_closed=True) == {"total_inserted": 1, "skipped": 1}
    assert load() == {"total_inserted": 1, "skipped": 1}
    assert load() == {"total_inserted": 0, "skipped": 2}
    write(src / "p" / "s.jsonl", *log, user("q3"), reply(TEXT))
    assert load() == {"total_inserted": 1, "skipped": 2}
    assert sorted(r.turn_no for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_offsets_wait_for_the_write(spark, tmp_path):
    write(tmp_path / "src" / "p" / "s.jsonl", user("q1"), reply(TEXT))
    got = I.renumber(T.group_turns(S.read_claude_sessions(spark, str(tmp_path / "src")), "claude"))

    def fail(df):
        raise RuntimeError("store is down")
    with pytest.raises(RuntimeError):
        I.load_incremental(spark, got, str(tmp_path / "o"), fail)
    assert I.read_offsets(spark, str(tmp_path / "o")).count() == 0


def test_records_and_wire(spark, tmp_path):
    write(tmp_path / "p" / "s.jsonl", user("hi"), reply(TEXT, USE, usage=USAGE))
    rec = T.to_records(T.group_turns(S.read_claude_sessions(spark, str(tmp_path)), "claude"), "ns", "bot")
    wire = to_wire_format(rec)
    assert "total_tokens" not in wire.columns
    msgs = json.loads(wire.select(F.to_json("msg").alias("j")).first().j)
    assert msgs[0] == {"role": "user", "content": "hi"}
    assert set(msgs[1]) == {"role", "content", "tool_calls"} and msgs[2]["tool_name"] == "Read"


@pytest.mark.parametrize("dialect", ["claude", "openclaw", "cline"])
def test_turns_over_block_edges(spark, monkeypatch, dialect):
    """Turns put together from pieces of many small blocks equal those of one block."""
    from turnwise.operators.scan import line_block
    roles = ["assistant", "user", "assistant", "assistant", "assistant", "assistant", "user", "user", "assistant"] * 4
    rows = [(s, i, r, f"text {s} {i}", "a", f"m-{i % 3}") for s in ("x", "y", None) for i, r in enumerate(roles[: 36 if s else 5])]
    lines = spark.createDataFrame(rows, "session_id string, line bigint, role string, text string, agent string, model string").select(
        "session_id", "line", "role", F.col("text").cast("variant").alias("content"), "agent", "model")

    def result():
        out = T.group_turns(lines, dialect)
        return sorted(map(repr, out.withColumn("msg", F.to_json("msg")).collect()))

    whole = result()
    for size in (1, 3, 5):
        monkeypatch.setattr(T, "line_block", lambda c, size=size: line_block(c, size))
        assert result() == whole


def test_bodies_are_shuffled_once(spark):
    """One exchange carries whole lines; the one behind it only pieces at block edges."""
    lines = spark.createDataFrame([("x", 1, "user", "t", "a")], "session_id string, line bigint, role string, text string, agent string")
    out = T.group_turns(lines.select("session_id", "line", "role", F.col("text").cast("variant").alias("content"), "agent"), "openclaw")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(session_id") == 1


def test_token_estimator(spark):
    """Texts are counted by the function that is given, in turns, chats and chains."""
    from turnwise.operators.folds import fold_chain_events
    rows = [("s", 1, "user", "one two three", "a"), ("s", 2, "assistant", "four five", "a")]
    lines = spark.createDataFrame(rows, "session_id string, line bigint, role string, text string, agent string")
    lines = lines.select("session_id", "line", "role", F.col("text").cast("variant").alias("content"), "agent")
    words = lambda text: F.size(F.split(F.coalesce(text, F.lit("x")), " ")).cast("bigint")
    for dialect in ("openclaw", "cline"):
        t = T.group_turns(lines, dialect, token_estimator=words).first()
        assert (t.input_tokens, t.output_tokens, t.total_tokens) == (3, 2, 5), dialect
        t = T.group_turns(lines, dialect).first()
        assert (t.input_tokens, t.output_tokens) == (13 // 4, 9 // 4), dialect
    chat = spark.sql("""SELECT 'c' AS conv_id, array(parse_json('{"role": "user", "content": "a b c d"}'),
      parse_json('{"role": "bot", "content": "e f"}')) AS turns""")
    c = T.chat_records(chat, token_estimator=words).first()
    assert (c.input_tokens, c.output_tokens) == (4, 2)
    ddl = ("run string, seq bigint, event string, prompt string, prompt_tokens bigint, completion_tokens bigint, tool string, "
           "input string, output string, model string")
    events = spark.createDataFrame([
        ("r", 1, "llm_start", "a b c", None, None, None, None, None, "m"),
        ("r", 2, "llm_end", None, None, None, None, None, "d e", None),
        ("r", 3, "chain_end", None, None, None, None, None, "done", None)], ddl)
    got = fold_chain_events(events, ["run"], token_estimator=words).where("input_tokens > 0").first()
    assert (got.input_tokens, got.output_tokens) == (3, 2)
