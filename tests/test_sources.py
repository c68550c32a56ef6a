import json

import pytest
from pyspark.sql import functions as F

from turnwise.operators import folds, rollups
from turnwise.operators.query import filter_records
from turnwise.sources import events as E, records as R, sinks as K, usage as U

GOOD = {"namespace": "n", "agent": "a", "session_id": "s", "msg": {"role": "user", "content": "hi"}, "input_tokens": 10,
        "output_tokens": 20, "process_tokens": 5, "memory_tokens": 15, "transfers": [{"from": "a", "to": "b", "reason": "r"}],
        "inserted_at": "2025-01-02T03:04:05Z"}
LIST = {**GOOD, "msg": [{"role": "user", "content": [{"type": "text", "text": "x"}]}, {"role": "assistant", "content": None}], "total_tokens": 7}
BAD = [{**GOOD, "agent": None}, {k: v for k, v in GOOD.items() if k != "msg"}, {**GOOD, "msg": "text"}, {**GOOD, "msg": [{"content": "no role"}]},
       {**GOOD, "namespace": 5}, {**GOOD, "input_tokens": "many"}, {**GOOD, "msg": [{"role": "user", "content": 42}]}]


def put(path, data):
    path.write_text(data if isinstance(data, str) else json.dumps(data), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("shape", ["array", "envelope", "lines"])
def test_read_records(spark, tmp_path, shape):
    rows = [GOOD, LIST, *BAD, {**GOOD, "msg": {"anything": 1}}]
    data = {"array": rows, "envelope": {"records": rows}, "lines": "\n".join(json.dumps(r) for r in rows)}[shape]
    path = put(tmp_path / "r.json", data)
    got = R.read_records_json(spark, path, lines=shape == "lines")
    out = {r.total_tokens: r for r in got.withColumn("j", F.to_json("msg")).collect()}
    assert got.count() == 3 and set(out) == {50, 7}
    assert json.loads(out[7].j)[0]["content"] == [{"type": "text", "text": "x"}]
    assert out[7].transfers[0].from_agent == "a" and out[7].transfers[0].to_agent == "b"
    assert str(out[50].inserted_at) == "2025-01-02 03:04:05"
    valid, rejected = R.validate_records(R.raw_records_json(spark, path, lines=shape == "lines"))
    assert (valid.count(), rejected.count()) == (3, 7)
    assert {r.reason: r.rows for r in R.rejects_by_reason(rejected).collect()} == {
        "missing_agent": 1, "missing_msg": 1, "bad_msg": 3, "bad_namespace": 1, "bad_input_tokens": 1}


def test_structure(spark, tmp_path):
    for name, data in {"env": {"records": []}, "arr": [{"agent": 1}], "empty": [], "other": {"x": 1}, "first": [{"x": 1}], "broken": "{"}.items():
        put(tmp_path / f"{name}.json", data)
    got = {r.file.rsplit("/", 1)[1][:-5]: r.valid for r in R.validate_structure(spark, str(tmp_path)).collect()}
    assert got == {"env": True, "arr": True, "empty": False, "other": False, "first": False, "broken": False}
    with pytest.raises(R.BadStructure):
        R.read_records_json(spark, str(tmp_path / "other.json"), check=True)


def test_read_logs(spark, tmp_path):
    logs = [{"id": "1", "level": "info", "message": "m", "custom_object": {"k": 1}}, {"namespace": "x", "level": "warn", "message": "n"},
            {"namespace": "", "level": "debug", "message": "e"}, {"namespace": "x", "message": "no level"}]
    path = put(tmp_path / "l.json", {"logs": logs})
    assert sorted((r.namespace, r.level) for r in R.read_logs_json(spark, path, "dflt").collect()) == [("dflt", "debug"), ("dflt", "info"), ("x", "warn")]
    assert sorted((r.namespace, r.level) for r in R.read_logs_json(spark, path, "dflt", strict=True).collect()) == [("dflt", "debug"), ("x", "warn")]


def test_usage_csv(spark, tmp_path):
    path = put(tmp_path / "u.csv", "day,login,ide,language,shown,accepted,lines_suggested,lines_accepted\n"
               "2025-01-01,ann,vscode,py,8,1,3,\n2025-01-01,bob,,py,,,,\n2025-01-01,eve,vim,py,many,1,1,1\n")
    logs, rejects = U.read_copilot_csv(spark, path)
    got = {r.resource_id: r for r in logs.collect()}
    assert got["copilot-ann-2025-01-01"].message == "Copilot usage: ann (vscode) - 12.5% acceptance"
    assert got["copilot-ann-2025-01-01"].custom_object.lines_accepted == 0
    assert got["copilot-bob-2025-01-01"].message.endswith("- 0% acceptance")
    assert [r.user for r in rejects.collect()] == ["eve"]


def test_org_usage(spark, tmp_path):
    day = {"day": "2025-01-01", "total_suggestions_count": 4, "total_acceptances_count": 1, "total_active_users": 2, "breakdown": [{"language": "py"}]}
    for name, body in (("a.json", [day]), ("b.json", {"usage": [{**day, "day": "2025-01-02"}]})):
        put(tmp_path / name, body)
    got = sorted(U.read_copilot_org_usage(spark, str(tmp_path), "acme").collect(), key=lambda r: r.timestamp)
    assert [r.resource_id for r in got] == ["copilot-org-acme-2025-01-01", "copilot-org-acme-2025-01-02"]
    assert got[0].message == "Copilot org usage (acme): 2 users, 25.0% acceptance"
    assert json.loads(got[0].custom_object.breakdown) == [{"language": "py"}]


def test_program_logs(spark):
    rows = [("app", 40, "boom", "m", "f", 7, 1, "main", 1700000000.25, "Trace", '{"user_id":"u","line":99}'),
            ("app", 15, "odd", "m", "f", 8, 1, "main", 1700000000.0, None, None), ("app", 50, "x", "m", "f", 1, 1, "main", 1700000000.0, None, "{}")]
    df = spark.createDataFrame(rows, "name string, levelno int, message string, module string, func string, lineno int, thread bigint, "
                                     "thread_name string, created double, exception string, extra string")
    got = U.structured_logs_to_entries(df, "ns").withColumn("j", F.to_json("custom_object")).collect()
    assert [r.level for r in got] == ["error", "info", "error"]
    first = json.loads(got[0].j)
    assert first["user_id"] == "u" and first["line"] == 99 and first["exception"] == "Trace" and first["logger"] == "app"
    assert str(got[0].timestamp) == "2023-11-14 22:13:20.250000"
    assert json.loads(got[1].j)["line"] == 8
    assert U.structured_logs_to_entries(df, "ns", include_metadata=False).first().custom_object is None


def test_trace_batch(spark):
    rows = [(0, "llm", "s", None, None, None, None), (0, "handoff", "s", None, None, "b", None), (0, "log", None, None, None, None, "m"),
            (0, "log", "s", None, None, None, "m"), (0, "tool", "s", "", None, None, None), (0, None, "s", None, None, None, None),
            (1, "tool", "s", "t", None, None, None), (0, "span", "s", None, None, None, None)]
    df = spark.createDataFrame(rows, "batch_id int, type string, session_id string, tool_name string, from_agent string, to_agent string, message string")
    ok, bad, summary = E.ingest_trace_batch(df)
    assert ok.count() == 3
    assert sorted((r.type or "", r.error_code, r.error_message) for r in bad.collect()) == [
        ("", "missing_field", "type is required"), ("handoff", "missing_field", "from_agent is required"),
        ("log", "missing_field", "session_id or namespace is required"), ("span", "invalid_type", "unknown type span"),
        ("tool", "missing_field", "tool_name is required")]
    assert {r.batch_id: (r.total, r.succeeded, r.failed, r.success) for r in summary.collect()} == {0: (7, 2, 5, False), 1: (1, 1, 0, True)}


def test_sinks(spark, tmp_path):
    path = put(tmp_path / "r.json", [GOOD, LIST])
    rec = R.read_records_json(spark, path)
    out = str(tmp_path / "stored")
    assert K.write_records(rec, out)["total_inserted"] == 2
    stored = spark.read.parquet(out)
    assert stored.where("namespace = 'n' AND dt = date'2025-01-02'").count() == 2
    hits = filter_records(stored, "n", start_date="2025-01-02", end_date="2025-01-03")
    assert hits.count() == 2 and filter_records(stored, "n", end_date="2025-01-02").count() == 0
    plan = hits.select("agent")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "namespace" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "dt#" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "GreaterThanOrEqual(inserted_at" in scan and "msg" not in scan.split("ReadSchema:")[1]
    K.export_records(stored, str(tmp_path / "csv"), "csv", namespace="n")
    csv = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert tuple(csv.columns) == K.RECORD_EXPORT_COLUMNS
    assert {json.loads(r.msg)[0]["role"] for r in csv.collect()} == {"user"}
    K.export_records(stored, str(tmp_path / "json"), cap=1, namespace="n")
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    with pytest.raises(ValueError):
        K.export_records(stored, str(tmp_path / "x"), "xml", namespace="n")
    status = spark.createDataFrame([("n", s) for s in ("inserted", "duplicate", "rejected", "inserted")], "namespace string, status string")
    assert K.ingest_summary(status).first().asDict() == {"namespace": "n", "received": 4, "inserted": 2, "dropped": 1, "rejected": 1}


CHAIN = "run string, seq bigint, event string, prompt string, prompt_tokens bigint, completion_tokens bigint, tool string, input string, output string, model string"


def test_chain_fold(spark):
    rows = [("r", 1, "llm_start", "p" * 40, None, None, None, None, None, "m1"), ("r", 2, "llm_end", None, 7, 3, None, None, None, None),
            ("r", 3, "agent_action", None, None, None, "calc", "1+1 = two", None, None), ("r", 4, "tool_start", None, None, None, "calc", "1+1 = two", None, None),
            ("r", 5, "tool_end", None, None, None, None, None, "22222222", None), ("r", 6, "llm_start", "p" * 8, None, None, None, None, None, "m2"),
            ("r", 7, "llm_end", None, None, None, None, None, "o" * 12, None), ("r", 8, "chain_end", None, None, None, None, None, None, None),
            ("r", 9, "chain_end", None, None, None, None, None, "done", None), ("r", 10, "llm_start", "x", None, None, None, None, None, "m3"),
            ("r", 11, "chain_end", None, None, None, None, None, "again", None), ("r", 12, "llm_start", "x", None, None, None, None, None, None)]
    got = folds.fold_chain_events(spark.createDataFrame(rows, CHAIN)).orderBy("seq").collect()
    action, first, second = got
    assert action.msg.content == "Tool: calc | Input: 1+1 = two" and action.msg.sender == "calc" and action.process_tokens == 2
    assert (first.msg.content, first.input_tokens, first.output_tokens) == ("done", 7 + 2, 3 + 3)
    assert (first.process_tokens, first.process_tokens_raw, first.model) == (2 + 2, 2 + 2 + 2, "m2")
    assert (second.msg.content, second.input_tokens, second.output_tokens, second.model) == ("again", 1, 0, "m3")


AGENT = ("session_id string, seq bigint, event string, agent string, instructions string, role string, content string, tool string, "
         "payload string, in_tokens bigint, out_tokens bigint, to_agent string, reason string, ts string, model string")


def _ev(seq, event, agent="A", **kw):
    names = [c.split()[0] for c in AGENT.split(", ")]
    return tuple({**dict.fromkeys(names), "session_id": "s", "seq": seq, "event": event, "agent": agent, "ts": "2025", **kw}[n] for n in names)


def test_agent_runs(spark):
    rows = [_ev(1, "agent_start", instructions="i" * 17, content="question"), _ev(2, "tool_start", tool="find", payload='{"q":1}'),
            _ev(3, "tool_end", tool="find", payload="result"), _ev(4, "handoff", to_agent="B"),
            _ev(5, "agent_end", content="answer", in_tokens=5, out_tokens=6, model="m"),
            _ev(6, "agent_start", "B"), _ev(7, "message", "B", role="assistant", content="own words"), _ev(8, "agent_end", "B", content="unused")]
    first, second = folds.fold_agent_events(spark.createDataFrame(rows, AGENT)).orderBy("run_no").collect()
    assert [(m.role, m.content) for m in first.msg] == [
        ("user", "question"), ("tool", "Calling tool: find"), ("tool", "result"), ("tool", "Transferindo conversa para B"), ("assistant", "answer")]
    assert (first.input_tokens, first.output_tokens, first.process_tokens, first.total_tokens, first.model) == (5, 6, 4, 15, "m")
    assert [(t.from_agent, t.to_agent) for t in first.transfers] == [("A", "B")]
    assert [m.content for m in second.msg] == ["own words"] and second.transfers is None and second.total_tokens == 0


def test_agent_framework(spark):
    rows = [_ev(1, "agent_start", instructions="be very kind"), _ev(2, "message", role="user", content="one two three four"),
            _ev(3, "message", role="assistant", content="ok"), _ev(4, "tool_start", tool="t", payload='{"a":1}'),
            _ev(5, "tool_end", tool="t", payload="r" * 300), _ev(6, "handoff", to_agent="B", reason="why"), _ev(7, "agent_end"),
            _ev(8, "agent_start"), _ev(9, "agent_end", in_tokens=3, out_tokens=4)]
    first, second = folds.fold_agent_events(spark.createDataFrame(rows, AGENT), dialect="framework").orderBy("run_no").collect()
    assert (first.input_tokens, first.output_tokens, first.process_tokens, first.memory_tokens) == (5, 1, 1 + 75, 3)
    assert first.msg[3].content == "Tool result: " + "r" * 200 and first.transfers[0].reason == "why"
    assert json.loads(first.msg[2].tool_calls) == [{"name": "t", "arguments": {"a": 1}}]
    assert first.total_tokens == 5 + 1 + 76 + 3
    assert (second.input_tokens, second.output_tokens, second.msg) == (3, 4, [])


def test_internal_tools(spark):
    items = [{"type": "web_search_call", "id": "w", "status": "done", "action": {"query": "q", "sources": [{"u": 1}]}},
             {"type": "tool_call_item", "raw_item": {"type": "web_search_call", "id": "w", "action": {"query": "again"}}},
             {"type": "code_interpreter_call", "code": "x", "output": "y"}, {"type": "computer_call", "id": "c", "action": {"type": "click"}}, {"type": "message"}]
    df = spark.createDataFrame([("r", i, "bot", json.dumps(x)) for i, x in enumerate(items)], "run string, pos bigint, agent string, j string")
    got = folds.internal_tool_messages(df.withColumn("item", F.try_parse_json("j"))).orderBy("pos").collect()
    assert [r.tool_name for r in got] == ["web_search", "code_interpreter", "computer_use"]
    call = json.loads(got[0].message.tool_calls)[0]
    assert call == {"name": "web_search", "type": "web_search_call", "id": "w", "status": "done",
                    "arguments": {"query": "q", "sources": [{"u": 1}]}, "result": None}
    assert got[0].message.is_internal_tool and got[0].message.content == "Internal tool: web_search"
    assert json.loads(got[1].arguments) == {"code": "x", "language": "python"} and json.loads(got[1].result) == "y"


def test_pairing_keeps_every_call(spark):
    calls = spark.createDataFrame([("s", "1", 1, "a"), ("s", "1", 5, "dup"), ("s", "2", 2, "b"), ("s", "", 3, "c"), ("s", None, 4, "d")],
                                  "session_id string, call_id string, line bigint, tool_name string")
    results = spark.createDataFrame([("s", "1", 6, "r1"), ("s", "1", 7, "r2"), ("s", "", 8, "no")],
                                    "session_id string, call_id string, line bigint, text string")
    got = {r.tool_name: r.result for r in rollups.pair_tool_calls(calls, results).collect()}
    assert got == {"a": "r1", "b": None, "c": None, "d": None}


def test_percentiles_with_null_groups(spark):
    df = spark.createDataFrame([(None, "a", "s1", False, 10), (None, "a", "s2", True, 30), ("t", "a", "s1", False, None)],
                               "tool_name string, agent string, session_id string, is_error boolean, latency_ms bigint")
    got = {r.tool_name: (r.calls, r.errors, r.p50_ms, r.p95_ms) for r in rollups.tool_usage(df).collect()}
    assert got == {None: (2, 1, 10, 30), "t": (1, 0, None, None)}
    assert rollups.tool_usage(df, approx=True).count() == 2


@pytest.mark.parametrize("fmt", ["json", "csv"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_exported_times_keep_microseconds(spark, tmp_path, fmt, kind):
    logs = spark.sql(f"SELECT 1L AS id, 'n' AS namespace, 'info' AS level, 'm' AS message, CAST('2024-01-04 06:33:45.410546' AS {kind}) AS timestamp")
    K.export_logs(logs, str(tmp_path / "out"), fmt, namespace="n")
    assert any("06:33:45.410546" in r.value for r in spark.read.text(str(tmp_path / "out")).collect())
