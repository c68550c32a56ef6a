import random
import re

import pytest
from pyspark.sql import functions as F

from turnwise.functions import redaction as R
from turnwise.functions.jsonredact import _scrubber
from turnwise.operators import redact as O
from turnwise.schemas import MSG_DDL

def cpf(nine: str) -> str:
    """Nine digits with their two check digits."""
    digits = [int(c) for c in nine]
    for _ in range(2):
        weights = range(len(digits) + 1, 1, -1)
        digits.append(sum(d * w for d, w in zip(digits, weights)) * 10 % 11 % 10)
    return "".join(map(str, digits))


def card(fifteen: str) -> str:
    """Fifteen digits with their Luhn digit."""
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(fifteen))
    return fifteen + str(-total % 10)


def dotted(number: str) -> str:
    return f"{number[:3]}.{number[3:6]}.{number[6:9]}-{number[9:]}"


def grouped(number: str) -> str:
    return " ".join(number[i:i + 4] for i in range(0, 16, 4))


TAX = cpf("730154982")
BROKEN_TAX = TAX[:-1] + str((int(TAX[-1]) + 1) % 10)
CARD = card("601198430275116")
BROKEN_CARD = CARD[:-1] + str((int(CARD[-1]) + 1) % 10)
FIRM = "40.871.365/0002-18"
MAIL = "ines+orders@post.harbour.example"


def wide(text: str, zero: int) -> str:
    """The text with its digits from another script."""
    return "".join(chr(zero + int(c)) if c.isdigit() else c for c in text)


# --- a grid: kind of value x place in the text x what stands beside it x script ----------------

def _check_digits_fit(text: str) -> bool:
    d = [int(c) for c in text if c.isdecimal()]
    return len(d) == 11 and len(set(d)) > 1 and "".join(map(str, d)) == cpf("".join(map(str, d[:9])))


def _luhn_fits(text: str) -> bool:
    d = "".join(str(int(c)) for c in text if c.isdecimal())
    return len(d) >= 13 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plainly(text: str, off=()) -> str:
    """The classes in their order by plain regexes, with check digits of this file."""
    if "cpf" not in off:
        text = re.sub(R.CPF_PATTERN, lambda m: R.CPF_TOKEN if _check_digits_fit(m[0]) else m[0], text)
    for name, pattern, token in R.PLAIN_CLASSES:
        if name not in off:
            text = re.sub(pattern, token, text)
    if not set(off) & set(R.CARD_NAMES):
        text = re.sub(R.CARD_PATTERN, lambda m: R.CARD_TOKEN if _luhn_fits(m[0]) else m[0], text)
    return text


def _values(rng) -> list[str]:
    """One random value of every kind, among them some that just fail to be one."""
    def some(n):
        return "".join(rng.choice("0123456789") for _ in range(n))
    tax, long = cpf(some(9)), card("4" + some(14))
    shift = lambda number: number[:-1] + str((int(number[-1]) + rng.randrange(1, 10)) % 10)
    quads = [str(rng.randrange(256)) for _ in range(4)]
    groups = [f"{rng.randrange(1, 65536):x}" for _ in range(rng.randrange(3, 9))]
    return [tax, dotted(tax), shift(tax), dotted(shift(tax)), some(6), long, grouped(long), long.replace("", "-")[1:-1], grouped(shift(long)),
            f"{some(2)}.{some(3)}.{some(3)}/{some(4)}-{some(2)}", some(14), f"{some(2)}.{some(3)}.{some(3)}-{rng.choice('xX7')}",
            f"user{some(2)}@host-{some(1)}.example", f"@host{some(1)}", ".".join(quads), ".".join(quads[:3]), ":".join(groups), ":".join(groups[:2]),
            f"({some(2)}) 9{some(4)}-{some(4)}", f"+55{some(2)}{some(8)}", f"{some(2)} {some(4)} {some(4)}", some(25), ""]


def _grid() -> list[str]:
    rng, texts = random.Random(17), []
    for left, right in [("", ""), ("said ", " twice"), ("", ", and"), ("no:", ""), ("(", ")"), ("a", "b"), ("\u00a0", "\u3000"), ("\n", "\n\n"), ("7 ", " 7"), ("-", "-")]:
        for value in _values(rng):
            texts.append(left + value + right)
            texts.append(left + wide(value, rng.choice([0x0660, 0x0966, 0xFF10])) + right)
    for _ in range(60):
        texts.append(rng.choice([" ", ", ", "; ", "/"]).join(rng.sample(_values(rng), 3)))
    return texts


GRID = _grid()


def test_text_grid(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(GRID)], "i int, t string")
    rows = df.select("i", R.redact_text(F.col("t")).alias("got"),
                     R.redact_text_toggled(F.col("t"), F.create_map().cast("map<string,boolean>")).alias("got2"))
    want = [plainly(t) for t in GRID]
    for r in rows.collect():
        assert (r.got, r.got2) == (want[r.i], want[r.i]), GRID[r.i]
    tokens = {token for _, _, token in R.PLAIN_CLASSES} | {R.CPF_TOKEN, R.CARD_TOKEN}
    assert all(sum(token in w for w in want) >= 5 for token in tokens) and sum(w == t for w, t in zip(want, GRID)) >= 50


def test_python_side_agrees():
    scrub = _scrubber(())
    for text in GRID:
        assert scrub(text) == plainly(text), text


def test_null_and_idempotent(spark):
    df = spark.createDataFrame([(None,), *[(t,) for t in GRID]], "t string")
    once = df.withColumn("a", R.redact_text(F.col("t")))
    assert once.where("t is null and a is not null").count() == 0
    # Again over what is left gives what plain regexes give for it.
    again = once.where("t IS NOT NULL").select("a", R.redact_text(F.col("a")).alias("b")).collect()
    assert all(r.b == plainly(r.a) for r in again) and sum(r.a == r.b for r in again) > 0.9 * len(again)


def test_validators(spark):
    rng = random.Random(5)
    numbers = [None, "", "x"] + [str(d) * 11 for d in range(10)]
    for size in (3, 11, 13, 16, 19):
        for _ in range(60):
            digits = "".join(rng.choice("0123456789") for _ in range(size))
            numbers += [digits, wide(digits, 0x06F0), dotted(digits) if size == 11 else grouped(digits)]
    for _ in range(40):
        numbers += [cpf("".join(rng.choice("0123456789") for _ in range(9))), card("".join(rng.choice("0123456789") for _ in range(15)))]
    rows = spark.createDataFrame([(n,) for n in numbers], "t string").select("t", R.cpf_valid(F.col("t")).alias("c"), R.luhn_valid(F.col("t")).alias("l")).collect()
    assert all((r.c, r.l) == (r.t is not None and _check_digits_fit(r.t), r.t is not None and _luhn_fits(r.t)) for r in rows)
    assert sum(r.c for r in rows) >= 40 and sum(r.l for r in rows) >= 40


@pytest.mark.parametrize("off,text,want", [
    (["email"], f"{MAIL} {TAX}", f"{MAIL} [CPF]"),
    (["CARD"], CARD, CARD),
    (["credit_card"], CARD, CARD),
    (["Email", "cpf"], f"{MAIL} {dotted(TAX)}", f"{MAIL} {dotted(TAX)}"),
])
def test_disabled_classes(spark, off, text, want):
    got = spark.range(1).select(R.redact_text(F.lit(text), off).alias("t")).first().t
    assert got == want
    assert _scrubber(tuple(off))(text) == want


def _records(spark, messages):
    import json
    return (spark.createDataFrame([("t", json.dumps(messages))], "namespace string, j string")
            .select("namespace", F.from_json("j", MSG_DDL).alias("msg")))


def _msgs(df):
    import json
    return json.loads(df.select(F.to_json("msg").alias("j")).first().j)


def test_message_shapes(spark):
    """Text is redacted wherever a message keeps it; pictures, numbers and lists inside lists are not text."""
    picture = {"type": "image", "source": {"data": MAIL}}
    order = {"buyer": {"mail": MAIL, "tax": dotted(TAX)}, "notes": [FIRM, {"from": "172.20.9.33"}],
             "total": int(CARD), "grid": [[MAIL]], "memo": f"bill {CARD}"}
    msgs = [
        {"role": "user", "content": f"my id is {TAX}"},
        {"role": "assistant", "content": [picture, {"type": "tool_use", "id": "o-1", "name": "place_order", "input": order},
                                          {"type": "text", "text": f"noted {MAIL}"}]},
        {"role": "user", "content": [
            {"type": "tool_result", "tool_use_id": "o-1", "content": [{"type": "text", "text": "desk +55 47 93518-6240"}]},
            {"type": "tool_result", "tool_use_id": "o-2", "content": f"from {MAIL}"}]},
        {"role": "user", "content": 7},
        {"role": "assistant", "content": None,
         "tool_calls": [{"id": "o-3", "name": "notify", "arguments": {"mail": MAIL, "tax": TAX}}]},
    ]
    df = O.redact_messages(_records(spark, msgs))
    out = _msgs(df)
    assert out[0]["content"] == "my id is [CPF]"
    same, use, text = out[1]["content"]
    assert same == picture and text["text"] == "noted [EMAIL]"
    assert use["input"] == {"buyer": {"mail": "[EMAIL]", "tax": "[CPF]"}, "notes": ["[CNPJ]", {"from": "[IP]"}],
                            "total": int(CARD), "grid": [[MAIL]], "memo": "bill [CARD]"}
    assert [b["content"] for b in out[2]["content"]] == [[{"type": "text", "text": "desk [PHONE]"}], "from [EMAIL]"]
    assert out[3]["content"] == 7
    assert out[4].get("content") is None
    assert out[4]["tool_calls"][0] == {"id": "o-3", "name": "notify", "arguments": {"mail": "[EMAIL]", "tax": "[CPF]"}}


def test_plain_text_only_stays_native(spark):
    df = _records(spark, [{"role": "user", "content": f"mail {MAIL}"}])
    assert _msgs(O.redact_messages(df))[0]["content"] == "mail [EMAIL]"


RULES = [("t", 2, {"email": False}, [("ticket", r"TKT/(\d+)", r"[ID \1]"), ("bad", "[unclosed", "x"), ("usd", "USD", "$")]),
         ("other", 9, {}, [])]


def test_custom_rules_and_toggles(spark):
    rules = O.compile_rules(spark, spark.createDataFrame(RULES, O.RULES_DDL))
    msgs = [{"role": "user", "content": f"TKT/12 {MAIL} 5 USD {dotted(TAX)}"},
            {"role": "assistant", "content": [{"type": "text", "text": "TKT/7 USD"}],
             "tool_calls": [{"name": "x", "arguments": {"q": "TKT/1 10.0.0.1"}}]}]
    for ms in ([msgs[0]], msgs):
        df = O.redact_messages(_records(spark, ms), rules)
        out = _msgs(df)
        assert out[0]["content"] == f"[ID 12] {MAIL} 5 $ [CPF]"
        assert df.first().anonymization_version == 2
    assert out[1]["content"][0]["text"] == "[ID 7] $"
    assert out[1]["tool_calls"][0]["arguments"]["q"] == "TKT/1 [IP]"


def test_missing_tenant_gets_baseline(spark):
    rules = O.compile_rules(spark, spark.createDataFrame(RULES[1:], O.RULES_DDL))
    df = O.redact_messages(_records(spark, [{"role": "user", "content": f"TKT/1 {MAIL}"}]), rules)
    assert _msgs(df)[0]["content"] == "TKT/1 [EMAIL]"
    assert df.first().anonymization_version == 0


def test_fail_closed(spark):
    df = _records(spark, [{"role": "user", "content": "x"}])
    with pytest.raises(O.RulesNotReady):
        O.redact_messages(df, None, required=True)
    with pytest.raises(O.RulesNotReady):
        O.redact_messages(df, spark.createDataFrame([], O.RULES_DDL), required=True)


def test_reapply_on_drift(spark):
    rules = O.compile_rules(spark, spark.createDataFrame(
        [("t", 3, {}, [("ticket", r"TKT/\d+", "[TICKET]")])], O.RULES_DDL))
    df = _records(spark, [{"role": "user", "content": "TKT/1"}]).crossJoin(
        spark.createDataFrame([(0,), (None,), (3,), (5,)], "anonymization_version int"))
    out = {(r.anonymization_version, r.j) for r in O.reapply_on_drift(df, rules).select(
        "anonymization_version", F.to_json("msg").alias("j")).collect()}
    assert {v for v, j in out if "[TICKET]" in j} == {3}
    assert {v for v, j in out if "TKT/1" in j} == {3, 5}


@pytest.mark.parametrize("rule,code", [
    ({"name": "b", "pattern": "[unclosed", "replacement": "x"}, "invalid_regex"),
    ({"name": "b", "pattern": r"(\d)", "replacement": "$3"}, "invalid_replacement"),
    ({"pattern": "x", "replacement": "y"}, "missing_field"),
])
def test_validate_rules(rule, code):
    with pytest.raises(O.InvalidRules) as e:
        O.validate_rules([rule])
    assert e.value.problems == [(0, code)]


def test_validate_version_conflict():
    O.validate_rules([{"name": "a", "pattern": "x", "replacement": "y"}], 3, 3)
    with pytest.raises(O.InvalidRules):
        O.validate_rules([], current_version=3, expected_version=2)


def test_rules_that_cannot_run_are_left_out(spark):
    """A replacement that names a group the pattern lacks would fail at the first match."""
    rules = [("a", "abc", r"\5"), ("b", "(x", "y"), ("c", "(?P<n>z)", r"\g<n>!"), ("d", "(?P<n>z)", r"\g<m>"), ("e", None, "y"), ("f", "q", None)]
    table = spark.createDataFrame([("t", 1, {}, rules)], O.RULES_DDL)
    compiled = O.compile_rules(spark, table)
    df = O.redact_messages(_records(spark, [{"role": "user", "content": "abc z q"}]), compiled)
    assert _msgs(df)[0]["content"] == "abc z! [REDACTED]"
    assert {(r.rule, r.problem) for r in O.rule_problems(table).collect()} >= {(0, "invalid_replacement"), (1, "invalid_regex"), (4, "missing_field")}


def test_too_many_rules_are_reported(spark):
    table = spark.createDataFrame([("t", 1, {}, [("a", "x" * 100, "y")])], O.RULES_DDL)
    with pytest.raises(O.RulesTooLarge):
        O.read_rules(table, most=50)


def test_plain_rows_do_not_reach_python(spark):
    """The branch of plain rows has no Arrow node below it."""
    rules = O.compile_rules(spark, spark.createDataFrame([("t", 1, {"email": False}, [])], O.RULES_DDL))
    plan = O.redact_messages(_records(spark, [{"role": "user", "content": "x"}]), rules)._jdf.queryExecution().optimizedPlan().toString()
    plain, walked = plan.split("Union")[1].split("ArrowEvalPython")[0], plan.count("ArrowEvalPython")
    assert walked == 1 and "transform" in plain


def test_audit_counts_then_zero(spark):
    df = spark.createDataFrame([("n", f"write {MAIL}, {dotted(TAX)} or {TAX}; {CARD} {grouped(CARD)}"), ("n", f"{FIRM} and 172.20.9.33"), ("n", "nothing"),
                                ("n", f"{TAX} again, {CARD}, {MAIL}, 10.1.2.3 and {dotted(TAX)}")], "namespace string, t string")
    before = O.pii_audit(df, "t").agg(F.sum("hits")).first()[0]
    after = O.pii_audit(O.redact_column(df, "t"), "t").agg(F.sum("hits")).first()[0]
    assert before > 10 and after == 0


@pytest.mark.parametrize("pattern, want", [
    ("ticket-[0-9]+", ["ticket-"]), ("[0-9]+", None), ("a|bcd", None), ("abc|de", ["abc", "de"]), ("(?:foo|barbar)x?", ["foo", "barbar"]),
    ("(?i)PROJECT", ["projec"[:3]]), ("x(abcd)*", None), ("x(abcd)+y", ["abcd"]), ("(?i:AB)CD", ["ab"]), ("é?naïve word", ["ve word"]), ("(?=abc)..", None),
    ("a.b", None),
])
def test_literals_that_a_match_cannot_do_without(pattern, want):
    found = O.required_literals(pattern)
    if pattern == "(?i)PROJECT":
        assert found and all("s" not in x and "k" not in x and "i" not in x for x in found)
        return
    assert found == want


def test_literals_against_matches():
    """Whatever a pattern matches holds one of its literals, over texts of odd letters."""
    import itertools
    import random
    import re
    rng = random.Random(3)
    patterns = ["(?i)task", "(?i)mr[sz]? smith", "ab(c|de)+f", "(no|yes)\\s+way", "(?i)straße", "k{2,}elvin", "(?i)Kelvin", "(ab|ba){2}", "x?yz"]
    letters = ["task", "TASK", "ta\u017fk", "TAS\u212a", "mr smith", "MRS SMITH", "abcf", "abdecf", "no way", "yes\tway", "stra\u00dfe", "kkelvin", "\u212aelvin", "abba", "baab", "yz", "Σ"]
    for pattern in patterns:
        literals = O.required_literals(pattern)
        for _ in range(200):
            text = "".join(rng.choice(letters) + rng.choice(["", " ", "."]) for _ in range(3))
            if re.search(pattern, text) and literals:
                assert any(x.lower() in text.lower() for x in literals), (pattern, text)


def test_only_texts_that_rules_may_match_go_through_arrow(spark):
    """The rows of the branch that leaves the JVM are counted; results are those of running every rule on every row."""
    from pyspark.sql import functions as F
    from turnwise.functions.jsonredact import _custom
    raw = [("t", 1, {}, [("a", "secret-[0-9]+", "<s>"), ("b", "(?i)codename \\w+", "<c>")]), ("u", 2, {}, [("c", "[0-9]{9}", "<n>")]), ("v", 3, {}, []),
           ("w", 4, {}, [("d", "EMAIL", "<e>")])]
    rules = O.compile_rules(spark, spark.createDataFrame(raw, O.RULES_DDL))
    assert {r.tenant: r.literals for r in rules.collect()} == {"t": ["codename ", "secret-"], "u": None, "v": [], "w": None} or \
        {r.tenant: r.literals for r in rules.collect()}["u"] is None
    texts = ["nothing here", "a secret-12 b", "CodeName Zorro", "mail a.b@example.com", "123456789", "secret", "x" * 1000]
    rows = [(i, tenant, text) for i, (tenant, text) in enumerate((t, x) for t in "tuvw" for x in texts)]
    records = spark.createDataFrame(rows, "id int, namespace string, text string").select("id", "namespace", F.from_json(
        F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))), MSG_DDL).alias("msg"))
    from turnwise.operators.scan import lookup_join
    joined = lookup_join(records, rules.withColumnRenamed("tenant", "namespace"), ["namespace"])
    sent = joined.where(O.needs_rules(F.col("msg"), F.col("custom_json"), F.col("literals")))
    # Of t the two texts with a literal, of u and w (nothing can be told) all, of v none.
    assert sorted(r.id for r in sent.collect()) == [1, 2, *range(7, 14), *range(21, 28)]
    got = {r.id: r.t for r in O.redact_messages(records, rules).select("id", F.try_variant_get(F.col("msg")[0]["content"], "$", "string").alias("t")).collect()}
    every = rules.withColumn("literals", F.lit(None).cast("array<string>"))
    want = {r.id: r.t for r in O.redact_messages(records, every).select("id", F.try_variant_get(F.col("msg")[0]["content"], "$", "string").alias("t")).collect()}
    assert got == want and got[1] == "a <s> b" and got[2] == "<c>" and got[24] == "mail [<e>]"
