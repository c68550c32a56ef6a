"""Queries over redaction: classes, toggles, tenant rules, versions, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwise.functions import redaction as R
from turnwise.operators import redact as O
from turnwise.plans import views as V
from turnwise.plans.registry import query
from turnwise.schemas import MSG_DDL
from turnwise.session import landed, scratch_path

_NO_PHONE = ("brazilian_phone",)


def _luhn(m: str) -> str:
    d = f"regexp_replace({m}, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({d}, i, 1) AS INT)"
    return (f"(list_sum(list_transform(range(1, length({d}) + 1), lambda i: CASE WHEN (length({d}) - i) % 2 = 1 "
            f"THEN {digit} * 2 - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END ELSE {digit} END)) % 10 = 0)")


def _redacted(text: str, card: bool = True, email: bool = True) -> str:
    """SQL of the redaction without phone numbers, which need lookaround, and CPF, which do not occur."""
    out = text
    for name, pattern, token in R.PLAIN_CLASSES:
        if name != "brazilian_phone" and (email or name != "email"):
            out = f"regexp_replace({out}, '{pattern}', '{token}', 'g')"
    if not card:
        return out
    hits = f"list_transform(regexp_extract_all({out}, '{R.CARD_PATTERN}'), lambda m: CASE WHEN {_luhn('m')} THEN '{R.CARD_TOKEN}' ELSE m END)"
    return (f"array_to_string(list_transform(list_zip(regexp_split_to_array({out}, '{R.CARD_PATTERN}'), {hits}), "
            f"lambda z: z[1] || coalesce(z[2], '')), '')")


def docs(spark, sf):
    return docs_of(V.table(spark, sf, "documents"))


def docs_of(documents):
    return documents.select("doc_id", "text", "lang", F.concat(F.lit("ns"), F.col("doc_id") % 5).alias("namespace"))


@query("a1_redact_text_nophone", f"SELECT doc_id, md5({_redacted('text')}) AS redacted FROM documents")
def a1(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(R.redact_text(F.col("text"), _NO_PHONE)).alias("redacted"))


@query("a1_redact_text")
def a1_all(spark, sf):
    """All classes. The phone pattern looks around, which the SQL engine's regexes cannot."""
    return docs(spark, sf).select("doc_id", F.md5(R.redact_text(F.col("text"))).alias("redacted"))


@query("a1_redact_pages", f"SELECT page_id, md5({_redacted('html')}) AS redacted FROM pages")
def a1_pages(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", F.md5(R.redact_text(F.col("html"), _NO_PHONE)).alias("redacted"))


def _cpf_sql(d: str) -> str:
    def check(upto: int) -> str:
        total = " + ".join(f"CAST(substr({d}, {i + 1}, 1) AS INT) * {upto + 1 - i}" for i in range(upto))
        return f"((({total}) * 10) % 11) % 10"
    return f"CAST({check(9)} AS VARCHAR) = substr({d}, 10, 1) AND CAST({check(10)} AS VARCHAR) = substr({d}, 11, 1)"


@query("a2_cpf_valid", f"""WITH n AS (SELECT event_id, lpad(CAST(CASE WHEN event_id % 50 = 0 THEN 11111111111 * ((event_id // 50) % 10)
  ELSE 12345678909 + event_id * 37 END AS VARCHAR), 11, '0') AS d FROM events)
  SELECT event_id, {_cpf_sql('d')} AND NOT (length(replace(d, substr(d, 1, 1), '')) = 0) AS valid FROM n""")
def a2(spark, sf):
    return V.table(spark, sf, "events").selectExpr("event_id", """lpad(cast(CASE WHEN event_id % 50 = 0 THEN 11111111111 * ((event_id DIV 50) % 10)
      ELSE 12345678909 + event_id * 37 END AS string), 11, '0') AS d""").select("event_id", R.cpf_valid(F.col("d")).alias("valid"))


@query("a3_luhn_valid", f"""WITH n AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(411111111111 + event_id AS VARCHAR)
  ELSE CAST(4111111111111111 + event_id * 7 AS VARCHAR) END AS d FROM events) SELECT event_id, length(d) >= 13 AND {_luhn('d')} AS valid FROM n""")
def a3(spark, sf):
    return V.table(spark, sf, "events").selectExpr("event_id", """CASE WHEN event_id % 3 = 0 THEN cast(411111111111 + event_id AS string)
      ELSE cast(4111111111111111 + event_id * 7 AS string) END AS d""").select("event_id", R.luhn_valid(F.col("d")).alias("valid"))


_SPLIT = f"""list_transform(regexp_extract_all(text, '{R.CARD_PATTERN}'), lambda m: CASE WHEN {_luhn('m')} THEN '<card>' ELSE m END)"""


@query("a4_replace_validated", f"""SELECT doc_id, md5(array_to_string(list_transform(list_zip(regexp_split_to_array(text, '{R.CARD_PATTERN}'), {_SPLIT}),
  lambda z: z[1] || coalesce(z[2], '')), '')) AS redacted FROM documents""")
def a4(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(R.replace_validated(
        F.col("text"), R.CARD_PATTERN, R.luhn_valid, "<card>")).alias("redacted"))


@query("a5_disabled_classes", f"SELECT doc_id, md5({_redacted('text', card=False, email=False)}) AS redacted FROM documents")
def a5(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(R.redact_text(
        F.col("text"), [*_NO_PHONE, "Credit_Card", "EMAIL"])).alias("redacted"))


def _raw_rules(spark, sf):
    """Tenant rules derived from the documents' namespaces: toggles and custom patterns differ per tenant."""
    return docs(spark, sf).select("namespace").distinct().select(
        F.col("namespace").alias("tenant"), (F.substring("namespace", 3, 2).cast("int") + 1).alias("version"),
        F.when(F.col("namespace") == "ns1", F.create_map(F.lit("email"), F.lit(False), F.lit("brazilian_phone"), F.lit(False)))
         .otherwise(F.create_map(F.lit("brazilian_phone"), F.lit(False))).alias("toggles"),
        F.when(F.col("namespace") == "ns2", F.expr(
            "array(named_struct('name', 'the', 'pattern', '(?i)\\\\bthe (\\\\w+)', 'replacement', '<\\\\1>'), "
            "named_struct('name', 'bad', 'pattern', '[open', 'replacement', 'x'), "
            "named_struct('name', 'und', 'pattern', 'und', 'replacement', '$'))"))
         .otherwise(F.expr("cast(array() AS array<struct<name:string,pattern:string,replacement:string>>)")).alias("custom"))


def _rules(spark, sf):
    return O.compile_rules(spark, _raw_rules(spark, sf))


def text_records(documents):
    """Documents as one-message records."""
    msg = F.array(F.struct(
        F.lit("user").alias("role"), F.col("text").cast("variant").alias("content"), F.lit(None).cast("string").alias("sender"),
        F.lit(None).cast("variant").alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"),
        F.lit(None).cast("string").alias("tool_name"), F.lit(False).alias("is_internal_tool"),
        F.lit(None).cast("string").alias("internal_tool_type"), F.lit(None).cast("string").alias("refusal"),
        *[F.lit(None).cast("variant").alias(n) for n in ("annotations", "audio", "function_call")])).cast(MSG_DDL)
    return documents.withColumn("msg", msg)


_CUSTOM = "regexp_replace(regexp_replace({0}, '(?i)\\bthe (\\w+)', '<\\1>', 'g'), 'und', '$', 'g')"
_TENANT = f"""CASE doc_id % 5 WHEN 1 THEN {_redacted('text', email=False)} WHEN 2 THEN {_CUSTOM.format(_redacted('text'))} ELSE {_redacted('text')} END"""


@query("a7_tenant_rules", f"SELECT doc_id, md5({_TENANT}) AS redacted, CAST(doc_id % 5 + 1 AS INTEGER) AS anonymization_version FROM documents")
def a7(spark, sf):
    out = O.redact_messages(text_records(docs(spark, sf)), _rules(spark, sf), required=True)
    return out.select("doc_id", F.md5(F.try_variant_get(F.col("msg")[0]["content"], "$", "string")).alias("redacted"), "anonymization_version")


@query("j1_rules_dimension", "SELECT doc_id, CAST(doc_id % 5 + 1 AS INTEGER) AS anonymization_version FROM documents")
def j1(spark, sf):
    return O.stamp_version(docs(spark, sf), _rules(spark, sf)).select("doc_id", "anonymization_version")


@query("a8_stamp_version", """SELECT 'ns' || (doc_id % 5) AS namespace, CAST(doc_id % 5 + 1 AS INTEGER) AS anonymization_version, count(*) AS rows FROM documents GROUP BY 1, 2""")
def a8(spark, sf):
    return O.stamp_version(docs(spark, sf), _rules(spark, sf)).groupBy("namespace", "anonymization_version").agg(F.count(F.lit(1)).alias("rows"))


@query("a9_reapply_on_drift", f"""SELECT doc_id, md5(CASE WHEN doc_id % 5 = 2 AND doc_id % 4 < 3 THEN {_CUSTOM.format('text')} ELSE text END) AS text_md5,
  CAST(greatest(doc_id % 4, doc_id % 5 + 1) AS INTEGER) AS anonymization_version FROM documents""")
def a9(spark, sf):
    rows = docs(spark, sf).withColumn("anonymization_version", (F.col("doc_id") % 4).cast("int"))
    out = O.reapply_on_drift(rows, _rules(spark, sf), message="text")
    return out.select("doc_id", F.md5("text").alias("text_md5"), "anonymization_version")


def _tool_records(spark, sf):
    """Documents as two messages: the text as a block list, and as an argument of a tool call."""
    return V.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("ns"), F.col("doc_id") % 5).alias("namespace"), F.from_json(
        F.to_json(F.array(
            F.struct(F.lit("user").alias("role"), F.array(F.struct(F.lit("text").alias("type"), "text")).alias("content"),
                     F.lit(None).cast("array<struct<name:string,arguments:struct<q:string,n:bigint>>>").alias("tool_calls")),
            F.struct(F.lit("assistant").alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.lit("ok").alias("text"))).alias("content"),
                     F.array(F.struct(F.lit("find").alias("name"), F.struct(F.col("text").alias("q"), F.col("doc_id").alias("n")).alias("arguments"))).alias("tool_calls")))),
        MSG_DDL).alias("msg"))


@query("a6_redact_messages")
def a6(spark, sf):
    """Text and nested payloads of tool calls; the phone class keeps it from a SQL form."""
    out = O.redact_messages(_tool_records(spark, sf))
    return out.select("doc_id", F.md5(F.to_json(F.col("msg")[0]["content"])).alias("content"),
                      F.md5(F.to_json(F.col("msg")[1]["tool_calls"])).alias("tool_calls"))


@query("a6_redact_messages_nophone", f"SELECT doc_id, md5({_redacted('text')}) AS block, md5({_redacted('text')}) AS argument, doc_id AS number FROM documents")
def a6_nophone(spark, sf):
    """As above with the phone class off: the leaves of block lists and tool arguments, numbers untouched."""
    rules = docs(spark, sf).select("namespace").distinct().select(
        F.col("namespace").alias("tenant"), F.lit(1).alias("version"),
        F.create_map(F.lit(_NO_PHONE[0]), F.lit(False)).alias("toggles"),
        F.expr("cast(array() AS array<struct<name:string,pattern:string,replacement:string>>)").alias("custom"))
    out = O.redact_messages(_tool_records(spark, sf), O.compile_rules(spark, rules), required=True)
    block, calls = F.col("msg")[0]["content"], F.col("msg")[1]["tool_calls"]
    return out.select("doc_id", F.md5(F.try_variant_get(block, "$[0].text", "string")).alias("block"),
                      F.md5(F.try_variant_get(calls, "$[0].arguments.q", "string")).alias("argument"),
                      F.try_variant_get(calls, "$[0].arguments.n", "bigint").alias("number"))


_CLASSES = [c for c in R.PLAIN_CLASSES if c[0] != "brazilian_phone"]


@query("a12_pii_audit", "WITH hits AS (" + " UNION ALL ".join(
    f"SELECT 'ns' || (doc_id % 5) AS namespace, '{name}' AS pii_class, len(regexp_extract_all(text, '{pattern}')) AS n FROM documents"
    for name, pattern, _ in _CLASSES)
    + f" UNION ALL SELECT 'ns' || (doc_id % 5), 'card', len(list_filter(regexp_extract_all(text, '{R.CARD_PATTERN}'), lambda m: {_luhn('m')})) FROM documents"
    + ") SELECT namespace, pii_class, CAST(sum(n) AS BIGINT) AS hits, count(*) FILTER (n > 0) AS rows_hit FROM hits GROUP BY ALL")
def a12(spark, sf):
    return O.pii_audit(docs(spark, sf), "text", classes=[*[c[0] for c in _CLASSES], "card"])


@query("a12_pii_audit_after", "WITH c AS (SELECT unnest(['cpf', 'email', 'cnpj', 'rg', 'ipv6', 'ipv4', 'brazilian_phone', 'card']) AS pii_class) "
       "SELECT DISTINCT 'ns' || (doc_id % 5) AS namespace, pii_class, CAST(0 AS BIGINT) AS hits, CAST(0 AS BIGINT) AS rows_hit FROM documents, c")
def a12_after(spark, sf):
    return O.pii_audit(O.redact_column(docs(spark, sf), "text"), "text")


@query("a10_validate_rules", "SELECT DISTINCT 'ns' || (doc_id % 5) AS tenant, CAST(1 AS INTEGER) AS rule, 'invalid_regex' AS problem FROM documents WHERE doc_id % 5 = 2")
def a10(spark, sf):
    """What an upload of the tenants' rules would be refused for."""
    return O.rule_problems(_raw_rules(spark, sf))


@query("a10_usable_rules", """SELECT DISTINCT 'ns' || (doc_id % 5) AS tenant, CASE WHEN doc_id % 5 = 2 THEN 'the,und' END AS kept FROM documents""")
def a10_usable(spark, sf):
    """The custom rules that are applied, per tenant; the broken one is left out."""
    listed = F.from_json("custom_json", "array<struct<pattern:string,replacement:string>>")
    names = F.when(F.col("custom_json").isNotNull(), F.array_join(F.transform(
        listed, lambda r: F.regexp_extract(r["pattern"], "(the|und)", 1)), ","))
    return _rules(spark, sf).select("tenant", names.alias("kept"))


# Of every tenant some days are up to date, others hold rows of older versions.
_STORED_VERSION = "CAST(CASE WHEN doc_id % 7 < 3 THEN doc_id % 5 + 1 ELSE least(doc_id % 4, doc_id % 5 + 1) END AS INT)"


@query("a9_partition_rewrite", f"""WITH d AS (SELECT doc_id, text, doc_id % 5 AS ns, doc_id % 7 AS day, {_STORED_VERSION} AS version FROM documents),
  p AS (SELECT ns, day, min(version) < ns + 1 AS rewritten FROM d GROUP BY ns, day)
  SELECT doc_id, md5(CASE WHEN ns = 2 AND version < 3 THEN {_CUSTOM.format('text')} ELSE text END) AS text_md5, CAST(ns + 1 AS INTEGER) AS anonymization_version, rewritten
  FROM d JOIN p USING (ns, day)""")
def a9_partitions(spark, sf):
    """A stored table brought up to date by partition; tells which files were replaced."""
    path = scratch_path(spark, "stored")
    rows = docs(spark, sf).withColumns({
        "anonymization_version": F.expr(_STORED_VERSION), "dt": F.expr("date_add(DATE '2024-01-01', CAST(doc_id % 7 AS INT))")})
    rows.hint("rebalance", "namespace", "dt").write.partitionBy("namespace", "dt").parquet(path)
    before = landed(spark, spark.read.parquet(path).select("_metadata.file_path").distinct(), "files-before")
    O.reapply_stored(spark, path, _rules(spark, sf), message="text")
    after = spark.read.parquet(path).select("doc_id", F.md5("text").alias("text_md5"), "anonymization_version", "_metadata.file_path")
    kept = before.withColumn("_kept", F.lit(True))
    return after.join(kept, "file_path", "left").select("doc_id", "text_md5", "anonymization_version", F.col("_kept").isNull().alias("rewritten"))


@query("a11_fail_closed", """SELECT namespace, required, CASE WHEN required THEN 'refused' ELSE 'published' END AS outcome,
    CASE WHEN required THEN 0 ELSE n END AS published FROM (SELECT 'ns' || (doc_id % 5) AS namespace, count(*) AS n FROM documents GROUP BY 1), (VALUES (true), (false)) AS r(required)
  UNION ALL SELECT namespace, true, 'published with rules', n FROM (SELECT 'ns' || (doc_id % 5) AS namespace, count(*) AS n FROM documents GROUP BY 1)""")
def a11(spark, sf):
    """What gets out with no rules table, an empty one and a loaded one, when rules are required and when not."""
    records = text_records(docs(spark, sf))
    out = None
    for required, rules, name in ((True, None, "published"), (True, _rules(spark, sf).limit(0), "published"), (False, None, "published"),
                                  (True, _rules(spark, sf), "published with rules")):
        by = records.groupBy("namespace").agg(F.count(F.lit(1)).alias("published"))
        try:
            by = O.redact_messages(records, rules, required=required).groupBy("namespace").agg(F.count("msg").alias("published"))
            by = by.withColumn("outcome", F.lit(name))
        except O.RulesNotReady:
            by = by.select("namespace", F.lit(0).cast("bigint").alias("published"), F.lit("refused").alias("outcome"))
        by = by.select("namespace", F.lit(required).alias("required"), "outcome", "published")
        out = by if out is None else out.unionByName(by)
    return out.distinct()
