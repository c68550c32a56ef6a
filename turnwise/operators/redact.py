"""Redaction of records: baseline classes, per-tenant rules, versions, audit."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnwise.functions import redaction as R
from turnwise.functions.content import as_array, is_string
from turnwise.functions.jsonredact import custom_rules_text, redact_json_messages
from turnwise.operators.scan import lookup_join
from turnwise.schemas import MSG_DDL
from turnwise.session import landed

DEFAULT_TOKEN = "[REDACTED]"
MAX_RULE_BYTES = 64 << 20

RULES_DDL = ("tenant string, version int, toggles map<string,boolean>, "
             "custom array<struct<name:string,pattern:string,replacement:string>>")


class RulesNotReady(RuntimeError):
    """Rules are required but were never loaded: nothing may be published."""


class RulesTooLarge(RuntimeError):
    """The rules table is no configuration any more; nothing was applied."""


class InvalidRules(ValueError):
    """A rules document was refused; ``problems`` lists (rule index, code)."""

    def __init__(self, problems: Sequence[tuple[int, str]]):
        super().__init__("; ".join(f"rule {i}: {code}" for i, code in problems))
        self.problems = list(problems)


# --- rule syntax -------------------------------------------------------------------------

def usable(pattern, replacement: str) -> bool:
    """Whether a rule compiles and its replacement names only groups the pattern has."""
    try:
        re.compile(pattern).sub(replacement, "")
    except (re.error, TypeError, IndexError):
        return False
    return True


def validate_rules(custom: Sequence[dict], current_version: int | None = None,
                   expected_version: int | None = None) -> None:
    """Refuse a rules document: missing fields, bad patterns, references to no group.

    Raises :class:`InvalidRules`. With both versions given, a stale ``expected_version``
    is refused too.
    """
    problems: list[tuple[int, str]] = []
    if expected_version is not None and current_version is not None and expected_version != current_version:
        problems.append((-1, "version_conflict"))
    for i, rule in enumerate(custom):
        if not isinstance(rule, dict) or not all(isinstance(rule.get(k), str) and rule[k] != ""
                                                 for k in ("name", "pattern")):
            problems.append((i, "missing_field"))
            continue
        try:
            groups = re.compile(rule["pattern"]).groups
        except re.error:
            problems.append((i, "invalid_regex"))
            continue
        text = rule.get("replacement", DEFAULT_TOKEN)
        refs = [int(n) for n in re.findall(r"(?:\$|\\(?:g<)?)(\d+)", text)]
        if any(n > groups for n in refs):
            problems.append((i, "invalid_replacement"))
    if problems:
        raise InvalidRules(problems)


def read_rules(rules: DataFrame, most: int = MAX_RULE_BYTES) -> list:
    """The rows of a rules table, which is configuration: refused, not cut, beyond ``most`` bytes."""
    kept = landed(rules.sparkSession, rules.select("tenant", "version", "toggles", "custom"), "rules")
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct(*kept.columns))))).first()[0] or 0
    if size > most:
        raise RulesTooLarge(f"rules take {size} bytes, more than {most}")
    return kept.collect()


# Letters that a pattern ignoring case also finds in others than their own two forms.
_ODD_CASE = set("iskISK")
_SHORTEST = 2


def required_literals(pattern: str) -> list[str] | None:
    """Texts of which every match of the pattern holds at least one; None if none can be told.

    Taken from the parsed pattern: the longest run of plain characters that a sequence cannot do
    without, or such runs of all its alternatives. A run is ASCII, whose lower case does not depend
    on what stands around; where case is ignored it ends at letters that have more than two forms.
    """
    tree = _parser.parse(pattern)
    return _required(tree, bool(tree.state.flags & re.IGNORECASE))


def _required(tree, nocase: bool) -> list[str] | None:
    best: list[str] | None = None
    run = ""

    def better(found: list[str] | None) -> None:
        nonlocal best
        if found and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    def flush() -> None:
        nonlocal run
        if len(run) >= _SHORTEST:
            better([run])
        run = ""

    for op, arg in tree:
        if op is _parser.LITERAL and arg < 128 and not (nocase and chr(arg) in _ODD_CASE):
            run += chr(arg).lower() if nocase else chr(arg)
            continue
        flush()
        if op is _parser.SUBPATTERN:
            _, add, remove, inner = arg
            better(_required(inner, (nocase or bool(add & re.IGNORECASE)) and not remove & re.IGNORECASE))
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT) and arg[0] > 0:
            better(_required(arg[2], nocase))
        elif op is _parser.ATOMIC_GROUP:
            better(_required(arg, nocase))
        elif op is _parser.BRANCH:
            parts = [_required(part, nocase) for part in arg[1]]
            if all(parts):
                better([x for part in parts for x in part])
    flush()
    return best


def _meets_token(literal: str) -> bool:
    """Whether the literal can take part in a token that a built-in class leaves in the text."""
    for token in [token.lower() for _, _, token in R.PLAIN_CLASSES] + [R.CARD_TOKEN.lower(), R.CPF_TOKEN.lower()]:
        low = literal.lower()
        if low in token or token in low or any(token.endswith(low[:n]) or token.startswith(low[-n:]) for n in range(1, len(low))):
            return True
    return False


def rule_literals(custom: Sequence[dict]) -> list[str] | None:
    """Lower-case texts of which a content holds one if any of the rules changes it; None if that cannot be told.

    Rules run on text that the built-in classes have been over, so a literal that could take part in
    one of their tokens tells nothing. What a rule puts in stands only where that rule matched.
    """
    out: set[str] = set()
    for rule in custom:
        try:
            found = required_literals(rule["pattern"])
        except (re.error, RecursionError):
            return None
        if not found or any(_meets_token(x) for x in found):
            return None
        out.update(x.lower() for x in found)
    return sorted(out)


COMPILED_DDL = "tenant string, version int, toggles map<string,boolean>, disabled array<string>, custom_json string, literals array<string>"


def compile_rules(spark: SparkSession, rules: DataFrame) -> DataFrame:
    """Rules table ready to join: ``tenant, version, toggles, disabled, custom_json, literals``.

    Rules that do not compile, or whose replacement names a group the pattern lacks, are left
    out. ``custom_json`` lists the others in order, null where a tenant has none. Only a text with
    one of ``literals`` (see :func:`rule_literals`) needs to be run through them; null means any.
    """
    out = []
    for row in read_rules(rules):
        toggles = row.toggles or {}
        listed = [{"pattern": r.pattern, "replacement": DEFAULT_TOKEN if r.replacement is None else r.replacement}
                  for r in (row.custom or []) if r is not None]
        good = [r for r in listed if usable(r["pattern"], r["replacement"])]
        out.append((row.tenant, row.version, toggles, [k for k, v in toggles.items() if v is False],
                    json.dumps(good) if good else None, rule_literals(good)))
    return spark.createDataFrame(out, COMPILED_DDL)


def rule_problems(rules: DataFrame) -> DataFrame:
    """(tenant, rule, problem) of every rule :func:`validate_rules` would refuse."""
    found = []
    for row in read_rules(rules):
        custom = [{k: v for k, v in r.asDict().items() if v is not None} for r in (row.custom or []) if r is not None]
        try:
            validate_rules(custom)
        except InvalidRules as refused:
            found += [(row.tenant, i, code) for i, code in refused.problems]
    return rules.sparkSession.createDataFrame(found, "tenant string, rule int, problem string")


def require_rules(rules: DataFrame | None) -> DataFrame:
    """Fail closed: without a loaded rules table nothing is published."""
    if rules is None or rules.isEmpty():
        raise RulesNotReady("rules table is missing or empty; refusing to publish")
    return rules


# --- applying ----------------------------------------------------------------------------

def redact_column(df: DataFrame, column: str, disabled: Iterable[str] | None = None) -> DataFrame:
    return df.withColumn(column, R.redact_text(F.col(column), disabled))


def _native_message(m: Column, clean) -> Column:
    content = F.when(is_string(m["content"]),
                     clean(F.try_variant_get(m["content"], "$", "string")).cast("variant")).otherwise(m["content"])
    return m.withField("content", content)


def has_payload(msg: Column) -> Column:
    """Whether any message holds a block list or tool calls."""
    return F.exists(msg, lambda m: as_array(m["content"]).isNotNull() | m["tool_calls"].isNotNull())


def unsupported_content(msg: Column) -> Column:
    """Messages whose content is neither text, list nor null: kept, but worth a warning."""
    return F.size(F.filter(msg, lambda m: m["content"].isNotNull()
                           & ~F.schema_of_variant(m["content"]).rlike("^(STRING|ARRAY|VOID)")))


def _may_match(text: Column, literals: Column) -> Column:
    """Whether rules that need one of ``literals`` can match in the text; any text where they are null."""
    low = F.lower(text)
    return F.coalesce(F.exists(literals, lambda x: F.contains(low, x)), literals.isNull())


def needs_rules(msg: Column, custom: Column, literals: Column) -> Column:
    """Whether a text content of the messages may be changed by the tenant's custom rules."""
    def meets(m: Column) -> Column:
        return F.coalesce(_may_match(F.try_variant_get(m["content"], "$", "string"), literals), F.lit(False))
    return custom.isNotNull() & (literals.isNull() | F.exists(msg, meets))


def redact_messages(records: DataFrame, rules: DataFrame | None = None, tenant: str = "namespace",
                    disabled: Iterable[str] | None = None, required: bool = False) -> DataFrame:
    """Redact the ``msg`` array of stored messages and stamp ``anonymization_version``.

    ``rules`` is the output of :func:`compile_rules`. Plain text is redacted in the JVM. Rows
    with blocks or tool calls, or with a text that the tenant's custom rules may match, are a branch
    of their own that goes through Arrow once; no other row does, and a rule is only ever run by
    one regex engine. A tenant without rules gets the baseline and version 0. ``required`` refuses
    to go on without rules.
    """
    if required:
        rules = require_rules(rules)
    off = F.array(*[F.lit(d) for d in sorted(R.coerce_disabled(disabled))]).cast("array<string>")
    kept = records.columns
    deep = has_payload(F.col("msg"))
    if rules is None:
        df = records
        clean = lambda t: R.redact_text(t, disabled)
        skip, custom_json = off, F.lit(None).cast("string")
    else:
        # Plain columns, so that a branch carries only those it needs.
        dim = rules.select(F.col("tenant").alias(tenant), *[F.col(c).alias(f"_rules_{c}") for c in (
            "version", "toggles", "disabled", "custom_json", "literals")])
        df = lookup_join(records, dim, [tenant])
        toggles = F.coalesce(F.col("_rules_toggles"), F.create_map().cast("map<string,boolean>"))
        clean = lambda t: R.redact_text_toggled(t, toggles)
        skip = F.coalesce(F.array_union(F.col("_rules_disabled"), off), off)
        custom_json = F.col("_rules_custom_json")
        deep = deep | needs_rules(F.col("msg"), custom_json, F.col("_rules_literals"))
        df = df.withColumn("anonymization_version", F.coalesce(F.col("_rules_version"), F.lit(0)))
        kept = [*[c for c in kept if c != "anonymization_version"], "anonymization_version"]
    deep = F.coalesce(deep, F.lit(False))
    plain = df.where(~deep).withColumn("msg", F.transform("msg", lambda m: _native_message(m, clean)))
    walked = df.where(deep).withColumn("_json", redact_json_messages(F.to_json("msg"), skip, custom_json)).withColumn(
        "msg", F.from_json("_json", MSG_DDL))
    return plain.select(*kept).unionByName(walked.select(*kept))


def stamp_version(records: DataFrame, rules: DataFrame, tenant: str = "namespace") -> DataFrame:
    """Write the tenant's rules version on each record; 0 where the tenant has none."""
    dim = rules.select(F.col("tenant").alias(tenant), F.col("version").alias("_version"))
    joined = lookup_join(records.drop("anonymization_version"), dim, [tenant])
    return joined.withColumn("anonymization_version", F.coalesce("_version", F.lit(0))).drop("_version")


def reapply_on_drift(records: DataFrame, rules: DataFrame, tenant: str = "namespace",
                     message: str = "msg", ddl: str = MSG_DDL) -> DataFrame:
    """Apply *all* current custom rules to rows stamped with an older version.

    They go over the message JSON text, as on ingest. Rows at or ahead of the current
    version are not touched; only rows that get rules go through Arrow.
    """
    kept = records.columns
    dim = rules.select(F.col("tenant").alias(tenant), *[F.col(c).alias(f"_rules_{c}") for c in ("version", "custom_json", "literals")])
    df = lookup_join(records, dim, [tenant])
    behind = F.coalesce(F.coalesce(F.col("anonymization_version"), F.lit(0)) < F.col("_rules_version"), F.lit(False))
    stamped = F.when(behind, F.col("_rules_version")).otherwise(F.col("anonymization_version"))
    text_column = dict(records.dtypes)[message] == "string"
    text = F.col(message) if text_column else F.to_json(message)
    with_rules = behind & F.col("_rules_custom_json").isNotNull() & F.coalesce(_may_match(text, F.col("_rules_literals")), F.lit(False))
    fixed = custom_rules_text(text, F.col("_rules_custom_json"))
    changed = df.where(with_rules).withColumn("_text", fixed).withColumns({
        message: F.col("_text") if text_column else F.from_json("_text", ddl), "anonymization_version": stamped})
    others = df.where(~with_rules).withColumn("anonymization_version", stamped)
    return others.select(*kept).unionByName(changed.select(*kept))


def drifted_partitions(records: DataFrame, rules: DataFrame, tenant: str = "namespace", day: str = "dt") -> DataFrame:
    """(tenant, day) of stored partitions that hold a row stamped with an older version than the rules."""
    oldest = records.groupBy(tenant, day).agg(F.min(F.coalesce("anonymization_version", F.lit(0))).alias("_oldest"))
    dim = rules.select(F.col("tenant").alias(tenant), F.col("version").alias("_version"))
    return lookup_join(oldest, dim, [tenant], how="inner").where("_oldest < _version").select(tenant, day)


def reapply_stored(spark: SparkSession, path: str, rules: DataFrame, tenant: str = "namespace", day: str = "dt",
                   message: str = "msg", ddl: str = MSG_DDL) -> DataFrame:
    """Bring a stored table, partitioned by tenant and day, up to its rules; returns the partitions rewritten.

    Only partitions that hold older versions are read and replaced; the files of all others stay as
    they are. The new content is complete in the shared folder before the first partition is
    replaced, and a run that dies in between is simply repeated: what is done is not found again.
    """
    records = spark.read.parquet(path)
    stale = landed(spark, drifted_partitions(records, rules, tenant, day), "drifted")
    # Few and narrow, so as a rule broadcast, which also prunes the partitions that are scanned.
    touched = lookup_join(records, stale.withColumn("_stale", F.lit(True)), [tenant, day], how="inner").drop("_stale")
    fixed = landed(spark, reapply_on_drift(touched.select(records.columns), rules, tenant, message, ddl), "reapplied")
    (fixed.hint("rebalance", tenant, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(tenant, day).parquet(path))
    return stale


def pii_audit(df: DataFrame, column: str, by: Sequence[str] = ("namespace",),
              classes: Sequence[str] | None = None) -> DataFrame:
    """Hits per class and group that are still in the text; all zero after redaction."""
    names = tuple(classes or R.class_names())
    guarded = df.select(*by, F.when(F.col(column).rlike(R.CANDIDATE), F.col(column)).alias("_text"))
    counted = guarded.select(*by, *[F.coalesce(R.count_class(F.col("_text"), n), F.lit(0)).alias(f"_n{i}")
                                    for i, n in enumerate(names)])
    sums = counted.groupBy(*by).agg(*[x for i in range(len(names)) for x in (
        F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_hits{i}"), F.count_if(F.col(f"_n{i}") > 0).alias(f"_rows{i}"))])
    per_class = F.array(*[F.struct(F.lit(n).alias("pii_class"), F.col(f"_hits{i}").alias("hits"),
                                   F.col(f"_rows{i}").alias("rows_hit")) for i, n in enumerate(names)])
    return sums.select(*by, F.inline(per_class))
