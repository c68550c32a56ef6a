"""Conversation records and logs from JSON, with per-row validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnwise.functions import content as C, tokens as T
from turnwise.schemas import MSG_DDL, TRANSFERS_DDL

_RECORD_TEXT = ("session_id", "inserted_at", "user_id", "user_whatsapp", "wam_id", "replied_whatsapp",
                "external_user_id", "external_user_name", "external_user_channel", "source", "model")
_RECORD_COUNTS = (*T.TOKEN_FIELDS, "total_tokens")
# Every field is read as VARIANT, so a value of the wrong type is seen and rejected
# instead of silently turned into text.
_RECORD_FIELDS = ("namespace", "agent", "msg", "transfers", "attachments", *_RECORD_TEXT, *_RECORD_COUNTS)
_LOG_FIELDS = ("namespace", "level", "message", "timestamp", "resource_id", "custom_object")


class BadStructure(ValueError):
    """A file holds neither the expected envelope nor an array."""


def _ddl(fields: Iterable[str]) -> str:
    return ", ".join(f"`{f}` variant" for f in fields)


def _read(spark: SparkSession, path, envelope: str, fields: tuple[str, ...], lines: bool) -> DataFrame:
    schema = f"{envelope} array<struct<{', '.join(f'`{f}`:variant' for f in fields)}>>, {_ddl(fields)}"
    raw = spark.read.schema(schema).option("multiLine", not lines).json(path)
    single = F.array(F.struct(*[F.col(f) for f in fields]))
    return raw.select(F.explode(F.coalesce(F.col(envelope), single)).alias("_r")).select("_r.*")


def _type(v: Column) -> Column:
    return F.schema_of_variant(v)


def present(v: Column) -> Column:
    return v.isNotNull() & (_type(v) != "VOID")


def _object(v: Column) -> Column:
    return F.coalesce(_type(v).startswith("OBJECT"), F.lit(False))


def _valid_message(m: Column) -> Column:
    body = F.try_variant_get(m, "$.content", "variant")
    ok_body = ~F.coalesce(present(body), F.lit(False)) | C.is_string(body) | _object(body) | F.coalesce(
        F.forall(C.as_array(body), _object), F.lit(False))
    return _object(m) & C.is_string(F.try_variant_get(m, "$.role", "variant")) & ok_body


def _named(names: Iterable[str]) -> Column:
    """Fields as an array of (name, value), so one lambda checks them all."""
    return F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("v")) for n in names])


def _codes(prefix: str, names: Iterable[str], bad) -> Column:
    """``prefix + name`` of every named field for which ``bad(value)`` holds."""
    found = F.filter(_named(names), lambda x: F.coalesce(bad(x["v"]), F.lit(False)))
    return F.transform(found, lambda x: F.concat(F.lit(prefix), x["name"]))


def _missing(v: Column) -> Column:
    return ~F.coalesce(present(v), F.lit(False))


def _not_text(v: Column) -> Column:
    return present(v) & ~C.is_string(v)


def _bad_message(v: Column) -> Column:
    listed = F.coalesce(F.forall(C.as_array(v), _valid_message), F.lit(False))
    return present(v) & ~(_object(v) | listed)


def record_errors() -> Column:
    """Codes of what is wrong with a raw record; an empty array means valid."""
    return F.concat(
        _codes("missing_", ("namespace", "agent", "msg"), _missing),
        _codes("bad_", ("msg",), _bad_message),
        _codes("bad_", ("namespace", "agent", *_RECORD_TEXT), _not_text),
        _codes("bad_", _RECORD_COUNTS, lambda v: present(v) & F.try_variant_get(v, "$", "bigint").isNull()))


def log_errors() -> Column:
    return F.concat(
        _codes("missing_", ("namespace", "level", "message"), _missing),
        _codes("bad_", ("namespace", "level", "message", "timestamp", "resource_id"), _not_text),
        _codes("bad_", ("custom_object",), lambda v: present(v) & ~_object(v)))


def _split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def validate_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their ``reasons``; no row is lost."""
    return _split(raw.withColumn("reasons", C.once(record_errors())))


def validate_logs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split(raw.withColumn("reasons", C.once(log_errors())))


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows"))


def validate_structure(spark: SparkSession, path, kind: str = "records") -> DataFrame:
    """Per file: does it hold the envelope, or a non-empty array whose first item looks right.

    Reads each file whole, as a check of an envelope must.
    """
    probe = {"records": "agent", "logs": "level"}[kind]
    v = F.try_parse_json("value")
    items = C.as_array(F.col("_v"))
    has = F.try_variant_get(F.col("_v"), f"$.{kind}", "variant").isNotNull()
    first = F.try_element_at(items, F.lit(1))
    ok = F.when(items.isNotNull(), F.coalesce(
        F.try_variant_get(first, f"$.{probe}", "variant").isNotNull(), F.lit(False))).otherwise(F.coalesce(has, F.lit(False)))
    return (spark.read.option("wholetext", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), v.alias("_v"))
            .select("file", ok.alias("valid")))


def _require_structure(spark: SparkSession, path, kind: str) -> None:
    v = F.try_parse_json("value")
    bad = (spark.read.option("wholetext", True).text(path).where(
        C.as_array(v).isNull() & F.try_variant_get(v, f"$.{kind}", "variant").isNull()))
    if not bad.isEmpty():
        raise BadStructure(f"expected a list of {kind}, or an object that holds one under '{kind}'")


def _text(name: str) -> Column:
    return F.try_variant_get(F.col(name), "$", "string").alias(name)


def stored_message(m: Column) -> Column:
    """Raw message variant -> stored message struct."""
    def sub(path: str) -> Column:
        v = F.try_variant_get(m, path, "variant")
        return F.when(present(v), v)
    return F.struct(
        C.get_text(m, "$.role").alias("role"), sub("$.content").alias("content"),
        C.get_text(m, "$.sender").alias("sender"), sub("$.tool_calls").alias("tool_calls"),
        C.get_text(m, "$.tool_call_id").alias("tool_call_id"), C.get_text(m, "$.tool_name").alias("tool_name"),
        F.coalesce(F.try_variant_get(m, "$.is_internal_tool", "boolean"), F.lit(False)).alias("is_internal_tool"),
        C.get_text(m, "$.internal_tool_type").alias("internal_tool_type"),
        C.get_text(m, "$.refusal").alias("refusal"), sub("$.annotations").alias("annotations"),
        sub("$.audio").alias("audio"), sub("$.function_call").alias("function_call"))


def parse_records(raw: DataFrame) -> DataFrame:
    """Raw VARIANT fields -> typed record columns (call on valid rows)."""
    transfers = F.transform(C.as_array(F.col("transfers")), lambda t: F.struct(
        F.coalesce(C.get_text(t, "$.from"), C.get_text(t, "$.from_agent")).alias("from_agent"),
        F.coalesce(C.get_text(t, "$.to"), C.get_text(t, "$.to_agent")).alias("to_agent"),
        C.get_text(t, "$.reason").alias("reason"), C.get_text(t, "$.timestamp").alias("timestamp")))
    counts = [F.try_variant_get(F.col(n), "$", "bigint").alias(n) for n in _RECORD_COUNTS]
    texts = [T.parse_iso(_text(n)).alias(n) if n == "inserted_at" else _text(n) for n in _RECORD_TEXT]
    shaped = raw.select(
        _text("namespace"), _text("agent"),
        F.transform(C.normalize_messages(F.col("msg")), stored_message).cast(MSG_DDL).alias("msg"),
        transfers.cast(TRANSFERS_DDL).alias("transfers"), *counts, *texts)
    return shaped.withColumn("total_tokens", T.total_tokens(
        F.col("total_tokens"), *[F.col(n) for n in T.TOKEN_FIELDS]))


def read_records_json(spark: SparkSession, path, lines: bool = False, check: bool = False) -> DataFrame:
    """Valid records of JSON files: ``{"records": [...]}``, a bare array, or JSON lines.

    A single JSON document cannot be split, so large loads should use ``lines=True``.
    ``check`` raises :class:`BadStructure` for a file of any other shape.
    """
    if check and not lines:
        _require_structure(spark, path, "records")
    valid, _ = validate_records(_read(spark, path, "records", _RECORD_FIELDS, lines))
    return parse_records(valid)


def raw_records_json(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """Raw record fields, for :func:`validate_records`."""
    return _read(spark, path, "records", _RECORD_FIELDS, lines)


def raw_records(df: DataFrame, column: str = "value") -> DataFrame:
    """Raw record fields of a column of JSON texts, one record each."""
    return df.select(C.once(F.try_parse_json(F.col(column))).alias("_v")).select(
        *[F.try_variant_get("_v", f"$.{f}", "variant").alias(f) for f in _RECORD_FIELDS])


def raw_logs(df: DataFrame, column: str = "value") -> DataFrame:
    return df.select(C.once(F.try_parse_json(F.col(column))).alias("_v")).select(
        *[F.try_variant_get("_v", f"$.{f}", "variant").alias(f) for f in _LOG_FIELDS])


def default_namespace(raw: DataFrame, namespace: str) -> DataFrame:
    """Fill a missing or empty namespace."""
    given = F.try_variant_get("namespace", "$", "string")
    return raw.withColumn("namespace", F.when(
        F.coalesce(given, F.lit("")) == "", F.lit(namespace).cast("variant")).otherwise(F.col("namespace")))


def parse_logs(raw: DataFrame) -> DataFrame:
    return raw.select(_text("namespace"), _text("level"), _text("message"),
                      T.parse_iso(_text("timestamp")).alias("timestamp"), _text("resource_id"),
                      F.when(present(F.col("custom_object")), F.col("custom_object")).alias("custom_object"))


def read_logs_json(spark: SparkSession, path, namespace: str, lines: bool = False, strict: bool = False,
                   check: bool = False) -> DataFrame:
    """Valid log entries; the server's ``id`` is dropped, a missing namespace is filled.

    ``strict`` rejects an entry without the namespace field instead, and fills empty ones.
    """
    if check and not lines:
        _require_structure(spark, path, "logs")
    raw = _read(spark, path, "logs", _LOG_FIELDS, lines)
    if not strict:
        raw = default_namespace(raw, namespace)
    valid, _ = validate_logs(raw)
    return parse_logs(default_namespace(valid, namespace))
