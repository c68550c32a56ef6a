"""Completion-usage exports and program logs -> log entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from turnwise.functions import content as C, tokens as T

_CSV_ALIASES = {
    "date": ("date", "day"), "user": ("user", "login"), "editor": ("editor", "ide"), "language": ("language",),
    "suggestions_shown": ("suggestions_shown", "shown"), "suggestions_accepted": ("suggestions_accepted", "accepted"),
    "lines_suggested": ("lines_suggested",), "lines_accepted": ("lines_accepted",),
}
_CSV_DEFAULTS = {"user": "unknown", "editor": "unknown"}
_COUNTS = ("suggestions_shown", "suggestions_accepted", "lines_suggested", "lines_accepted")


def resolve_usage_columns(df: DataFrame) -> DataFrame:
    """Give the columns of a usage export their usual names; absent ones get defaults."""
    def pick(name: str) -> Column:
        for alias in _CSV_ALIASES[name]:
            if alias in df.columns:
                return F.coalesce(F.col(alias).cast("string"), F.lit(""))
        return F.lit(_CSV_DEFAULTS.get(name, ""))
    return df.select(*[pick(n).alias(n) for n in _CSV_ALIASES])


def usage_to_logs(rows: DataFrame, namespace: str = "copilot") -> tuple[DataFrame, DataFrame]:
    """Per user and day usage rows -> log entries, and the rows whose counts are not whole numbers."""
    numbers = {n: F.when(F.trim(F.col(n)) == "", F.lit(0)).otherwise(F.expr(f"try_cast(trim({n}) AS BIGINT)")) for n in _COUNTS}
    typed = rows.withColumns({f"_{n}": c for n, c in numbers.items()})
    bad = F.lit(False)
    for n in _COUNTS:
        bad = bad | F.col(f"_{n}").isNull()
    rejects = typed.where(bad).select(*rows.columns)
    good = typed.where(~bad).select("date", "user", "editor", "language", *[F.col(f"_{n}").alias(n) for n in _COUNTS])
    good = good.withColumn("acceptance_rate", T.acceptance_rate(F.col("suggestions_accepted"), F.col("suggestions_shown")))
    logs = good.select(
        F.lit(namespace).alias("namespace"), F.lit("info").alias("level"),
        F.concat(F.lit("Copilot usage: "), "user", F.lit(" ("), "editor", F.lit(") - "),
                 T.number_text(F.col("acceptance_rate")), F.lit("% acceptance")).alias("message"),
        F.col("date").alias("timestamp"),
        F.concat_ws("-", F.lit("copilot"), "user", "date").alias("resource_id"),
        F.struct(F.lit("copilot").alias("source"), "user", "editor", "language", *_COUNTS,
                 "acceptance_rate").alias("custom_object"))
    return logs, rejects


def read_copilot_csv(spark: SparkSession, path, namespace: str = "copilot") -> tuple[DataFrame, DataFrame]:
    """Usage CSV -> (logs, rejects). A row with a count that is no whole number is set aside."""
    raw = spark.read.option("header", True).option("multiLine", False).csv(path)
    return usage_to_logs(resolve_usage_columns(raw), namespace)


def parse_org_usage(raw: DataFrame, org: str, namespace: str = "copilot") -> DataFrame:
    """Organisation day metrics (``value`` = saved JSON payload or one day) -> log entries."""
    v = F.try_parse_json("value")
    days = F.coalesce(C.as_array(F.col("_v")), C.as_array(F.try_variant_get("_v", "$.usage", "variant")),
                      F.when(F.try_variant_get("_v", "$.usage", "variant").isNull(), F.array(F.col("_v"))))
    def num(name: str) -> Column:
        return F.coalesce(F.try_variant_get("_d", f"$.{name}", "bigint"), F.lit(0))
    rows = (raw.select(v.alias("_v")).where(F.col("_v").isNotNull()).select(F.explode(days).alias("_d"))
            .select(F.coalesce(C.get_text(F.col("_d"), "$.day"), C.get_text(F.col("_d"), "$.date"), F.lit("")).alias("date"),
                    num("total_suggestions_count").alias("total_suggestions"),
                    num("total_acceptances_count").alias("total_acceptances"),
                    num("total_lines_suggested").alias("total_lines_suggested"),
                    num("total_lines_accepted").alias("total_lines_accepted"),
                    num("total_active_users").alias("total_active_users"),
                    F.to_json(F.try_variant_get("_d", "$.breakdown", "variant")).alias("breakdown")))
    rows = rows.withColumn("acceptance_rate", T.acceptance_rate(F.col("total_acceptances"), F.col("total_suggestions")))
    return rows.select(
        F.lit(namespace).alias("namespace"), F.lit("info").alias("level"),
        F.concat(F.lit(f"Copilot org usage ({org}): "), F.col("total_active_users").cast("string"), F.lit(" users, "),
                 T.number_text(F.col("acceptance_rate")), F.lit("% acceptance")).alias("message"),
        F.col("date").alias("timestamp"),
        F.concat_ws("-", F.lit("copilot-org"), F.lit(org), "date").alias("resource_id"),
        F.struct(F.lit("copilot").alias("source"), F.lit(org).alias("org"), "total_suggestions", "total_acceptances",
                 "total_lines_suggested", "total_lines_accepted", "total_active_users", "acceptance_rate",
                 F.coalesce("breakdown", F.lit("[]")).alias("breakdown")).alias("custom_object"))


def read_copilot_org_usage(spark: SparkSession, path, org: str, namespace: str = "copilot") -> DataFrame:
    return parse_org_usage(spark.read.option("wholetext", True).text(path), org, namespace)


def structured_logs_to_entries(df: DataFrame, namespace: str, include_metadata: bool = True) -> DataFrame:
    """Program log records (``name, levelno, message, module, func, lineno, thread,
    thread_name, created, exception, extra``) -> log entries.

    ``created`` is seconds since the epoch, ``extra`` a JSON object of further attributes,
    which win over the standard ones where names meet.
    """
    standard = F.struct(F.col("name").alias("logger"), "module", F.col("func").alias("function"),
                        F.col("lineno").alias("line"), "thread", "thread_name", "exception")
    body = F.to_json(standard)
    extra = F.trim(F.coalesce("extra", F.lit("{}")))
    has_extra = extra.rlike(r"^\{\s*[^}\s]")
    merged = F.when(has_extra, F.map_concat(
        F.map_filter(F.from_json(body, "map<string,variant>"),
                     lambda k, v: ~F.array_contains(F.coalesce(F.map_keys(F.from_json(extra, "map<string,variant>")),
                                                               F.array().cast("array<string>")), k)),
        F.from_json(extra, "map<string,variant>"))).otherwise(F.from_json(body, "map<string,variant>"))
    return df.select(
        F.lit(namespace).alias("namespace"), T.log_level(F.col("levelno")).alias("level"), "message",
        F.timestamp_micros((F.col("created") * 1_000_000).cast("bigint")).alias("timestamp"),
        F.lit(None).cast("string").alias("resource_id"),
        (F.to_variant_object(merged) if include_metadata else F.lit(None).cast("variant")).alias("custom_object"))
