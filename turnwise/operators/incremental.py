"""Loading only the turns a session has gained since the last load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnwise.operators.scan import blocked_scan, line_block, lookup_join
from turnwise.session import landed

OFFSETS_DDL = "session_id string, turns bigint"


def mark_new_turns(turns: DataFrame, offsets: DataFrame, only_closed: bool = False) -> DataFrame:
    """Add ``is_new`` to turns: beyond what the session had loaded before.

    Offsets count the session's loaded turns, so ``turn_no`` must be 1, 2, 3... per session
    (see :func:`renumber`). With ``only_closed`` the last turn of each session is held back
    until another follows, since more replies may still be written to it.
    """
    marked = lookup_join(turns, offsets.withColumnRenamed("turns", "_loaded"), ["session_id"])
    is_new = F.col("turn_no") > F.coalesce("_loaded", F.lit(0))
    if only_closed:
        # Aggregated, not a window: one row per session whatever its number of turns.
        last = turns.groupBy("session_id").agg(F.max("turn_no").alias("_last_turn"))
        marked = marked.join(last, "session_id", "left")
        is_new = is_new & (F.col("turn_no") < F.col("_last_turn"))
    return marked.withColumn("is_new", is_new).drop("_loaded", "_last_turn")


def renumber(turns: DataFrame) -> DataFrame:
    """Number the kept turns of a session 1, 2, 3...; grouping leaves gaps where a turn was dropped."""
    numbered = blocked_scan(turns, ["session_id"], line_block(F.col("turn_no")), ["turn_no"],
                            sums={"_n": F.lit(1)})
    return numbered.withColumn("turn_no", F.col("_n")).drop("_n")


def incremental_report(marked: DataFrame) -> DataFrame:
    """New and skipped turns per session."""
    return marked.groupBy("session_id").agg(
        F.count_if("is_new").alias("new_turns"), F.count_if(~F.col("is_new")).alias("skipped"))


def next_offsets(marked: DataFrame, offsets: DataFrame) -> DataFrame:
    """Offsets after the marked turns were written; never smaller than before.

    Commit these only after the turns themselves are stored: a failed write is then simply
    loaded again.
    """
    seen = marked.where("is_new").groupBy("session_id").agg(F.max("turn_no").alias("turns"))
    return offsets.select("session_id", "turns").unionByName(seen).groupBy("session_id").agg(
        F.max("turns").alias("turns"))


def load_incremental(spark: SparkSession, turns: DataFrame, offsets_path: str, write, only_closed: bool = False) -> dict:
    """Write the new turns with ``write(df)``, then append the sessions' new offsets.

    The offsets table is append-only and read as the maximum per session, so a run that
    dies between the two writes is simply repeated.
    """
    marked = landed(spark, mark_new_turns(turns, read_offsets(spark, offsets_path), only_closed), "marked-turns")
    counts = marked.agg(F.count_if("is_new").alias("n"), F.count_if(~F.col("is_new")).alias("s")).first()
    if counts.n:
        fresh = marked.where("is_new").drop("is_new")
        write(fresh)
        fresh.groupBy("session_id").agg(F.max("turn_no").alias("turns")).write.mode("append").parquet(offsets_path)
    return {"total_inserted": counts.n, "skipped": counts.s}


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Turns loaded so far per session; empty where nothing was loaded yet."""
    try:
        log = spark.read.schema(OFFSETS_DDL).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], OFFSETS_DDL)
    return log.groupBy("session_id").agg(F.max("turns").alias("turns"))
