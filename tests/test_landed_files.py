"""Many short transcripts as files: landed by many tasks, listed by few."""

import __spark_entry__ as entry
from test_transcripts import TEXT, reply, user, write

from turnwise.operators.turns import group_turns
from turnwise.plans import streams
from turnwise.session import LISTING_TASKS_PER_CORE
from turnwise.sources.transcripts import parse_claude_lines
from turnwise.streaming import jobs


def tasks_of(spark, group):
    """The tasks of each stage of a job group."""
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return [info.numTasks for info in map(tracker.getStageInfo, stages) if info is not None]


def test_landing_is_spread_however_few_the_bytes(spark, tmp_path):
    rows = [(f"/p{i % 2}/s{i}.jsonl", k, None if k == 1 else f"{i}-{k}") for i in range(40) for k in (2, 1, 0)]
    spark.sparkContext.setJobGroup("land", "land")
    try:
        streams._land_files(spark, spark.createDataFrame(rows, "path string, line bigint, value string"), str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {str(p.relative_to(tmp_path)): p.read_text() for p in tmp_path.rglob("*") if p.is_file()} == {
        f"p{i % 2}/s{i}.jsonl": f"{i}-0\n\n{i}-2\n" for i in range(40)}
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == tasks_of(spark, "land")[-1]


def test_a_stream_lists_short_files_by_few_tasks(spark, tmp_path):
    for i in range(100):
        write(tmp_path / "in" / "p" / f"s{i}.jsonl", user("q"), reply(TEXT))
    seen = []
    query = jobs.stream_incremental(spark, str(tmp_path / "in"), lambda raw: group_turns(parse_claude_lines(raw), "claude"),
                                    lambda df, _: seen.extend(r.session_id for r in df.collect()), str(tmp_path / "c"))
    query.awaitTermination()
    assert sorted(seen) == sorted(f"s{i}" for i in range(100))
    tasks = tasks_of(spark, str(query.runId))
    assert tasks and max(tasks) <= LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_incremental_turns_with_nulls(spark, tmp_path):
    said = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", None), (0, 3, "assistant", None), (1, 0, "user", "x"),
            (2, 0, None, "s"), (2, 1, "user", "q"), (2, 2, "assistant", "r"), (None, 0, "user", "n"), (None, 1, "assistant", "n")]
    spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.session_id: r.turns for r in entry.queries()["r4_stream_incremental"](spark, str(tmp_path)).collect()}
    assert got == {"conv-0": 2, "conv-2": 1}
