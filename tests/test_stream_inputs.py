"""A given table as a stream: one file, or a folder of files."""

import datetime as dt

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

TEXTS = ["mail the@a.example.com", None, "", "the server 10.0.0.1", "plain"]


@pytest.fixture(params=["file", "folder"])
def tables(spark, tmp_path, request):
    rows = [(i, TEXTS[i % 5], "en", "web", dt.datetime(2024, 1, 1)) for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, ts timestamp").repartition(3).write.parquet(f"{tmp_path}/parts")
    if request.param == "folder":
        (tmp_path / "parts").rename(tmp_path / "documents.parquet")
    else:
        spark.read.parquet(f"{tmp_path}/parts").coalesce(1).write.parquet(f"{tmp_path}/one")
        next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    # A neighbour whose name begins alike is another table.
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, ts timestamp").write.parquet(f"{tmp_path}/documents.parquet2")
    return str(tmp_path)


def test_a_table_streams_whole_as_file_and_as_folder(spark, tables):
    from turnwise.plans.streams import _source
    (_source(spark, tables, "documents").select("doc_id").writeStream.format("parquet").option("path", f"{tables}/out")
     .option("checkpointLocation", f"{tables}/state").trigger(availableNow=True).start().awaitTermination())
    assert sorted(r[0] for r in spark.read.parquet(f"{tables}/out").collect()) == list(range(20))


@pytest.mark.parametrize("name", ["r5_stream_redact", "r5_stream_redact_nophone"])
def test_redacted_streams_hold_every_document(spark, tables, name):
    got = {r.doc_id: r.redacted for r in entry.queries()[name](spark, tables).collect()}
    want = ["mail [EMAIL]", None, "", "<the> server [IP]", "plain"]
    expected = spark.createDataFrame([(i, want[i % 5]) for i in range(20)], "doc_id bigint, text string").select("doc_id", F.md5("text").alias("md5"))
    assert got == {r.doc_id: r.md5 for r in expected.collect()}
