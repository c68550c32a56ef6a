"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but
the last return the columns of ``documents``; each result is written as Parquet below the
shared folder and read again as the next stage's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnwise.llm import decontaminate, language, lines, near, packing
from turnwise.llm.text import keep_where
from turnwise.session import landed, prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models do not reject."""
    prepare(spark)
    return keep_where(docs, language.identify, "not rejected", ("doc_id", "text", "lang"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in three or more documents, but for the largest id.

    ``n_chars`` follows the text. A document that loses all its lines has nothing left and goes;
    one that was empty before stays as it was.
    """
    prepare(spark)
    # Columns but these go by other names meanwhile, so none can clash with the added ones.
    names = [c if c in ("doc_id", "text", "n_chars") else f"_c{i}" for i, c in enumerate(docs.columns)]
    done = lines.dedup_lines(docs.toDF(*names)).where("n_dropped = 0 OR n_dropped < n_lines")
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")),
           "n_chars": F.when(changed, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))}
    return done.select(*[new[c].alias(c) if c in new else F.col(c) for c in names]).toDF(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id."""
    prepare(spark)
    return near.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark phrases."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in sequences, with their token ids."""
    prepare(spark)
    pieces = packing.pack(docs, TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", keep_known_language),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Models and tokenizers decide here; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is landed before the next begins."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
