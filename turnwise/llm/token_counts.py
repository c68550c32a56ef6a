"""Token counts of flat token files by a separator scan.

A flat token file is nothing but token ids, one document after another, each closed by an
end-of-document id; there is no index. It travels as blocks of a fixed number of ids, cut
wherever the count falls. Each block is searched for the end id at once; only the ends found go
on. A prefix scan over a file's block summaries then gives every block the position it starts
at and the last end before it, which stitches the documents that reach over block edges. What is
ordered per file is one row of numbers per block; the ends found in a block stay where they are
and meet the block's position in a merge join on (file, block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from turnwise.llm.packing import encoder
from turnwise.llm.text import release_memory, text_pieces
from turnwise.session import landed

BLOCK_IDS = 1 << 20

FLAT_DDL = "file bigint, block bigint, ids binary, ordinal bigint, names array<bigint>"


def write_flat(docs: DataFrame, tokenizer_path: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Flat token files of (doc_id, text), one per task: blocks of ``ids`` (16-bit, little-endian).

    Rows without ``ids`` name the documents in order, so that counts can be given back to them;
    the scan does not read these. ``end_id`` must not be an id of the tokenizer.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, file = encoder(tokenizer_path), TaskContext.get().partitionId()
        waiting, size, block, ordinal = [], 0, 0, 0

        def batch(blocks: list, names: list) -> pa.RecordBatch:
            nonlocal block, ordinal
            table = [(file, block + i, b, None, None) for i, b in enumerate(blocks)]
            if names:
                table.append((file, None, None, ordinal, names))
            block, ordinal = block + len(blocks), ordinal + len(names)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
            columns = list(zip(*table)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=[p.split()[0] for p in FLAT_DDL.split(", ")])

        for part in batches:
            for piece, raw, offsets in text_pieces(part):
                waiting.append(coder.encode(raw, offsets, end_id)[0].astype("<u2"))
                size += len(waiting[-1])
                blocks = []
                if size >= block_ids:
                    flat = np.concatenate(waiting)
                    full = len(flat) // block_ids * block_ids
                    blocks = [flat[i: i + block_ids].tobytes() for i in range(0, full, block_ids)]
                    waiting, size = [flat[full:]], len(flat) - full
                yield batch(blocks, piece.column(0).to_pylist())
        if size:
            yield batch([np.concatenate(waiting).tobytes()], [])
        release_memory()

    return rows.mapInArrow(run, FLAT_DDL)


def scan_blocks(blocks: DataFrame, end_id: int) -> DataFrame:
    """(file, block, size, n_ends, tail, ends): where the end id is in each block of (file, block, ids).

    ``tail`` is the last such place, null if there is none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), dtype="<u2") for x in batch.column(2)]
            ends = [np.flatnonzero(ids == end_id) for ids in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(ids) for ids in found], pa.int64()),
                 pa.array([len(e) for e in ends], pa.int64()), pa.array([int(e[-1]) if len(e) else None for e in ends], pa.int64()),
                 pa.array(ends, pa.list_(pa.int64()))], names=["file", "block", "size", "n_ends", "tail", "ends"])

    return blocks.select("file", "block", "ids").mapInArrow(
        run, "file bigint, block bigint, size bigint, n_ends bigint, tail bigint, ends array<bigint>")


def count_tokens(blocks: DataFrame, end_id: int) -> DataFrame:
    """(file, ordinal, n_tokens, complete) of every document of flat token files.

    ``blocks`` has (file, block, ids), blocks numbered in order within a file, no number twice,
    gaps allowed; a missing file or block number is an error of the input and its ids are not counted.
    The end id is not counted; two ends in a row are a document of 0 tokens. Ids after a
    file's last end are one more document, not ``complete``. A file without ids has none.
    """
    numbered = blocks.where("file IS NOT NULL AND block IS NOT NULL AND ids IS NOT NULL")
    found = landed(blocks.sparkSession, scan_blocks(numbered, end_id), "token-ends")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.select("file", "block", "size", "n_ends", "tail").withColumns({
        "at": F.coalesce(F.sum("size").over(earlier), F.lit(0)), "first": F.coalesce(F.sum("n_ends").over(earlier), F.lit(0))})
    placed = placed.withColumn("last", F.col("at") + F.col("tail"))
    placed = placed.withColumn("before", F.coalesce(F.max("last").over(earlier), F.lit(-1)))
    start = F.when(F.col("i") > 0, F.col("at") + F.col("ends")[F.col("i") - 1]).otherwise(F.col("before"))
    whole = found.where("n_ends > 0").select("file", "block", "ends").join(
        placed.where("n_ends > 0").select("file", "block", "first", "at", "before").hint("merge"), ["file", "block"])
    whole = whole.select("file", "first", "at", "before", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"), (F.col("at") + F.col("end") - start - 1).alias("n_tokens"),
        F.lit(True).alias("complete"))
    files = placed.groupBy("file").agg(F.sum("size").alias("size"), F.sum("n_ends").alias("ordinal"),
                                       F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
    rest = files.where("size > last + 1").select("file", "ordinal", (F.col("size") - F.col("last") - 1).alias("n_tokens"),
                                                 F.lit(False).alias("complete"))
    return whole.unionByName(rest)


def count_documents(docs: DataFrame, tokenizer_path: str, end_id: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_id, n_tokens) per row of (doc_id, text): flat files are written, scanned, and named again.

    A null or empty text has 0 tokens. Repeated rows and rows without an id are counted each
    for itself; other columns are ignored; an empty table gives no rows.
    """
    flat = landed(docs.sparkSession, write_flat(docs, tokenizer_path, end_id, block_ids), "token-files")
    counts = count_tokens(flat.where("ids IS NOT NULL"), end_id)
    names = flat.where("names IS NOT NULL").select("file", "ordinal", F.posexplode("names").alias("i", "doc_id")).select(
        "file", (F.col("ordinal") + F.col("i")).alias("ordinal"), "doc_id")
    return names.join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
