"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows lie in cells (partitions as first written) of known sizes; the shards are cut into blocks of
known sizes. How many rows go from each cell to each block is drawn exactly, from the
multivariate hypergeometric law that a uniform permutation of all rows follows. A cell then
deals its rows in random order to these counts, the rows are exchanged by block, and each
block orders its rows at random again. Sizes are exact by construction, so a row's slot is its
block's first slot plus its place in the block, and no task ever holds more than a block.

The matrix is never built: its rows follow from halving the list of cells again and again.
A cell draws along its own path through that tree, with seeds that belong to the tree's nodes,
so all cells agree without talking, and a task that runs again draws the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from turnwise.session import landed

SHARDS = 40
BLOCK_ROWS = 100_000
SEED = 20240607
# The library's sampler is exact below this population.
SMALL_POPULATION = 10**9
_IN_CELL = 33  # bits that monotonically_increasing_id leaves to the row within its partition


def _hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many good ones are among ``draws`` from ``good + bad``, for any population.

    Above the library's limit by inversion: the probabilities around the mode follow from their
    ratios, and what lies beyond twelve standard deviations is below the resolution of a double.
    """
    total = good + bad
    if total < SMALL_POPULATION:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = np.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1)))
    low, high = max(low, mode - int(12 * spread) - 20), min(high, mode + int(12 * spread) + 20)
    k = np.arange(low, high, dtype=np.float64)
    logs = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    log_p = np.concatenate([[0.0], np.cumsum(logs)])
    p = np.exp(log_p - log_p.max())
    return low + int(np.searchsorted(np.cumsum(p), rng.random() * p.sum()))


def split_counts(counts: np.ndarray, draws: int, rng: np.random.Generator) -> np.ndarray:
    """A multivariate hypergeometric draw: ``draws`` rows out of groups of the sizes ``counts``."""
    total = int(counts.sum())
    if total < SMALL_POPULATION:
        return rng.multivariate_hypergeometric(counts, draws, method="marginals")
    if len(counts) == 1:
        return np.array([draws], dtype=counts.dtype)
    # Halves of the groups, until a half is small enough for the library's sampler.
    half = len(counts) // 2
    good = int(counts[:half].sum())
    first = _hypergeometric(good, total - good, draws, rng)
    return np.concatenate([split_counts(counts[:half], first, rng), split_counts(counts[half:], draws - first, rng)])


def matrix_row(cells: np.ndarray, blocks: np.ndarray, cell: int, seed: int = SEED) -> np.ndarray:
    """How many rows ``cell`` sends to each block; over all cells these add up to ``blocks``."""
    low, high, left = 0, len(cells), blocks.astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(cells)])
    while high - low > 1:
        middle = (low + high) // 2
        first = split_counts(left, int(upto[middle] - upto[low]), np.random.default_rng([seed, low, high]))
        if cell < middle:
            high, left = middle, first
        else:
            low, left = middle, left - first
    return left


def block_sizes(rows: int, shards: int, block_rows: int = BLOCK_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block sizes with the shard and first slot of each; shard sizes are at most one row apart."""
    sizes, owner, first = [], [], []
    for shard in range(shards):
        size = rows // shards + (shard < rows % shards)
        parts = max(1, -(-size // block_rows))
        cut = [size * i // parts for i in range(parts + 1)]
        sizes += [b - a for a, b in zip(cut, cut[1:])]
        owner += [shard] * parts
        first += cut[:-1]
    return np.array(sizes, dtype=np.int64), np.array(owner), np.array(first, dtype=np.int64)


def shuffle_to_shards(rows: DataFrame, shards: int = SHARDS, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards-1) and ``slot`` (0 onwards in each shard) added.

    Every order of all rows over all shards and slots is equally likely over seeds. The rows are
    written once with the cell and the place in it that they are dealt by, so whatever splits a
    later job reads them in, the counts hold. Values do not matter: nulls and repeated rows are
    dealt like any other; with fewer rows than shards the last shards are empty; an empty table
    gives no rows. Columns of the added names are replaced.
    """
    keep = [f for f in rows.schema.fields if f.name not in ("shard", "slot")]
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(keep)]
                       + [StructField(n, LongType()) for n in ("cell", "place", "block", "owner", "first")])
    named = rows.select(*[f.name for f in keep]).toDF(*inner.fieldNames()[:-5]).withColumn("_at", F.monotonically_increasing_id())
    named = landed(rows.sparkSession, named.withColumns({
        "cell": F.shiftright("_at", _IN_CELL), "place": F.col("_at").bitwiseAND(F.lit((1 << _IN_CELL) - 1))}).drop("_at"), "shard-cells")
    counted = dict(named.groupBy("cell").count().collect())
    cells = np.array([counted.get(i, 0) for i in range(max(counted, default=-1) + 1)], dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, owner, first = block_sizes(int(cells.sum()), shards, block_rows)
        now, dealt = None, np.zeros(0, dtype=np.int32)
        for batch in batches:
            cell, place = batch.column("cell").to_numpy(), batch.column("place").to_numpy()
            block = np.empty(len(batch), dtype=np.int64)
            for one in np.unique(cell):
                if one != now:
                    dealt = np.repeat(np.arange(len(blocks), dtype=np.int32), matrix_row(cells, blocks, int(one), seed))
                    np.random.default_rng([seed, 1, int(one)]).shuffle(dealt)
                    now = one
                at = place[cell == one]
                if at.max() >= len(dealt):
                    raise RuntimeError(f"cell {one} has more rows than were counted")
                block[cell == one] = dealt[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), pa.array(owner[block]), pa.array(first[block])],
                                             names=inner.fieldNames())

    dealt = named.mapInArrow(deal, inner)
    again = F.xxhash64(F.lit(seed), "cell", "place")
    place = F.row_number().over(Window.partitionBy("block").orderBy(again, "cell", "place")) - 1
    placed = dealt.withColumn("place", place)
    return placed.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(keep)], F.col("owner").cast("int").alias("shard"),
                         (F.col("first") + F.col("place")).cast("bigint").alias("slot"))


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of a table of texts: narrow rows are shuffled, texts are not.

    ``size`` is the text's UTF-8 bytes plus 16, 16 for a null text; a null text has the CRC of
    an empty one.
    """
    raw = F.coalesce("text", F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    return shuffle_to_shards(narrow, shards)
