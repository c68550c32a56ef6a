"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a slice of whole documents. Its words are numbered by the benchmark's vocabulary;
a word the benchmark lacks cannot lie in an occurrence, so only runs of known words, at least
as long as the shortest phrase, enter the shard's index. All phrases are searched backwards
at once through wavelet-tree ranks, occurrences are located by sampled suffix positions, and
their word ranges are merged into removal spans. Documents never leave their task: there is
no shuffle, and memory is bounded by the slice.

The benchmark travels in blocks of bounded size, one at a time. A benchmark of more than one
block costs a pass over the texts for each: a pass writes the marks of the rows it hit, its block
is given back by driver and workers before the next one is sent, and the last pass joins what
the others wrote.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from turnwise.llm.fm_index import FMIndex
from turnwise.llm.text import LOWER, add_columns, hash_spans, keep_where, word_spans
from turnwise.operators.scan import lookup_join
from turnwise.session import landed

WINDOW = 13
BLOCK_BYTES = 4 << 20
CONTAMINATED_PART = 20

# Every byte that is no digit, no letter a-z and below \x80 separates words; fixed by the contract.
APART = np.zeros(256, dtype=bool)
APART[:0x30] = APART[0x3A:0x61] = APART[0x7B:0x80] = True

SEPARATOR = 1
_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
_ADDED = {"n_words": LongType(), "n_hit": LongType(), "items": ArrayType(StringType()),
          "contaminated": BooleanType(), "hit_words": ArrayType(LongType()), "removal_spans": _SPANS}


def _words(raw: np.ndarray, offsets: np.ndarray):
    raw = LOWER[raw]
    starts, ends, row_words = word_spans(raw, offsets, APART)
    return hash_spans(raw, starts, ends), starts, ends, row_words


class Phrases:
    """The windows of a block of items: distinct word sequences and the items that hold each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = [t.encode("utf-8", "surrogatepass") for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        hashes, _, _, row_words = _words(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets)
        self.vocabulary, ranks = np.unique(hashes, return_inverse=True)
        symbols = ranks.astype(np.int64) + SEPARATOR + 1
        self.symbols = len(self.vocabulary) + SEPARATOR + 1
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        owner = np.array([number[name] for name, _ in items], dtype=np.int64)
        sizes = np.diff(row_words)
        self.groups = []
        for length in sorted({min(window, int(s)) for s in sizes if s}):
            rows = np.flatnonzero(sizes >= window if length == window else sizes == length)
            counts = sizes[rows] - length + 1
            first = np.repeat(row_words[rows] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
            begins = first + np.arange(int(counts.sum()))
            windows = symbols[begins[:, None] + np.arange(length)]
            distinct, which = np.unique(windows, axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), np.repeat(owner[rows], counts)], axis=1), axis=0)
            held = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
            self.groups.append((length, distinct, held, pairs[:, 1]))
        self.shortest = self.groups[0][0] if self.groups else 0

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's symbol, 0 for a word that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + SEPARATOR + 1, 0)


def known_runs(symbols: np.ndarray, row_words: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of known words of one row, joined by separators, and each symbol's word (-1: separator)."""
    known = np.zeros(len(symbols) + 2, dtype=bool)
    known[1:-1] = symbols > 0
    edge = np.zeros(len(symbols) + 1, dtype=bool)
    edge[row_words] = True
    starts = np.flatnonzero(known[1:] & (edge | ~known[:-1]))
    ends = np.flatnonzero(known[:-1] & (edge | ~known[1:]))
    long = ends - starts >= shortest
    starts, sizes = starts[long], (ends - starts)[long]
    slots = np.cumsum(sizes + 1) - (sizes + 1)
    word = np.full(int((sizes + 1).sum()), -1, dtype=np.int64)
    inside = np.arange(int(sizes.sum())) + np.repeat(slots - (np.cumsum(sizes) - sizes), sizes)
    word[inside] = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return np.where(word >= 0, symbols[word], SEPARATOR), word


def occurrences(symbols: np.ndarray, row_words: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in an occurrence, and the distinct (row, item) pairs that meet, of one shard."""
    depth = np.zeros(len(symbols) + 1, dtype=np.int64)
    pairs = [np.zeros((0, 2), dtype=np.int64)]
    text, word = known_runs(symbols, row_words, phrases.shortest) if phrases.groups else (np.zeros(0), None)
    if len(text):
        index = FMIndex(text, phrases.symbols)
        for length, windows, held, items in phrases.groups:
            for pattern, position in index.locate(*index.search(windows)):
                begin = word[position]
                depth += np.bincount(begin, minlength=len(depth)) - np.bincount(begin + length, minlength=len(depth))
                row = np.searchsorted(row_words, begin, side="right") - 1
                met = np.unique(np.stack([row, pattern], axis=1), axis=0)
                counts = held[met[:, 1] + 1] - held[met[:, 1]]
                where = np.arange(int(counts.sum())) + np.repeat(held[met[:, 1]] - (np.cumsum(counts) - counts), counts)
                pairs.append(np.unique(np.stack([np.repeat(met[:, 0], counts), items[where]], axis=1), axis=0))
    return np.cumsum(depth[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _ranges(mask: np.ndarray) -> np.ndarray:
    """Start and end of each run of true values, alternating."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))


def _shard_work(phrases, earlier: tuple[int, int] | None):
    def work(rows: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        ph = phrases.value
        hashes, starts, ends, row_words = _words(raw, offsets)
        hit, pairs = occurrences(ph.symbols_of(hashes), row_words, ph)
        n_words = np.diff(row_words)
        items: list[list[str]] = [[] for _ in range(len(rows))]
        for row, item in pairs:
            items[row].append(ph.names[item])
        if earlier is not None:
            before, named = rows.column(earlier[0]).to_pylist(), rows.column(earlier[1]).to_pylist()
            for row in range(len(rows)):
                for a, b in zip(before[row][::2], before[row][1::2]):
                    hit[row_words[row] + a: row_words[row] + b] = True
                items[row] = sorted({*items[row], *named[row]})
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[row_words[1:]] - total[row_words[:-1]]
        hit_words: list[list[int]] = [[] for _ in range(len(rows))]
        spans: list[list[dict]] = [[] for _ in range(len(rows))]
        touched = np.flatnonzero(n_hit)
        if len(touched):
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            for row in touched:
                words = _ranges(hit[row_words[row]: row_words[row + 1]])
                hit_words[row] = words.tolist()
                low = points[starts[row_words[row] + words[::2]]] - points[offsets[row]]
                high = points[ends[row_words[row] + words[1::2] - 1]] - points[offsets[row]]
                spans[row] = [{"start": int(a), "end": int(b)} for a, b in zip(low, high)]
        return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
                pa.array((n_hit > 0) & (CONTAMINATED_PART * n_hit >= n_words), pa.bool_()),
                pa.array(hit_words, pa.list_(pa.int64())),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    return work


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark as (item_id, text) in parts of about ``block_bytes`` of text each."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [items.where(part == i) for i in range(blocks)] if blocks > 1 else [items]


def _phrases(block: DataFrame, window: int):
    """A block's phrases, sent to the workers."""
    return block.sparkSession.sparkContext.broadcast(Phrases([(r.item_id, r.text) for r in block.collect()], window))


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, items, contaminated, hit_words and removal_spans added.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters from \\x80 up.
    A phrase is ``window`` consecutive words of an item, or the whole of a shorter item; a word
    inside any occurrence is hit. ``items`` are the ids, sorted as strings, of the items with
    an occurring phrase; ``hit_words`` alternates first and past-the-end word numbers;
    ``removal_spans`` are the same in code points of the text, from a span's first word to its
    last. A document is contaminated if at least a twentieth of its words, and one, is hit.

    Null or empty texts have no words and are clean. An item without a text or without words
    has no phrase; an item without an id counts under the empty id; equal ids count once.
    Repeated documents are judged alike. Empty tables on either side are fine.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in _ADDED]
    blocks = item_blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        return _pass(docs.select(*kept), _phrases(blocks[0], window), None).select(*kept, *_ADDED)
    # Rows have no key of their own; their numbers are written, so that all passes mean the same.
    names = ["text" if c == "text" else f"_c{i}" for i, c in enumerate(kept)]
    rows = landed(spark, docs.select(*kept).toDF(*names).withColumn("_row", F.monotonically_increasing_id()), "contamination-rows")
    marks = []
    for block in blocks[:-1]:
        sent = _phrases(block, window)
        hit = _pass(rows.select("_row", "text"), sent, None).where("n_hit > 0").select("_row", "hit_words", "items")
        marks.append(landed(spark, hit, "contamination-marks"))
        sent.destroy()
    marked = reduce(DataFrame.unionByName, marks).groupBy("_row").agg(
        F.flatten(F.collect_list("hit_words")).alias("_hits"), F.flatten(F.collect_list("items")).alias("_items"))
    none = F.array()
    joined = lookup_join(rows, marked, ["_row"]).select(
        *names, F.coalesce("_hits", none.cast("array<bigint>")).alias("_hits"), F.coalesce("_items", none.cast("array<string>")).alias("_items"))
    done = _pass(joined, _phrases(blocks[-1], window), (len(names), len(names) + 1))
    return done.select(*names, *_ADDED).toDF(*kept, *_ADDED)


def _pass(rows: DataFrame, phrases, earlier: tuple[int, int] | None) -> DataFrame:
    return add_columns(rows, _ADDED, _shard_work(phrases, earlier))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    return keep_where(docs, lambda rows: mark_contamination(rows, benchmark), "not contaminated", ("text",))
