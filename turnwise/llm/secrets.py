"""Secrets in texts: fixed patterns, and Markov models of random strings against identifiers.

Two character Markov models (each character given the one before) are trained on labelled
strings over one alphabet: values that a fixed pattern marks as secret, and all other strings
of that alphabet, such as words, identifiers, paths and numbers. In both, pairs are interpolated
with single characters, and these with equal chances for all. A
further string is reported when its log-likelihood ratio outweighs the prior odds against a
secret and is large enough for each of its characters, so that length alone proves nothing.
The labels come from the whole corpus, as sums of character-pair counts, which are a few
thousand numbers whatever its size. Both passes work on slices of whole texts in place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from turnwise.llm.text import add_columns, text_pieces, word_spans

# Fixed by the contract: patterns, least lengths, and the order of the kinds.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"passw", b"secret", b"token", b"api")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")
BASE = 3

LEAST_RANDOM = 16
LEAST_ORDINARY = 8
# A string is taken for a secret from even odds, starting at one in a million.
LEAST_RATIO = float(np.log(1e6))
# The ratio a string must have for each of its pairs of characters.
LEAST_MEAN = 0.75
# The parts of the models that give every character the same chance. A secret's format may be
# none of the labelled ones. For ordinary strings the part bounds what one unseen pair can
# weigh, as code holds many pairs that prose lacks.
EVEN_RANDOM, EVEN_ORDINARY = 0.5, 0.05

_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SYMBOLS = len(_ALPHABET) + 1
_SYMBOL = np.full(256, SYMBOLS - 1, dtype=np.int64)
_SYMBOL[list(_ALPHABET)] = np.arange(len(_ALPHABET))


def _all_but(chars: bytes) -> np.ndarray:
    apart = np.ones(256, dtype=bool)
    apart[list(chars)] = False
    return apart


NOT_HEX = _all_but(b"0123456789abcdef")
NOT_CANDIDATE = _all_but(_ALPHABET)


def base_spans(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, start, rank, end, value start) of the fixed patterns, in bytes of the slice."""
    starts, ends, row_spans = word_spans(raw, offsets, NOT_HEX)
    long = np.flatnonzero(ends - starts >= LEAST_HEX)
    rows = np.searchsorted(row_spans, long, side="right") - 1
    found = [(int(r), int(starts[i]), 2, int(ends[i]), int(starts[i])) for r, i in zip(rows, long)]
    data = raw.tobytes()
    low = data.lower()
    # Rows with a keyword at all; the patterns then run over those rows only.
    for words, whole, pattern, rank in ((KEYWORDS, low, ASSIGN, 0), ((b"AKIA",), data, ACCESS, 1)):
        hits = {int(np.searchsorted(offsets, m, side="right")) - 1 for word in words for m in _everywhere(whole, word)}
        for row in sorted(hits):
            for m in pattern.finditer(data, int(offsets[row]), int(offsets[row + 1])):
                if rank == 0 and len(m.group(2)) >= LEAST_VALUE:
                    found.append((row, m.start(), 0, m.end(), m.start(2)))
                elif rank == 1 and len(m.group()) >= LEAST_ACCESS:
                    found.append((row, m.start(), 1, m.end(), m.start()))
    return sorted(found)


def _everywhere(data: bytes, word: bytes) -> Iterator[int]:
    at = data.find(word)
    while at >= 0:
        yield at
        at = data.find(word, at + 1)


def _clear_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple]) -> np.ndarray:
    """Which ranges touch no span; ranges are in order and apart."""
    clear = np.ones(len(starts), dtype=bool)
    for _, start, _, end, _ in spans:
        clear[np.searchsorted(ends, start, side="right"): np.searchsorted(starts, end, side="left")] = False
    return clear


def _pairs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character pairs of ranges of two or more bytes, and each range's first pair."""
    sizes = ends - starts - 1
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(starts - first, sizes)
    return _SYMBOL[raw[at]] * SYMBOLS + _SYMBOL[raw[at + 1]], first


@dataclass
class SecretModel:
    """Log-likelihood ratio of each character pair, random over ordinary."""

    ratio: np.ndarray

    @classmethod
    def of(cls, random: np.ndarray, ordinary: np.ndarray) -> SecretModel:
        """From pair counts of the two kinds of strings."""
        logs = [np.log(_interpolated(counts.reshape(SYMBOLS, SYMBOLS), even))
                for counts, even in ((random, EVEN_RANDOM), (ordinary, EVEN_ORDINARY))]
        return cls((logs[0] - logs[1]).ravel())


def _interpolated(counts: np.ndarray, even: float) -> np.ndarray:
    """Chances of each character after each, from pair counts.

    A pair weighs as often as it was seen, single characters as often as the first one was
    followed by something new.
    """
    single = counts.sum(axis=0)
    single = (single + 1.0) / (single.sum() + SYMBOLS)
    seen, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    pairs = np.where(seen > 0, (counts + kinds * single) / np.maximum(seen + kinds, 1), single)
    return (1 - even) * pairs + even / SYMBOLS


def count_pairs(docs: DataFrame) -> DataFrame:
    """(random, pair, n) over all texts: pairs in values the fixed patterns mark, and in all other strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SYMBOLS * SYMBOLS), dtype=np.int64)
        for batch in batches:
            for _, raw, offsets in text_pieces(batch):
                spans = base_spans(raw, offsets)
                values = np.array([(s[4], s[3]) for s in spans], dtype=np.int64).reshape(-1, 2)
                counts[1] += np.bincount(_pairs(raw, values[:, 0], values[:, 1])[0], minlength=counts.shape[1])
                starts, ends, _ = word_spans(raw, offsets, NOT_CANDIDATE)
                long = ends - starts >= LEAST_ORDINARY
                starts, ends = starts[long], ends[long]
                ordinary = _clear_of(starts, ends, spans)
                counts[0] += np.bincount(_pairs(raw, starts[ordinary], ends[ordinary])[0], minlength=counts.shape[1])
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label == 1), pa.array(pair.astype(np.int64)), pa.array(counts[label, pair])],
                                         names=["random", "pair", "n"])

    return (docs.select("text").mapInArrow(run, "random boolean, pair bigint, n bigint")
            .groupBy("random", "pair").agg(F.sum("n").alias("n")))


def train(pairs: DataFrame) -> SecretModel:
    """The model of labelled pair counts, at most two for each pair of symbols."""
    counts = np.zeros((2, SYMBOLS * SYMBOLS))
    for r in pairs.collect():
        counts[int(r.random), r.pair] = r.n
    return SecretModel.of(counts[1], counts[0])


def random_spans(raw: np.ndarray, offsets: np.ndarray, spans: list[tuple], model: SecretModel
                 ) -> list[tuple[int, int, int, int, float]]:
    """(row, start, rank, end, ratio) of long strings that look random, whatever their characters."""
    starts, ends, row_spans = word_spans(raw, offsets, NOT_CANDIDATE)
    long = np.flatnonzero(ends - starts >= LEAST_RANDOM)
    starts, ends = starts[long], ends[long]
    clear = _clear_of(starts, ends, spans)
    long, starts, ends = long[clear], starts[clear], ends[clear]
    if not len(long):
        return []
    pairs, first = _pairs(raw, starts, ends)
    ratio = np.add.reduceat(model.ratio[pairs], first)
    rows = np.searchsorted(row_spans, long, side="right") - 1
    told = (ratio > LEAST_RATIO) & (ratio >= LEAST_MEAN * (ends - starts - 1))
    return [(int(rows[i]), int(starts[i]), 3, int(ends[i]), float(ratio[i])) for i in np.flatnonzero(told)]


_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType()),
                               StructField("kind", StringType()), StructField("ratio", DoubleType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("ratio", pa.float64())]))


def find_secrets(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``docs`` with ``secrets`` added: spans (start, end, kind, ratio) by start, then kind.

    Positions are code points, the end exclusive. Spans of the fixed patterns are the whole
    match, always stay, and have no ratio; ``random`` spans touch none of them. A null or empty
    text has none. Each row stands for itself; other columns are kept, one named ``secrets`` is
    replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(rows: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        spans = base_spans(raw, offsets)
        extra = random_spans(raw, offsets, spans, sent.value)
        out: list[list[dict]] = [[] for _ in range(len(rows))]
        if spans or extra:
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            for row, start, rank, end, ratio in sorted([(*s[:4], None) for s in spans] + extra, key=lambda s: s[:3]):
                zero = points[offsets[row]]
                out[row].append({"start": int(points[start] - zero), "end": int(points[end] - zero),
                                 "kind": KINDS[rank], "ratio": ratio})
        return [pa.array(out, _ARROW_SPANS)]

    return add_columns(docs, {"secrets": _SPANS}, work)


def scan(docs: DataFrame) -> DataFrame:
    """Train on the whole table, then find the secrets of all its rows."""
    return find_secrets(docs, train(count_pairs(docs)))
