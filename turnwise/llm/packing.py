"""Vector bin packing of tokenised documents into training sequences.

A sequence has three limits: tokens, segments, and tokens that bear loss. Documents longer
than a sequence are cut to full sequences first; what is left is packed bin by bin: of the
pieces that still fit, the one with the largest dot product of its needs and the bin's free
room goes in, both as parts of the limits.

Each task packs its own documents as they stream by, so nothing is shuffled. It keeps at most
a bounded number of pieces waiting; bins that are nearly full leave, the pieces of others wait
on. A task thus ends with at most a few bins that are not full, whatever its size.

Tokenizing is by the given tokenizer, once per distinct chunk: text is cut at ASCII blanks and
between ASCII letters and punctuation, where neither the tokenizer's normalisation nor its
split reaches across, and A-Z are lower-cased, as the tokenizer does itself. A text's ids are
its chunks' ids in order. Each worker keeps the ids of chunks it has seen, by 64-bit hash, up
to a bound. This holds for word tokenizers that drop blanks and lower-case, such as the one
the query names.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from turnwise.llm.text import IS_BLANK, LOWER, hash_spans, release_memory, text_pieces, word_spans

END_ID = 2
CACHED_CHUNKS = 1 << 20
# Text is tokenised in slices of this size, since its arrays take many times as much.
SLICE_BYTES = 1 << 20
ENCODE_AT_ONCE = 4096
JOINED = 256
WAITING = 4096
FULL_ENOUGH = 0.995

# 1 an ASCII letter, 2 ASCII punctuation without the apostrophe, which may start a contraction.
SIDE = np.zeros(256, dtype=np.uint8)
SIDE[0x21:0x7F] = 2
SIDE[0x30:0x3A] = SIDE[0x27] = 0
SIDE[0x41:0x5B] = SIDE[0x61:0x7B] = 1
# Special tokens are matched in the text as it is.
SPECIAL_MARK = b"<|"


def plain(chunk: str) -> bool:
    """Whether a chunk is surely one word to the tokenizer's split: letters that stay as they are."""
    return chunk.isalpha() and chunk == chunk.lower() and unicodedata.is_normalized("NFC", chunk)

PIECE_DDL = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, loss_tokens bigint, "
             "sequence_id bigint, segment bigint, offset bigint, ids binary")


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


class ChunkIds:
    """Token ids of chunks without blanks, remembered across calls."""

    def __init__(self, path: str, most: int = CACHED_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.begins, self.pool = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def _coded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _one_word_each(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of plain chunks: joined by spaces, a token that ends a word ends a chunk."""
        out = []
        for at in range(0, len(chunks), JOINED):
            part = chunks[at: at + JOINED]
            ids = self._coded([" ".join(part)])[0]
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            out += np.split(ids, ends[:-1]) if len(ends) == len(part) else self._coded(part)
        return out

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        simple = np.fromiter((plain(t) for t in texts), dtype=bool, count=len(texts))
        coded: list[np.ndarray] = [self.pool[:0]] * len(texts)
        words = np.flatnonzero(simple)
        for i, ids in zip(words, self._one_word_each([texts[i] for i in words])):
            coded[i] = ids
        others = np.flatnonzero(~simple)
        for at in range(0, len(others), ENCODE_AT_ONCE):
            part = others[at: at + ENCODE_AT_ONCE]
            for i, ids in zip(part, self._coded([texts[i] for i in part])):
                coded[i] = ids
        known = len(self.begins) - 1
        self.pool = np.concatenate([self.pool, *coded])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum([len(x) for x in coded], dtype=np.int64)])
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.place = np.insert(self.place, where, known + np.arange(len(keys)))

    def _missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] != keys

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows with ``end_id`` after each, and the rows' offsets in them."""
        cuts = None
        if SPECIAL_MARK not in raw.tobytes():
            side = SIDE[raw]
            cuts = np.flatnonzero(side[:-1] + side[1:] == 3) + 1
            raw = LOWER[raw]
        starts, ends, row_words = word_spans(raw, offsets, IS_BLANK, cuts)
        keys, first, which = np.unique(hash_spans(raw, starts, ends), return_index=True, return_inverse=True)
        new = self._missing(keys)
        if len(self.keys) and len(self.keys) + int(new.sum()) > self.most:
            self._forget()
            new = self._missing(keys)
        if new.any():
            self._learn(keys[new], [raw[starts[i]: ends[i]].tobytes() for i in first[new]])
        at = self.place[np.searchsorted(self.keys, keys)]
        begin, size = self.begins[at][which], (self.begins[at + 1] - self.begins[at])[which]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.arange(before[-1]) + np.repeat(begin - before[:-1], size)]
        rows = len(offsets) - 1
        row_ends = before[row_words[1:]] + np.arange(rows)
        out = np.full(len(ids) + rows, end_id, dtype=np.uint32)
        place = np.ones(len(out), dtype=bool)
        place[row_ends] = False
        out[place] = ids
        return out, np.concatenate([[0], row_ends + 1])


_ENCODERS: dict[str, ChunkIds] = {}


def encoder(path: str) -> ChunkIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkIds(path)
    return _ENCODERS[path]


def pack_bins(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> list[list[int]]:
    """Bins of item numbers by the dot-product rule; every item fits an empty bin.

    Items of equal needs are one class; ties go to the larger item, then to the earlier one.
    """
    classes, which = np.unique(np.stack([-tokens, -loss], axis=1), axis=0, return_inverse=True)
    need_t, need_l = -classes[:, 0], -classes[:, 1]
    order = np.argsort(which.ravel(), kind="stable")
    counts = np.bincount(which.ravel(), minlength=len(classes))
    begins = np.cumsum(counts) - counts
    left = counts.copy()
    live = np.arange(len(classes))
    bins = []
    while len(live):
        room_t, room_s, room_l, inside = limits.tokens, limits.segments, limits.loss, []
        while room_s:
            fits = live[(need_t[live] <= room_t) & (need_l[live] <= room_l) & (left[live] > 0)]
            if not len(fits):
                break
            score = (need_t[fits] * (room_t / limits.tokens**2) + need_l[fits] * (room_l / limits.loss**2)
                     + room_s / limits.segments**2)
            best = fits[np.argmax(score)]
            left[best] -= 1
            inside.append(int(order[begins[best] + left[best]]))
            room_t, room_s, room_l = room_t - need_t[best], room_s - 1, room_l - need_l[best]
        bins.append(inside)
        live = live[left[live] > 0]
    return bins


class Packer:
    """Pieces of one task: full ones leave at once, others wait to be packed."""

    def __init__(self, limits: Limits, task: int):
        self.limits, self.next, self.waiting, self.done = limits, task << 33, [], []

    def add(self, doc_id, ids: np.ndarray, prompt: int) -> None:
        total, at = len(ids), 0
        while at < total:
            size = min(self.limits.tokens, total - at)
            if max(0, at + size - max(at, prompt)) > self.limits.loss:
                size = max(at, prompt) + self.limits.loss - at
            loss = max(0, at + size - max(at, prompt))
            piece = (doc_id, at, size, total, loss, ids[at: at + size].tobytes())
            self._close([piece]) if size == self.limits.tokens else self.waiting.append(piece)
            at += size

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for segment, (doc_id, start, size, total, loss, ids) in enumerate(pieces):
            self.done.append((doc_id, start, size, total, loss, self.next, segment, offset, ids))
            offset += size
        self.next += 1

    def pack(self, last: bool) -> None:
        if not self.waiting:
            return
        tokens = np.array([p[2] for p in self.waiting])
        keep = []
        for inside in pack_bins(tokens, np.array([p[4] for p in self.waiting]), self.limits):
            pieces = [self.waiting[i] for i in inside]
            full = int(tokens[inside].sum()) >= FULL_ENOUGH * self.limits.tokens or len(inside) == self.limits.segments
            self._close(pieces) if full or last else keep.extend(pieces)
        # Most waiting although none fit well: let them go rather than grow.
        if len(keep) > WAITING // 2:
            self.waiting = keep
            self.pack(last=True)
            keep = []
        self.waiting = keep

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 8 + [pa.binary()]
        names = [part.split()[0] for part in PIECE_DDL.split(", ")]
        columns = list(zip(*self.done)) or [()] * 9
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), prompt_tokens: str | None = None) -> DataFrame:
    """One row per piece: where it lies in its document and its sequence, and its token ids.

    ``ids`` are little-endian unsigned 32-bit numbers; a document's ids are its text's, without
    special tokens added, and then the end id. ``prompt_tokens`` names a column with the number
    of leading ids that bear no loss (null: none), else all ids bear loss. Each id is in exactly
    one piece, the pieces of a sequence follow one another from offset 0, and no sequence passes
    a limit. ``sequence_id`` is unique but not gapless. A null or empty text is the end id alone.
    Repeated rows are packed each for itself; rows without an id keep a null doc_id; other
    columns are not carried. An empty table gives no pieces.
    """
    prompt = F.coalesce(F.col(prompt_tokens).cast("bigint"), F.lit(0)) if prompt_tokens else F.lit(0).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"), prompt.alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(tokenizer_path), Packer(limits, TaskContext.get().partitionId())
        for batch in batches:
            for part, raw, offsets in text_pieces(batch, most=SLICE_BYTES):
                ids, ends = coder.encode(raw, offsets)
                names, prompts = part.column(0).to_pylist(), part.column(2).to_pylist()
                for row in range(len(part)):
                    packer.add(names[row], ids[ends[row]: ends[row + 1]], prompts[row])
                    if len(packer.waiting) >= WAITING:
                        packer.pack(last=False)
                yield packer.batch()
        packer.pack(last=True)
        yield packer.batch()
        release_memory()

    return rows.mapInArrow(run, PIECE_DDL)
