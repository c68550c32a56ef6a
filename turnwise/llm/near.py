"""Near duplicates: an exact Jaccard join of word shingle sets.

Sets that are equal are one node from the start. Others meet in tiles. A tile is a shingle
that two sets hold among the first quarter of their shingles, in an order common to all that
puts frequent shingles last; sets of Jaccard 0.75 must share one of these. Inside a tile sets
are ordered by size, and only sizes within the band that allows the similarity are compared.
A hashed parity bitmap per set, as wide as its size band asks, bounds the overlap from above
by bit counts; what passes is checked by intersecting the sorted sets.

Groups of thousands of copies would make pairs by the million, so tiles are worked in rounds.
First each set of a tile is paired with the tile's smallest fitting set only, and these pairs
are checked. Tiles whose sets are then all connected are done. Next each set of the others goes
into one of its open tiles only, and is paired there with a few sets of other components, by a
preference that all sets share; the links found join components. The last round takes all open
tiles. No pair leaves a tile there: the pairs that the bitmaps allow are joined to groups, and a
tile gives one row per set, which names its group. Groups of all tiles are then joined, and each
set is sent once to its group, where all sets are intersected with all others within the task,
as products of the table of sets and shared shingles. Large tiles and groups are cut into parts,
and pairs of parts are tasks of their own. Sets that resemble each other without being near
duplicates thus cost work inside tasks, but no rows.

How frequent a shingle is comes from a count sketch of fixed size over all documents. It only
decides the order, which is the same for all sets, so its errors cost time, never a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from turnwise.llm.graph import components, spanning
from turnwise.llm.text import IS_BLANK, LOWER, add_columns, hash_spans, mix64, release_memory, text_pieces, word_spans
from turnwise.session import landed, landed_path, remove_path

WORDS = 5
# Similarity 3/4, as whole numbers; prefix and bands below follow from it.
PART, OF = 3, 4
SKETCH_BITS = 20
SLICES = 64
SEEN_KEYS, SEEN_PAIRS = 1 << 20, 1 << 17
PAIRS_AT_ONCE = 1 << 18
# Which open tile a set enters and how many partners it is given there, round by round, before the
# last round takes all tiles and all partners, which makes the result whole.
ROUNDS = (("min", 16), ("max", 16))
# Sets of a tile or group that are compared in one task; more are cut into parts.
TILE_SETS, GROUP_SETS = 2048, 512
# Tiles up to this size are compared many at once.
FEW = 64
WORDS_AT_ONCE = 1 << 22
NARROWEST, WIDEST = 256, 1 << 16

_MIX = np.random.default_rng(5).integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_rows(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a row of fewer words has its whole sequence."""
    raw = LOWER[raw]
    starts, ends, row_words = word_spans(raw, offsets, IS_BLANK)
    words = hash_spans(raw, starts, ends)
    grams = np.zeros(0, dtype=np.uint64)
    if len(words) >= WORDS:
        grams = words[: len(words) - WORDS + 1] * _MIX[0]
        for k in range(1, WORDS):
            grams += words[k: len(words) - WORDS + 1 + k] * _MIX[k]
        grams = mix64(grams)
    for a, b in zip(row_words[:-1], row_words[1:]):
        if b - a >= WORDS:
            row = np.sort(grams[a: b - WORDS + 1])
            yield row[np.r_[True, row[1:] != row[:-1]]]
        elif b > a:
            total = (words[a:b] * _MIX[: b - a]).sum(dtype=np.uint64)
            yield mix64(np.array([total ^ np.uint64(b - a)], dtype=np.uint64))
        else:
            yield grams[:0]


def set_key(grams: np.ndarray) -> int:
    """A 64-bit name of a set, signed; equal sets have equal names."""
    total = mix64(grams ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64) ^ np.uint64(len(grams))
    return int(mix64(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def prefix_size(n: int) -> int:
    return n - -(-PART * n // OF) + 1


def width_of(n: int) -> int:
    """Bits of the bitmap of a set of this size."""
    return min(max(NARROWEST, 1 << int(2 * n - 1).bit_length()), WIDEST)


def signature(grams: np.ndarray) -> bytes:
    """Parity of the number of shingles hashed to each bit; a wide bitmap folds to a narrow one by xor."""
    width = width_of(len(grams))
    bits = np.bincount((grams >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _folded(marks: list[bytes], width: int) -> np.ndarray:
    table = np.frombuffer(b"".join(marks), dtype=np.uint8).reshape(len(marks), -1)
    while table.shape[1] * 8 > width:
        half = table.shape[1] // 2
        table = table[:, :half] ^ table[:, half:]
    return table


def may_link(a: list[bytes], b: list[bytes], na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which pairs the bitmaps do not rule out.

    Each differing bit needs a shingle in one set only, so the overlap is at most half of the
    sizes less the differing bits; the similarity needs (na + nb) * PART / (PART + OF) of it.
    """
    out = np.zeros(len(a), dtype=bool)
    wa = np.array([len(x) * 8 for x in a])
    wb = np.array([len(x) * 8 for x in b])
    for pair in set(zip(wa.tolist(), wb.tolist())):
        at = np.flatnonzero((wa == pair[0]) & (wb == pair[1]))
        width = min(pair)
        differ = np.bitwise_count(_folded([a[i] for i in at], width) ^ _folded([b[i] for i in at], width)).sum(axis=1, dtype=np.int64)
        total = na[at] + nb[at]
        out[at] = (total - differ) * (PART + OF) >= 2 * PART * total
    return out


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have the similarity."""
    where = np.searchsorted(b, a)
    where[where == len(b)] = 0
    shared = int((b[where] == a).sum())
    return OF * shared >= PART * (len(a) + len(b) - shared)


def sketch_levels(docs: DataFrame) -> np.ndarray:
    """Bit length of the count of each hash bucket over all documents' shingles."""
    size = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for _, raw, offsets in text_pieces(batch):
                rows = list(shingle_rows(raw, offsets))
                total += np.bincount((np.concatenate(rows) & np.uint64(size - 1)).astype(np.int64), minlength=size)
        parts = total.reshape(SLICES, -1).astype(np.int32 if total.max() < 2**31 else np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int64()), pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())],
                                         names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(counts, dtype="<i8")
                totals[i] = totals[i] + more if i in totals else more
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
                                         names=["slice", "counts"])

    ddl = "slice bigint, counts binary"
    rows = docs.select("text").mapInArrow(count, ddl).repartition("slice").mapInArrow(add, ddl).collect()
    total = np.zeros((SLICES, size // SLICES), dtype=np.int64)
    for r in rows:
        total[r.slice] = np.frombuffer(r.counts, dtype="<i8")
    return np.ceil(np.log2(total.ravel() + 1.0)).astype(np.uint8)


def describe_sets(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(doc_id, n, key, prefix, bits) per row.

    ``prefix`` and ``bits`` are null where the task has lately described the same set, so a set
    of very many copies goes on about once per task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(levels)
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    added = {"n": LongType(), "key": LongType(), "prefix": ArrayType(LongType()), "bits": BinaryType()}
    seen: set[int] = set()

    def work(rows: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        level = sent.value
        sizes, keys, prefixes, bits = [], [], [], []
        for grams in shingle_rows(raw, offsets):
            key = set_key(grams)
            sizes.append(len(grams))
            keys.append(key)
            if not len(grams) or key in seen:
                prefixes.append(None)
                bits.append(None)
                continue
            if len(seen) >= SEEN_KEYS:
                seen.clear()
            seen.add(key)
            order = np.argsort(level[(grams & mask).astype(np.int64)], kind="stable")[: prefix_size(len(grams))]
            prefixes.append(grams[order].view(np.int64))
            bits.append(signature(grams))
        return [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())),
                pa.array(bits, pa.binary())]

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return add_columns(rows, added, work).drop("text")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole tiles from batches sorted by the first column."""
    waiting: list[list] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(batch):
            continue
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if cut:
            waiting.append([c[:cut] for c in columns])
            yield [np.concatenate(c) for c in zip(*waiting)]
            waiting = []
        waiting.append([c[cut:] for c in columns])
        # A tile that goes on through many batches is kept whole; it is narrow rows only.
        if len(waiting) > 1 and waiting[0][0][0] != columns[0][-1]:
            yield [np.concatenate(c) for c in zip(*waiting[:-1])]
            waiting = waiting[-1:]
    if waiting:
        yield [np.concatenate(c) for c in zip(*waiting)]


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (token, n, key) sorted: the rows of tiles of several sets, each with its leader.

    The leader is the tile's first set, or the first that is large enough for the row's size.
    """
    for token, n, key in _runs(batches):
        new = np.r_[True, (token[1:] != token[:-1]) | (key[1:] != key[:-1])]
        token, n, key = token[new], n[new], key[new]
        begin = np.r_[True, token[1:] != token[:-1]]
        while True:
            lead = np.flatnonzero(begin)[np.cumsum(begin) - 1]
            far = OF * n[lead] < PART * n
            if not far.any():
                break
            # The first row of each run that is too far from its leader leads from here on.
            rows = np.flatnonzero(far)
            begin[rows[np.r_[True, lead[rows[1:]] != lead[rows[:-1]]]]] = True
        near = (token[1:] == token[:-1]) & (OF * n[:-1] >= PART * n[1:])
        shared = np.r_[near, False] | np.r_[False, near]
        yield pa.RecordBatch.from_arrays([pa.array(x[shared]) for x in (token, n, key, key[lead], n[lead])],
                                         names=["token", "n", "key", "leader", "leader_n"])


def _preferred(i: np.ndarray, j: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` with the smallest partner, for either of their sets."""
    own, other = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((key[other], own))
    first = np.flatnonzero(np.r_[True, own[order][1:] != own[order][:-1]])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    chosen = np.zeros(len(own), dtype=bool)
    chosen[order[rank < most]] = True
    return chosen[: len(i)] | chosen[len(i):]


def _dense_pairs(n: np.ndarray, label: np.ndarray, part: np.ndarray, cross: bool, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one large tile, sorted by size, that the bitmaps allow: blocks of rows against all their band."""
    widths = np.array([len(x) * 8 for x in bits])
    found_i, found_j = [], []
    for wide in np.unique(widths):
        rows = np.flatnonzero(widths == wide)
        for other in np.unique(widths[widths >= wide]):
            partners = np.flatnonzero(widths == other)
            a = _folded([bits[x] for x in rows], int(wide)).view(np.uint64)
            b = a if other == wide else np.ascontiguousarray(_folded([bits[x] for x in partners], int(wide))).view(np.uint64)
            step = max(1, WORDS_AT_ONCE // (len(partners) * a.shape[1]))
            for at in range(0, len(rows), step):
                own = rows[at:at + step]
                differ = np.bitwise_count(a[at:at + step, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int64)
                total = n[own][:, None] + n[partners][None, :]
                passed = (total - differ) * (PART + OF) >= 2 * PART * total
                passed &= OF * np.minimum(n[own][:, None], n[partners][None, :]) >= PART * np.maximum(n[own][:, None], n[partners][None, :])
                passed &= label[own][:, None] != label[partners][None, :]
                if cross:
                    passed &= part[own][:, None] != part[partners][None, :]
                if other == wide:
                    passed &= own[:, None] < partners[None, :]
                i, j = np.nonzero(passed)
                found_i.append(own[i])
                found_j.append(partners[j])
    return np.concatenate(found_i), np.concatenate(found_j)


def _tile_pairs(tile: np.ndarray, cross: np.ndarray, part: np.ndarray, n: np.ndarray, label: np.ndarray, bits: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of whole tiles, sorted by (tile, n), in different components that the bitmaps allow."""
    begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    ends = np.r_[begins[1:], len(tile)]
    sizes = ends - begins
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for a, b in zip(begins[sizes > FEW], ends[sizes > FEW]):
        i, j = _dense_pairs(n[a:b], label[a:b], part[a:b], bool(cross[a]), bits[a:b])
        found.append((i + a, j + a))
    # The others all at once: past-the-end row of each row's band is in the same tile, and not too large for it.
    last = np.repeat(np.where(sizes > FEW, begins, ends), sizes)
    rank, span = np.repeat(np.arange(len(begins)), sizes), int(n.max()) + 1
    end = np.minimum(np.searchsorted(rank * span + n, rank * span + np.minimum(OF * n // PART, span - 1), side="right"), last)
    counts = np.maximum(end - np.arange(len(tile)) - 1, 0)
    upto = np.concatenate([[0], np.cumsum(counts)])
    at = 0
    while at < len(tile):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS_AT_ONCE, side="right")) - 1)
        i = np.repeat(np.arange(at, stop), counts[at:stop])
        j = i + 1 + np.arange(len(i)) - np.repeat(upto[at:stop] - upto[at], counts[at:stop])
        apart = (label[i] != label[j]) & (~cross[i] | (part[i] != part[j]))
        i, j, at = i[apart], j[apart], stop
        if len(i):
            passed = may_link([bits[x] for x in i], [bits[x] for x in j], n[i], n[j])
            found.append((i[passed], j[passed]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _few_pairs(most: int):
    """Of tile rows sorted by (tile, n, key): pairs of sets, for each set its ``most`` preferred partners."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for tile, cross, part, n, key, label, bits in _runs(batches):
            i, j = _tile_pairs(tile, cross, part, n, label, bits)
            if len(i):
                few = _preferred(i, j, key, most)
                i, j = i[few], j[few]
            pairs = []
            for pair in zip(key[i].tolist(), key[j].tolist()):
                if pair not in done:
                    if len(done) >= SEEN_PAIRS:
                        done.clear()
                    done.add(pair)
                    pairs.append(pair)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                                             names=["a", "b"])
        release_memory()
    return run


def _resembling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of tile rows sorted by (tile, n, key): (key, another key of its group) for the pairs that the bitmaps allow."""
    for tile, cross, part, n, key, label, bits in _runs(batches):
        i, j = _tile_pairs(tile, cross, part, n, label, bits)
        root = spanning(len(tile), i, j)
        rows = np.flatnonzero(root != np.arange(len(tile)))
        yield pa.RecordBatch.from_arrays([pa.array(key[root[rows]]), pa.array(key[rows])], names=["a", "b"])
    release_memory()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share, from the table of sets and shingles that several hold."""
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    count = np.bincount(column, minlength=len(grams))
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    several = np.flatnonzero(count > 1)
    place = np.full(len(grams), -1)
    place[several] = np.arange(len(several))
    at = place[column]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    step = max(1, WORDS_AT_ONCE // len(sets))
    for low in range(0, len(several), step):
        a, b = np.searchsorted(at, [low, low + step])
        marks = np.zeros((len(sets), min(step, len(several) - low)), dtype=np.float32)
        marks[row[a:b], at[a:b] - low] = 1
        shared += marks @ marks.T
    return shared


def _linked_in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (tile, cross, part, key, label, grams) sorted by tile: links (a, b) that join all sets of a tile that links join."""
    for tile, cross, part, key, label, grams in _runs(batches):
        begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
        for a, b in zip(begins, np.r_[begins[1:], len(tile)]):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in grams[a:b]]
            n = np.array([len(x) for x in sets])
            shared = overlaps(sets)
            total = n[:, None] + n[None, :]
            linked = np.triu(OF * shared >= PART * (total - shared), 1)
            if cross[a]:
                linked &= part[a:b][:, None] != part[a:b][None, :]
            i, j = np.nonzero(linked)
            root = spanning(b - a, i, j)
            rows = np.flatnonzero(root != np.arange(b - a))
            yield pa.RecordBatch.from_arrays([pa.array(key[a + root[rows]]), pa.array(key[a + rows])], names=["a", "b"])
    release_memory()


def _in_parts(rows: DataFrame, by: str, most: int) -> DataFrame:
    """``rows`` with tile, cross and part: those of one ``by`` in one tile, or in a tile for each pair of parts if they are many."""
    parts = F.ceil(F.col("_n") / F.lit(most)).cast("bigint")
    sized = rows.join(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).hint("merge"), by)
    sized = sized.withColumn("part", F.pmod(F.xxhash64("key", F.lit(7)), parts)).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    low, high = F.least("part", "_other"), F.greatest("part", "_other")
    return sized.withColumns({"tile": F.when(parts == 1, F.col(by)).otherwise(F.xxhash64(by, low, high)),
                              "cross": low != high}).drop("_n", "_other")


def _allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, na, nb, bits_a, bits_b): the pairs that the bitmaps allow."""
    for batch in batches:
        a, b, na, nb, bits_a, bits_b = batch.columns
        passed = may_link(bits_a.to_pylist(), bits_b.to_pylist(), na.to_numpy(), nb.to_numpy())
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(passed))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, set_a, set_b): the pairs that link."""
    for batch in batches:
        a, b, set_a, set_b = batch.columns
        keep = [links(np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64))
                for x, y in zip(set_a, set_b)]
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets_of(docs: DataFrame, first: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, grams) of the sets named in ``keys``, made again from one document each (``first``)."""
    some = landed(docs.sparkSession, first.join(keys, "key", "left_semi"), "near-some")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Spark knows the written table's size, and sends it to the texts only if it is small.
    rows = rows.join(some.select("_id"), rows.doc_id.eqNullSafe(F.col("_id")), "left_semi")

    def work(part: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        sets = list(shingle_rows(raw, offsets))
        return [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]

    made = add_columns(rows, {"key": LongType(), "grams": BinaryType()}, work).select("key", "grams")
    # Rows that repeat an id may bring in further sets, and a set may come twice.
    return landed(docs.sparkSession, made.join(some.select("key"), "key", "left_semi").dropDuplicates(["key"]), "near-sets")


class _Checker:
    """Checks pairs of sets by exact intersection; sets made for one round serve the next ones."""

    def __init__(self, docs: DataFrame, first: DataFrame):
        self.docs, self.first, self.sets = docs, first, None

    def sets_of(self, keys: DataFrame) -> DataFrame:
        """(key, grams) with the sets named in ``keys`` at least."""
        if self.sets is None:
            self.sets = _sets_of(self.docs, self.first, keys)
        else:
            new = landed(self.docs.sparkSession, keys.join(self.sets.select("key"), "key", "left_anti"), "near-new")
            if not new.isEmpty():
                self.sets = self.sets.unionByName(_sets_of(self.docs, self.first, new))
        return self.sets

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of set names that link."""
        sets = self.sets_of(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))))
        joined = (pairs.join(sets.select(F.col("key").alias("b"), F.col("grams").alias("set_b")).hint("merge"), "b")
                  .join(sets.select(F.col("key").alias("a"), F.col("grams").alias("set_a")).hint("merge"), "a"))
        return landed(self.docs.sparkSession, joined.select("a", "b", "set_a", "set_b").mapInArrow(_verified, "a bigint, b bigint"),
                      "near-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of (doc_id, text).

    Words are separated by blanks, A-Z lower-cased; a set holds the distinct shingles of five
    words, or the whole sequence of a shorter text. Sets of Jaccard similarity 0.75 or more
    link; ``component_id`` is the smallest doc_id reachable by links. A null, empty or blank
    text has an empty set and links with nothing: it is its own component. Rows that repeat an
    id are compared each for itself. A row without an id is compared too, and names a component
    only if none of its rows has an id, when component_id is null. Empty tables give no rows.
    """
    spark = docs.sparkSession
    described, described_path = landed_path(spark, describe_sets(docs, sketch_levels(docs)), "near-described")
    # What the end needs of every row, without prefixes and bitmaps.
    ids = landed(spark, described.select("doc_id", "n", "key"), "near-ids")
    first = landed(spark, described.where("prefix IS NOT NULL").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("_d")).select("key", F.col("_d.doc_id").alias("_id")), "near-first")
    postings = described.where("prefix IS NOT NULL").select(F.explode("prefix").alias("token"), "n", "key")
    shared, shared_path = landed_path(spark, postings.repartition("token").sortWithinPartitions("token", "n", "key")
                                      .mapInArrow(_lead, "token bigint, n bigint, key bigint, leader bigint, leader_n bigint"), "near-shared")
    bits, bits_path = landed_path(spark, described.where("bits IS NOT NULL").join(shared.select("key").distinct(), "key", "left_semi")
                                  .groupBy("key").agg(F.first("bits").alias("bits")), "near-bits")
    remove_path(spark, described_path)

    stars = shared.where("key <> leader").select(F.col("leader").alias("a"), F.col("key").alias("b"),
                                                 F.col("leader_n").alias("na"), F.col("n").alias("nb")).distinct()
    stars = (stars.join(bits.select(F.col("key").alias("b"), F.col("bits").alias("bits_b")).hint("merge"), "b")
             .join(bits.select(F.col("key").alias("a"), F.col("bits").alias("bits_a")).hint("merge"), "a"))
    stars = landed(spark, stars.select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(_allowed, "a bigint, b bigint"), "near-stars")
    checker = _Checker(docs, first)
    final = landed(spark, components(checker.linked(stars)), "near-labels")
    tiles, tiles_path = shared.select("token", "n", "key"), shared_path

    def still_open(tiles: DataFrame, tiles_path: str) -> tuple[DataFrame, str]:
        """The tiles whose sets are not all in one component, with labels; the former table is used up."""
        labels = final.withColumnRenamed("node", "key")
        known, known_path = landed_path(spark, tiles.join(labels, "key", "left").select("token", "n", "key", F.coalesce("label", "key").alias("label")), "near-known")
        remove_path(spark, tiles_path)
        still = known.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
        left = landed_path(spark, known.join(landed(spark, still, "near-open"), "token", "left_semi"), "near-open-tiles")
        remove_path(spark, known_path)
        return left

    def joined_by(links: DataFrame) -> DataFrame:
        """The labels after further links; those so far stand for the links found before."""
        so_far = final.select(F.col("node").alias("a"), F.col("label").alias("b"))
        return landed(spark, components(so_far.unionByName(links)), "near-labels")

    def compared(entered: DataFrame, work, ddl: str) -> DataFrame:
        rows = _in_parts(entered, "token", TILE_SETS).join(bits.hint("merge"), "key")
        return (rows.select("tile", "cross", "part", "n", "key", "label", "bits").repartition("tile").sortWithinPartitions("tile", "n", "key")
                .mapInArrow(work, ddl))

    for pick, most in ROUNDS:
        known, tiles_path = still_open(tiles, tiles_path)
        tiles = known.select("token", "n", "key")
        entered = landed(spark, known.groupBy("key", "n", "label").agg(F.expr(f"{pick}(token)").alias("token")), "near-entered")
        pairs = landed(spark, compared(entered, _few_pairs(most), "a bigint, b bigint").distinct(), "near-pairs")
        if pairs.isEmpty():
            continue
        final = joined_by(checker.linked(pairs))

    known, tiles_path = still_open(tiles, tiles_path)
    alike = landed(spark, compared(known, _resembling, "a bigint, b bigint").distinct(), "near-alike")
    remove_path(spark, tiles_path)
    remove_path(spark, bits_path)
    if not alike.isEmpty():
        groups = landed(spark, components(alike).withColumnsRenamed({"node": "key", "label": "grp"}), "near-groups")
        sets = checker.sets_of(groups.select("key"))
        members = _in_parts(groups, "grp", GROUP_SETS).withColumn("label", F.lit(0)).join(sets.hint("merge"), "key")
        links_found = (members.select("tile", "cross", "part", "key", "label", "grams").repartition("tile").sortWithinPartitions("tile", "key")
                       .mapInArrow(_linked_in_groups, "a bigint, b bigint"))
        final = joined_by(landed(spark, links_found, "near-links"))

    final = final.withColumnRenamed("node", "key")
    keys = ids.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    keys = landed(spark, keys.join(final, "key", "left").select("key", "least", F.coalesce("label", "key").alias("label")), "near-keys")
    least = keys.groupBy("label").agg(F.min("least").alias("component_id"))
    named = landed(spark, keys.join(least, "label").select("key", "component_id"), "near-named")
    joined = ids.join(named, "key", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: the one whose id names it, with its columns as they were.

    Of rows that repeat that id all stay; rows without an id stay where they are alone.
    """
    # Columns but these two go by other names meanwhile, so none can clash.
    rows = docs.toDF(*[c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(docs.columns)])
    groups = near_duplicates(rows)
    least = landed(docs.sparkSession, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_id")).distinct(), "near-kept")
    kept = rows.join(least.hint("merge"), rows.doc_id.cast("bigint").eqNullSafe(F.col("_id")), "left_semi")
    return kept.toDF(*docs.columns)
