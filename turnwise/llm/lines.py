"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

The exact side is two tables. ``refs`` holds one row per (line key, document); ``counts``
one row per key: in how many documents it stands and the largest of their ids. Keys are dealt
to shards by their digest, and each shard has a cuckoo filter of all its counted keys. A new
load is reduced to distinct keys with counts before it moves; a key its filter does not know
is new and skips the exact table, a key it may know is looked up there. Deleting documents
subtracts their references; a key without any left also leaves its filter. Inserting and then
deleting documents therefore restores the counts.

A shard sees each distinct key once, and the number of shards follows the number of keys, so
a line that stands in a third of all documents is one key here. It is many rows only in
``refs``, whose join with the counts is a merge join of two tables, which Spark may split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from turnwise.llm.text import BLANKS, lower_ascii, mix64
from turnwise.session import landed

MIN_CHARS = 20
MIN_DOCS = 3
KEYS_PER_SHARD = 2048
SLOTS = 4
MAX_KICKS = 500

FILTER_DDL = "shard bigint, buckets bigint, seed bigint, cells binary"
# How far shards may fill up before they are dealt anew.
FULL = 3
# Beside an id stands whether there is one: pandas would turn a column with a gap into doubles.
PROBE_DDL = "digest binary, n_docs bigint, keep_id bigint, known boolean, maybe boolean"
REF_DDL = "digest binary, doc_id bigint, n bigint"


class CuckooFilter:
    """Four 16-bit fingerprints a bucket; a key may sit in either of two buckets."""

    def __init__(self, buckets: int, seed: int = 0, cells: np.ndarray | None = None):
        self.buckets, self.seed = buckets, seed
        self.cells = np.zeros((buckets, SLOTS), dtype=np.uint16) if cells is None else cells

    @staticmethod
    def room_for(keys: int) -> int:
        return 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))

    def _marks(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.ascontiguousarray(digests).view("<u8")
        h = mix64(words[:, 0] + np.uint64(self.seed) * np.uint64(0x9E3779B97F4A7C15))
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = (h & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, one, one ^ self._shift(mark)

    def _shift(self, mark: np.ndarray) -> np.ndarray:
        return (mix64(mark.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        mark, one, two = self._marks(digests)
        return ((self.cells[one] == mark[:, None]) | (self.cells[two] == mark[:, None])).any(axis=1)

    def _settle(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Put each mark into a free slot of its bucket; returns which found none."""
        order = np.argsort(at, kind="stable")
        bucket = at[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rank = np.arange(len(bucket)) - np.repeat(first, np.diff(np.r_[first, len(bucket)]))
        nth_free = np.cumsum(self.cells[bucket] == 0, axis=1)
        fits = rank < nth_free[:, -1]
        slot = (nth_free[fits] == (rank[fits] + 1)[:, None]).argmax(axis=1)
        self.cells[bucket[fits], slot] = mark[order[fits]]
        return np.sort(order[~fits])

    def insert(self, digests: np.ndarray) -> bool:
        """Add keys that are not in yet; False if the filter is too full, which leaves it unusable."""
        if not len(digests):
            return True
        mark, one, two = self._marks(digests)
        left = self._settle(mark, one)
        if len(left):
            left = left[self._settle(mark[left], two[left])]
        rng = np.random.default_rng(self.seed)
        for key in left:
            wanted, at = mark[key], int(two[key])
            for _ in range(MAX_KICKS):
                free = np.flatnonzero(self.cells[at] == 0)
                if len(free):
                    self.cells[at, free[0]] = wanted
                    break
                slot = rng.integers(SLOTS)
                wanted, self.cells[at, slot] = self.cells[at, slot], wanted
                at ^= int(self._shift(np.array([wanted], dtype=np.uint16))[0])
            else:
                return False
        return True

    def delete(self, digests: np.ndarray) -> None:
        """Remove keys that are in."""
        for mark, one, two in zip(*self._marks(digests)):
            for bucket in (one, two):
                found = np.flatnonzero(self.cells[bucket] == mark)
                if len(found):
                    self.cells[bucket, found[0]] = 0
                    break

    @classmethod
    def of(cls, digests: np.ndarray) -> CuckooFilter:
        """A filter of these distinct keys; a failed build starts again with another seed and more room."""
        buckets, seed = cls.room_for(len(digests)), 0
        while True:
            made = cls(buckets, seed)
            if made.insert(digests):
                return made
            seed += 1
            buckets *= 1 + seed % 2

    def row(self, shard: int) -> dict:
        return {"shard": shard, "buckets": self.buckets, "seed": self.seed, "cells": self.cells.tobytes()}

    @classmethod
    def from_row(cls, row) -> CuckooFilter:
        cells = np.frombuffer(row["cells"], dtype=np.uint16).reshape(-1, SLOTS).copy()
        return cls(int(row["buckets"]), int(row["seed"]), cells)


def _digests(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, 16)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def line_refs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(digest, doc_id, n): the distinct long-enough line keys of each row, n = 1."""
    keys = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line_key),
                                     lambda key: F.length(key) >= min_chars))
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.explode(keys).alias("_key"))
            .select(F.substring(F.unhex(F.sha2(F.col("_key").cast("binary"), 256)), 1, 16).alias("digest"),
                    "doc_id", F.lit(1).cast("bigint").alias("n")))


@dataclass
class LineState:
    """``refs``, ``counts`` and ``filters`` as landed tables, the number of shards and of keys meant for each."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    keys_per_shard: int = KEYS_PER_SHARD


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards))


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("digest").agg(F.sum("n").alias("n_docs"), F.max("doc_id").alias("keep_id"))


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([CuckooFilter.of(_digests(pdf["digest"])).row(int(pdf["shard"].iloc[0]))])


def build_filters(counts: DataFrame, shards: int) -> DataFrame:
    return (counts.select("digest", _shard(shards).alias("shard")).groupBy("shard")
            .applyInPandas(_build_filter, FILTER_DDL))


def _probe(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    columns = ["digest", "n_docs", "keep_id", "known", "maybe"]
    if filters.empty or keys.empty:
        return keys.assign(maybe=False)[columns]
    maybe = CuckooFilter.from_row(filters.iloc[0]).contains(_digests(keys["digest"]))
    return keys.assign(maybe=maybe)[columns]


def probe(state: LineState, keys: DataFrame) -> DataFrame:
    """Distinct counted ``keys`` with ``maybe``: False proves that the state does not hold the key."""
    sharded = keys.select("digest", "n_docs", F.coalesce("keep_id", F.lit(0).cast("bigint")).alias("keep_id"),
                          F.col("keep_id").isNotNull().alias("known"), _shard(state.shards).alias("shard"))
    probed = state.filters.groupBy("shard").cogroup(sharded.groupBy("shard")).applyInPandas(_probe, PROBE_DDL)
    return probed.select("digest", "n_docs", F.when(F.col("known"), F.col("keep_id")).alias("keep_id"), "maybe")


def _renew(filters: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """Insert new keys into a shard's filter and delete keys that are gone."""
    if changes.empty:
        return filters[["shard", "buckets", "seed", "cells"]]
    shard = int(changes["shard"].iloc[0])
    add, drop = changes[changes["added"]], changes[~changes["added"]]
    if filters.empty:
        return pd.DataFrame([CuckooFilter.of(_digests(add["digest"])).row(shard)])
    made = CuckooFilter.from_row(filters.iloc[0])
    if len(drop):
        made.delete(_digests(drop["digest"]))
    room = int((made.cells != 0).sum()) + len(add) <= 0.85 * made.cells.size
    if len(add) and not (room and made.insert(_digests(add["digest"]))):
        return pd.DataFrame([{"shard": shard, "buckets": 0, "seed": 0, "cells": b""}])
    return pd.DataFrame([made.row(shard)])


def _renewed(state: LineState, changes: DataFrame, counts: DataFrame) -> DataFrame:
    """Filters after ``changes`` (digest, added); a shard that ran full is built again from ``counts``."""
    spark = counts.sparkSession
    done = landed(spark, state.filters.groupBy("shard").cogroup(
        changes.withColumn("shard", _shard(state.shards)).groupBy("shard")).applyInPandas(_renew, FILTER_DDL),
        "lines-filters")
    full = done.where("buckets = 0").select("shard")
    again = counts.withColumn("shard", _shard(state.shards)).join(full, "shard", "left_semi").select("digest")
    return landed(spark, done.where("buckets > 0").unionByName(build_filters(again, state.shards)), "lines-filters")


def _shards_for(keys: int, keys_per_shard: int) -> int:
    return max(1, -(-keys // keys_per_shard))


def _first_state(refs: DataFrame, keys_per_shard: int) -> LineState:
    spark = refs.sparkSession
    counts = landed(spark, _counted(refs), "lines-counts")
    shards = _shards_for(counts.count(), keys_per_shard)
    return LineState(refs, counts, landed(spark, build_filters(counts, shards), "lines-filters"), shards, keys_per_shard)


def build_state(docs: DataFrame, min_chars: int = MIN_CHARS, keys_per_shard: int = KEYS_PER_SHARD) -> LineState:
    """The state of a first load."""
    return _first_state(landed(docs.sparkSession, line_refs(docs, min_chars), "lines-refs"), keys_per_shard)


def _with_refs(state: LineState, more: DataFrame) -> LineState:
    """The state with more references.

    Keys that the filters prove new go to the counts as they are; only the others meet the exact
    counts. Shards are dealt anew once they hold ``FULL`` times the keys meant for them.
    """
    spark = more.sparkSession
    probed = landed(spark, probe(state, _counted(more)), "lines-probed")
    seen = probed.where("maybe").select("digest", F.col("n_docs").alias("_n"), F.col("keep_id").alias("_keep"))
    # Marked where the filter wrongly took a key for known: it is new to the exact counts.
    old = state.counts.join(seen, "digest", "full_outer").select(
        "digest", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n_docs"),
        F.greatest("keep_id", "_keep").alias("keep_id"), F.col("n_docs").isNull().alias("new"))
    fresh = probed.where("not maybe").select("digest", "n_docs", "keep_id", F.lit(True).alias("new"))
    counted = landed(spark, old.unionByName(fresh), "lines-counts")
    counts, keys = counted.drop("new"), counted.count()
    refs = state.refs.unionByName(more)
    if keys > FULL * state.shards * state.keys_per_shard:
        shards = _shards_for(keys, state.keys_per_shard)
        return LineState(refs, counts, landed(spark, build_filters(counts, shards), "lines-filters"), shards, state.keys_per_shard)
    filters = _renewed(state, counted.where("new").select("digest", F.lit(True).alias("added")), counts)
    return LineState(refs, counts, filters, state.shards, state.keys_per_shard)


def insert_docs(state: LineState, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineState:
    """The state with the lines of more documents; their ids are not in it yet."""
    return _with_refs(state, landed(docs.sparkSession, line_refs(docs, min_chars), "lines-more"))


def delete_docs(state: LineState, ids: DataFrame) -> LineState:
    """The state without the documents whose ``doc_id`` is in ``ids``."""
    spark = ids.sparkSession
    gone = ids.select("doc_id").distinct()
    touched = state.refs.join(gone, "doc_id", "left_semi").select("digest").distinct()
    touched = landed(spark, touched, "lines-touched")
    refs = landed(spark, state.refs.join(gone, "doc_id", "left_anti").select("digest", "doc_id", "n"), "lines-refs")
    again = landed(spark, _counted(refs.join(touched, "digest", "left_semi")), "lines-again")
    counts = landed(spark, state.counts.join(touched, "digest", "left_anti").unionByName(again), "lines-counts")
    lost = touched.join(again, "digest", "left_anti").withColumn("added", F.lit(False))
    return LineState(refs, counts, _renewed(state, lost, counts), state.shards, state.keys_per_shard)


def corpus_state(docs: DataFrame, min_chars: int = MIN_CHARS, keys_per_shard: int = KEYS_PER_SHARD) -> LineState:
    """The state of a whole table, loaded in two parts: the lower half of the id range, then the rest.

    So the filters of the first part prove most keys of the second one new.
    """
    refs = landed(docs.sparkSession, line_refs(docs, min_chars), "lines-refs")
    low, high = refs.agg(F.min("doc_id"), F.max("doc_id")).first()
    early = F.coalesce(F.col("doc_id") <= F.lit(0 if low is None else (low + high) // 2), F.lit(False))
    state = _with_refs(_first_state(refs.where(early), keys_per_shard), refs.where(~early))
    return LineState(refs, state.counts, state.filters, state.shards, keys_per_shard)


def drops(state: LineState, refs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, digests): the line keys that each document of ``refs`` loses.

    Keys of other documents than the state's pass its filters first; its own are all in it.
    """
    spark = refs.sparkSession
    often = state.counts.where(F.col("n_docs") >= min_docs).select("digest", "keep_id")
    if refs is not state.refs:
        keys = probe(state, _counted(refs)).where("maybe").select("digest")
        often = often.join(keys, "digest", "left_semi")
    often = landed(spark, often, "lines-often")
    lost = refs.join(often.hint("merge"), "digest").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return lost.groupBy("doc_id").agg(F.collect_set("digest").alias("_drop"))


def _cleaner(columns: list[str], at: int, min_chars: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blanks = BLANKS.encode()
        upper = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        for batch in batches:
            texts, lost = batch.column(at), batch.column(len(columns))
            out, total, gone = [], [], []
            for i in range(len(batch)):
                text = texts[i].as_buffer()
                text = b"" if text is None else text.to_pybytes()
                lines = text.split(b"\n")
                total.append(len(lines))
                if lost[i].is_valid:
                    drop = set(lost[i].as_py())
                    kept = []
                    for line in lines:
                        key = line.strip(blanks).translate(upper)
                        if len(key) < min_chars or len(key.decode("utf-8", "surrogatepass")) < min_chars \
                                or hashlib.sha256(key).digest()[:16] not in drop:
                            kept.append(line)
                    gone.append(len(lines) - len(kept))
                    # Without a line left the text is empty.
                    out.append(b"\n".join(kept))
                else:
                    gone.append(0)
                    out.append(text)
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays += [pa.array(out, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])
    return clean


def dedup_lines(docs: DataFrame, state: LineState | None = None, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with kept_text, n_lines and n_dropped added (and any columns of these names replaced).

    Without ``state`` the documents are the whole corpus and build it. A line is split off at
    \\n only; a null or empty text is one empty line. A line whose key (blanks stripped, A-Z
    lower-cased) has at least ``min_chars`` code points and stands in at least ``min_docs``
    documents goes, except in the largest doc_id that holds it, where all its copies stay.
    Every row counts as a document; rows that repeat an id are treated alike; a null id is
    never the largest unless all are null. A text that loses all lines becomes empty; other
    texts are kept byte for byte. Empty tables give no rows.
    """
    if state is None:
        state = corpus_state(docs, min_chars)
        refs = state.refs
    else:
        refs = landed(docs.sparkSession, line_refs(docs, min_chars), "lines-refs")
    marks = drops(state, refs, min_docs).withColumnRenamed("doc_id", "_id")
    kept = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    rows = docs.select(*kept).toDF(*[f"c{i}" for i in range(len(kept))])
    rows = rows.join(marks, F.col(f"c{kept.index('doc_id')}").cast("bigint").eqNullSafe(F.col("_id")), "left").drop("_id")
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate([dict(docs.dtypes)[c] for c in kept] + ["string", "bigint", "bigint"]))
    done = rows.mapInArrow(_cleaner(kept, kept.index("text"), min_chars), schema)
    return done.toDF(*kept, "kept_text", "n_lines", "n_dropped")
