"""Exact dedup against history by a minimal perfect hash.

The distinct digests of earlier loads are dealt to shards by hash. A shard is one row: the
levels of a minimal perfect hash over its digests, and slots that hold each full digest with
its winner and count. A new load is reduced to its distinct digests, dealt the same way, and
each digest is looked up in its shard: the hash names a slot for any digest, and only a slot
whose 32 bytes are the same makes it a member. Members join the slot's group; nonmembers form
groups of their own.

Shards hold distinct digests only, and their number follows the larger side, so a group of
copies of any size costs one digest, and no task holds more than a few shards. Only narrow
rows (id, digest) are joined back to groups, by a join whose hot partitions Spark may split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from turnwise.llm.text import lower_ascii, mix64
from turnwise.session import landed

KEYS_PER_SHARD = 1024
GAMMA = 2.0

INDEX_DDL = ("shard bigint, sizes array<bigint>, bits binary, digests binary, "
             "winners binary, known binary, counts binary")
# An id travels through pandas beside a flag that tells whether there is one: a column with a gap
# would turn into doubles there, which do not hold large ids.
GROUP_DDL = "digest binary, keep_id bigint, known boolean, group_size bigint, member boolean"


def text_digest(text: Column) -> Column:
    """SHA-256 bytes of the text with A-Z lower-cased; a null text counts as empty."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(digests[:, :16]).view("<u8")
    return words[:, 0].copy(), words[:, 1].copy()


def _place(halves, level: int, size: int) -> np.ndarray:
    a, b = halves
    return (mix64(a + np.uint64(level) * (b | np.uint64(1))) % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits and each digest's slot, 0 to n-1 without gaps; digests are distinct.

    At each level the digests that land on a bit alone take it; the others go on.
    """
    levels, slots = [], np.full(len(digests), -1, dtype=np.int64)
    left, base = np.arange(len(digests)), 0
    while len(left):
        size = max(1, int(np.ceil(GAMMA * len(left))))
        place = _place(_halves(digests[left]), len(levels), size)
        taken = np.bincount(place, minlength=size) == 1
        alone = taken[place]
        slots[left[alone]] = base + (np.cumsum(taken) - 1)[place[alone]]
        base += int(alone.sum())
        left = left[~alone]
        levels.append(taken)
    return levels, slots


def find_slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The slot of each digest; any slot, or -1, for one that is not in the hash."""
    slots = np.full(len(digests), -1, dtype=np.int64)
    left, base = np.arange(len(digests)), 0
    for level, taken in enumerate(levels):
        if not len(left):
            break
        place = _place(_halves(digests[left]), level, len(taken))
        hit = taken[place]
        slots[left[hit]] = base + (np.cumsum(taken) - 1)[place[hit]]
        base += int(taken.sum())
        left = left[~hit]
    return slots


def _digest_array(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, 32)


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = _digest_array(pdf["digest"])
    levels, slots = build_hash(digests)
    order = np.argsort(slots)
    return pd.DataFrame([{
        "shard": int(pdf["shard"].iloc[0]), "sizes": [len(x) for x in levels],
        "bits": np.packbits(np.concatenate(levels)).tobytes(), "digests": digests[order].tobytes(),
        "winners": pdf["keep_id"].to_numpy(dtype=np.int64)[order].tobytes(),
        "known": pdf["known"].to_numpy(dtype=bool)[order].tobytes(), "counts": pdf["group_size"].to_numpy(dtype=np.int64)[order].tobytes(),
    }])


def _merge_shard(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    columns = ["digest", "keep_id", "known", "group_size", "member"]
    fresh = batch.assign(member=False)[columns]
    if index.empty:
        return fresh
    row = index.iloc[0]
    bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8)).astype(bool)
    ends = np.cumsum(row["sizes"])
    levels = [bits[e - s: e] for s, e in zip(row["sizes"], ends)]
    held = np.frombuffer(row["digests"], dtype=np.uint8).reshape(-1, 32)
    winners = np.frombuffer(row["winners"], dtype=np.int64).copy()
    known = np.frombuffer(row["known"], dtype=bool).copy()
    counts = np.frombuffer(row["counts"], dtype=np.int64).copy()
    hit = np.zeros(len(held), dtype=bool)
    if len(batch):
        digests = _digest_array(batch["digest"])
        slots = find_slots(levels, digests)
        member = slots >= 0
        member[member] = (held[slots[member]] == digests[member]).all(axis=1)
        at = slots[member]
        new, given = batch["keep_id"].to_numpy(dtype=np.int64)[member], batch["known"].to_numpy(dtype=bool)[member]
        better = given & (~known[at] | (new > winners[at]))
        winners[at[better]], known[at[better]] = new[better], True
        counts[at] += batch["group_size"].to_numpy(dtype=np.int64)[member]
        hit[at] = True
        fresh = fresh[~member]
    old = pd.DataFrame({"digest": [bytes(x) for x in held], "keep_id": winners, "known": known, "group_size": counts, "member": hit})
    return old if fresh.empty else pd.concat([old, fresh])


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: its largest id and its number of rows, combined before the shuffle."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumns({"shard": F.pmod(F.xxhash64("digest"), F.lit(shards)), "known": F.col("keep_id").isNotNull(),
                               "keep_id": F.coalesce("keep_id", F.lit(0).cast("bigint"))})


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """The index of ``digest_groups``: one row per shard."""
    return _sharded(groups, shards).groupBy("shard").applyInPandas(_build_shard, INDEX_DDL)


def merge_groups(index: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """Groups of history and a new load together: (digest, keep_id, group_size, member).

    ``member`` is true where the load repeats a digest of the index.
    """
    merged = (index.groupBy("shard").cogroup(_sharded(batch, shards).groupBy("shard"))
              .applyInPandas(_merge_shard, GROUP_DDL))
    return merged.withColumn("keep_id", F.when(F.col("known"), F.col("keep_id"))).drop("known")


def dedup_against_history(history: DataFrame, batch: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """Groups of equal digests over two loads of (doc_id, digest), see :func:`merge_groups`."""
    old, new = digest_groups(history), digest_groups(batch)
    spark = history.sparkSession
    old, new = landed(spark, old, "exact-old"), landed(spark, new, "exact-new")
    shards = max(1, -(-max(old.count(), new.count()) // keys_per_shard))
    return merge_groups(landed(spark, build_index(old, shards), "exact-index"), new, shards)


def dedup(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """Exact duplicates of a table of (doc_id, text); other columns are ignored.

    The lower half of the id range is taken as the earlier load, the rest as the new one.
    Per row: doc_id, keep_id (largest id of the same text), group_size (rows), kept,
    text_sha256, and in_history (the text was in the earlier load and came again). Texts are
    equal if identical after lower-casing A-Z; null counts as empty. A null id never wins
    against a number; where all ids of a group are null, keep_id is null and all rows stay.
    Rows that repeat an id with the same text are one document and stay or go together. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = landed(spark, docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                     text_digest(F.col("text")).alias("digest")), "exact-rows")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if low is None else (low + high) // 2
    early = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    groups = landed(spark, dedup_against_history(rows.where(early), rows.where(~early), keys_per_shard),
                    "exact-groups")
    joined = rows.join(groups.hint("merge"), "digest")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"), F.col("member").alias("in_history"))
