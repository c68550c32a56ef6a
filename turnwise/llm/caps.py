"""Near duplicates of vectors by spherical-cap filters.

A filter is a direction; a vector is in it if their inner product exceeds a threshold, so a
filter's vectors lie in one cap of the sphere. Directions are a structured random product code:
after a random rotation the coordinates are cut into blocks, each block has a few random unit
words, and every combination of words is a direction. All directions that a vector exceeds are
listed by adding up the blocks' products with branch and bound, so they are never tried one by
one. Directions of one code lean together, so a vector may be in few of them; several codes, each
with a rotation of its own, even this out.

Vectors are joined on filters and verified there by cosine in double precision. Two vectors of
the wanted similarity share a filter with probability ``recall`` or more; what is found is exact.

* Equal vectors are one node from the start, with their number as weight.
* Threshold and number of directions follow from the number of vectors: a filter holds ``load``
  unrelated vectors on average, so vectors in filters of their own are dropped before any vector
  moves, and the others meet few strangers.
* A filter with many vectors is cut into parts of about ``TILE``, and pairs of parts are tiles
  of their own, so a dense group is spread over tasks. Its pairs stay inside the tiles: a pair
  counts in the first filter that both share, and a tile gives one row per vector, its weighted
  number of links and one link towards the others. Work on n vectors that are all similar but
  different grows with their pairs, since each one's number of links is asked for; none is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from turnwise.llm.graph import components, spanning
from turnwise.llm.text import release_memory
from turnwise.session import landed

SIMILARITY = 0.93
RECALL = 0.9999
LOAD = 4.0
TILE = 512
SMALL = 48
WORDS = 512
CODES = 16
CELLS_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 4096


class Code(NamedTuple):
    """A product code: rotation, words per block, bounds of the blocks, threshold."""

    rotation: np.ndarray
    words: list[np.ndarray]
    bounds: list[int]
    threshold: float


def _cap(dim: int, points: int = 200_001) -> tuple[np.ndarray, np.ndarray]:
    """Heights from -1 to 1, and the share of the unit sphere above each."""
    x = np.linspace(-1, 1, points)
    density = (1 - x * x).clip(0) ** ((max(dim, 3) - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return x, above / above[0]


@lru_cache(maxsize=64)
def plan_filters(vectors: int, dim: int, similarity: float, recall: float, load: float) -> tuple[float, float]:
    """(threshold, number of directions) for a group of this many vectors of this dimension.

    A cap holds the share load / vectors of the sphere. Two vectors of the similarity share
    Poisson many filters; the number of directions makes their mean large enough.
    """
    x, above = _cap(dim)
    share = min(load / max(vectors, 1), 0.25)
    at = int(np.searchsorted(-above, -share))
    threshold = float(x[at])
    # The second vector's height is similarity * height + the rest in a random direction across.
    heights, weights = x[at:-1], above[at:-1] - above[at + 1:]
    step = max(1, len(heights) // 2000)
    heights, weights = heights[::step], np.add.reduceat(weights, np.arange(0, len(weights), step))
    across = np.sqrt(max(1 - similarity**2, 1e-12)) * np.sqrt((1 - heights**2).clip(1e-12))
    y, beyond = _cap(dim - 1)
    both = np.interp((threshold - similarity * heights) / across, y, beyond)
    chance = float((both * weights).sum() / weights.sum())
    return threshold, -np.log(1 - recall) / (share * max(chance, 1e-6))


@lru_cache(maxsize=8 * CODES)
def make_code(vectors: int, dim: int, similarity: float, recall: float, load: float, number: int = 0) -> Code:
    """One of the codes of a dimension; a function of its arguments only, so every task has the same."""
    threshold, directions = plan_filters(vectors, dim, similarity, recall, load)
    directions /= CODES
    blocks = min(max(1, int(np.ceil(np.log(max(directions, 2)) / np.log(WORDS)))), dim)
    count = max(2, int(np.ceil(directions ** (1 / blocks))))
    rng = np.random.default_rng([number, dim])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    bounds = [dim * k // blocks for k in range(blocks + 1)]
    words = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        drawn = rng.standard_normal((count, b - a))
        words.append(drawn / np.linalg.norm(drawn, axis=1, keepdims=True) / np.sqrt(blocks))
    return Code(rotation, words, bounds, threshold)


def list_decode(units: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of every direction of a code that a row's inner product exceeds; the best one if none."""
    turned = units @ code.rotation
    products = [turned[:, a:b] @ w.T for a, b, w in zip(code.bounds[:-1], code.bounds[1:], code.words)]
    best = np.stack([p.max(axis=1) for p in products])
    rest = np.concatenate([np.cumsum(best[::-1], axis=0)[::-1][1:], np.zeros((1, len(units)))])
    count = len(code.words[0])
    rows, names = [], []

    def expand(row: np.ndarray, name: np.ndarray, total: np.ndarray, level: int) -> None:
        if level == len(products):
            rows.append(row)
            names.append(name)
            return
        # Branches of this level are taken in slices, each to its end, so memory stays small.
        for at in range(0, len(row), max(1, CELLS_AT_ONCE // count)):
            r, n, t = (x[at:at + max(1, CELLS_AT_ONCE // count)] for x in (row, name, total))
            sums = t[:, None] + products[level][r]
            i, w = np.nonzero(sums + rest[level][r][:, None] >= code.threshold)
            if len(i):
                expand(r[i], n[i] * count + w, sums[i, w], level + 1)

    expand(np.arange(len(units)), np.zeros(len(units), dtype=np.int64), np.zeros(len(units)), 0)
    lone = np.flatnonzero(rest[0] + best[0] < code.threshold) if len(units) else np.zeros(0, dtype=np.int64)
    if len(lone):
        name = np.zeros(len(lone), dtype=np.int64)
        for p in products:
            name = name * count + p[lone].argmax(axis=1)
        rows.append(lone)
        names.append(name)
    return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(names or [np.zeros(0, np.int64)])


def _described(kind: np.dtype):
    """Of (id, vector, group): id, group, vector bytes and a 16-byte name of (group, vector).

    Name and bytes are null where the row links with nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, groups = batch.columns
            names, held = [], []
            lists = vectors.cast(pa.large_list(pa.float64()))
            ends = lists.offsets.to_numpy()
            values = lists.values
            gaps = values.is_null().to_numpy(zero_copy_only=False)
            numbers = np.asarray(values.fill_null(0.0), dtype=np.float64)
            for k, (there, group) in enumerate(zip(lists.is_valid().to_pylist(), groups.to_pylist())):
                a, b = int(ends[k]), int(ends[k + 1])
                x = numbers[a:b]
                if not there or group is None or gaps[a:b].any() or not np.isfinite(x).all() or not x.any():
                    names.append(None)
                    held.append(None)
                    continue
                raw = (x + 0.0).astype(kind).tobytes()  # + 0.0: minus zero is zero
                held.append(raw)
                names.append(hashlib.blake2b(group.encode() + b"\x00" + raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([ids, groups, pa.array(held, pa.binary()), pa.array(names, pa.binary())],
                                             names=["vec_id", "grp", "vec", "name"])
    return run


def units_of(raw: list[bytes], kind: np.dtype) -> np.ndarray:
    """Unit vectors in double precision, whatever the numbers' magnitude."""
    x = np.frombuffer(b"".join(raw), dtype=kind).astype(np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _decoded(kind: np.dtype, largest: int, settings: tuple):
    """Of (rep, grp, vec): (grp, dim, direction, rep) for each filter of a vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, groups = batch.column(0).to_numpy(), batch.column(1)
            raw = batch.column(2).to_pylist()
            dims = np.array([len(r) // kind.itemsize for r in raw], dtype=np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                units = units_of([raw[i] for i in at], kind)
                for number in range(CODES):
                    row, name = list_decode(units, make_code(largest, int(dim), *settings, number))
                    row = at[row]
                    yield pa.RecordBatch.from_arrays([groups.take(pa.array(row)), pa.array(dims[row]), pa.array(name * CODES + number), pa.array(reps[row])],
                                                     names=["grp", "dim", "direction", "rep"])
        release_memory()
    return run


class Tiles(NamedTuple):
    """Rows of whole tiles, in order: filter, parts of the tile, own part, and the vector's row."""

    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    part: np.ndarray
    rep: np.ndarray
    weight: np.ndarray
    group: np.ndarray
    units: np.ndarray
    cells: list[np.ndarray]


def _met_before(t: Tiles, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether both vectors of a pair also share an earlier filter."""
    width = max(len(c) for c in t.cells)
    own = np.zeros((len(t.cells), width), dtype=np.int64)
    there = np.zeros((len(t.cells), width), dtype=bool)
    for k, c in enumerate(t.cells):
        c = c[c < t.cell[k]]
        own[k, : len(c)], there[k, : len(c)] = c, True
    out = np.zeros(len(i), dtype=bool)
    step = max(1, CELLS_AT_ONCE // (width * width))
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        same = (own[a][:, :, None] == own[b][:, None, :]) & there[a][:, :, None] & there[b][:, None, :]
        out[at:at + step] = same.any(axis=(1, 2))
    return out


def _dense_links(t: Tiles, a: int, b: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one large tile, rows a to b, that meet here first."""
    units, part = t.units[a:b], t.part[a:b]
    linked = np.triu(units @ units.T >= similarity, 1)
    linked &= t.group[a:b][:, None] == t.group[a:b][None, :]
    if t.low[a] != t.high[a]:
        linked &= part[:, None] != part[None, :]
    earlier = [c[c < t.cell[a]] for c in t.cells[a:b]]
    names, column = np.unique(np.concatenate(earlier), return_inverse=True)
    row = np.repeat(np.arange(b - a), [len(c) for c in earlier])
    for at in range(0, len(names), 1024):
        some = (column >= at) & (column < at + 1024)
        marks = np.zeros((b - a, min(1024, len(names) - at)), dtype=np.float32)
        marks[row[some], column[some] - at] = 1
        linked &= marks @ marks.T == 0
    i, j = np.nonzero(linked)
    return i + a, j + a


def links_of(t: Tiles, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that link and meet in this filter first, over tiles of any size."""
    begins = np.flatnonzero(np.r_[True, (t.cell[1:] != t.cell[:-1]) | (t.low[1:] != t.low[:-1]) | (t.high[1:] != t.high[:-1])])
    ends = np.r_[begins[1:], len(t.cell)]
    found = []
    for a, b in zip(begins, ends):
        if b - a > SMALL:
            found.append(_dense_links(t, a, b, similarity))
    sizes = ends - begins
    few = sizes <= SMALL
    last = np.repeat(ends, sizes)
    partners = np.where(np.repeat(few, sizes), last - np.arange(len(t.cell)) - 1, 0)
    upto = np.concatenate([[0], np.cumsum(partners)])
    step, at = max(1, CELLS_AT_ONCE // t.units.shape[1]), 0
    while at < len(t.cell):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] + step, side="right")) - 1)
        i = np.repeat(np.arange(at, stop), partners[at:stop])
        j = i + 1 + np.arange(len(i)) - np.repeat(upto[at:stop] - upto[at], partners[at:stop])
        asked = (t.group[i] == t.group[j]) & ((t.low[i] == t.high[i]) | (t.part[i] != t.part[j]))
        i, j, at = i[asked], j[asked], stop
        linked = np.einsum("ij,ij->i", t.units[i], t.units[j]) >= similarity
        i, j = i[linked], j[linked]
        if len(i):
            new = ~_met_before(t, i, j)
            found.append((i[new], j[new]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _verified(kind: np.dtype, similarity: float):
    """Of tile rows, sorted by tile: (rep, root, links), one row per vector that links in its tile."""
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        raw = table.column("vec").to_pylist()
        dims = np.array([len(r) for r in raw])
        cells = [np.asarray(c, dtype=np.int64) for c in table.column("cells").to_pylist()]
        columns = {c: table.column(c).to_numpy() for c in ("cell", "low", "high", "part", "rep", "weight")}
        groups = np.array(table.column("grp").to_pylist(), dtype=object)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            t = Tiles(**{c: v[at] for c, v in columns.items()}, group=groups[at],
                      units=units_of([raw[k] for k in at], kind), cells=[cells[k] for k in at])
            i, j = links_of(t, similarity)
            if not len(i):
                continue
            degree = np.bincount(i, t.weight[j], len(at)) + np.bincount(j, t.weight[i], len(at))
            root = spanning(len(at), i, j)
            some = np.flatnonzero(degree > 0)
            yield pa.RecordBatch.from_arrays([pa.array(t.rep[some]), pa.array(t.rep[root[some]]), pa.array(degree[some].astype(np.int64))],
                                             names=["rep", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not len(batch):
                continue
            waiting.append(batch)
            rows += len(batch)
            if rows < ROWS_AT_ONCE:
                continue
            table = pa.Table.from_batches(waiting)
            tile = [table.column(c).to_numpy() for c in ("cell", "low", "high")]
            same = np.all([c == c[-1] for c in tile], axis=0)
            # The last tile may go on; it starts after the last row of another one.
            cut = len(table) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield from work(table.slice(0, cut))
            waiting, rows = table.slice(cut).to_batches(), len(table) - cut
        if waiting:
            yield from work(pa.Table.from_batches(waiting))
        release_memory()
    return run


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str = "label",
                 similarity: float = SIMILARITY, recall: float = RECALL, load: float = LOAD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (key, vector, group).

    Rows link if their groups are equal and not null, their vectors have the same length, and
    their cosine, in double precision, is at least ``similarity``. ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest id reachable by links, ``kept`` tells
    whether it is the row's own. A vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing and is its own component. Equal vectors are linked
    in any case. Rows that repeat an id are compared each for itself; a row without an id counts
    as a link, and names a component only if none of its rows has an id, when component_id is
    null. Other columns are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    element = table.schema[vector].dataType
    kind = np.dtype("<f4" if isinstance(element, ArrayType) and isinstance(element.elementType, FloatType) else "<f8")
    rows = table.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("vec"), F.col(group).cast("string").alias("grp"))
    rows = landed(spark, rows.mapInArrow(_described(kind), "vec_id bigint, grp string, vec binary, name binary"), "caps-rows")
    reps = rows.where("name IS NOT NULL").groupBy("name").agg(
        F.first("grp").alias("grp"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
    reps = landed(spark, reps.withColumn("rep", F.monotonically_increasing_id()), "caps-nodes")
    largest = reps.groupBy("grp", F.octet_length("vec")).count().agg(F.max("count")).first()[0] or 1

    # Vectors in filters of their own have no partner there; only the others go on.
    settings = (similarity, recall, load)
    postings = reps.select("rep", "grp", "vec").mapInArrow(
        _decoded(kind, int(largest), settings), "grp string, dim bigint, direction bigint, rep bigint")
    postings = landed(spark, postings.select(F.xxhash64("grp", "dim", "direction").alias("cell"), "rep"), "caps-filters")
    busy = postings.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = landed(spark, postings.join(busy.hint("merge"), "cell"), "caps-shared")

    parts = F.ceil(F.col("n") / F.lit(tile)).cast("bigint")
    vectors = reps.join(shared.groupBy("rep").agg(F.sort_array(F.collect_list("cell")).alias("cells")).hint("merge"), "rep")
    entries = (shared.withColumn("part", F.pmod(F.xxhash64("rep", F.lit(3)), parts))
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
               .select("cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "rep"))
    tiles = entries.join(vectors.hint("merge"), "rep").select(
        "cell", "low", "high", "part", "rep", "weight", "grp", "vec", "cells")
    found = (tiles.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "part", "rep")
             .mapInArrow(_verified(kind, similarity), "rep bigint, root bigint, links bigint"))
    found = landed(spark, found, "caps-found")

    labels = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct())
    degrees = found.groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = (reps.select("name", "rep", "weight", "least").join(labels.withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
             .join(degrees.hint("merge"), "rep", "left")
             .select("name", "least", F.coalesce("label", "rep").alias("label"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    nodes = landed(spark, nodes, "caps-labels")
    named = nodes.join(nodes.groupBy("label").agg(F.min("least").alias("component_id")).hint("merge"), "label")
    joined = rows.select("vec_id", "name").join(named.select("name", "n_links", "component_id").hint("merge"), "name", "left")
    component = F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
