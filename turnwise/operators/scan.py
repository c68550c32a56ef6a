"""Ordered running values per key, for keys of any size.

A plain ``Window.partitionBy(key).orderBy(...)`` puts a whole key into one task, and one
key may be a third of the table. Here every key is cut into *blocks* that follow the order
(a range of line numbers, a minute of time). The work inside a block is a window over
(key, block); what one block hands to the next is a summary row per block, built with
map-side partial aggregation. Only those summary rows are ever ordered per key, and their
number is bounded by the key's range of lines or time, not by its rows times their width.

Blocks are plain functions of the data, so a recomputed task after a lost executor
arrives at the same blocks.

There is one plan for keys of any size: no count decides on it beforehand. Blocks are wide
enough that ordinary keys have one or a few, and narrow enough that the largest has many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnwise.session import landed

LINES_PER_BLOCK = 65536
SECONDS_PER_BLOCK = 3600
BROADCAST_BYTES = 16 << 20


def line_block(line: Column, size: int = LINES_PER_BLOCK) -> Column:
    """Block of an integer line number that is unique within its key, named by its first line."""
    number = line.cast("bigint")
    return number - F.pmod(number, F.lit(size).cast("bigint"))


def time_block(ts: Column, seconds: int = SECONDS_PER_BLOCK) -> Column:
    """Block of an event time, named by its first microsecond."""
    return line_block(F.unix_micros(ts.cast("timestamp")), seconds * 1_000_000)


# Stand-ins for null keys, so that those rows form a key of their own instead of being lost
# in the join below, and the plan carries no null checks that would keep its shuffles apart.
_NULL_STAND_INS = {"string": "\x00", "bigint": -(2**63), "int": -(2**31)}


def solid_keys(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """``_k0, _k1, ...``: the keys with nulls replaced by a value no real key has."""
    types = dict(df.dtypes)
    out = {}
    for i, key in enumerate(keys):
        kind = types[key] if types[key] in _NULL_STAND_INS else "string"
        out[f"_k{i}"] = F.coalesce(F.col(key).cast(kind), F.lit(_NULL_STAND_INS[kind]).cast(kind))
    return out


def blocked_scan(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    prev: Mapping[str, str] | None = None,
    pieces_of: str | None = None,
) -> DataFrame:
    """Add inclusive running sums and previous-row values per key.

    ``sums`` maps an output name to the number summed over the key's rows up to and
    including this one; ``prev`` maps an output name to the column whose value is taken from
    the row before. ``order`` must be a total order within the key, and ``block`` must rise
    with its first column. The input columns and all rows are kept.

    Rows come out partitioned by block and key. For grouping them by key and the running sum
    ``pieces_of`` without another shuffle, the columns ``_block`` and ``_k0, _k1, ...`` are kept
    then, and ``_edge`` tells the rows whose group may go on in a neighbouring block.
    """
    sums, prev = dict(sums or {}), dict(prev or {})
    kept = df.columns
    solid = solid_keys(df, keys)
    by = list(solid)
    rows = df.withColumns({**solid, **{f"_v_{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()}})
    rows = rows.withColumn("_block", F.coalesce(block, F.lit(-(2**63))))

    inside = Window.partitionBy("_block", *by).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"_l_{n}": F.sum(f"_v_{n}").over(upto) for n in sums}
    local.update({f"_q_{n}": F.lag(c).over(inside) for n, c in prev.items()})
    if prev:
        local["_at"] = F.row_number().over(inside)

    totals = [F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    # The leading order column is largest on a block's last row; others need a max_by.
    leading = [n for n, c in prev.items() if c == order[0]]
    others = {n: c for n, c in prev.items() if c != order[0]}
    totals += [F.max(order[0]).alias(f"_e_{n}") for n in leading]
    if others:
        last = F.max_by(F.struct(*[F.col(c).alias(n) for n, c in others.items()]), F.struct(*order))
        totals.append(last.alias("_last"))
    summary = rows.groupBy("_block", *by).agg(*totals)
    by_key = Window.partitionBy(*by).orderBy("_block")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in sums]
    carried += [F.lag(f"_e_{n}").over(by_key).alias(f"_b_{n}") for n in leading]
    carried += [F.lag("_last").over(by_key)[n].alias(f"_b_{n}") for n in others]
    if pieces_of:
        carried += [F.lag("_block").over(by_key).isNull().alias("_is_first"), F.lead("_block").over(by_key).isNull().alias("_is_last"),
                    F.col(f"_t_{pieces_of}").alias("_in_block")]
    carry = summary.select(*by, "_block", *carried)

    joined = rows.withColumns(local).join(carry, ["_block", *by])
    out = [F.col(c) for c in kept]
    out += [(F.col(f"_l_{n}") + F.col(f"_c_{n}")).alias(n) for n in sums]
    out += [F.when(F.col("_at") > 1, F.col(f"_q_{n}")).otherwise(F.col(f"_b_{n}")).alias(n) for n in prev]
    if pieces_of:
        local_sum = F.col(f"_l_{pieces_of}")
        edge = (~F.col("_is_first") & (local_sum == 0)) | (~F.col("_is_last") & (local_sum == F.col("_in_block")))
        out += [edge.alias("_edge"), F.col("_block"), *[F.col(k) for k in by]]
    return joined.select(*out)


def solid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null equals null, as grouping has it; the left's keys are kept."""
    a, b = left.withColumns(solid_keys(left, keys)), right.withColumns(solid_keys(right, keys)).drop(*keys)
    solid = [f"_k{i}" for i in range(len(keys))]
    return a.join(b, solid, how).drop(*solid)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **more: Column) -> DataFrame:
    """Rows per (keys, value) as ``_n``, with further aggregates: written once, read as often as needed."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in more.items()])
    return landed(df.sparkSession, counts, "value-counts")


def exact_percentiles(counts: DataFrame, keys: Sequence[str], value: str,
                      probs: Mapping[str, float], block_size: int = 1024) -> DataFrame:
    """Exact discrete percentiles of an integer column per key, without collecting a key.

    ``counts`` is a :func:`value_counts`; the running count goes over distinct values, in
    blocks of the value range. Missing values do not count.
    """
    keys = list(keys)
    counts = counts.where(F.col(value).isNotNull()).select(*keys, value, "_n")
    ranked = blocked_scan(counts, keys, line_block(F.col(value), block_size), [value],
                          sums={"_cum": F.col("_n")})
    sized = solid_join(ranked, counts.groupBy(*keys).agg(F.sum("_n").alias("_total")), keys)
    picks = [F.min(F.when(F.col("_cum") >= F.ceil(F.col("_total") * F.lit(p)), F.col(value))).alias(n)
             for n, p in probs.items()]
    return sized.groupBy(*keys).agg(*picks)


def lookup_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left",
                max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join facts to a lookup table with one row per key.

    The lookup is broadcast only if its values, written as JSON, are at most
    ``max_broadcast_bytes``; a row may be of any size. Beyond that it is a shuffle join whose
    skewed fact partitions AQE splits; the lookup side has one row per key, so no key is copied
    more than once per split.
    """
    size = dim.agg(F.sum(F.octet_length(F.to_json(F.struct(*dim.columns))))).first()[0] or 0
    return facts.join(F.broadcast(dim) if size <= max_broadcast_bytes else dim.hint("merge"), list(keys), how)
