"""Merkle manifest of a table: interval-labelled nodes, containment joins, proofs.

Rows are leaves; those of a group are ranked, and every three consecutive nodes become their
parent until one is left. A node is labelled with the interval of leaf ranks that it covers, so
an ancestor is a node whose interval contains another's, and the siblings of a node are its
parent's interval less its own.

Levels are bucketed by three. A *record* is one bucket: up to 27 neighbouring nodes of its
lowest level, kept as the families (a parent's interval and its children) of the next three
levels. Building a bucket of levels is one grouping of at most 27 rows a group; attaching the
ancestors is one join on (tree, bucket) per three levels, checked by containment, and runs from
the root down over records, each level bucket 27 times smaller than the one below. Leaves join
once, with narrow rows, and no tree, however large, is ever in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from turnwise.llm.ranks import rank_rows
from turnwise.session import landed

FAN, LEVELS = 3, 3
WIDTH = FAN**LEVELS
STEP = "array<struct<left:string,right:string>>"


def digest_of(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns: ``-`` for null, else byte count, ``:`` and value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hashed(children: Column) -> Column:
    """One parent's digest from its children's, as hex text."""
    return F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ""), 256)


FAMILIES = "array<struct<lo:bigint,hi:bigint,children:array<struct<lo:bigint,hi:bigint,digest:string>>>>"


def _family(nodes: str):
    def made(i: Column) -> Column:
        children = F.slice(F.col(nodes), i * FAN + 1, FAN)
        return F.struct(F.element_at(children, 1)["lo"].alias("lo"), F.element_at(children, -1)["hi"].alias("hi"), children.alias("children"))
    return made


def _with_families(grouped: DataFrame) -> DataFrame:
    """Adds ``families`` of three levels, and ``top``, over up to 27 sorted nodes ``_nodes0`` (lo, hi, digest).

    A level is built while its tree, of ``n`` nodes at the lowest level, has several nodes.
    """
    rows = grouped.withColumns({"families": F.array().cast(FAMILIES), "top": F.element_at("_nodes0", 1)["digest"]})
    for level in range(LEVELS):
        several, nodes = F.col("n") > F.lit(FAN**level), f"_nodes{level}"
        count = F.floor((F.size(nodes) - 1) / F.lit(FAN)).cast("int")
        rows = rows.withColumn("_made", F.transform(F.sequence(F.lit(0), count), _family(nodes)))
        rows = rows.withColumn(f"_nodes{level + 1}", F.transform(
            "_made", lambda f: F.struct(f["lo"].alias("lo"), f["hi"].alias("hi"), _hashed(f["children"]).alias("digest"))))
        rows = rows.withColumns({"families": F.when(several, F.concat("families", "_made")).otherwise(F.col("families")),
                                 "top": F.when(several, F.element_at(f"_nodes{level + 1}", 1)["digest"]).otherwise(F.col("top"))})
    return rows


def build_records(leaves: DataFrame, largest: int, label: str) -> list[DataFrame]:
    """One table of records per three levels, lowest first, of leaves (tree, pos, size, digest).

    Columns: tree, bucket, n (the tree's nodes at the lowest level), lo, hi, families, top.
    ``largest`` is the size of the largest tree.
    """
    out, scale = [], 1
    nodes = leaves.select("tree", "pos", F.col("size").alias("n"), F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"), "digest")
    while True:
        grouped = nodes.groupBy("tree", F.floor(F.col("pos") / F.lit(WIDTH)).alias("bucket")).agg(
            F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("_nodes0"))
        records = landed(leaves.sparkSession, _with_families(grouped).select(
            "tree", "bucket", "n", F.element_at("_nodes0", 1)["lo"].alias("lo"), F.element_at("_nodes0", -1)["hi"].alias("hi"),
            "families", "top"), f"{label}-records")
        out.append(records)
        scale *= WIDTH
        if scale >= largest:
            return out
        nodes = records.where(F.col("n") > WIDTH).select(
            "tree", F.col("bucket").alias("pos"), F.ceil(F.col("n") / F.lit(WIDTH)).alias("n"), "lo", "hi", F.col("top").alias("digest"))


def roots(records: Sequence[DataFrame]) -> DataFrame:
    """(tree, root): the top of the one record that each tree ends in."""
    ends = [r.where(F.col("n") <= WIDTH).select("tree", F.col("top").alias("root")) for r in records]
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return out


def nodes_of(records: Sequence[DataFrame]) -> DataFrame:
    """All labelled nodes but the roots: (tree, lo, hi, digest, parent_lo, parent_hi)."""
    out = None
    for r in records:
        rows = r.select("tree", F.explode("families").alias("f")).select(
            "tree", F.col("f.lo").alias("parent_lo"), F.col("f.hi").alias("parent_hi"), F.inline("f.children"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _steps(lo: Column, hi: Column) -> Column:
    """The siblings on either side at each ancestor of [lo, hi) among the joined families, lowest first."""
    ancestors = F.filter("families", lambda f: (f["lo"] <= lo) & (hi <= f["hi"]))

    def beside(f: Column) -> Column:
        left = F.filter(f["children"], lambda c: c["hi"] <= lo)
        right = F.filter(f["children"], lambda c: c["lo"] >= hi)
        return F.struct(F.array_join(F.transform(left, lambda c: c["digest"]), "").alias("left"),
                        F.array_join(F.transform(right, lambda c: c["digest"]), "").alias("right"))
    return F.transform(ancestors, beside)


def attach_paths(leaves: DataFrame, records: Sequence[DataFrame], ends: DataFrame, label: str) -> DataFrame:
    """``leaves`` (tree, pos, ...) with ``path``: siblings (left, right) from the leaf's level up.

    ``ends`` (tree, tail, ...) has what follows at each tree's root; its other columns are added.
    """
    spark = leaves.sparkSession
    more = [c for c in ends.columns if c not in ("tree", "tail")]
    above = None
    for records_here in reversed(records):
        own = records_here.select("tree", "bucket", "n", "lo", "hi", "families")
        done = own.where(F.col("n") <= WIDTH).join(ends.hint("merge"), "tree").select("tree", "bucket", "families", "tail", *more)
        if above is not None:
            higher = above.select("tree", F.col("bucket").alias("_b"), F.col("families").alias("_f"), "tail", *more)
            going = own.where(F.col("n") > WIDTH).withColumn("_b", F.floor(F.col("bucket") / F.lit(WIDTH)))
            going = going.join(higher.hint("merge"), ["tree", "_b"])
            # What this record covers is a node of the record above it.
            steps = going.select("tree", "bucket", F.col("families").alias("_own"), F.col("_f").alias("families"), "lo", "hi", "tail", *more)
            done = done.unionByName(steps.select("tree", "bucket", F.col("_own").alias("families"),
                                                 F.concat(_steps(F.col("lo"), F.col("hi")), F.col("tail")).alias("tail"), *more))
        above = landed(spark, done, f"{label}-above")
    joined = leaves.withColumn("bucket", F.floor(F.col("pos") / F.lit(WIDTH))).join(above.hint("merge"), ["tree", "bucket"])
    return joined.withColumn("path", F.concat(_steps(F.col("pos"), F.col("pos") + 1), F.col("tail"))).drop("bucket", "families", "tail")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def manifest(rows: DataFrame, group: str, key: str, leaf: Column, carry: Sequence[Column] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves with proofs, and the records (see :func:`nodes_of`) of the groups' trees.

    A leaf row has ``key``, ``group``, what is to ``carry``, leaf, subroot (of its group), root (of
    all groups, ordered with null first), and path (siblings left and right, from the leaf to the
    root). Leaves ascend by key, null first, and by digest among equal keys; equal rows are
    leaves of their own. One leaf is its own subroot, one group's subroot is the root. An empty
    table has no leaves and no root.
    """
    spark = rows.sparkSession
    # The group's order is kept, with null first, and null is a value like others.
    named = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
                        F.col(key).alias("_key"), leaf.alias("digest"), *carry)
    ranked, groups = rank_rows(named, "tree", ["_key", "digest"], "merkle-leaves")
    largest = groups.agg(F.max("size")).first()[0] or 1
    records = build_records(ranked, largest, "merkle")
    subroots = landed(spark, roots(records), "merkle-subroots")

    over = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_tree"), F.col("root").alias("digest"))
    over, whole = rank_rows(over, "tree", ["_tree"], "merkle-groups")
    upper = build_records(over, whole.agg(F.max("size")).first()[0] or 1, "merkle-groups")
    ends = roots(upper).withColumn("tail", F.array().cast(STEP))
    tops = attach_paths(over, upper, ends, "merkle-groups").select(
        F.col("_tree").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("tail"))
    proofs = attach_paths(ranked, records, landed(spark, tops, "merkle-tops"), "merkle")
    return (proofs.withColumn(group, F.when(F.col("tree") != "", F.substr("tree", F.lit(2)))).drop("tree", "pos", "size")
            .withColumnsRenamed({"_key": key, "digest": "leaf"}), records)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_text() -> Column:
    """The text without its newlines where 2 divides the CRC-32 of the decimal id."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(F.coalesce(even, F.lit(False)), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def verify_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` checked against a copy that was tampered with.

    Per row: doc_id, leaf, subroot, root, proof_sha256 (of all siblings, level by level), and
    folded_root and verified of the tampered leaf on the original siblings. Null fields are
    encoded apart from empty ones, a null id comes first and is not tampered with, rows that
    repeat an id are ordered by digest, columns but the five are ignored, an empty table gives no
    rows.
    """
    kept = docs.select(*FIELDS)
    changed = digest_of([F.col(c) for c in FIELDS[:-1]] + [tampered_text()])
    leaf = digest_of([F.col(c) for c in FIELDS])
    proofs, _ = manifest(kept, "source", "doc_id", leaf, [changed.alias("_changed")])
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                           fold(F.col("_changed"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
