"""The perfect hash, and exact dedup over two loads."""

import hashlib

import numpy as np

from turnwise.llm import exact


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        keys = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        levels, slots = exact.build_hash(keys)
        assert sorted(slots) == list(range(n))
        assert (exact.find_slots(levels, keys) == slots).all()


def brute(docs):
    def norm(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for d, t in docs:
        groups.setdefault(norm(t), []).append(d)
    out = []
    for d, t in docs:
        ids = groups[norm(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


DOCS = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 100000), (8, "X" * 100000), (9, "a b"),
        (9, "a b"), (None, "a b"), (None, "lone"), (None, "lone"), (-4, "only early"), (50, "late"), (51, "late")]


def run(spark, docs, **more):
    df = spark.createDataFrame([(d, t, b"d", 1) for d, t in docs], "doc_id bigint, text string, digest binary, keep_id int")
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.dedup(df, **more).collect()), key=repr)


def test_against_brute_force(spark):
    assert run(spark, DOCS) == brute(DOCS)
    many = [(i, f"text {i % 700}") for i in range(1500)]
    assert run(spark, many, keys_per_shard=50) == brute(many)


def test_empty(spark):
    assert run(spark, []) == []


def test_members(spark):
    old = spark.createDataFrame([(1, b"a" * 32), (2, b"b" * 32)], "doc_id bigint, digest binary")
    new = spark.createDataFrame([(3, b"b" * 32), (4, b"c" * 32), (5, b"c" * 32)], "doc_id bigint, digest binary")
    got = {bytes(r.digest)[:1]: (r.keep_id, r.group_size, r.member) for r in exact.dedup_against_history(old, new).collect()}
    assert got == {b"a": (1, 1, False), b"b": (3, 2, True), b"c": (5, 2, False)}


def test_large_ids_beside_missing_ones(spark):
    """Ids that a double does not hold, over several shards, with a missing id in each."""
    docs = [(2**60 + 2 * i + 1, f"text {i % 40}") for i in range(120)] + [(None, f"text {i}") for i in range(0, 60, 3)] + [(None, None)]
    docs += [(-(2**60) - i, f"text {i % 40}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = exact.dedup(df, keys_per_shard=5).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept or r.doc_id is None and r.keep_id is None, r.text_sha256) for r in got], key=repr) == brute(docs)
