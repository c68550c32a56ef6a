import hashlib
import zlib

import pytest

from turnwise.llm import merkle
from turnwise.llm.ranks import rank_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(digests):
    """(root, per leaf: siblings as (left, right) from the bottom up) by plain lists."""
    proofs, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i:i + 3] for i in range(0, len(digests), 3)]
        for leaf, i in enumerate(at):
            run = runs[i // 3]
            proofs[leaf].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        digests, at = [sha("".join(run)) for run in runs], [i // 3 for i in at]
    return digests[0], proofs


def brute(rows):
    groups = {}
    for row in rows:
        doc_id, text, lang, source, n_chars = row[:5]
        changed = text if text is None or doc_id is None or zlib.crc32(str(doc_id).encode()) % 2 else text.replace("\n", "")
        groups.setdefault(source, []).append((doc_id, leaf_of(doc_id, source, lang, n_chars, text), leaf_of(doc_id, source, lang, n_chars, changed)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for s in order}
    subs = {s: climb([r[1] for r in trees[s]]) for s in order}
    root, upper = climb([subs[s][0] for s in order]) if order else (None, [])
    out = []
    for s, tail in zip(order, upper):
        for (doc_id, leaf, changed), proof in zip(trees[s], subs[s][1]):
            folded = changed
            for left, right in proof + tail:
                folded = sha(left + folded + right)
            out.append((doc_id, leaf, subs[s][0], root, sha("".join(a + b for a, b in proof + tail)), folded, folded == root))
    return sorted(out, key=repr)


def run(spark, rows):
    return sorted([tuple(r) for r in merkle.verify_documents(spark.createDataFrame(rows, SCHEMA)).collect()], key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [27], [28], [82], [1, 1, 1, 1], [9, 10, 1, 730]])
def test_trees_of_many_sizes(spark, sizes):
    rows = [(i * 7919 % 10007, f"line {i}\nmore" if i % 3 else f"one {i}", "en", f"s{g}", i, "x", 1)
            for g, n in enumerate(sizes) for i in range(g * 1000, g * 1000 + n)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(not r[-1] for r in got) or len(got) < 20
    assert any(r[-1] for r in got) or len(got) < 20


def test_odd_rows(spark):
    rows = [(None, "a\nb", None, None, None, None, None), (None, "a\nb", None, None, None, None, None), (4, None, "en", None, 0, None, None),
            (4, "", "en", "", 0, None, None), (4, "\n\n", "en", "", 0, None, None), (2**60 + 7, "é\n" * 50000, "fr", "é", 100000, None, None),
            (2**60 + 9, "x", "de", "z", 1, None, None), (2**60 + 9, "x", "de", "z", 1, None, None), (-5, "neg\n", "de", "z", 4, None, None)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_group_of_equal_rows(spark):
    rows = [(7, "same\ntext", "en", "hot", 9, None, None)] * 400 + [(i, f"t{i}", "en", "s", 2, None, None) for i in range(100)]
    assert run(spark, rows) == brute(rows)


def test_nodes_are_nested_intervals(spark):
    rows = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 2}", 2, None, None) for i in range(200)], SCHEMA)
    proofs, records = merkle.manifest(rows, "source", "doc_id", merkle.digest_of([rows.text]))
    assert proofs.count() == 200
    nodes = merkle.nodes_of(records).where("tree = '=s0'").collect()
    by_label = {(n.lo, n.hi) for n in nodes}
    assert sum(n.hi - n.lo == 1 for n in nodes) >= 100
    for n in nodes:
        assert n.parent_lo <= n.lo < n.hi <= n.parent_hi and n.parent_hi <= 100
        assert (n.parent_lo, n.parent_hi) in by_label or (n.parent_lo, n.parent_hi) == (0, 100)
    family = {}
    for n in nodes:
        family.setdefault((n.parent_lo, n.parent_hi), []).append((n.lo, n.hi))
    for (lo, hi), children in family.items():
        # Of a chain of one-child families, several share a label; each covers its parent.
        assert min(c[0] for c in children) == lo and max(c[1] for c in children) == hi


def test_ranks_of_a_hot_group_are_spread(spark):
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', concat('g', id % 50)) AS g", "id % 10 AS k", "id")
    placed, groups = rank_rows(rows, "g", ["k", "id"], "test")
    got = {}
    for r in placed.collect():
        got.setdefault(r.g, []).append((r.k, r.id, r.pos, r["size"]))
    for g, members in got.items():
        members.sort()
        assert [m[2] for m in members] == list(range(len(members)))
        assert {m[3] for m in members} == {len(members)}
    assert {r.g: r["size"] for r in groups.collect()} == {g: len(m) for g, m in got.items()}
