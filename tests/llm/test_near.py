"""The Jaccard join against all pairs by brute force."""

import random
import re

import numpy as np
import pytest

from turnwise.llm import graph, near, queries


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    overlap = {}
    for rows in holders.values():
        for x in range(len(rows)):
            for y in range(x):
                pair = (rows[y], rows[x])
                overlap[pair] = overlap.get(pair, 0) + 1
    for (a, b), shared in overlap.items():
        if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def order(rows):
    return sorted(rows, key=repr)


def check(spark, docs):
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in docs], "doc_id bigint, text string, key string, n int")
    got = near.near_duplicates(df.repartition(3)).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute(docs))


def test_edges(spark):
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "a b c d e"), (8, "a b c d e f"),
                  (None, "a b c d e"), (None, "z z"), (9, "é è"), (9, "é è"), (10, "É è"), (11, "x " * 9000), (12, "x " * 50)])


@pytest.mark.parametrize("seed", [1, 2])
def test_borderline(spark, seed):
    """Chains of edits around the threshold, copies, a shared passage, and one large group of near copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=30))
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randrange(6, 120))
        for _ in range(rng.randrange(1, 6)):
            texts.append(" ".join(base))
            base = [rng.choice(words) if rng.random() < 0.03 else w for w in base]
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(40)]
    base = rng.choices(words, k=80)
    texts += [" ".join(base[: 70 + i % 10] + [f"tail{i}"]) for i in range(60)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts + texts[:7])))


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for n in (3, 200, 256, 257, 700, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for cut in (0, n // 8, n // 7, n // 4):
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**63, n // 12).astype(np.uint64)]))
            may = near.may_link([near.signature(a)], [near.signature(b)], np.array([len(a)]), np.array([len(b)]))[0]
            assert may or not near.links(a, b)
    far = [np.unique(rng.integers(0, 2**63, 600).astype(np.uint64)) for _ in range(2)]
    assert not near.may_link([near.signature(far[0])], [near.signature(far[1])], np.array([600]), np.array([600]))[0]


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100)] + [(200 + rng.randrange(80), 200 + rng.randrange(80)) for _ in range(60)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_links_of_one_task_need_no_rounds(spark, monkeypatch):
    """A task contracts what it holds: a long chain is settled as soon as it is read."""
    asked, settled = [], graph._settled
    monkeypatch.setattr(graph, "_settled", lambda edges: asked.append(1) or settled(edges))
    chain = spark.range(500).selectExpr("id AS a", "id + 1 AS b").coalesce(1)
    got = {r.node: r.label for r in graph.components(chain).collect()}
    assert got == dict.fromkeys(range(501), 0)
    assert len(asked) == 1


def test_empty(spark):
    assert near.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op4_near_duplicates"](spark, sf).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute(docs))


def _near_threshold(rng, copies, words=120, changed=4):
    """Copies of one text with a few words changed in each: some pairs link, most just fail to."""
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(copies):
        own = list(base)
        for at in rng.sample(range(words), changed):
            own[at] = f"c{k}x{at}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("parts", [False, True])
def test_groups_that_resemble_without_linking(spark, monkeypatch, parts):
    """Large tiles and groups, whole and cut into parts; no pair of a resembling group becomes a row."""
    if parts:
        monkeypatch.setattr(near, "TILE_SETS", 32)
        monkeypatch.setattr(near, "GROUP_SETS", 16)
        monkeypatch.setattr(near, "FEW", 8)
    rng = random.Random(11)
    docs = [(i, t) for i, t in enumerate(_near_threshold(rng, 90) + _near_threshold(rng, 60, 60, 2) + _near_threshold(rng, 80, 200, 12))]
    check(spark, docs)


def test_overlaps_are_exact(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200))).astype(np.uint64) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    for words in (1 << 22, 64):
        monkeypatch.setattr(near, "WORDS_AT_ONCE", words)
        got = near.overlaps(sets)
        off = ~np.eye(30, dtype=bool)
        assert (got[off] == want[off]).all()


def test_large_tiles_pass_the_same_pairs_as_small_ones(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, rng.integers(60, 400)).astype(np.uint64)) for _ in range(8)]
    sets += [np.unique(np.concatenate([s[rng.random(len(s)) > 0.05], rng.integers(0, 2**63, 5).astype(np.uint64)])) for s in sets for _ in range(6)]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    rows = dict(tile=np.zeros(len(n), int), cross=np.zeros(len(n), bool), part=np.zeros(len(n), int), n=n, label=np.arange(len(n)) % 50,
                bits=np.array([near.signature(s) for s in sets], dtype=object))
    some = [set(zip(*(x.tolist() for x in near._tile_pairs(**rows))))]
    monkeypatch.setattr(near, "FEW", 4)
    some.append(set(zip(*(x.tolist() for x in near._tile_pairs(**rows)))))
    assert some[0] == {(min(p), max(p)) for p in some[1]} and len(some[0]) > 50
