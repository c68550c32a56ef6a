import numpy as np
import pytest

from turnwise.llm import caps

SCHEMA = "vec_id long, embedding array<float>, label int, name string, rep long"


def unit(x):
    x = np.asarray(x, dtype=float)
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def usable(vector, label):
    return (label is not None and vector is not None and len(vector) > 0 and all(v is not None and np.isfinite(v) for v in vector)
            and any(vector))


def brute(rows, similarity=caps.SIMILARITY):
    n, links = len(rows), {i: set() for i in range(len(rows))}
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i][:3], rows[j][:3]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b) and (
                    list(a) == list(b) or unit(a) @ unit(b) >= similarity):
                links[i].add(j)
                links[j].add(i)
    out, seen = [], {}
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        least = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        seen.update(dict.fromkeys(group, least))
    for i in range(n):
        out.append((rows[i][0], len(links[i]), seen[i], rows[i][0] == seen[i]))
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA, **settings):
    return sorted([tuple(r) for r in caps.near_vectors(spark.createDataFrame(rows, schema), **settings).collect()], key=repr)


def around(rng, center, n, spread):
    return [[float(v) for v in np.float32(center + spread * rng.standard_normal(len(center)))] for _ in range(n)]


def test_groups_copies_and_strangers(spark):
    rng = np.random.default_rng(4)
    vectors = []
    for size, spread in ((1, 0), (2, 0.01), (40, 0.02), (120, 0.005), (60, 0.03)):
        vectors += around(rng, unit(rng.standard_normal(32)), size, spread)
    vectors += [vectors[3]] * 70 + around(rng, np.zeros(32), 80, 1)
    rows = [(1000 - i, v, int(i % 7 == 0), "x", 5) for i, v in enumerate(vectors)]
    want = brute(rows)
    assert run(spark, rows) == want
    # Small tiles cut a dense group into pairs of parts; nothing changes.
    assert run(spark, rows, tile=8) == want
    assert max(r[1] for r in want) > 100


def test_odd_rows(spark):
    big, near = [3e38, 1e38, 0.0, 0.0], [3e38, 1.1e38, 0.0, 0.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0] * 4, 1), (4, [1.0, None, 0.0, 0.0], 1), (5, [1.0, float("nan"), 0.0, 0.0], 1),
            (6, [float("inf"), 0.0, 0.0, 0.0], 1), (7, big, 1), (8, near, 1), (9, big, 2), (9, near, 2), (10, big, None), (11, big, None),
            (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.0, 0.0, 0.0], 1), (14, [-3e38, -1e38, 0.0, 0.0], 1), (None, [0.0, 0.0, 1.0, 0.0], 3),
            (None, [0.0, 0.0, 2.0, 0.0], 3), (15, [0.0, -0.0, 0.0, 1.0], 4), (16, [-0.0, 0.0, 0.0, 1.0], 4), (None, [0.0, 0.0, 0.0, 1.0], 4),
            (2**60 + 1, [1.0], 5), (2**60 + 3, [7.0], 5), (2**60 + 5, [-1.0], 5), (20, [1e-40, 0.0, 0.0, 0.0], 6), (21, [1.0, 0.0, 0.0, 0.0], 6)]
    rows = [(*r, "n", 1) for r in rows]
    got = run(spark, rows)
    # Numbers are held as floats, so the smallest are rounded; the brute force sees the same.
    held = [(r[0], None if r[1] is None else [None if v is None else float(np.float32(v)) for v in r[1]], r[2]) for r in rows]
    assert got == brute(held)


def test_doubles_and_empty(spark):
    schema = "vec_id long, embedding array<double>, label string"
    rows = [(1, [1e300, 1e300, 0.0], "a"), (2, [1e-300, 1e-300, 0.0], "a"), (3, [1.0, -1.0, 0.0], "a"), (4, [1.0, 1.0, 0.0], "b")]
    assert run(spark, rows, schema) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]
    assert run(spark, [], schema) == []


def test_list_decoding_finds_all_directions():
    rng = np.random.default_rng(1)
    for dim, vectors in ((64, 5000), (12, 300), (3, 50), (1, 5)):
        code = caps.make_code(vectors, dim, 0.93, 0.99, 4.0)
        units = np.array([unit(v) for v in rng.standard_normal((50, dim))])
        row, name = caps.list_decode(units, code)
        count, turned = len(code.words[0]), units @ code.rotation
        totals = np.zeros((50, 1))
        for a, b, words in zip(code.bounds[:-1], code.bounds[1:], code.words):
            totals = (totals[:, :, None] + (turned[:, a:b] @ words.T)[:, None, :]).reshape(50, -1)
        assert totals.shape[1] == count ** len(code.words)
        want = {(i, d) for i, d in zip(*np.nonzero(totals >= code.threshold))}
        got = set(zip(row.tolist(), name.tolist()))
        alone = {i for i in range(50) if (totals[i] < code.threshold).all()}
        assert {x for x in got if x[0] not in alone} == want
        assert {i for i, _ in got} == set(range(50))


@pytest.mark.parametrize("vectors", [500, 100_000])
def test_pairs_just_above_the_similarity_share_a_filter(vectors):
    rng = np.random.default_rng(7)
    a = np.array([unit(v) for v in rng.standard_normal((3000, 64))])
    across = rng.standard_normal((3000, 64))
    across -= (across * a).sum(1, keepdims=True) * a
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * across
    shared = np.zeros(3000, dtype=bool)
    for number in range(caps.CODES):
        code = caps.make_code(vectors, 64, 0.93, caps.RECALL, caps.LOAD, number)
        (ra, na), (rb, nb) = caps.list_decode(a, code), caps.list_decode(b, code)
        both = np.isin(ra * 2**32 + na, rb * 2**32 + nb)
        shared[ra[both]] = True
    assert shared.mean() > 0.99


def test_links_count_once_however_many_filters_are_shared():
    rng = np.random.default_rng(3)
    base = unit(rng.standard_normal(16))
    vectors = np.array([unit(base + 0.02 * rng.standard_normal(16)) for _ in range(60)])
    want = np.triu(vectors @ vectors.T >= 0.93, 1)
    seen = np.zeros_like(want, dtype=int)
    for size in (20, 60):  # small tiles and large ones go different ways
        seen[:] = 0
        for cell in (5, 9, 12):
            part = np.arange(size)
            t = caps.Tiles(cell=np.full(size, cell), low=np.zeros(size, int), high=np.zeros(size, int), part=np.zeros(size, int),
                           rep=part, weight=np.ones(size, int), group=np.array(["g"] * size, dtype=object), units=vectors[:size],
                           cells=[np.array([5, 9, 12]) if i % 2 else np.array([9, 12]) for i in part])
            i, j = caps.links_of(t, 0.93)
            if cell == 5:  # only odd rows are in the first filter
                odd = (i % 2 == 1) & (j % 2 == 1)
                i, j = i[odd], j[odd]
            np.add.at(seen, (i, j), 1)
        assert (seen[:size, :size] == want[:size, :size]).all()
