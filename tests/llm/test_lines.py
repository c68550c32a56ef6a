"""Line dedup against brute force, the filters, and inserting and deleting documents."""

import random
from collections import defaultdict

import numpy as np

from turnwise.llm import lines


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(" \t\n\x0b\x0c\r")


def brute(docs):
    """Every row is a document; ids may be missing."""
    count, largest = defaultdict(int), {}
    for doc, text in docs:
        for k in {key_of(x) for x in (text or "").split("\n")}:
            count[k] += 1
            if doc is not None:
                largest[k] = max(largest.get(k, doc), doc)
    out = []
    for doc, text in docs:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines
                if len(key_of(x)) < 20 or count[key_of(x)] < 3 or largest.get(key_of(x)) == doc]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 7) for d, t in docs], "doc_id bigint, text string, kept_text string, n_lines int")


def rows_of(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()), key=repr)


LONG = "This line is long enough "
DOCS = [
    (1, LONG + "1"), (2, " \t" + LONG.upper() + "1\r\n\nother"), (3, LONG + "1\nunique line of three " * 2),
    (4, None), (5, ""), (6, "\n\n"), (7, "short\nshort\nshort"), (8, "short"), (9, "short"),
    (10, "ééééééééééééééééééé"), (11, "ééééééééééééééééééé"), (12, "ééééééééééééééééééé"),
    (13, "éééééééééééééééééééé"), (14, "éééééééééééééééééééé"), (15, "éééééééééééééééééééé\nx"), (None, LONG + "1"),
    (16, (LONG + "2\n") * 3), (16, LONG + "2"), (17, LONG + "2"), (None, LONG + "3"), (None, LONG + "3"), (None, LONG + "3"),
    (18, "\x1f" + LONG + "4"), (19, LONG + "4"), (20, LONG + "4" + " "), (21, (LONG + "5\n") * 4000), (22, LONG + "5"), (23, LONG + "5"),
]


def test_against_brute_force(spark):
    assert rows_of(lines.dedup_lines(frame(spark, DOCS))) == brute(DOCS)


def test_empty(spark):
    assert lines.dedup_lines(frame(spark, DOCS).limit(0)).collect() == []


def test_filter():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 256, (5000, 16), dtype=np.uint8)
    made = lines.CuckooFilter.of(keys)
    assert made.contains(keys).all()
    assert made.contains(rng.integers(0, 256, (5000, 16), dtype=np.uint8)).mean() < 0.01
    made.delete(keys[:2500])
    assert made.contains(keys[2500:]).all() and made.contains(keys[:2500]).mean() < 0.01
    assert made.insert(keys[:2500]) and made.contains(keys).all()
    assert int((made.cells != 0).sum()) == 5000
    made.delete(keys)
    assert not made.cells.any()
    tight = lines.CuckooFilter(2)
    assert not tight.insert(keys[:20])


def state_of(state):
    counts = {bytes(r.digest): (r.n_docs, r.keep_id) for r in state.counts.collect()}
    held = 0
    for row in state.filters.collect():
        held += int((np.frombuffer(row.cells, dtype=np.uint16) != 0).sum())
    return counts, held


def test_reversible(spark):
    """Inserting documents and deleting them again restores counts and filters; results follow the state."""
    rng = random.Random(5)
    pool = [f"a shared line number {i} of the pool" for i in range(60)]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 12)) + [f"an own line of document {i}"])) for i in range(80)]
    old, new = docs[:50], docs[50:]
    first = lines.build_state(frame(spark, old), keys_per_shard=16)
    both = lines.insert_docs(first, frame(spark, new))
    assert state_of(both)[0] == state_of(lines.build_state(frame(spark, docs)))[0]
    assert state_of(both)[1] == len(state_of(both)[0])
    assert rows_of(lines.dedup_lines(frame(spark, docs), both)) == brute(docs)
    back = lines.delete_docs(both, spark.createDataFrame([(d,) for d, _ in new], "doc_id bigint"))
    assert state_of(back) == state_of(first)
    none = lines.delete_docs(back, spark.createDataFrame([(d,) for d, _ in old], "doc_id bigint"))
    assert state_of(none) == ({}, 0)


def test_large_ids_beside_missing_ones(spark):
    docs = [(2**60 + 2 * i + 1, "\n".join(LONG + f"{(i + k) % 30}" for k in range(4))) for i in range(60)] + [(None, LONG + f"{i}") for i in range(0, 40, 3)]
    assert rows_of(lines.dedup_lines(frame(spark, docs))) == brute(docs)
    first, second = frame(spark, docs[:30]), frame(spark, docs[30:])
    state = lines.insert_docs(lines.build_state(first, keys_per_shard=3), second)
    assert rows_of(lines.dedup_lines(frame(spark, docs), state)) == brute(docs)


def test_filters_prove_new_keys_and_deletion_undoes_a_load(spark):
    """Over a table in two parts: what the filters prove new is new, and deleting the second part gives the first state."""
    docs = [(i, "\n".join(LONG + f"{(7 * i + k) % 500}" for k in range(5))) for i in range(200)]
    whole = lines.corpus_state(frame(spark, docs), keys_per_shard=16)
    middle = (min(d for d, _ in docs) + max(d for d, _ in docs)) // 2
    first = lines.build_state(frame(spark, [d for d in docs if d[0] <= middle]), keys_per_shard=16)
    second = lines.line_refs(frame(spark, [d for d in docs if d[0] > middle]))
    probed = lines.probe(first, lines._counted(second))
    held = {r.digest for r in first.counts.collect()}
    marks = [(r.digest in held, r.maybe) for r in probed.collect()]
    assert all(maybe for known, maybe in marks if known)
    assert sum(not maybe for known, maybe in marks if not known) > 0.9 * sum(not known for known, _ in marks) > 50
    back = lines.delete_docs(whole, spark.createDataFrame([(d,) for d, _ in docs if d > middle], "doc_id bigint"))
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, first.counts.collect()))
    # The filters after the deletion hold the first part's keys, and no more than a false positive now and then.
    probed = lines.probe(back, lines._counted(second)).collect()
    assert all(r.maybe for r in probed if r.digest in held)
    assert sum(r.maybe for r in probed if r.digest not in held) <= 0.05 * len(probed) + 1


def test_shards_follow_the_keys(spark):
    state = lines.build_state(frame(spark, [(0, "\n".join(LONG + f"a{k}" for k in range(8)))]), keys_per_shard=8)
    for i in range(1, 6):
        state = lines.insert_docs(state, frame(spark, [(i, "\n".join(LONG + f"{i}-{k}" for k in range(40)))]))
    assert state.counts.count() == 208 and 208 / 8 / lines.FULL <= state.shards <= 27
    assert all(r.maybe for r in lines.probe(state, state.counts).collect())
