"""The FM-index and decontamination against brute force."""

import random
import re

import numpy as np
import pytest

from turnwise.llm import decontaminate, fm_index


@pytest.mark.parametrize("symbols", [2, 3, 5, 40])
def test_index_finds_all_occurrences(symbols):
    rng = np.random.default_rng(symbols)
    text = rng.integers(1, symbols, 300) if symbols > 2 else np.ones(300, dtype=np.int64)
    index = fm_index.FMIndex(text, symbols)
    for length in (1, 2, 5):
        patterns = np.unique(np.concatenate([np.lib.stride_tricks.sliding_window_view(text, length)[::7],
                                             rng.integers(1, symbols, (5, length))]), axis=0)
        got = sorted((p, int(i)) for ps, at in index.locate(*index.search(patterns)) for p, i in zip(ps.tolist(), at))
        want = [(p, i) for p, row in enumerate(patterns) for i in range(300 - length + 1) if (text[i:i + length] == row).all()]
        assert got == sorted(want)


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def brute(docs, items):
    out = []
    for doc, text in docs:
        words = words_of(text)
        hit, met = set(), set()
        for item, phrase in items:
            own = [w for w, _, _ in words_of(phrase)]
            size = min(13, len(own))
            windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
            for i in range(len(words) - size + 1):
                if tuple(w for w, _, _ in words[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    met.add(item or "")
        spans, inside = [], sorted(hit)
        for k in inside:
            if spans and spans[-1][2] == k - 1:
                spans[-1] = (spans[-1][0], words[k][2], k)
            else:
                spans.append((words[k][1], words[k][2], k))
        out.append((doc, len(words), len(hit), sorted(met), bool(hit) and 20 * len(hit) >= len(words), [s[:2] for s in spans]))
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    left = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, items string")
    right = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, n_words int")
    rows = decontaminate.mark_contamination(left, right, **more).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated, [(s.start, s.end) for s in r.removal_spans]) for r in rows), key=repr)


def table(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "über", "a", "in", "x1", "naïve", "日本"]
    items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.choice([1, 6, 13, 14, 30])))) for i in range(9)]
    items += [("9", None), ("91", ""), ("92", "?!"), (None, "lonely phrase here"), ("3", "a second text for three, of many words in the same item"), ("94", items[4][1])]
    docs = [(None, None), (0, ""), (1, "--"), (2, items[3][1].upper() + "!"), (2, "x")]
    for i in range(3, 40):
        own = rng.choices(vocabulary + ["other", "words"], k=rng.randrange(1, 90))
        if i % 3 == 0:
            own[5:5] = (rng.choice(items)[1] or "").split()
        docs.append((i, " \U0001F600 , ".join(own)))
    docs.append((99, "filler " * 30000 + items[1][1] + " lonely, PHRASE (here)"))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 22, 60])
def test_against_brute_force(spark, block_bytes):
    docs, items = table(block_bytes)
    assert run(spark, docs, items, block_bytes=block_bytes) == brute(docs, items)


def test_blocks_with_clashing_names(spark):
    """Rows keep their own columns, whatever these are called, over several passes."""
    docs = spark.createDataFrame([(1, "one two three four", "a", 7), (2, "nothing", None, 8), (None, "four five six", "b", 9), (1, "one two three four", "a", 7)],
                                 "_row bigint, text string, _items string, _hits int")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["two three", "five six", "seven eight", "three four"])], "item_id int, text string")
    whole = decontaminate.mark_contamination(docs, items)
    parts = decontaminate.mark_contamination(docs, items, block_bytes=9)
    assert len(decontaminate.item_blocks(items, 9)) > 1 and parts.columns == whole.columns
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect()))


def test_empty(spark):
    docs, items = table(1)
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == brute(docs, [])


def test_drop(spark):
    docs = spark.createDataFrame([(1, "one two three four", 5), (2, "nothing here", 6)], "doc_id bigint, text string, n_hit int")
    items = spark.createDataFrame([(7, "two three")], "item_id bigint, text string")
    assert [tuple(r) for r in decontaminate.drop_contaminated(docs, items).collect()] == [(2, "nothing here", 6)]
