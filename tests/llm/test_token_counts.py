"""The separator scan against brute force, with documents that reach over block edges."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from turnwise.llm import queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 9


def brute(ids):
    counts, now = [], 0
    for i in ids:
        if i == END:
            counts.append((now, True))
            now = 0
        else:
            now += 1
    return counts + ([(now, False)] if now else [])


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_scan(spark, block):
    rng = random.Random(block)
    files = [[], [END], [END, END, 1], [1] * 50, [1] * 20 + [END], [rng.choice([1, 2, 3, 4, END]) for _ in range(200)]]
    rows = [(f, b, np.array(ids[i:i + block], dtype="<u2").tobytes())
            for f, ids in enumerate(files) for b, i in enumerate(range(0, len(ids), block))]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "file bigint, block bigint, ids binary").repartition(3), END).collect()
    for f, ids in enumerate(files):
        own = sorted((r.ordinal, r.n_tokens, r.complete) for r in got if r.file == f)
        assert own == [(i, n, c) for i, (n, c) in enumerate(brute(ids))]


def test_ends_are_not_ordered_per_file(spark):
    """What the windows sort for one file is a row of numbers per block, without the ends."""
    blocks = spark.range(4).selectExpr("0L AS file", "id AS block", "unhex('09000100') AS ids")
    plan = token_counts.count_tokens(blocks, END)._jdf.queryExecution().executedPlan().toString()
    below = [line.split("Window [", 1)[1] for line in plan.splitlines() if "Window [" in line]
    assert below and not any("ends#" in line.replace("n_ends#", "") for line in below)


def test_odd_blocks(spark):
    rows = [(0, 0, b"\x01\x00\x09\x00"), (None, 0, b"\x01\x00"), (0, None, b"\x01\x00"), (1, 3, None), (1, 5, b"\x02\x00")]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "file bigint, block bigint, ids binary"), END).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 1, True), (1, 0, 1, False)]


def test_documents(spark):
    texts = [None, "", "a b c", "# ## ###", "<|endoftext|> x", "word " * 5000, "a b c"]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, "no id", "k"), (2, "a b c", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in rows), key=repr)
    for block in (3, 1 << 20):
        got = token_counts.count_documents(docs.repartition(2), PATH, 49408, block).collect()
        assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == want
    assert token_counts.count_documents(docs.limit(0), PATH, 49408).collect() == []


def test_query(spark, sf):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = sorted((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs)
    assert sorted(map(tuple, queries.QUERIES["op5_token_counts"](spark, sf).collect())) == want
