"""Packing: ids against the tokenizer on whole texts, pieces against their documents, limits."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from turnwise.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    None, "", " ", "\n\n", "a", "It's  they'll\tWE'VE 12 345!", "x<|endoftext|>y <|startoftext|> z", "é ̈a  b c",
    "İİ ΣΣ ß", "\U0001F600\U0001F469‍\U0001F4BB hi", "日本語 текст ١٢٣", "a\x0bb\x0cc\rd\x1ce\x85f",
    "don't.'s a.b,c;d'll-'re_x \"q\"", "<\u0338 a<\u0338 =\u0338b", "Caf\u00c9, caf\u00e9. \u00c9t\u00e9 \u00aa\u00ba\u02b0 \u0345x", "lo" * 9000, "word " * 9000, "ﬁne Å 가가",
]


def check(pieces, texts, limits=packing.Limits()):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, text in texts.items():
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[doc], key=lambda p: p.start)
        got = b"".join(bytes(p.ids) for p in own)
        assert np.frombuffer(got, dtype="<u4").tolist() == want, repr(text)[:80]
        at = 0
        for p in own:
            assert (p.start, p.length, p.doc_tokens) == (at, len(p.ids) // 4, len(want))
            at += p.length
        total += len(want)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(parts) <= limits.segments
        assert sum(p.loss_tokens for p in parts) <= limits.loss
    return total / (len(by_sequence) * limits.tokens)


def frame(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string"), {i: t for i, t, _ in rows}


def test_odd_texts(spark):
    df, texts = frame(spark, ODD)
    check(packing.pack(df, PATH).collect(), texts)
    df, texts = frame(spark, [t for t in ODD if t and "<|" not in t])
    check(packing.pack(df, PATH).collect(), texts)


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").coalesce(1)
    texts = {r.doc_id: r.text for r in df.collect()}
    assert check(packing.pack(df, PATH).collect(), texts) > 0.97


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 40), packing.Limits(100, 1, 100), packing.Limits(50, 9, 7)])
def test_limits(spark, limits):
    words = ["one two three " * (i % 40) for i in range(300)]
    rows = [(i, t, i % 11 if i % 3 else None) for i, t in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, prompt bigint")
    check(packing.pack(df, PATH, limits, "prompt").collect(), {i: t for i, t, _ in rows}, limits)


def test_empty_and_repeats(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id bigint, text string")
    assert [p.doc_tokens for p in packing.pack(df, PATH).collect()] == [3, 3, 3]


def test_forgetting(spark, sf, monkeypatch):
    coder = packing.ChunkIds(PATH, most=50)
    tokenizer = Tokenizer.from_file(PATH)
    for text in ["a b c d " * 3 + " ".join(f"w{i}" for i in range(n)) for n in (10, 40, 80, 5)]:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        ids, ends = coder.encode(raw, np.array([0, len(raw)]))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2] and ends.tolist() == [0, len(ids)]


def test_query(spark, sf):
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), PATH).collect()
    rows = queries.QUERIES["op2_packing"](spark, sf).collect()
    assert sorted((p.doc_id, p.start, zlib.crc32(p.ids)) for p in pieces) == sorted((r.doc_id, r.start, r.ids_crc32) for r in rows)
