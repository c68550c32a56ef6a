"""The pipeline against a stage-by-stage brute-force version, and the guard around the subpackage."""

import re
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_near import brute as near_brute


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(docs):
    holders = defaultdict(set)
    keyed = {d: [lower(x).strip(" \t\n\x0b\x0c\r") for x in t.split("\n")] for d, t in docs.items()}
    for d, keys in keyed.items():
        for k in keys:
            if len(k) >= 20:
                holders[k].add(d)
    out = {}
    for d, t in docs.items():
        kept = [x for x, k in zip(t.split("\n"), keyed[d]) if len(holders.get(k, ())) < 3 or max(holders[k]) == d]
        if kept or not t:
            out[d] = "\n".join(kept)
    return out


def contaminated(text, windows):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hit = set()
    for size, found in windows.items():
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in found:
                hit.update(range(i, i + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_pipeline(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    columns = table.columns
    docs, outs = table, []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        outs.append(docs)
    assert all(d.columns == columns for d in outs[:-1])
    first = {r.doc_id: r.text for r in outs[0].collect()}
    original = {r.doc_id: r.text for r in table.collect()}
    # Rejection is the model's; what has letters in the invented languages stays.
    assert len(first) >= 0.99 * sum(any(c.isalpha() for c in t or "") for t in original.values())
    second = line_dedup(first)
    rows = outs[1].collect()
    assert {r.doc_id: r.text for r in rows} == second and all(r.n_chars == len(r.text) for r in rows)
    keep = {doc for doc, _, component in near_brute(sorted(second.items())) if doc == component}
    third = {r.doc_id: r.text for r in outs[2].collect()}
    assert third == {d: t for d, t in second.items() if d in keep}
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r.text))
        for i in range(max(1, len(words) - 12)):
            windows[min(13, len(words))].add(tuple(words[i:i + 13]))
    fourth = {r.doc_id: r.text for r in outs[3].collect()}
    assert fourth == {d: t for d, t in third.items() if not contaminated(t, windows)}
    assert len(fourth) < len(third)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for p in outs[4].collect():
        pieces[p.doc_id].append(p)
    assert set(pieces) == set(fourth)
    for d, own in pieces.items():
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in sorted(own, key=lambda p: p.start)), dtype="<u4").tolist()
        assert ids == tokenizer.encode(fourth[d], add_special_tokens=False).ids + [2]


DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines int, score string, items int, key int, _id string"


def odd_docs(spark):
    long = "word number one of many and so on " * 3000
    texts = [None, "", "\n\n", "12 34", "a", "the cat sat on the mat today", "the cat sat on the mat today", long, long + "end",
             "\U0001F600 ok", "une phrase assez longue pour une ligne\nb", "une phrase assez longue pour une ligne\nc",
             "une phrase assez longue pour une ligne\nd"]
    rows = [(i, t, "en" if i % 2 else None, None, None if t is None else len(t), i, "s", None, 1, None) for i, t in enumerate(texts)]
    return rows + [(None, "no id here but some words", None, None, None, None, None, None, None, None), rows[5]]


def test_odd_rows_and_clashing_names(spark, sf):
    """Nulls, empty and long texts, repeated rows and columns named like added ones pass every stage."""
    docs = spark.createDataFrame(odd_docs(spark), DDL)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = {(r.doc_id, r.n_lines, r.score) for r in docs.collect()}
        assert {(r.doc_id, r.n_lines, r.score) for r in out.collect()} <= rows
        docs = out
    assert sum(p.length for p in corpus_pipeline.pack_sequences(spark, docs, sf).collect()) > 0


def test_empty_tables(spark, sf):
    docs = spark.createDataFrame([], DDL)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == []


def test_each_stage_takes_odd_rows_itself(spark, sf):
    docs = spark.createDataFrame(odd_docs(spark), DDL)
    kept = {name: stage(spark, docs, sf).count() for name, stage in corpus_pipeline.STAGES[1:-1]}
    assert kept["decontamination"] == docs.count() and kept["line dedup"] >= docs.count() - 2
