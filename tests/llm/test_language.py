"""Language models: probabilities sum to one, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np

from turnwise.llm import language, queries


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    grams, counts = np.unique(rng.integers(0, 64**4, 3000) & 0b000111000111000111000111, return_counts=True)
    made = language.kneser_ney(grams, counts)
    arrays = {("x", k): v for k, v in made.items()}
    scorer = language.LanguageModel(["x"], arrays).ready()
    for context in [0, int(grams[5]) >> 6, 64**3 - 1]:
        following = (context << 6) + np.arange(64)
        nll, _ = scorer.cross_entropy(following.astype(np.uint32), np.arange(65))
        assert abs(np.exp(-nll[0]).sum() - 1) < 1e-4


def test_grams():
    texts = ["", "ab", "  A--b ", "é1"]
    raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    grams, ends, letters = language.grams_of(raw, offsets)
    e = 27 + ord("é") % 37
    assert ends.tolist() == [0, 0, 2, 6, 8] and letters.tolist() == [0, 2, 2, 1]
    assert grams.tolist() == [1, 66, 1, 64, 64 * 64 + 2, 64**3 + 2 * 64, e, e * 64]


def test_odd_rows(spark):
    rows = [(1, "the cat sat on the mat", "en", "a"), (2, "le chat est sur la table", "fr", "b"), (3, None, "en", "c"),
            (4, "", None, "d"), (None, "the dog", "en", "e"), (6, "123 !!", "fr", None), (7, "the cat", None, "f"),
            (7, "the cat", "fr", "f"), (8, "the " * 20000, "en", "g"), (9, "\U0001F600", "en", "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in (3, 4, 6, 9):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[8].lang_pred == "en" and by_id[2].lang_pred == "fr" and not by_id[None].held_out
    assert len({r.lang_pred for r in got if r.doc_id == 7}) == 1


def _texts_of_one_script(seed, first, step, n_docs):
    """Documents of invented words over 300 letters that start at ``first``, a ``step`` apart."""
    rng = random.Random(seed)
    letters = [chr(first + step * i) for i in range(300)]
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 4))) for _ in range(2000)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return ["".join(rng.choices(words, weights, k=30)) for _ in range(n_docs)]


def _accuracy(spark, languages):
    rows = [(name, t, i) for name, texts in languages.items() for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(j, *r) for j, r in enumerate(rows)], "doc_id bigint, lang string, text string, i int")
    model = language.train(docs.where("i % 4 > 0"))
    got = language.predict(docs.where("i % 4 = 0"), model).collect()
    return np.mean([r.lang_pred == r.lang for r in got])


def test_languages_of_one_script(spark):
    """Letters that a class takes together, and letters that two languages share, in Han characters and syllables."""
    apart = {"a": _texts_of_one_script(1, 0x4E00, 37, 80)}
    # The same words in letters 37 code points on: every class is the same.
    apart["b"] = [t.translate({0x4E00 + 37 * i: 0x4E00 + 37 * (i + 301) for i in range(300)}) for t in apart["a"]]
    assert _accuracy(spark, apart) == 1
    shared = {"zh": _texts_of_one_script(2, 0x4E00, 1, 80), "ja": _texts_of_one_script(3, 0x4E00, 1, 80),
              "ko": _texts_of_one_script(4, 0xAC00, 1, 80), "kp": _texts_of_one_script(5, 0xAC00, 1, 80)}
    assert _accuracy(spark, shared) >= 0.99


def test_letter_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    letters = 0x4E00 + 37 * rng.integers(0, 40, (4000, 3))
    grams, counts = np.unique((letters << (21 * np.arange(3))).sum(axis=1), return_counts=True)
    arrays = {("x", k): v for k, v in (language.kneser_ney(np.array([5]), np.array([1])) | language.letter_kneser_ney(grams, counts)).items()}
    scorer = language.LanguageModel(["x"], arrays).ready()
    every = np.unique(language.tables()[0])[1:].astype(np.int64)
    same = every[language.class_of(every) == language.class_of(np.array([0x4E00]))[0]]
    for before in [int(grams[7]) >> 21 << 21, 0x4E00 << 21, 98 << 21]:
        assert abs(np.exp(scorer.letters("x", before | same)).sum() - 1) < 1e-4
    assert len(scorer.letters("x", np.zeros(0, dtype=np.int64))) == 0


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert language.identify(docs).collect() == []
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert language.identify(docs).first().lang_pred == "und"


def _plain_limit(texts, halves, lang_texts_of):
    """Limits of one language by fitting and scoring here, each half under the model of the other."""
    mean, square, size = [], [], []
    for half in (0, 1):
        own = [t for t, h in zip(texts, halves) if h == half]
        rest = [t for t, h in zip(texts, halves) if h != half]
        if not own or not rest:
            continue
        grams, ends, _ = lang_texts_of(rest)
        arrays = language.kneser_ney(*np.unique(grams.astype(np.int64), return_counts=True))
        nothing = np.zeros(0, dtype=np.int64)
        arrays |= language.letter_kneser_ney(nothing, nothing)
        scorer = language.LanguageModel(["x"], {("x", k): v for k, v in arrays.items()}).ready()
        grams, ends, _ = lang_texts_of(own)
        found = scorer.cross_entropy(grams, ends)
        mean, square, size = np.append(mean, found[0][0]), np.append(square, found[1][0]), np.append(size, np.diff(ends))
    if not len(mean):
        return None
    centre = np.average(mean, weights=size)
    return centre, np.average((mean - centre) ** 2, weights=size), max(np.average(square - mean**2, weights=size), 1e-6)


def test_limits_come_from_all_rows_by_the_other_half(spark):
    """Rows count in full, a small language has its limit, and one with a single text has none."""
    rows = [(i, "en", f"the cat number {'abcdefghij'[i % 10] * (i % 7)} sat on the mat") for i in range(6000)]
    rows += [(12000 + i, "fr", ("le chat est sur la table " * (i + 1))[: 20 + 9 * i]) for i in range(9)]
    rows += [(13000, "xx", "12 34"), (13001, "it", "una sola riga"), (13002, "it", "una sola riga")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = language.train(docs.repartition(5))
    assert model.langs == ["en", "fr", "it"]
    halves = {r.text: r.half for r in docs.selectExpr("text", "pmod(xxhash64(text), 2) AS half").distinct().collect()}

    def grams_of(texts):
        raw = [t.encode() for t in texts]
        return language.grams_of(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0] + [len(t) for t in raw]))

    for i, lang in enumerate(model.langs):
        texts = [t for _, known, t in rows if known == lang]
        expected = _plain_limit(texts, [halves[t] for t in texts], grams_of)
        if lang == "it":
            assert expected is None and np.isinf(model.limits[i][0])
        else:
            assert np.allclose(model.limits[i], expected, rtol=1e-5, atol=1e-9), lang
    assert not language.predict(docs.where("lang = 'it'"), model).where("rejected").count()


def test_held_out_texts_of_a_small_language_are_kept(spark):
    """Where there is little to learn from, texts that the model has not learned are as welcome as the others."""
    texts = {"a": _texts_of_one_script(1, 0x4E00, 37, 60)}
    texts["b"] = [t.translate({0x4E00 + 37 * i: 0x4E00 + 37 * (i + 301) for i in range(300)}) for t in texts["a"]]
    rows = [(i, lang, t) for lang, own in texts.items() for i, t in enumerate(own)]
    docs = spark.createDataFrame(rows, "i bigint, lang string, text string")
    model = language.train(docs.where("i % 4 > 0"))
    got = language.predict(docs.where("i % 4 = 0"), model).collect()
    assert all(r.lang_pred == r.lang for r in got)
    assert np.mean([r.rejected for r in got]) <= 0.05
    rng = np.random.default_rng(9)
    noise = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9FA5, 400)) for _ in range(20)]
    odd = language.predict(spark.createDataFrame([(t,) for t in noise], "text string"), model).collect()
    assert all(r.rejected for r in odd)


def test_held_out(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_language"](spark, sf).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows) and np.mean([r.rejected for r in rows]) < 0.01


def test_memory_of_counting_and_scoring(monkeypatch):
    """The lookup table has a row for each context met only; counts that do not shrink are not merged at every slice."""
    grams = np.unique(np.random.default_rng(3).integers(0, language.CLASSES**language.ORDER, 5000))
    counts = np.ones(len(grams), dtype=np.int64)
    arrays = {("x", kind): (g.astype(np.int64), w.astype(np.float32)) for kind, (g, w) in language.kneser_ney(grams, counts).items()}
    scorer = language.LanguageModel(["x"], arrays).ready()
    assert sum(v.nbytes for v in vars(scorer).values() if isinstance(v, np.ndarray)) < 16 << 20

    monkeypatch.setattr(language, "MERGE_AT", 1000)
    merged, merge = [], language._Tally._merged
    monkeypatch.setattr(language._Tally, "_merged", staticmethod(lambda parts: merged.append(1) or merge(parts)))
    tally = language._Tally()
    for i in range(100):
        tally.add("x", 0, np.arange(100 * i, 100 * i + 100))
    assert len(merged) <= 10
