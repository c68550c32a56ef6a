"""Language identification by interpolated Kneser-Ney character models.

A character is predicted in two steps. First its class, of 64: word gap, a-z, and the other
letters by code point modulo 37. An n-gram of four classes is a 24-bit number. Then, where the
class has several letters, which of them it is, from the two characters before it: an n-gram of
three code points is a 63-bit number, so none is folded, hashed or left out. The product of
both is a probability over all letters, and languages of one script are told apart by their
letters and words. Training counts the highest orders over all labelled documents (in each task
first, then summed); the lower orders follow from them as Kneser-Ney continuation counts. A
model is a set of sorted arrays of n-gram numbers with their log-probabilities, and is
broadcast: at most 64**4 class n-grams a language, and as many letter n-grams as the corpus has.

A text goes to the language with the lowest cross-entropy per character. It is rejected where
even that is far above what the labelled documents of that language show for their length, each
under a model of the half of the labelled texts that it is not in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType

from turnwise.llm.text import add_columns, code_points, release_memory, text_pieces
from turnwise.session import landed, landed_path, remove_path

ORDER = 4
CLASSES = 64
BITS = 6
GAP = 0
OTHER_LETTERS = 37
FIRST_OTHER = 27
# Letters are numbered by their code points.
LETTER_ORDER = 3
LETTER_BITS = 21
HELD_OUT_OF = 5
# Parts of the labelled texts; each is scored by a model of the others for the rejection limits.
HALVES = 2
UNDETERMINED = "und"
REJECT_SIGMAS = 8.0
REJECT_MARGIN = 0.25
MERGE_AT = 1 << 20
# Text is worked on in slices of this size, since its arrays take many times as much.
SLICE_BYTES = 1 << 19

COUNT_DDL = "lang string, half int, gram bigint, n bigint"
# Sums over a language's documents that its rejection limit is taken from.
SUMS = ("n", "size", "mean", "mean_square", "square")
MODEL_DDL = "lang string, kind string, grams binary, weights binary"

_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """The lower-case letter of every code point, or 0 for anything but a letter, and its class."""
    if not _TABLES:
        lower = np.zeros(0x110000, dtype=np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                lower[point] = ord(char.lower()[0])
        classes = np.where((lower >= 97) & (lower <= 122), lower - 96, FIRST_OTHER + lower % OTHER_LETTERS)
        _TABLES.append((lower, np.where(lower == 0, GAP, classes).astype(np.uint8)))
    return _TABLES[0]


def class_sizes() -> np.ndarray:
    """How many letters each class has."""
    letters = np.unique(tables()[0])[1:]
    return np.bincount(class_of(letters), minlength=CLASSES)


def class_of(letter: np.ndarray) -> np.ndarray:
    """The class of lower-case letters."""
    return np.where((letter >= 97) & (letter <= 122), letter - 96, FIRST_OTHER + letter % OTHER_LETTERS).astype(np.int64)


@dataclass
class Grams:
    """The characters of a slice's rows: class n-grams, rows' offsets in them, and letters per row.

    ``spelled`` holds the letter n-grams of those characters, at ``where``, whose class has several letters.
    """

    classes: np.ndarray
    ends: np.ndarray
    letters: np.ndarray
    where: np.ndarray
    spelled: np.ndarray


def _windows(values: np.ndarray, ends: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The numbers of each value and those before it in its row; before a row stand zeros."""
    sizes = np.diff(ends)
    padded = np.zeros(int(ends[-1]) + (order - 1) * len(sizes), dtype=values.dtype)
    at = np.arange(int(ends[-1])) + np.repeat((order - 1) * np.arange(1, len(sizes) + 1), sizes)
    padded[at] = values
    gram = padded[at]
    for back in range(1, order):
        gram |= padded[at - back] << values.dtype.type(bits * back)
    return gram


def read_grams(raw: np.ndarray, offsets: np.ndarray) -> Grams:
    """Runs of other characters than letters are one gap, none at a row's start."""
    points = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    rows = points[offsets]
    lower, classes = tables()
    codes = code_points(raw)
    letter = np.zeros(len(codes) + 1, dtype=bool)
    letter[1:] = lower[codes] != 0
    after = letter[:-1].copy()
    after[rows[:-1][rows[:-1] < len(after)]] = False
    kept = letter[1:] | after
    before = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(kept, out=before[1:])
    ends = before[rows]
    letters = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(letter[1:], out=letters[1:])
    codes = codes[kept]
    own = classes[codes]
    where = np.flatnonzero(own >= FIRST_OTHER)
    spelled = np.zeros(0, dtype=np.int64)
    if len(where):
        # The two letters before, none from before the row.
        at = where - ends[np.searchsorted(ends, where, side="right") - 1]
        spelled = lower[codes[where]].astype(np.int64)
        for back in range(1, LETTER_ORDER):
            spelled |= np.where(at >= back, lower[codes[where - back]], 0).astype(np.int64) << (LETTER_BITS * back)
    return Grams(_windows(own.astype(np.uint32), ends, ORDER, BITS), ends, np.diff(letters[rows]), where, spelled)


def grams_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four-class numbers of all characters, the rows' offsets in them, and letters per row."""
    found = read_grams(raw, offsets)
    return found.classes, found.ends, found.letters


def learnable(doc_id: Column, lang: Column) -> Column:
    """Rows that may be learned from; an id without a value has no fold and is left out."""
    return F.coalesce((fold(doc_id) != 0) & lang.isNotNull(), F.lit(False))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF


class _Tally:
    """Counts per language and half of one task, merged whenever they grow large."""

    def __init__(self):
        self.parts: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size, self.most = 0, MERGE_AT

    def add(self, lang: str, half: int, grams: np.ndarray) -> None:
        found = np.unique(grams, return_counts=True)
        self.parts.setdefault((lang, half), []).append(found)
        self.size += len(found[0])
        if self.size > self.most:
            for k, v in self.parts.items():
                self.parts[k] = [self._merged(v)]
            self.size = sum(len(v[0][0]) for v in self.parts.values())
            # What does not shrink is not merged again before it has doubled.
            self.most = max(MERGE_AT, 2 * self.size)

    @staticmethod
    def _merged(parts):
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (lang, half), parts in self.parts.items():
            grams, counts = self._merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(np.full(len(grams), half, dtype=np.int32)),
                 pa.array(grams), pa.array(counts)],
                names=["lang", "half", "gram", "n"])


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, half, gram, n) over all rows of (lang, half, text); numbers of letter n-grams are inverted, so below 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            for rows, raw, offsets in text_pieces(batch, most=SLICE_BYTES):
                found = read_grams(raw, offsets)
                langs = rows.column(0).dictionary_encode()
                own = HALVES * langs.indices.to_numpy(zero_copy_only=False) + rows.column(1).to_numpy(zero_copy_only=False)
                which = np.repeat(own, np.diff(found.ends))
                for i in np.unique(own):
                    lang, half = langs.dictionary[i // HALVES].as_py(), int(i % HALVES)
                    tally.add(lang, half, found.classes[which == i].astype(np.int64))
                    tally.add(lang, half, ~found.spelled[which[found.where] == i])
        yield from tally.batches()
        release_memory()

    return (docs.select("lang", "half", "text").mapInArrow(run, COUNT_DDL)
            .groupBy("lang", "half", "gram").agg(F.sum("n").alias("n")))


def _discount(number: np.ndarray) -> float:
    ones, twos = float((number == 1).sum()), float((number == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted arrays of one language: log-probabilities of each order, log back-off weights of each context."""
    order = np.argsort(grams)
    levels = {ORDER: (grams[order], counts[order].astype(np.float64))}
    for k in range(ORDER - 1, 0, -1):
        # How many different classes come before: one for each longer n-gram that ends so.
        tails = levels[k + 1][0] & ((1 << (BITS * k)) - 1)
        found, number = np.unique(tails, return_counts=True)
        levels[k] = (found, number.astype(np.float64))
    out, lower = {}, np.full(1, 1.0 / CLASSES)
    lower_grams = np.zeros(1, dtype=np.int64)
    for k in range(1, ORDER + 1):
        found, number = levels[k]
        discount = _discount(number)
        contexts, which = np.unique(found >> BITS, return_inverse=True)
        total = np.bincount(which, weights=number)
        kinds = np.bincount(which)
        spare = discount * kinds / total
        tail = found & ((1 << (BITS * (k - 1))) - 1)
        below = lower[np.searchsorted(lower_grams, tail)] if k > 1 else lower[0]
        prob = np.maximum(number - discount, 0) / total[which] + spare[which] * below
        out[f"prob{k}"] = (found, np.log(prob))
        out[f"back{k}"] = (contexts, np.log(spare))
        lower, lower_grams = prob, found
    return out


def _letter_context(grams: np.ndarray) -> np.ndarray:
    """The number of what a letter is predicted from: the letters before it, then its class."""
    return (grams >> LETTER_BITS << BITS) | class_of(grams & ((1 << LETTER_BITS) - 1))


def letter_kneser_ney(grams: np.ndarray, counts: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The same for which letter of its class a character is, given the letters before it."""
    order = np.argsort(grams)
    levels = {LETTER_ORDER: (grams[order], counts[order].astype(np.float64))}
    for k in range(LETTER_ORDER - 1, 0, -1):
        found, number = np.unique(levels[k + 1][0] & ((1 << (LETTER_BITS * k)) - 1), return_counts=True)
        levels[k] = (found, number.astype(np.float64))
    out = {}
    for k in range(1, LETTER_ORDER + 1):
        found, number = levels[k]
        discount = _discount(number)
        contexts, which = np.unique(_letter_context(found), return_inverse=True)
        total = np.bincount(which, weights=number, minlength=len(contexts))
        spare = discount * np.bincount(which, minlength=len(contexts)) / total
        if k == 1:
            below = 1.0 / class_sizes()[class_of(found)]
        else:
            below = lower[np.searchsorted(lower_grams, found & ((1 << (LETTER_BITS * (k - 1))) - 1))]
        prob = np.maximum(number - discount, 0) / total[which] + spare[which] * below
        out[f"letter_prob{k}"] = (found, np.log(prob))
        out[f"letter_back{k}"] = (contexts, np.log(spare))
        lower, lower_grams = prob, found
    return out


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    # A number that both halves have is one n-gram.
    grams, which = np.unique(pdf["gram"].to_numpy(), return_inverse=True)
    counts = np.bincount(which, weights=pdf["n"].to_numpy())
    spelled = grams < 0
    made = kneser_ney(grams[~spelled], counts[~spelled]) | letter_kneser_ney(~grams[spelled], counts[spelled])
    return pd.DataFrame([{"lang": pdf["lang"].iloc[0], "kind": kind, "grams": grams.astype(np.int64).tobytes(),
                          "weights": weights.astype(np.float32).tobytes()} for kind, (grams, weights) in made.items()])


@dataclass
class LanguageModel:
    """Sorted arrays of all languages; ``limits`` holds mean, spread and per-character variance of each."""

    langs: list[str]
    arrays: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]]
    limits: np.ndarray | None = None

    def ready(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model laid out for lookup: one row of values, by language, for each n-gram any language has."""

    def __init__(self, model: LanguageModel):
        self.langs, self.limits, self.arrays = model.langs, model.limits, model.arrays
        self.base = -np.log(np.maximum(class_sizes(), 1))
        n = len(self.langs)
        lower = np.full((1, n), -np.log(CLASSES), dtype=np.float32)
        for k in range(1, ORDER + 1):
            back = np.zeros((CLASSES ** (k - 1), n), dtype=np.float32)
            for i, lang in enumerate(self.langs):
                contexts, weights = model.arrays[lang, f"back{k}"]
                back[contexts, i] = weights
            grams = (np.unique(np.concatenate([model.arrays[lang, f"prob{k}"][0] for lang in self.langs]))
                     if k == ORDER and n else np.arange(CLASSES**k if k < ORDER else 0))
            tails = grams & (CLASSES ** (k - 1) - 1)
            value = back[grams >> BITS] + lower[tails]
            for i, lang in enumerate(self.langs):
                found, weights = model.arrays[lang, f"prob{k}"]
                value[np.searchsorted(grams, found), i] = weights
            if k < ORDER:
                lower = value
        self.back, self.lower = back, lower
        self.values = np.ascontiguousarray(value.T)
        # Where an n-gram's values are: a row of places, by last class, for each context met; row 0 has none.
        contexts = np.unique(grams >> BITS)
        self.row = np.zeros(CLASSES ** (ORDER - 1), dtype=np.int32)
        self.row[contexts] = np.arange(1, len(contexts) + 1)
        self.place = np.full((len(contexts) + 1, CLASSES), -1, dtype=np.int32)
        self.place[self.row[grams >> BITS], grams & (CLASSES - 1)] = np.arange(len(grams))

    def _look_up(self, kind: str, lang: str, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the numbers the language has, and their weights, 0 for the others."""
        found, weights = self.arrays[lang, kind]
        if not len(found):
            return np.zeros(len(grams), dtype=bool), np.zeros(len(grams))
        at = np.minimum(np.searchsorted(found, grams), len(found) - 1)
        has = found[at] == grams
        return has, np.where(has, weights[at], 0.0)

    def letters(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Log-probability of each letter n-gram's last letter among its class, given the letters before."""
        value = self.base[class_of(grams & ((1 << LETTER_BITS) - 1))]
        rows = np.arange(len(grams))
        for k in range(1, LETTER_ORDER + 1):
            tails = grams[rows] & ((1 << (LETTER_BITS * k)) - 1)
            met, back = self._look_up(f"letter_back{k}", lang, _letter_context(tails))
            # What follows a context never met is as after the shorter one, and so for all longer ones.
            rows, tails, back = rows[met], tails[met], back[met]
            has, prob = self._look_up(f"letter_prob{k}", lang, tails)
            value[rows] = np.where(has, prob, value[rows] + back)
        return value

    def cross_entropy(self, grams: np.ndarray, ends: np.ndarray, where: np.ndarray | None = None,
                      spelled: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Mean negative log-probability per character of each row (language by row), and its mean square.

        ``spelled`` are letter n-grams of the characters ``where``; without them classes only are scored.
        """
        if where is not None:
            kinds, which = np.unique(spelled, return_inverse=True)
        rows = len(ends) - 1
        full = np.flatnonzero(np.diff(ends))
        total = np.zeros((len(self.langs), rows))
        square = np.zeros((len(self.langs), rows))
        slot = self.place[self.row[grams >> BITS], grams & (CLASSES - 1)]
        unseen = np.flatnonzero(slot < 0)
        for i in range(len(self.langs) if len(grams) else 0):
            value = self.values[i][slot]
            if len(unseen):
                gram = grams[unseen]
                value[unseen] = self.back[gram >> BITS, i] + self.lower[gram & (CLASSES ** (ORDER - 1) - 1), i]
            # In double, whatever the number of characters.
            value = value.astype(np.float64)
            if where is not None and len(where):
                value[where] += self.letters(self.langs[i], kinds)[which]
            total[i, full] = np.add.reduceat(value, ends[:-1][full])
            square[i, full] = np.add.reduceat(value * value, ends[:-1][full])
        size = np.maximum(np.diff(ends), 1)
        return -total / size, square / size


def _scorer(model: LanguageModel) -> Scorer:
    """The model's layout, made once per worker."""
    if not hasattr(model, "scorer"):
        model.scorer = model.ready()
    return model.scorer


def _fitted(counts: DataFrame) -> LanguageModel:
    """The model of (lang, half, gram, n), the halves taken together."""
    rows = landed(counts.sparkSession, counts.groupBy("lang").applyInPandas(_fit, MODEL_DDL), "lang-model").collect()
    arrays = {(r.lang, r.kind): (np.frombuffer(r.grams, dtype=np.int64), np.frombuffer(r.weights, dtype=np.float32))
              for r in rows}
    return LanguageModel(sorted({r.lang for r in rows}), arrays)


def _entropy_sums(docs: DataFrame, model: LanguageModel) -> list:
    """Per language, :data:`SUMS` over all rows of (lang, text) under their own language's model.

    A task gives one row a language. Rows of a language that the model lacks have no number.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = sent.value.langs
        number = {lang: i for i, lang in enumerate(langs)}
        sums = np.zeros((len(SUMS), len(langs)))
        for batch in batches:
            scorer = _scorer(sent.value)
            for rows, raw, offsets in text_pieces(batch, most=SLICE_BYTES):
                found = read_grams(raw, offsets)
                mean, square = scorer.cross_entropy(found.classes, found.ends, found.where, found.spelled)
                own = np.array([number.get(x, -1) for x in rows.column(0).to_pylist()], dtype=np.int64)
                size = np.where(own < 0, 0, np.diff(found.ends)).astype(np.float64)
                own = np.maximum(own, 0)
                mean, square = mean[own, np.arange(len(rows))], square[own, np.arange(len(rows))]
                for total, value in zip(sums, (size > 0, size, size * mean, size * mean**2, size * square)):
                    total += np.bincount(own, weights=value, minlength=len(langs))
        met = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array([langs[i] for i in met], pa.string()), *[pa.array(x[met]) for x in sums]],
                                         names=["lang", *SUMS])
        release_memory()

    rows = (docs.select("lang", "text").mapInArrow(run, "lang string, " + ", ".join(f"{x} double" for x in SUMS))
            .groupBy("lang").agg(*[F.sum(x).alias(x) for x in SUMS]).collect())
    sent.destroy()
    return rows


def _calibrate(docs: DataFrame, counts: DataFrame, langs: list[str]) -> np.ndarray:
    """Per language: mean cross-entropy, spread between documents, and variance per character.

    They follow from sums over all rows of (lang, half, text), each scored by the model of the
    other half, one half after the other so that one model is in memory at a time. A language with
    texts in one half only cannot be held against others of its own and gets no limit.
    """
    sums = np.zeros((len(langs), len(SUMS)))
    for half in range(HALVES):
        model = _fitted(counts.where(F.col("half") != half))
        for r in _entropy_sums(docs.where(F.col("half") == half), model) if model.langs else []:
            sums[langs.index(r.lang)] += [r[x] for x in SUMS]
    limits = np.zeros((len(langs), 3))
    limits[:, 0] = np.inf
    for i in np.flatnonzero(sums[:, 0]):
        _, size, mean, mean_square, square = sums[i]
        centre, between = mean / size, mean_square / size
        limits[i] = (centre, max(between - centre**2, 0.0), max(square / size - between, 1e-6))
    return limits


def train(docs: DataFrame) -> LanguageModel:
    """A model of every ``lang`` of the rows of (doc_id, lang, text), which are all learned from.

    The rejection limits come from all these rows too, by models of two halves of the texts;
    equal texts are in one half. Empty input gives a model without languages.
    """
    spark = docs.sparkSession
    docs = docs.select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(HALVES)).cast("int").alias("half"))
    counts, path = landed_path(spark, count_grams(docs), "lang-counts")
    model = _fitted(counts)
    model.limits = _calibrate(docs, counts, model.langs) if model.langs else np.zeros((0, 3))
    remove_path(spark, path)
    return model


ADDED = {"lang_pred": StringType(), "score": DoubleType(), "cross_entropy": DoubleType(), "rejected": BooleanType(),
         "n_letters": LongType()}


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy, rejected and n_letters added, from ``text`` alone.

    A null text, or one without any letter, is ``und`` with score 0 and rejected; so is every
    text if no language was learned. ``score`` compares the languages' cross-entropies, from 1
    over their number up to 1; ties go to the first name. Equal texts get equal answers. Other
    columns are kept, those of the added names replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(rows: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        scorer = _scorer(sent.value)
        found = read_grams(raw, offsets)
        ends, letters = found.ends, found.letters
        known = (letters > 0) & bool(scorer.langs)
        names = np.array([*scorer.langs, UNDETERMINED], dtype=object)
        best = np.full(len(rows), len(scorer.langs))
        score, entropy = np.zeros(len(rows)), np.full(len(rows), np.nan)
        rejected = ~known
        if scorer.langs:
            mean, _ = scorer.cross_entropy(found.classes, ends, found.where, found.spelled)
            size = np.maximum(np.diff(ends), 1)
            lead = mean.argmin(axis=0)
            low = mean.min(axis=0)
            odds = np.exp(np.maximum((low - mean) * np.sqrt(size), -700)).sum(axis=0)
            best, score = np.where(known, lead, best), np.where(known, 1 / odds, 0.0)
            entropy = np.where(known, low, np.nan)
            centre, between, per_char = scorer.limits[lead].T
            rejected |= low > centre + REJECT_SIGMAS * np.sqrt(between + per_char / size) + REJECT_MARGIN
        return [pa.array(names[best], pa.string()), pa.array(score), pa.array(entropy, from_pandas=True),
                pa.array(rejected), pa.array(letters, pa.int64())]

    return add_columns(docs, ADDED, work, most=SLICE_BYTES)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows whose fold is not 0 and whose ``lang`` is known, then predict all rows; adds held_out."""
    labelled = docs.where(learnable(F.col("doc_id"), F.col("lang"))).select("doc_id", "lang", "text")
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return predict(docs, train(labelled)).withColumn("held_out", held_out)
