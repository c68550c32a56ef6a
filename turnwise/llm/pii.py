"""Personal data in texts, with DataFrame functions only.

A regular expression proposes spans of each kind, a checksum or range test confirms them
(Luhn, mod 97, parts of an address, number of digits), and words near a span move its score.
Positions come from lengths alone: the pieces between matches and the matches alternate, so a
span starts at the sum of all lengths before it. These sums are taken in chunks, which keeps
a text of very many matches from copying ever longer arrays. Every row is worked on in place:
no shuffle, no Python.

Quantifiers that can only match one way are possessive, and a run of characters is entered
only at its start (or right after the last match), so long runs cost linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """``guard`` is a cheap necessary condition; ``score`` holds without any context word."""

    name: str
    guard: str
    pattern: str
    score: float
    context: str


# The first four are the base kinds, in the order of the contract; the others are added.
KINDS = (
    Kind("email", "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         0.8, r"mail|contact|write"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?:[ -]?[0-9]){13}", r"[0-9](?:[ -]?[0-9])++", 0.7, r"card|credit|visa|payment"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 0.6, r"phone|tel\b|call|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         0.7, r"iban|account|bank|konto|compte"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         0.3, r"ssn|social security|insurance"),
)
BASE = 4
CONTEXT_GAIN = 0.3
LEAST_SCORE = 0.5
BEFORE, AFTER = 40, 20
CHUNK = 256


def luhn_ok(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def mod97_ok(code: Column) -> Column:
    """ISO 7064 mod 97-10 over letters and digits, the first four moved to the end."""
    letters = F.split(F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4)), "")
    step = F.aggregate(
        F.filter(letters, lambda c: c != ""), F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97)
    return step == 1


def _confirmed(name: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if name == "ip":
        return found.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    if name == "card":
        return F.length(digits).between(14, 19) & luhn_ok(digits)
    if name == "phone":
        return F.length(digits).between(10, 15)
    if name == "iban":
        return mod97_ok(F.regexp_replace(found, " ", ""))
    return F.lit(True)


def _starts(steps: Column) -> Column:
    """Start of each match from an array of (gap, size): chunk by chunk, then chunks after one another."""
    longs = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("bigint")
    last = F.floor((F.size(steps) - 1) / F.lit(CHUNK)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)))
    local = F.transform(chunks, lambda chunk: F.aggregate(
        chunk, F.struct(zero.alias("end"), longs.alias("at")),
        lambda acc, x: F.struct((acc["end"] + x["gap"] + x["size"]).alias("end"),
                                F.concat(acc["at"], F.array(acc["end"] + x["gap"])).alias("at"))))
    whole = F.aggregate(
        local, F.struct(zero.alias("end"), F.array().cast("array<array<bigint>>").alias("at")),
        lambda acc, x: F.struct((acc["end"] + x["end"]).alias("end"),
                                F.concat(acc["at"], F.array(F.transform(x["at"], lambda s: s + acc["end"]))).alias("at")))
    return F.flatten(whole["at"])


def _proposed(rows: DataFrame, kind: Kind) -> DataFrame:
    """Add a kind's matches ``_m_``, the pieces between them ``_g_`` and the matches' starts ``_s_``."""
    matches, pieces = f"_m_{kind.name}", f"_g_{kind.name}"
    any_match = F.size(matches) > 0
    rows = rows.withColumn(matches, F.when(
        F.col("_t").rlike(kind.guard), F.regexp_extract_all("_t", F.lit(kind.pattern), F.lit(0))))
    rows = rows.withColumn(pieces, F.when(any_match, F.split("_t", kind.pattern, -1)))
    steps = F.transform(matches, lambda m, i: F.struct(
        F.length(F.col(pieces)[i]).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size")))
    return rows.withColumn(f"_s_{kind.name}", F.when(any_match, _starts(steps)))


def _accepted(rank: int, kind: Kind) -> Column:
    """The kind's confirmed and scored spans."""
    matches, pieces = F.col(f"_m_{kind.name}"), F.col(f"_g_{kind.name}")
    least = 0.0 if rank < BASE else LEAST_SCORE

    def span(start: Column, i: Column) -> Column:
        found = matches[i]
        near = (F.lower(F.right(pieces[i], F.lit(BEFORE))).rlike(kind.context)
                | F.lower(F.left(pieces[i + 1], F.lit(AFTER))).rlike(kind.context))
        score = F.lit(kind.score) + F.when(near, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
        return F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(found)).alias("end"),
            F.lit(kind.name).alias("kind"), F.when(_confirmed(kind.name, found), score).alias("score"))

    spans = F.transform(f"_s_{kind.name}", span)
    return F.coalesce(F.filter(spans, lambda x: F.coalesce(x["score"] >= least, F.lit(False))),
                      F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"))


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii`` added: an array of (start, rank, end, kind, score) in order of start.

    Positions are code points, the end exclusive; ``rank`` is the kind's place in ``KINDS``.
    Base kinds are kept whatever their score, added kinds from ``LEAST_SCORE`` up. A null or
    empty text has an empty array. Each row stands for itself, so repeated rows, ids without a
    value and further columns do not matter; a column named ``pii`` is replaced.
    """
    keep = [c for c in docs.columns if c != "pii"]
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    for kind in KINDS:
        rows = _proposed(rows, kind)
    found = [_accepted(rank, kind) for rank, kind in enumerate(KINDS)]
    return rows.select(*keep, F.array_sort(F.concat(*found)).alias("pii"))


def of_kind(rank: int):
    """A test for spans of one kind."""
    return lambda x: x["rank"] == rank


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
