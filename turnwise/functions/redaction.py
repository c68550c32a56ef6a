"""Redaction of personal data in text, as JVM expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from turnwise.functions.content import bind

# The classes, what each one matches, the token written instead, and the
# order in which they apply. The patterns are read by two regex engines and mean the same
# in both once the JVM one is put into Unicode mode.
CPF_PATTERN = r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"
CARD_PATTERN = r"\b\d(?:[ -]?\d){12,18}\b"
PLAIN_CLASSES = (
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[EMAIL]"),
    ("cnpj", r"\b\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}\b", "[CNPJ]"),
    ("rg", r"\b\d{1,2}\.\d{3}\.\d{3}-[\dxX]\b", "[RG]"),
    ("ipv6", r"\b[0-9a-fA-F]{1,4}(?::{1,2}[0-9a-fA-F]{1,4}){2,7}\b", "[IP]"),
    ("ipv4", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[IP]"),
    ("brazilian_phone",
     r"(?<!\d)(?:\+?55[\s-]?)?(?:\(\d{2}\)|\d{2})[\s-]?9?\s?\d{4}[\s-]?\d{4}(?![\s-]?\d)", "[PHONE]"),
)
CPF_TOKEN, CARD_TOKEN = "[CPF]", "[CARD]"
CARD_NAMES = ("card", "credit_card")

UNICODE = "(?U)"
# Every class needs a digit, an at sign or a colon; text with none of them is left alone.
CANDIDATE = UNICODE + r"[\d@:]"

# Zero digits of scripts whose numbers are read as well (checked as numbers, not only matched).
_ZEROS = (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50, 0xFF10)
_OTHER_DIGITS = "".join(chr(z + i) for z in _ZEROS for i in range(10))
_ASCII_DIGITS = "0123456789" * len(_ZEROS)


def class_names() -> tuple[str, ...]:
    return ("cpf", *[name for name, _, _ in PLAIN_CLASSES], "card")


def coerce_disabled(disabled: Iterable[str] | None) -> frozenset[str]:
    low = {d.lower() for d in (disabled or ())}
    if low & set(CARD_NAMES):
        low |= set(CARD_NAMES)
    return frozenset(low)


def _digits(text: Column) -> Column:
    """The digits of a text as ``array<int>``."""
    plain = F.regexp_replace(F.translate(text, _OTHER_DIGITS, _ASCII_DIGITS), "[^0-9]", "")
    return F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: c.cast("int"))


def luhn_valid(text: Column) -> Column:
    """At least 13 digits whose Luhn sum is a multiple of 10."""
    def check(d: Column) -> Column:
        n = F.size(d)
        def weigh(x: Column, i: Column) -> Column:
            twice = x * 2
            return F.when((n - i) % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(x)
        total = F.aggregate(F.transform(d, weigh), F.lit(0), lambda a, x: a + x)
        return (n >= 13) & (total % 10 == 0)
    return F.coalesce(bind(_digits(text), check), F.lit(False))


def cpf_valid(text: Column) -> Column:
    """Eleven digits, not all alike, with two right mod-11 check digits."""
    def check(d: Column) -> Column:
        def check_digit(upto: int) -> Column:
            weighted = F.transform(F.slice(d, 1, upto), lambda x, i: x * (F.lit(upto + 1) - i))
            rest = (F.aggregate(weighted, F.lit(0), lambda a, x: a + x) * 10) % 11
            return F.when(rest == 10, 0).otherwise(rest)
        return F.when((F.size(d) == 11) & (F.size(F.array_distinct(d)) > 1),
                      (check_digit(9) == d[9]) & (check_digit(10) == d[10])).otherwise(F.lit(False))
    return F.coalesce(bind(_digits(text), check), F.lit(False))


def replace_validated(text: Column, pattern: str, ok, token: str) -> Column:
    """Replace only those matches of ``pattern`` for which ``ok(match)`` holds."""
    java = UNICODE + pattern

    def rebuild(x: Column) -> Column:
        hits = F.transform(F.regexp_extract_all(x, F.lit(java), F.lit(0)),
                           lambda m: F.when(ok(m), F.lit(token)).otherwise(m))
        gaps = F.split(x, java, -1)
        pieces = F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(h, F.lit(""))))
        return F.when(x.rlike(java), F.array_join(pieces, "")).otherwise(x)
    return bind(text, rebuild)


def _plain(text: Column, pattern: str, token: str) -> Column:
    return F.regexp_replace(text, UNICODE + pattern, token.replace("$", r"\$"))


def redact_text(text: Column, disabled: Iterable[str] | None = None) -> Column:
    """Text with every enabled class replaced by its token, in the fixed order."""
    off = coerce_disabled(disabled)

    def run(x: Column) -> Column:
        out = x
        if "cpf" not in off:
            out = replace_validated(out, CPF_PATTERN, cpf_valid, CPF_TOKEN)
        for name, pattern, token in PLAIN_CLASSES:
            if name not in off:
                out = _plain(out, pattern, token)
        if "card" not in off:
            out = replace_validated(out, CARD_PATTERN, luhn_valid, CARD_TOKEN)
        return F.when(x.rlike(CANDIDATE), out).otherwise(x)
    return bind(text, run)


def enabled(toggles: Column, *names: str) -> Column:
    """Whether a class is on for this row's tenant: on unless a toggle says false."""
    on = F.lit(True)
    for name in names:
        on = on & F.coalesce(F.try_element_at(toggles, F.lit(name)), F.lit(True))
    return on


def redact_text_toggled(text: Column, toggles: Column) -> Column:
    """Like :func:`redact_text` with the classes switched per row by ``map<string,boolean>``."""
    def step(x: Column, names: tuple[str, ...], fn) -> Column:
        return bind(x, lambda v: F.when(enabled(toggles, *names), fn(v)).otherwise(v))

    def run(x: Column) -> Column:
        out = step(x, ("cpf",), lambda v: replace_validated(v, CPF_PATTERN, cpf_valid, CPF_TOKEN))
        for name, pattern, token in PLAIN_CLASSES:
            out = step(out, (name,), lambda v, p=pattern, t=token: _plain(v, p, t))
        out = step(out, CARD_NAMES, lambda v: replace_validated(v, CARD_PATTERN, luhn_valid, CARD_TOKEN))
        return F.when(x.rlike(CANDIDATE), out).otherwise(x)
    return bind(text, run)


def count_class(text: Column, name: str) -> Column:
    """How often a class occurs in a text; check digits are verified where they exist."""
    if name == "cpf":
        return F.size(F.filter(F.regexp_extract_all(text, F.lit(UNICODE + CPF_PATTERN), F.lit(0)), cpf_valid))
    if name in CARD_NAMES:
        return F.size(F.filter(F.regexp_extract_all(text, F.lit(UNICODE + CARD_PATTERN), F.lit(0)), luhn_valid))
    pattern = {n: p for n, p, _ in PLAIN_CLASSES}[name]
    return F.regexp_count(text, F.lit(UNICODE + pattern))
