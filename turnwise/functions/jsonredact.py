"""Redaction inside nested JSON payloads, the one step VARIANT has no expression for.

Only rows whose messages hold block lists or tool calls come here, as Arrow batches of
JSON text; everything else is redacted in the JVM by :mod:`turnwise.functions.redaction`.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F

from turnwise.functions.redaction import (CARD_PATTERN, CARD_TOKEN, CPF_PATTERN, CPF_TOKEN,
                                          PLAIN_CLASSES, coerce_disabled)

# Compiled rule sets of this process, by what they were built from.
_COMPILED: dict = {}
_COMPILED_MAX = 1024


def _cached(key, build):
    if key not in _COMPILED:
        if len(_COMPILED) >= _COMPILED_MAX:
            _COMPILED.pop(next(iter(_COMPILED)))  # the oldest; others stay compiled
        _COMPILED[key] = build()
    return _COMPILED[key]


def _number_ok(match: re.Match, kind: str) -> bool:
    digits = [int(c) for c in match.group(0) if c.isdigit()]
    if kind == "card":
        odd, even = digits[::-1][0::2], digits[::-1][1::2]
        return len(digits) >= 13 and (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0
    if len(digits) != 11 or len(set(digits)) < 2:
        return False
    return all(
        sum(d * (n + 1 - i) for i, d in enumerate(digits[:n])) * 10 % 11 % 10 == digits[n] for n in (9, 10))


# A character without which a class cannot occur; all others need a digit.
_NEEDS = {"email": "@", "ipv6": ":"}


def _scrubber(disabled: tuple[str, ...]):
    off = coerce_disabled(disabled)
    steps = []
    if "cpf" not in off:
        steps.append((None, re.compile(CPF_PATTERN), lambda m: CPF_TOKEN if _number_ok(m, "cpf") else m.group(0)))
    for name, pattern, token in PLAIN_CLASSES:
        if name not in off:
            steps.append((_NEEDS.get(name), re.compile(pattern), lambda m, t=token: t))
    if "card" not in off:
        steps.append((None, re.compile(CARD_PATTERN), lambda m: CARD_TOKEN if _number_ok(m, "card") else m.group(0)))
    digit = re.compile(r"\d")

    def scrub(text: str) -> str:
        numbers = digit.search(text) is not None
        for need, pattern, repl in steps:
            if numbers if need is None else need in text:
                text = pattern.sub(repl, text)
        return text
    return scrub


def _custom(rules: str):
    steps = []
    for rule in json.loads(rules):
        try:
            steps.append((re.compile(rule["pattern"]), rule.get("replacement", "[REDACTED]")))
        except (re.error, KeyError, TypeError):
            continue

    def apply(text: str) -> str:
        for pattern, repl in steps:
            text = pattern.sub(repl, text)
        return text
    return apply


def _leaves(value, fix, in_list: bool = False):
    """Fix every string leaf below an object; a list inside a list is left as it is."""
    match value:
        case str():
            return fix(value)
        case dict():
            return {k: _leaves(v, fix) for k, v in value.items()}
        case list() if not in_list:
            return [_leaves(v, fix, in_list=True) for v in value]
    return value


def _content(content, fix):
    """Message content or the content of a tool result: text, or a list of blocks."""
    if isinstance(content, str):
        return fix(content)
    if isinstance(content, list):
        return [_block(b, fix) for b in content]
    return content


# Which field of a block carries visible text, and how it is walked.
_BLOCK_FIELDS = {
    "text": ("text", lambda v, fix: fix(v) if isinstance(v, str) else v),
    "tool_use": ("input", lambda v, fix: _leaves(v, fix) if isinstance(v, dict) else v),
    "tool_result": ("content", _content),
}


def _block(block, fix):
    if not isinstance(block, dict):
        return block
    field, walk = _BLOCK_FIELDS.get(block.get("type"), (None, None))
    return {**block, field: walk(block[field], fix)} if field in block else block


def _redact_one(text: str, disabled, rules: str | None) -> str:
    off = tuple(sorted(disabled)) if disabled is not None else ()
    scrub = _cached(off, lambda: _scrubber(off))
    both = scrub
    if rules is not None:
        custom = _cached(rules, lambda: _custom(rules))
        both = lambda t: custom(scrub(t))
    out = []
    for m in json.loads(text):
        if isinstance(m, dict):
            m = dict(m)
            if "content" in m:
                m["content"] = _content(m["content"], both)
            if isinstance(m.get("tool_calls"), list):
                m["tool_calls"] = [_leaves(c, scrub) if isinstance(c, dict) else c for c in m["tool_calls"]]
        out.append(m)
    return json.dumps(out, ensure_ascii=False)


def _redact_batch(texts: pd.Series, disabled: pd.Series, rules: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else _redact_one(t, d, r)
                      for t, d, r in zip(texts, disabled, rules)])


def redact_json_messages(texts: Column, disabled: Column, rules: Column) -> Column:
    """JSON array of messages with content blocks and tool calls redacted.

    ``disabled`` is ``array<string>`` of classes to skip, ``rules`` the tenant's custom
    rules as JSON text or null; custom rules touch content only, not tool calls.
    """
    return F.pandas_udf(_redact_batch, "string")(texts, disabled, rules)


def _custom_batch(texts: pd.Series, rules: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else _cached(r, lambda: _custom(r))(t) for t, r in zip(texts, rules)])


def custom_rules_text(text: Column, rules: Column) -> Column:
    """The tenant's custom rules, as JSON text, over a whole text."""
    return F.pandas_udf(_custom_batch, "string")(text, rules)
