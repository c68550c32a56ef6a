"""Personal data against plain Python regular expressions."""

import hashlib
import re

from turnwise.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def brute(text):
    spans = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if holds(kind, m.group()):
                spans.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def base_of(row):
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in row.pii if x.rank < pii.BASE)


TEXTS = [
    None, "", "no data", "a@b.c", "x.y+z@host.example.org, a@b%c@d.ef", "é€\U0001F600 me@host.de \U0001F600 10.0.0.1",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3 9999999999999999999999.1.1.1",
    "4539 1488 0343 6467 4539148803436467 4539148803436468 1234-5678-9012-3452", "+49 (30) 1234-567 890 x +1 2 +12345678901234567",
    "@@@ a@ @b.c a@b a@b. a@b..c", "+1+234567890123 +12 34567890.", "a@b.cd@e.fg", "ends 192.168.0.255",
    " ".join(f"u{i}@h{i}.net 10.{i % 256}.0.{i % 300}" for i in range(700)), "9" * 5000, "a." * 5000 + "@x.y", "+1" + " " * 3000,
]


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, "pii") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, pii string")
    for row in pii.find_pii(docs).collect():
        assert base_of(row) == brute(row.text), row.text[:80]


def test_added_kinds(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 now", "GB82 WEST 1234 5698 7654 33", "id 078-05-1120", "SSN: 078-05-1120", "mail me: a@b.cd"]
    rows = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    got = {r.text: [(x.kind, r.text[x.start:x.end], round(x.score, 2)) for x in r.pii] for r in rows}
    assert got[texts[0]] == [("iban", "GB82 WEST 1234 5698 7654 32", 1.0)]
    assert not got[texts[1]] and not got[texts[2]]
    assert got[texts[3]] == [("ssn", "078-05-1120", 0.6)]
    assert got[texts[4]] == [("email", "a@b.cd", 1.1)]


def test_empty_table(spark):
    assert pii.find_pii(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(brute(texts[r.doc_id]).encode()).hexdigest()
