import hashlib
import heapq
import random
import re
import zlib

import pytest

from turnwise.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, pos int, block string"
GOOD = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired) by search over whole edit strings: rows are (role, text, must go, cut)."""
    todo, seen = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, i, initials, said = heapq.heappop(todo)
        if i == len(rows) and GOOD.match(initials):
            return cost, audit, said
        # What may still follow depends on the last initial and on whether there is any.
        state = (i, initials[-1:], initials == "s")
        if state in seen:
            continue
        seen.add(state)
        for name in ("user", "assistant"):
            if re.match(r"(s?(ua)*u?)\Z", initials + name[0]):
                heapq.heappush(todo, (cost + 5, audit + "I", i, initials + name[0], said + (name + ":",)))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            heapq.heappush(todo, (cost + 2, audit + "D", i + 1, initials, said))
            if not gone:
                more = 5 if cut else 0
                for edit, price, new in [("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")]:
                    if new and re.match(r"(s?(ua)*u?)\Z", initials + new[0]):
                        heapq.heappush(todo, (cost + more + price, audit + edit, i + 1, initials + new[0], said + (f"{new}:{text}",)))
    raise AssertionError


def brute(rows, damaged=True):
    convs = {}
    for conv, turn, role, text in (r[:4] for r in rows):
        kept = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = {r[0] for r in kept} - {None}
        counts, seen, marked = [0, 0, 0], set(), []
        for _, role, text in kept:
            bare = text.strip(BLANK)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            marked.append((role, text, fault < 2, fault == 2))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, said = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    return sorted([tuple(r) for r in repair.repair_damaged(spark.createDataFrame(rows, SCHEMA)).collect()], key=repr)


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(most + 1)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool"])
            text = rng.choice(["Yes.", "No!", "", "\t ", "cut", "cut \n", f"said {rng.random()}.", f"said {rng.random()}"])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, text, turn, "x"))
    return rows


@pytest.mark.parametrize("block", [1 << 16, 3])
def test_random_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = random_rows(block, 120, 12)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (2, None, "user", "a."), (2, None, "assistant", "b."),
            (2, None, "user", "a."), (3, 5, "", "empty role."), (3, 6, "User", "upper."), (3, 7, "sys", "other system."), (3, 7, "user", "x" * 200000 + "."),
            (4, 1, "user", "same."), (4, 1, "user", "same."), (4, 1, "user", "same."), (2**60 + 7, -3, "assistant", "né?"), (2**60 + 7, 2**40, "user", "\x85"),
            (2**60 + 9, 1, "user", None), (5, 3, None, "no role."), (6, 1, "user", "."), (6, 2, "assistant", "!")]
    rows = [(*r, 0, "b") for r in rows]
    assert run(spark, rows) == brute(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    got = run(spark, [(c, 0, "user", "Hi.", 0, "b") for c in gone])
    assert got == sorted([(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone], key=repr)
    assert run(spark, []) == []


def test_long_runs(spark, monkeypatch):
    """A conversation over many blocks, of few symbols in long runs."""
    monkeypatch.setattr(repair, "BLOCK", 64)
    rows = [(1, t, "user" if t < 400 else "assistant" if t < 700 else "system", f"t{t}." if t % 300 else "cut", 0, "x") for t in range(1000)]
    rows += [(2, t, "user" if t % 2 == 0 else "assistant", f"t{t}.", 0, "x") for t in range(300)]
    assert run(spark, rows) == brute(rows)


def test_lines_are_what_the_digest_covers(spark):
    rows = random_rows(8, 30, 9)
    done = repair.Repair(repair.damage(spark.createDataFrame(rows, SCHEMA)))
    lines = {}
    for r in sorted(done.lines().collect(), key=lambda r: (r.conv_id, r.line)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in done.report().collect():
        said = lines.get(int(r.conv[1:]), [])
        assert hashlib.sha256("\n".join(said).encode()).hexdigest() == r.repaired_sha256
        assert GOOD.match("".join(x[0] for x in said))


def test_powers_equal_single_rows():
    rng = random.Random(5)
    for _ in range(200):
        runs = [(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]), rng.randrange(1, 40)) for _ in range(4)]
        after = single = repair.END
        for symbol, length in reversed(runs):
            after = repair.apply(repair.run_matrix(symbol, length), after)
            for _ in range(length):
                single = repair.before_row(symbol, single)
        assert after == single
        whole, state = repair.unroll(runs, repair.START, repair.END)
        rows = [(symbol, 1) for symbol, length in runs for _ in range(length)]
        assert (whole, state) == repair.unroll(rows, repair.START, repair.END)
