"""Files that grow between triggers: bytes admitted, lines read, turns completed."""

import json

import pytest
from pyspark.sql import functions as F

from test_transcripts import TEXT, reply, user
from turnwise.operators.turns import group_turns
from turnwise.sources import growing
from turnwise.sources.transcripts import parse_claude_lines
from turnwise.streaming import jobs, ordered


def reader(root, log, **options):
    return growing.GrowingLinesReader({"path": str(root), "log": str(log), **{k: str(v) for k, v in options.items()}})


def rows_of(source, start, end):
    return [tuple(r.values()) for p in source.partitions(start, end) for b in source.read(p) for r in b.to_pylist()]


@pytest.mark.parametrize("split", [1, 3, 7, 1 << 20])
def test_lines_are_read_once_whatever_the_splits(tmp_path, split):
    path = tmp_path / "in" / "p" / "a.txt"
    path.parent.mkdir(parents=True)
    body = b"one\n\nthree is longer\n" + "fünf\n".encode() + b"x" * 200000 + b"\nsix\r\nseven"
    at, got = {"entry": 0}, []
    for cut in (2, 4, 5, 24, 30, 100000, 200030, len(body), len(body)):
        path.write_bytes(body[:cut])
        source = reader(tmp_path / "in", tmp_path / "log", splitBytes=split if cut < 100 else max(split, 1000))
        end = source.latestOffset()
        got += rows_of(source, at, end)
        at = end
    path.write_bytes(body + b"\n")
    source = reader(tmp_path / "in", tmp_path / "log", splitBytes=max(split, 1000))
    got += rows_of(source, at, source.latestOffset())
    want, offset = [], 0
    for line in (body + b"\n").split(b"\n")[:-1]:
        want.append((str(path), offset, line.removesuffix(b"\r").decode()))
        offset += len(line) + 1
    assert got == want


def test_bytes_are_admitted_a_little_at_a_time_and_survive_a_restart(tmp_path):
    (tmp_path / "in").mkdir()
    for name in "abc":
        (tmp_path / "in" / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(100)))
    (tmp_path / "in" / "long.txt").write_text("y" * 500 + "\nz\n")
    (tmp_path / "in" / "other.bin").write_text("no\n")
    at, got, entries = {"entry": 0}, [], 0
    while True:
        # Another instance each time, as after a restart.
        source = reader(tmp_path / "in", tmp_path / "log", maxBytesPerTrigger=120, pattern="*.txt")
        end = source.latestOffset()
        if end == at:
            break
        new = rows_of(source, at, end)
        assert sum(len(v) + 1 for _, _, v in new) <= 120 or len(new) == 1
        assert rows_of(source, at, end) == new  # a replay gives the same
        got, at, entries = got + new, end, entries + 1
    assert entries > growing.ENTRIES_PER_SNAPSHOT // 10
    assert sorted(v for _, _, v in got) == sorted([f"{n}{i}" for n in "abc" for i in range(100)] + ["y" * 500, "z"])
    assert len({(p, o) for p, o, _ in got}) == len(got)


def test_snapshots_stand_for_the_entries_before(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "ENTRIES_PER_SNAPSHOT", 3)
    (tmp_path / "in").mkdir()
    path, at, got = tmp_path / "in" / "a.txt", {"entry": 0}, []
    for i in range(8):
        path.write_text("".join(f"{k}\n" for k in range(i + 1)))
        source = reader(tmp_path / "in", tmp_path / "log")
        end = source.latestOffset()
        got += [v for _, _, v in rows_of(source, at, end)]
        at = end
    assert got == [str(k) for k in range(8)]
    assert len(list((tmp_path / "log").glob("snapshot-*"))) == 2


def test_a_file_that_shrinks_is_an_error(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    source = reader(tmp_path / "in", tmp_path / "log")
    source.latestOffset()
    (tmp_path / "in" / "a.txt").write_text("one\n")
    with pytest.raises(ValueError, match="shorter"):
        source.latestOffset()


def test_turns_come_once_each_when_complete(spark, tmp_path):
    """A session grows by lines and halves of lines over several runs; each turn is handed out once."""
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    lines = [json.dumps(x) for k in range(5) for x in (user(f"question {k}"), reply(TEXT), reply(TEXT))]
    body = "".join(f"{v}\n" for v in lines).encode()
    group = lambda rows: group_turns(rows, "claude")
    (src / "p").mkdir(parents=True)

    def run():
        jobs.stream_growing(spark, str(src), parse_claude_lines, group, ordered.into(out), state, F.col("role") == "user",
                            max_bytes=300, split_bytes=64).awaitTermination()
    seen = []
    for share in (0.1, 0.33, 0.5, 0.9, 1.0):
        (src / "p" / "one.jsonl").write_bytes(body[:int(len(body) * share)])
        for _ in range(6):
            run()
        seen.append(spark.read.parquet(out).count())
    (src / "p" / "two.jsonl").write_bytes(body[:len(body) // 2])
    for _ in range(6):
        run()
    done = spark.read.parquet(out)
    turns = [(r.session_id, r.turn_no, r.text, r.n) for r in done.select(
        "session_id", "turn_no", F.col("msg")[0]["content"].alias("text"), F.size("msg").alias("n")).collect()]
    assert sorted(t for t in turns if t[0] == "one") == [("one", k + 1, f"question {k}", 3) for k in range(4)]
    assert sorted(t for t in turns if t[0] == "two") == [("two", k + 1, f"question {k}", 3) for k in range(2)]
    assert seen[-1] == 4 and seen[0] < 4
    rest = jobs.open_turns(spark, state, parse_claude_lines, group)
    # The third question of the other file has no answer yet, so it is no turn.
    assert {(r.session_id, r.turn_no) for r in rest.collect()} == {("one", 5)}
