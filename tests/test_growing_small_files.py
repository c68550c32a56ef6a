"""Many small files that grow: read by few tasks, looked up many at a time."""

import pyarrow as pa

from test_growing import reader, rows_of
from turnwise.plans.streams import _write_files
from turnwise.sources import growing


def land(folder, names, lines):
    folder.mkdir(parents=True, exist_ok=True)
    for name in names:
        (folder / f"{name}.txt").write_text("".join(f"{name}-{i}\n" for i in range(lines)) + "unfinished")


def test_small_files_share_tasks(tmp_path):
    names = [f"f{i:04d}" for i in range(600)]
    land(tmp_path / "in", names, 3)
    source = reader(tmp_path / "in", tmp_path / "log", minPartitions=4, splitBytes=1 << 26)
    end = source.latestOffset()
    parts = source.partitions({"entry": 0}, end)
    assert 4 <= len(parts) <= 6
    assert max(len(p.ranges) for p in parts) <= 150
    got = rows_of(source, {"entry": 0}, end)
    assert sorted(v for _, _, v in got) == sorted(f"{n}-{i}" for n in names for i in range(3))
    assert {o for _, o, _ in got} == {0, 8, 16}
    # By the split alone, where no number of tasks is asked for.
    assert len(reader(tmp_path / "in", tmp_path / "log", splitBytes=10 * growing.OPEN_BYTES).partitions({"entry": 0}, end)) == 67


def test_allowance_is_kept_when_files_are_looked_up_together(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "FILES_AT_ONCE", 3)
    names = [f"f{i}" for i in range(20)]
    land(tmp_path / "in", names, 4)
    at, got = {"entry": 0}, []
    while True:
        source = reader(tmp_path / "in", tmp_path / "log", maxBytesPerTrigger=170)
        end = source.latestOffset()
        if end == at:
            break
        new = rows_of(source, at, end)
        assert 0 < sum(len(v) + 1 for _, _, v in new) <= 170
        got, at = got + new, end
    assert sorted(v for _, _, v in got) == sorted(f"{n}-{i}" for n in names for i in range(4))


def test_a_line_without_text_is_landed_blank(tmp_path):
    batch = pa.RecordBatch.from_pydict({"path": ["/p/a", "/p/a", "/p/b"], "line": [0, 1, 0], "value": ["x", None, "y"]})
    assert [b.column("path").to_pylist() for b in _write_files(str(tmp_path))([batch])] == [[f"{tmp_path}/p/a", f"{tmp_path}/p/b"]]
    assert (tmp_path / "p" / "a").read_text() == "x\n\n" and (tmp_path / "p" / "b").read_text() == "y\n"
