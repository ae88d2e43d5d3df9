"""Growing files: lines exactly once over ranges, appends, half-written lines and restarts."""

import random

import pytest

from loadlens.functions.parsing import parse_csv
from loadlens.sources import growing
from loadlens.streaming.sinks import partition_per_batch, run_bounded


@pytest.mark.parametrize("step", [3, 1 << 20])
@pytest.mark.parametrize("range_bytes", [1, 2, 7, 64, 10_000])
def test_ranges_have_each_line_once(tmp_path, monkeypatch, step, range_bytes):
    monkeypatch.setattr(growing, "STEP", step)
    draw = random.Random(range_bytes)
    lines = ["x" * draw.choice([0, 0, 1, 2, 5, 30]) + str(i) * draw.randint(0, 1) for i in range(60)]
    path = str(tmp_path / "f")
    data = "".join(s + draw.choice(["\n", "\r\n"]) for s in lines)
    with open(path, "w", newline="") as f:
        f.write(data + "half a li")
    reader = growing.GrowingLinesReader(path, range_bytes)
    end = reader.latestOffset()
    assert end == {path: len(data)}
    cut = data.index("\n", len(data) // 2) + 1  # a batch that begins behind a line end in the middle
    system, _ = growing._open(path)
    got = [s.decode() for start, stop in (({}, {path: cut}), ({path: cut}, end)) for r in reader.partitions(start, stop)
           for s in growing.lines_of_range(system, r)]
    assert got == lines


def test_files_of_a_path(tmp_path):
    for name in ("a.csv", "b.csv", "c.txt", "_hidden.csv"):
        (tmp_path / name).write_text("1\n")
    assert len(growing._files(str(tmp_path))) == 3 and len(growing._files(f"{tmp_path}/*.csv")) == 2
    assert list(growing._files(f"{tmp_path}/a.csv").values()) == [2] and growing._files(f"{tmp_path}/none/*.csv") == {}
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="shorter"):
        growing.GrowingLinesReader(f"{tmp_path}/a.csv", 10).partitions({"x": 5}, {"x": 3})


def test_appended_lines_arrive_once_over_restarts(spark, tmp_path):
    path, out, ckpt = tmp_path / "feed.csv", str(tmp_path / "out"), str(tmp_path / "ckpt")
    rows = [f"{i},{1377986401 + i},{i / 2},1,0,0,{i % 3}" for i in range(200)]
    parsed = parse_csv(growing.growing_lines(spark, str(path), range_bytes=500))

    def append(text):
        with open(path, "a") as f:
            f.write(text)

    def ids():
        return sorted(r.id for r in spark.read.parquet(out).collect())

    append("\n".join(rows[:50]) + "\n" + rows[50][:9])  # the last line is cut off
    run_bounded(parsed, partition_per_batch(out), "append", ckpt)
    assert ids() == list(range(50))
    append(rows[50][9:] + "\n" + "\n".join(rows[51:120]) + "\n")
    run_bounded(parsed, partition_per_batch(out), "append", ckpt)  # a new run goes on from the checkpoint
    assert ids() == list(range(120))
    run_bounded(parsed, partition_per_batch(out), "append", ckpt)  # nothing new
    append("\n".join(rows[120:]) + "\n")
    run_bounded(parsed, partition_per_batch(out), "append", ckpt)
    assert ids() == list(range(200))
