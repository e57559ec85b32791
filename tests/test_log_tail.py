"""Every line of growing and rotated files comes once."""

import gzip
import os
import random

import pytest

from botlens.sources import log_tail
from botlens.sources.access_log import follow_lines


def names(folder):
    return sorted(os.listdir(folder))


def read(folder, start, piece=1 << 20):
    """Lines between an offset and now, as the engine would read them; and the new offset."""
    reader = log_tail._Reader(str(folder), "*", piece)
    end = reader.latestOffset()
    rows = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            rows += batch.column(0).to_pylist()
    return rows, end


def append(path, text):
    with open(path, "ab") as file:
        file.write(text.encode() if isinstance(text, str) else text)


START = {"files": "[]"}


def test_appended_lines_and_half_lines(tmp_path):
    log = tmp_path / "access.log"
    append(log, "one\ntwo\nthr")
    rows, at = read(tmp_path, START)
    assert rows == ["one", "two"]
    assert read(tmp_path, at)[0] == []
    append(log, "ee\r\n\nfo")
    rows, at = read(tmp_path, at)
    assert rows == ["three", ""]
    append(log, b"\xffur\n")
    assert read(tmp_path, at)[0] == ["fo�ur"]
    assert read(tmp_path / "nowhere", START)[0] == []


def test_rotation_by_name_and_by_gz(tmp_path):
    log = tmp_path / "access.log"
    append(log, "a1\na2\na3")
    rows, at = read(tmp_path, START)
    append(log, "+\na4")  # the writer still has the old file open
    os.rename(log, tmp_path / "access.log.1")
    append(log, "b1\n")
    more, at = read(tmp_path, at)
    rows += more
    assert sorted(rows) == ["a1", "a2", "a3+", "b1"]
    packed = tmp_path / "access.log.2.gz"
    with gzip.open(packed, "wb") as file:
        file.write((tmp_path / "access.log.1").read_bytes())
    assert read(tmp_path, at)[0] == []  # both are there while it is packed
    os.remove(tmp_path / "access.log.1")
    os.rename(log, tmp_path / "access.log.1")
    append(log, "c1\n")
    more, at = read(tmp_path, at)
    assert sorted(more) == ["a4", "c1"]  # a packed file is complete
    assert read(tmp_path, at)[0] == []


def test_copied_and_cut(tmp_path):
    log = tmp_path / "access.log"
    append(log, "a1\na2\n")
    _, at = read(tmp_path, START)
    append(log, "a3\n")
    append(tmp_path / "access.log.1", log.read_bytes())
    rows, between = read(tmp_path, at)
    assert rows == ["a3"]
    os.truncate(log, 0)
    append(log, "b1\n")
    assert read(tmp_path, between)[0] == ["b1"]
    assert sorted(read(tmp_path, at)[0]) == ["a3", "b1"]


def test_a_repeated_batch_finds_the_moved_file(tmp_path):
    log = tmp_path / "access.log"
    append(log, "".join(f"line {i}\n" for i in range(1000)))
    reader = log_tail._Reader(str(tmp_path), "*", 1 << 20)
    parts = reader.partitions(START, reader.latestOffset())
    os.rename(log, tmp_path / "access.log.1")
    append(log, "new\n")
    rows = [v for p in parts for b in reader.read(p) for v in b.column(0).to_pylist()]
    assert rows == [f"line {i}" for i in range(1000)]


def test_files_that_begin_alike(tmp_path):
    append(tmp_path / "a.log", "same\n")
    append(tmp_path / "b.log", "same\n")
    rows, at = read(tmp_path, START)
    assert rows == ["same"]  # one until they differ
    append(tmp_path / "a.log", "x\n")
    append(tmp_path / "b.log", "y\n")
    rows, at = read(tmp_path, at)
    assert sorted(rows) == ["same", "x", "y"]


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_pieces_meet_at_lines(tmp_path, piece, monkeypatch):
    monkeypatch.setattr(log_tail, "_CHUNK", 16)
    draw = random.Random(3)
    lines = ["x" * draw.randint(0, 40) + str(i) for i in range(60)]
    append(tmp_path / "access.log", "\n".join(lines) + "\n")
    assert read(tmp_path, START, piece)[0] == lines


def test_stream_with_rotation_and_restart(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "logs", tmp_path / "out", tmp_path / "checkpoint"
    folder.mkdir()
    log = folder / "access.log"

    def go():
        lines = follow_lines(spark, str(folder), pattern="access.log*")
        assert lines.isStreaming and lines.columns == ["value"]
        query = (
            lines.writeStream.format("text").option("path", str(out)).option("checkpointLocation", str(checkpoint))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert query.exception() is None
        return sorted(r.value for r in spark.read.text(str(out)).collect())

    append(log, "1\n2\n3 and a ha")
    append(folder / "other.txt", "not a log\n")
    assert go() == ["1", "2"]
    append(log, "lf\n4\n")  # a restart in the middle of a line
    os.rename(log, folder / "access.log.1")
    append(log, "5\n")
    assert go() == ["1", "2", "3 and a half", "4", "5"]
    with gzip.open(folder / "access.log.2.gz", "wb") as file:
        file.write((folder / "access.log.1").read_bytes() + b"late")
    os.remove(folder / "access.log.1")
    append(log, "6\n")
    assert go() == ["1", "2", "3 and a half", "4", "5", "6", "late"]
    assert go() == ["1", "2", "3 and a half", "4", "5", "6", "late"]
