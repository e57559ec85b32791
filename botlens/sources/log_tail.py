"""Follow growing and rotated log files: a streaming source of lines with byte offsets.

A file stream takes a file once; this source goes on where it stopped. Its offset names every file of the
folder with the hashes of its first 1, 2, 4, ... lines and the byte after its last whole line. A file is
known again by those hashes, whatever it is called by now: renamed (``access.log`` to ``access.log.1``), copied
and cut, or packed (``.gz``, positions are those of the unpacked bytes). So each line is read once:

* lines that were appended come with the next batch, a line without its line break waits for it;
* the rest of a renamed or packed file is read before or together with the new file;
* a ``.gz`` file is taken to be complete, a last line without a line break included;
* of files that begin alike the plain and longer one counts, so a file being packed or copied is not read twice.

A batch that is repeated after a failure reads the same bytes, from the file they are in now. Ranges are cut into
pieces of ``piece_bytes``, each a task. Files are reached through Arrow's file systems, local or remote, on the
driver (listing, the first 8 KB and the end of changed files) and in the tasks.

Limits: a file that goes away before it was read is lost; two files that begin with the same lines count as one
until they differ; a file cut and filled with the same first lines again looks unchanged.
"""

from __future__ import annotations

import fnmatch
import hashlib
import json
import posixpath
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "botlens_tail"
SCHEMA = "value string, file string, position bigint"
_HEAD, _CHUNK, _PATIENCE = 8192, 1 << 22, 100
#: End of a range that goes to the end of a packed file.
_ALL = -1


def _heads(start: bytes, whole: bool) -> dict[str, str]:
    """Hashes of the first 1, 2, 4, ... lines within the first bytes of a file; none without a whole line."""
    out, at, lines, wanted = {}, 0, 0, 1
    while (stop := start.find(b"\n", at)) >= 0:
        at, lines = stop + 1, lines + 1
        if lines == wanted:
            out[str(lines)] = hashlib.sha256(start[:at]).hexdigest()[:16]
            wanted *= 2
    if not out and (len(start) >= _HEAD or whole and start):
        out["0"] = hashlib.sha256(start).hexdigest()[:16]
    return out


def _alike(one: dict[str, str], other: dict[str, str]) -> bool:
    common = one.keys() & other.keys()
    return bool(common) and one[max(common, key=int)] == other[max(common, key=int)]


class _Folder:
    """The log files of a folder through an Arrow file system."""

    def __init__(self, path: str, pattern: str):
        self.files, self.path = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        self.pattern = pattern
        self.seen: dict[str, tuple] = {}

    def _open(self, name: str) -> pa.NativeFile:
        path = posixpath.join(self.path, name)
        if name.endswith(".gz"):
            return self.files.open_input_stream(path, compression="gzip")
        return self.files.open_input_file(path)

    def head(self, name: str) -> dict[str, str]:
        with self._open(name) as file:
            return _heads(file.read(_HEAD), name.endswith(".gz"))

    def _end(self, name: str, size: int) -> int:
        """The byte after the last line break among the first ``size`` bytes."""
        with self._open(name) as file:
            stop = size
            while stop > 0:
                start = max(0, stop - (1 << 16))
                file.seek(start)
                found = file.read(stop - start).rfind(b"\n")
                if found >= 0:
                    return start + found + 1
                stop = start
        return 0

    def listed(self) -> list[tuple[int, dict]]:
        """(size, entry) of every file with something to read; unchanged files are not opened again."""
        out, seen = [], {}
        selector = pafs.FileSelector(self.path, allow_not_found=True)
        for info in self.files.get_file_info(selector):
            name = posixpath.basename(info.path)
            if info.type != pafs.FileType.File or not fnmatch.fnmatch(name, self.pattern) or not info.size:
                continue
            state = (info.size, info.mtime_ns)
            kept = self.seen.get(name)
            if kept is None or kept[0] != state:
                try:
                    heads = self.head(name)
                    end = _ALL if name.endswith(".gz") else self._end(name, info.size)
                except (OSError, EOFError):  # renamed or still being packed: the next listing has it
                    continue
                kept = state, {"name": name, "heads": heads, "end": end}
            seen[name] = kept
            if kept[1]["heads"] and kept[1]["end"]:
                out.append((info.size, kept[1]))
        self.seen = seen
        return out

    def snapshot(self) -> list[dict]:
        """One entry for each different file; of those that begin alike the plain and longest one."""
        entries: list[dict] = []
        ordered = sorted(self.listed(), key=lambda f: (f[1]["end"] == _ALL, -f[0], f[1]["name"]))
        for _, entry in ordered:
            if not any(_alike(entry["heads"], other["heads"]) for other in entries):
                entries.append(entry)
        return sorted(entries, key=lambda e: e["name"])

    def name_of(self, name: str, heads: dict[str, str]) -> str:
        """The file that holds the content now; its old name is tried first."""
        for found in [name, *(e["name"] for e in self.snapshot())]:
            try:
                if _alike(self.head(found), heads):
                    return found
            except (OSError, EOFError):
                continue
        raise FileNotFoundError(f"the content of {name} is in no file of {self.path} any more")

    def lines(self, name: str, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
        """(position, line) of the lines that start in [begin, end), or from begin on in a packed file."""
        with self._open(name) as file:
            packed = name.endswith(".gz")
            at = self._skip(file, begin) if packed else max(begin - 1, 0)
            rest = b""
            if not packed:
                file.seek(at)
            aligned = packed or begin == 0
            while True:
                chunk = file.read(_CHUNK)
                data = rest + chunk
                if not aligned:  # the line that begins before the range belongs to the piece before
                    cut = data.find(b"\n") + 1
                    if not cut and chunk:
                        rest = data
                        continue
                    data, at, aligned = data[cut:], at + (cut or len(data)), True
                start = 0
                while (stop := data.find(b"\n", start)) >= 0:
                    if end != _ALL and at + start >= end:
                        return
                    yield at + start, data[start:stop]
                    start = stop + 1
                rest, at = data[start:], at + start
                if not chunk:
                    if packed and rest:
                        yield at, rest
                    return
                if end != _ALL and at >= end:
                    return

    @staticmethod
    def _skip(file: pa.NativeFile, count: int) -> int:
        left = count
        while left and (data := file.read(min(left, _CHUNK))):
            left -= len(data)
        return count - left


def added(start: list[dict], end: list[dict]) -> list[tuple[dict, int]]:
    """Entries of ``end`` with unread bytes, and where to begin: the same file is looked for in ``start``."""
    left, out = list(start), []
    # By name first: of files that begin alike, each goes on with itself.
    for entry in sorted(end, key=lambda e: not any(e["name"] == s["name"] and _alike(e["heads"], s["heads"]) for s in start)):
        same = [s for s in left if _alike(s["heads"], entry["heads"])]
        known = next((s for s in same if s["name"] == entry["name"]), same[0] if same else None)
        if known is not None:
            left.remove(known)
        begin = known["end"] if known is not None else 0
        if begin != _ALL and (entry["end"] == _ALL or begin < entry["end"]):
            out.append((entry, begin))
    return out


@dataclass
class _Piece(InputPartition):
    name: str
    heads: dict[str, str]
    begin: int
    end: int

    def __init__(self, name: str, heads: dict[str, str], begin: int, end: int):
        super().__init__((name, begin))
        self.name, self.heads, self.begin, self.end = name, heads, begin, end


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, pattern: str, piece_bytes: int):
        self.path, self.pattern, self.piece_bytes = path, pattern, piece_bytes
        self.folder: _Folder | None = None
        self.last: list[dict] = []
        self.missing: dict[str, int] = {}

    def _folder(self) -> _Folder:
        if self.folder is None:
            self.folder = _Folder(self.path, self.pattern)
        return self.folder

    def initialOffset(self) -> dict:
        return {"files": "[]"}

    def latestOffset(self) -> dict:
        found = self._folder().snapshot()
        # A file may be between two names while the folder is listed: it stays known for a while.
        lost = [e for e in self.last if not any(_alike(e["heads"], f["heads"]) for f in found)]
        self.missing = {k: self.missing.get(k, 0) + 1 for k in (json.dumps(e, sort_keys=True) for e in lost)}
        kept = [e for e in lost if self.missing[json.dumps(e, sort_keys=True)] <= _PATIENCE]
        self.last = sorted([*found, *kept], key=lambda e: e["name"])
        return {"files": json.dumps(self.last, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        pieces = []
        for entry, begin in added(json.loads(start["files"]), json.loads(end["files"])):
            step = self.piece_bytes if entry["end"] != _ALL else 0
            at = begin
            while step and at + step < entry["end"]:
                pieces.append(_Piece(entry["name"], entry["heads"], at, at + step))
                at += step
            pieces.append(_Piece(entry["name"], entry["heads"], at, entry["end"]))
        return pieces

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        folder = _Folder(self.path, self.pattern)
        name = folder.name_of(partition.name, partition.heads)
        positions, values, size = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(values, pa.string()), pa.array([name] * len(values), pa.string()), pa.array(positions, pa.int64())],
                names=["value", "file", "position"],
            )

        for position, line in folder.lines(name, partition.begin, partition.end):
            positions.append(position)
            values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            size += len(line)
            if size > _CHUNK or len(values) >= 10_000:
                yield batch()
                positions, values, size = [], [], 0
        if values:
            yield batch()

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class LogTail(DataSource):
    """``spark.readStream.format("botlens_tail").load(folder)``; options ``pattern`` and ``piece_bytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        path = self.options["path"]
        return _Reader(path, self.options.get("pattern", "*"), int(self.options.get("piece_bytes", 64 << 20)))


def tail_lines(spark: SparkSession, path: str, pattern: str = "*", piece_bytes: int = 64 << 20) -> DataFrame:
    """Lines of the files in a folder, for ever: value, file, position (byte of the line's start)."""
    # By value, so that workers need no copy of this package to list and read.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LogTail)
    reader = spark.readStream.format(NAME).option("pattern", pattern).option("piece_bytes", piece_bytes)
    return reader.load(path)
