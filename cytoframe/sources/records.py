"""FASTQ and SAM files as Python data sources: `spark.read.format("fastq").load(folder)`, the same with readStream, and writers.

Files are planned as byte ranges of at most `split_bytes`, small files together in one task. A range owns the records that begin in it:
its reader looks for the first of them and reads the last to its end, so no record is cut or read twice and no exchange is needed.
Compressed files are read whole by one task. Rows are Arrow batches of some megabytes, so no file has to fit in memory.

A stream keeps a log of the files that each of its batches took in, in a folder beside the checkpoint (option `log`): a batch that is
planned again, also after a restart, has the same files, and a file is taken in once.

Paths are local ones or URIs that pyarrow's file systems know (file, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from cytoframe.sources.ingress import ALIGNED, FASTQ

SPLIT_BYTES, BLOCK_BYTES = 128 << 20, 2 << 20
FASTQ_SCHEMA = "file string, folder string, read_id string, seq string, qual string, comment string"
SAM_SCHEMA = "file string, folder string, at long, line string"


def file_system(path: str):
    """pyarrow's file system of a path, and the path inside it."""
    from pyarrow import fs

    if ":/" in path:
        return fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1))
    return fs.LocalFileSystem(), path


@dataclass
class Found:
    """An input file: its folder is the sub-folder that it lies in, or None at the top."""

    path: str
    folder: str | None
    size: int


def listed(path: str, extensions: tuple[str, ...], *, unclassified: bool = False, sheet: dict | None = None, strict: bool = False) -> list[Found]:
    """Input files under a path, sorted; only names are read.

    Files of other extensions and parts named `unclassified` (unless wanted) or ending in `_fail` are left out. Files in the folder and in
    sub-folders at once, or deeper than one level, are errors. With a sheet, so are files at the top, and folders that it lacks are left
    out, or if `strict`, as in streams, errors.
    """
    from pyarrow import fs

    system, base = file_system(path)
    info = system.get_file_info(base)
    if info.type == fs.FileType.File:
        return [Found(base, None, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    base = base.rstrip("/")
    out = []
    for f in system.get_file_info(fs.FileSelector(base, recursive=True)):
        inner = f.path[len(base) :].strip("/").split("/")
        if f.type != fs.FileType.File or not f.path.endswith(extensions) or any(p.endswith("_fail") or (p == "unclassified" and not unclassified) for p in inner):
            continue
        if len(inner) > 2:
            raise ValueError(f"input files lie deeper than one sub-folder: {f.path}")
        out.append(Found(f.path, inner[0] if len(inner) == 2 else None, f.size))
    if len({f.folder is None for f in out}) > 1:
        raise ValueError("input files lie in the folder and in sub-folders")
    if sheet is not None:
        if any(f.folder is None for f in out):
            raise ValueError("input files lie in the folder itself although a sample sheet names sub-folders")
        unknown = sorted({f.folder for f in out if f.folder not in sheet})
        if unknown and strict:
            raise ValueError(f"sub-folders that the sample sheet lacks: {', '.join(unknown)}")
        out = [f for f in out if f.folder in sheet]
    return sorted(out, key=lambda f: f.path)


class Ranges(InputPartition):
    """What one task reads: (path, folder, first byte, one past the last; -1 for a compressed file)."""

    def __init__(self, parts: list[tuple[str, str | None, int, int]]):
        self.parts = parts


def planned(files: list[Found], split_bytes: int) -> list[Ranges]:
    """Ranges of large plain files by themselves, other files together until they reach split_bytes."""
    out, held, size = [], [], 0
    for f in files:
        if f.path.endswith(".gz"):
            parts = [(f.path, f.folder, 0, -1)]
        else:
            parts = [(f.path, f.folder, a, min(a + split_bytes, f.size)) for a in range(0, f.size, split_bytes)]
        for p in parts:
            own = f.size if p[3] < 0 else p[3] - p[2]
            if held and size + own > split_bytes:
                out.append(Ranges(held))
                held, size = [], 0
            held.append(p)
            size += own
    return [*out, Ranges(held)] if held else out


class Lines:
    """Whole lines of a file from a byte on, some megabytes at a time."""

    def __init__(self, system, path: str, first: int):
        self.file = system.open_input_stream(path, compression="gzip") if path.endswith(".gz") else system.open_input_file(path)
        self.at, self.rest, self.over = first, b"", False
        if first:  # the byte before tells whether a line begins here
            self.file.seek(first - 1)
            self.at = first - 1
            self.fill()
            end = self.rest.find(b"\n")
            while end < 0 and not self.over:
                self.fill()
                end = self.rest.find(b"\n")
            self.drop(end + 1 if end >= 0 else len(self.rest))

    def fill(self) -> None:
        block = self.file.read(BLOCK_BYTES)
        self.over = not block
        self.rest += block

    def drop(self, n: int) -> None:
        self.rest, self.at = self.rest[n:], self.at + n

    def take(self, least: int) -> list[bytes]:
        """All whole lines at hand, at least so many unless the file ends; the last line of a file needs no end mark."""
        while not self.over and self.rest.count(b"\n") < least:
            self.fill()
        lines = self.rest.split(b"\n")
        if not self.over or not lines[-1]:
            lines.pop()
        return lines


def fastq_batches(system, path: str, folder: str | None, first: int, stop: int, truncated: str) -> Iterator[pa.RecordBatch]:
    """Records of one range. A line begins a record if it begins with '@' and the line after next with '+': no other line can do both."""
    lines = Lines(system, path, first)
    if first:
        ahead = lines.take(6)
        begin = next((i for i in range(min(4, max(0, len(ahead) - 2))) if ahead[i][:1] == b"@" and ahead[i + 2][:1] == b"+"), None)
        if begin is None:
            return
        lines.drop(sum(len(x) + 1 for x in ahead[:begin]))
    while stop < 0 or lines.at < stop:
        own = lines.take(4)
        n = len(own) // 4
        if not n:
            if any(x.strip() for x in own) and truncated == "error":
                raise ValueError(f"{path}: the file ends inside a record that begins at byte {lines.at}")
            return
        own = own[: 4 * n]
        to = np.cumsum(np.fromiter(map(len, own), np.int64, 4 * n) + 1)[3::4]
        if stop >= 0:
            n = min(n, 1 + int(np.searchsorted(lines.at + to, stop)))
            own = own[: 4 * n]
        begin = lines.at
        lines.drop(int(to[n - 1]))
        if any(b"\r" in x for x in own[:4]):
            own = [x.rstrip(b"\r") for x in own]
        head, seq, plus, qual = own[::4], own[1::4], own[2::4], own[3::4]
        for i in range(n):
            if head[i][:1] != b"@" or plus[i][:1] != b"+" or len(seq[i]) != len(qual[i]):
                raise ValueError(f"{path}: no record of four lines at byte {begin + (int(to[i - 1]) if i else 0)}")
        names = [h[1:].replace(b"\t", b" ").split(b" ", 1) for h in head]
        text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
        comment = [h[len(x[0]) + 2 :] or None for h, x in zip(head, names, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([folder] * n, pa.string()), text([x[0] for x in names]), text(seq), text(qual), text(comment)], names=["file", "folder", "read_id", "seq", "qual", "comment"])


def sam_batches(system, path: str, folder: str | None, first: int, stop: int, truncated: str) -> Iterator[pa.RecordBatch]:
    """Lines of one range with the byte that each begins at, header lines too; empty ones are left out."""
    lines = Lines(system, path, first)
    while stop < 0 or lines.at < stop:
        own = lines.take(1)
        if not own:
            return
        to = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
        n = len(own) if stop < 0 else min(len(own), 1 + int(np.searchsorted(lines.at + to, stop)))
        kept = np.array([bool(x.strip()) for x in own[:n]])
        at = (lines.at + np.concatenate([[0], to[: n - 1]]))[kept]
        lines.drop(int(to[n - 1]))
        own = [x.rstrip(b"\r") for x in own[:n] if x.strip()]
        yield pa.RecordBatch.from_arrays([pa.array([path] * len(own)), pa.array([folder] * len(own), pa.string()), pa.array(at, pa.int64()), pa.array(own, pa.binary()).cast(pa.string())], names=["file", "folder", "at", "line"])


class _Reader:
    """Reads planned ranges; what batch and stream share."""

    def __init__(self, source: _Source):
        o = source.options
        self.path, self.extensions, self.batches = o.get("path"), source.extensions, source.batches
        if not self.path:
            raise ValueError("load() needs a path")
        self.split_bytes = int(o.get("split_bytes", SPLIT_BYTES))
        self.truncated = o.get("truncated", "error")
        self.unclassified = o.get("unclassified", "false").lower() == "true"
        self.sheet = json.loads(o["sheet"]) if "sheet" in o else None
        if self.split_bytes < 1 or self.truncated not in ("error", "drop"):
            raise ValueError("split_bytes must be positive, truncated 'error' or 'drop'")

    def found(self, strict: bool = False) -> list[Found]:
        return listed(self.path, self.extensions, unclassified=self.unclassified, sheet=self.sheet, strict=strict)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        for path, folder, first, stop in partition.parts:
            yield from self.batches(system, path, folder, first, stop, self.truncated)


class BatchReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Ranges]:
        return planned(self.found(), self.split_bytes) or [Ranges([])]


class StreamReader(_Reader, DataSourceStreamReader):
    """Offsets count the batches that the log holds; what each took in stands there."""

    def __init__(self, source: _Source):
        super().__init__(source)
        if "log" not in source.options:
            raise ValueError("a stream needs the option log: a folder beside its checkpoint")
        self.log_system, self.log = file_system(source.options["log"])
        self.log_system.create_dir(self.log, recursive=True)
        self.taken: list[list[dict]] = []

    def _load(self) -> None:
        from pyarrow import fs

        while self.log_system.get_file_info(at := f"{self.log}/{len(self.taken)}.json").type == fs.FileType.File:
            with self.log_system.open_input_stream(at) as f:
                self.taken.append(json.loads(f.read()))

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        self._load()
        seen = {f["path"] for batch in self.taken for f in batch}
        if new := [vars(f) for f in self.found(strict=True) if f.path not in seen]:
            at = f"{self.log}/{len(self.taken)}.json"
            with self.log_system.open_output_stream(f"{at}.tmp") as f:
                f.write(json.dumps(new).encode())
            self.log_system.move(f"{at}.tmp", at)
            self.taken.append(new)
        return {"batch": len(self.taken)}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        self._load()
        return planned([Found(**f) for batch in self.taken[start["batch"] : end["batch"]] for f in batch], self.split_bytes) or [Ranges([])]

    def commit(self, end: dict) -> None:
        """The log stays: a restart replays from it."""


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: where they are, and where they go when all tasks are done."""

    moves: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    """Text files, gzip unless compression is none. A row's folder, if there is such a column, is the sub-folder that it goes to.

    Files get their names when all tasks are done; a task that runs again leaves nothing behind.
    """

    needed: tuple[str, ...]
    end: str

    def __init__(self, source: _Source, columns: list[str], overwrite: bool):
        o = source.options
        self.path, self.columns, self.overwrite, self.extensions = o.get("path"), columns, overwrite, source.extensions
        self.compression = o.get("compression", "gzip")
        if not self.path or self.compression not in ("gzip", "none"):
            raise ValueError("save() needs a path, and compression gzip or none")
        if missing := set(self.needed) - set(columns):
            raise ValueError(f"no column {', '.join(sorted(missing))}")

    def column(self, batch: pa.RecordBatch, name: str) -> list:
        return batch.column(batch.schema.get_field_index(name)).to_pylist() if name in self.columns else [None] * batch.num_rows

    def texts(self, batch: pa.RecordBatch) -> Iterator[tuple[str | None, str | None, str]]:
        """Folder, file name without its end (None for one of the task's own) and text of each row."""
        raise NotImplementedError

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = file_system(self.path)
        task, open_, moves = uuid.uuid4().hex, {}, []
        end = self.end + (".gz" if self.compression == "gzip" else "")
        try:
            for batch in iterator:
                parts: dict[tuple, list[str]] = {}
                for folder, name, text in self.texts(batch):
                    parts.setdefault((folder, name), []).append(text)
                for (folder, name), lines in parts.items():
                    if (folder, name) not in open_:
                        at = f"{base}/{folder}" if folder else base
                        system.create_dir(at, recursive=True)
                        moves.append((f"{at}/_{task}-{len(moves)}.tmp", f"{at}/{name or f'part-{task}'}{end}"))
                        open_[folder, name] = system.open_output_stream(moves[-1][0], compression="gzip" if self.compression == "gzip" else None)
                    open_[folder, name].write("".join(lines).encode())
        finally:
            for out in open_.values():
                out.close()
        return Written(moves)

    def commit(self, messages: list[Written | None]) -> None:
        system, base = file_system(self.path)
        kept = [m for message in messages if message for m in message.moves]
        if self.overwrite:
            own = {a for a, _ in kept}
            for f in listed(self.path, self.extensions, unclassified=True) if self.exists(system, base) else []:
                if f.path not in own:
                    system.delete_file(f.path)
        for a, b in kept:
            system.move(a, b)

    def exists(self, system, base: str) -> bool:
        from pyarrow import fs

        return system.get_file_info(base).type != fs.FileType.NotFound

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = file_system(self.path)
        for message in messages:
            for a, _ in message.moves if message else ():
                system.delete_file(a)


class FastqWriter(_Writer):
    """Reads (read_id, seq, qual, and if there: comment, folder). Those without bases are left out; a task has a file for each folder."""

    needed, end = ("read_id", "seq", "qual"), ".fastq"

    def texts(self, batch: pa.RecordBatch) -> Iterator[tuple[str | None, str | None, str]]:
        for i, s, q, c, f in zip(*(self.column(batch, c) for c in ("read_id", "seq", "qual", "comment", "folder")), strict=True):
            if s:
                yield f, None, f"@{i}{f' {c}' if c else ''}\n{s}\n+\n{q}\n"


class SamWriter(_Writer):
    """Lines (line, and if there: name, folder) in the order in which they come. All lines of one name must be in one partition."""

    needed, end = ("line",), ".sam"

    def texts(self, batch: pa.RecordBatch) -> Iterator[tuple[str | None, str | None, str]]:
        for line, name, folder in zip(*(self.column(batch, c) for c in ("line", "name", "folder")), strict=True):
            yield folder, name, f"{line}\n"


class _Source(DataSource):
    extensions: tuple[str, ...]
    batches = None

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(self)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self)


class FastqSource(_Source):
    """Reads of four-line FASTQ files, plain or gzip, and their writer. Options: split_bytes, truncated (error or drop), unclassified, sheet (JSON), log."""

    extensions, batches = FASTQ, staticmethod(fastq_batches)

    def writer(self, schema: StructType, overwrite: bool) -> FastqWriter:
        return FastqWriter(self, schema.names, overwrite)

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return FASTQ_SCHEMA


class SamSource(_Source):
    """Lines of SAM files, plain or gzip, and their writer. The same options."""

    extensions, batches = tuple(x for x in ALIGNED if "sam" in x), staticmethod(sam_batches)

    def writer(self, schema: StructType, overwrite: bool) -> SamWriter:
        return SamWriter(self, schema.names, overwrite)

    @classmethod
    def name(cls) -> str:
        return "sam_lines"

    def schema(self) -> str:
        return SAM_SCHEMA


def register(spark: SparkSession) -> None:
    """Makes both formats known to a session."""
    for source in (FastqSource, SamSource):
        spark.dataSource.register(source)


def fastq(spark: SparkSession, path: str, **options) -> DataFrame:
    """Reads of a folder or file."""
    register(spark)
    return spark.read.format("fastq").options(**options).load(path)


def fastq_stream(spark: SparkSession, path: str, log: str, **options) -> DataFrame:
    """Reads of a landing folder as a stream, existing files first. Writers must move finished files in, as for all file streams."""
    register(spark)
    return spark.readStream.format("fastq").options(log=log, **options).load(path)
