"""CoNLL files as a data source: `spark.read.format("conll").load(folder)`, `df.write.format("conll").save(folder)`.

A file is read in byte ranges. A sentence belongs to the range in which the blank line before it begins (the first one to the range at 0), and a
reader goes past its range's end to finish the last sentence, so every sentence is read once, whole, wherever the cuts are. Blank lines end sentences, -DOCSTART-
lines don't count, a line's first field is the token and its last the tag; bytes that aren't UTF-8 are dropped.

Written files are moved into the folder when all tasks have ended; a task that fails leaves none there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "file string, at long, tokens array<string>, tags array<string>"
RANGE = 64 << 20


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def sentences(f, start: int, end: int) -> Iterator[tuple[int, list[str], list[str]]]:
    """(place, tokens, tags) of the sentences that belong to a range of an open file."""
    at = max(0, start - 1)
    f.seek(at)
    if start:
        at += len(f.readline())  # the rest of a line that began before the range
    mine, first, words = not start, 0, []
    while True:
        raw = f.readline()
        fields = raw.decode(errors="ignore").split()
        if not fields:  # a blank line, or the end
            if words:
                yield first, [w[0] for w in words], [w[-1] for w in words]
            if not raw or at >= end:
                return
            mine, words = True, []
        elif not mine and at >= end:
            return
        elif mine and not fields[0].startswith("-DOCSTART-"):
            first = first if words else at
            words.append(fields)
        at += len(raw)


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class Reader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[Range]:
        store, path = store_of(self.path)
        found = store.get_file_info(path)
        files = store.get_file_info(fs.FileSelector(path, recursive=True)) if found.type == fs.FileType.Directory else [found]
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        kept = sorted((x.path, x.size) for x in files if x.is_file and x.size and not x.base_name.startswith(("_", ".")))
        return [Range(p, lo, min(n, lo + self.size)) for p, n in kept for lo in range(0, n, self.size)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.path:
            return
        store, _ = store_of(self.path)
        with store.open_input_file(part.path) as raw:
            for at, tokens, tags in sentences(Lines(raw), part.start, part.end):
                yield part.path, at, tokens, tags


class Lines:
    """Lines of a file, read in blocks."""

    def __init__(self, raw, block: int = 1 << 20):
        self.raw, self.block, self.held, self.at = raw, block, b"", 0

    def seek(self, at: int) -> None:
        self.raw.seek(at)
        self.held, self.at = b"", 0

    def readline(self) -> bytes:
        while (cut := self.held.find(b"\n", self.at)) < 0:
            more = self.raw.read(self.block)
            self.held, self.at = self.held[self.at :] + more, 0
            if not more:
                out, self.held = self.held, b""
                return out
        out, self.at = self.held[self.at : cut + 1], cut + 1
        return out


class Part(WriterCommitMessage):
    def __init__(self, draft: str):
        self.draft = draft


class Writer(DataSourceWriter):
    def __init__(self, path: str, names: list[str]):
        self.path, self.at = path, (names.index("tokens"), names.index("tags"))
        self.job = uuid.uuid4().hex

    def write(self, rows: Iterator) -> Part:
        store, path = store_of(self.path)
        draft = f"{path}/_drafts-{self.job}/{uuid.uuid4().hex}"
        store.create_dir(draft.rpartition("/")[0], recursive=True)
        with store.open_output_stream(draft) as out:
            for row in rows:
                tokens, tags = row[self.at[0]], row[self.at[1]]
                if tokens:
                    out.write(("".join(f"{t} {g}\n" for t, g in zip(tokens, tags, strict=True)) + "\n").encode())
        return Part(draft)

    def commit(self, parts: list[Part]) -> None:
        store, path = store_of(self.path)
        for i, p in enumerate(x for x in parts if x):
            store.move(p.draft, f"{path}/part-{i:05d}-{self.job}.conll")
        store.delete_dir(f"{path}/_drafts-{self.job}")

    def abort(self, parts: list[Part]) -> None:
        store, path = store_of(self.path)
        if store.get_file_info(f"{path}/_drafts-{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/_drafts-{self.job}")


class Conll(DataSource):
    """Options: path; `range`, the bytes of a range. Written frames have columns tokens and tags, without white space in either."""

    @classmethod
    def name(cls) -> str:
        return "conll"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], int(self.options.get("range", RANGE)))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Conll)
