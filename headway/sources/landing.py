"""Spark data source for landed GTFS-realtime snapshots: ``spark.read.format("gtfs_rt")`` and
``df.write.format("gtfs_rt")``.

Layout: ``<root>/<feed>/dt=YYYY-MM-DD/hour=HH/<poll>.pb``, one FeedMessage per file; a poll written in parts has
``<poll>-c<n>.pb`` or ``<poll>-p<n>.pb`` beside it and is one poll.

Reading: the driver lists day and hour folders only (``days`` names the day folders, others are never listed); each
hour is a partition of its own.  Its task lists the hour's files, keeps every ``stride``-th poll in name order, opens
those files alone and decodes them into Arrow columns (:mod:`headway.sources.gtfs_rt_columns`).  No list of files
reaches the driver, and skipped files are never opened.

Writing: rows of the decoded layout plus ``path`` (below the root) become messages, one per path, or several
parts of ``max_entities`` rows.  A task writes its files under hidden names, notes them in a list of its own below
``_landing/<job>`` and then renames them; a retried task makes the same names with the same content.  A commit marks the
job complete, an abort deletes the files of the lists.  Files go through ``pyarrow.fs``, so any store it knows serves as landing root.

The feed's rows must come clustered and sorted by path (:func:`headway.sources.gtfs_rt.land`).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "gtfs_rt"
MAX_ENTITIES = 50_000
LISTS = "_landing"
PART = re.compile(r"(?:-[cp][0-9]+)+\.pb$")


def store(root: str):
    """File system and path of a landing root (a local path or any URI that ``pyarrow.fs`` knows)."""
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def _folders(files, path: str, prefix: str) -> list[str]:
    from pyarrow import fs

    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(prefix))


@dataclass
class Hour(InputPartition):
    path: str


@dataclass
class Landed(WriterCommitMessage):
    files: int


class LandingReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.root, self.feed = options["path"].rstrip("/"), options["feed"]
        self.stride = int(options.get("stride", 1))
        self.days = [d for d in options.get("days", "").split(",") if d] if "days" in options else None
        self.schema = schema

    def partitions(self) -> list[InputPartition]:
        files, base = store(f"{self.root}/{self.feed}")
        days = _folders(files, base, "dt=") if self.days is None else [f"{base}/dt={d}" for d in self.days]
        return [Hour(h) for d in days for h in _folders(files, d, "hour=")] or [Hour("")]

    def read(self, partition: Hour) -> Iterator:
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        from headway.sources.gtfs_rt_columns import decode_files

        if not partition.path:
            return
        files, _ = store(self.root)
        listed = sorted(f.path for f in files.get_file_info(fs.FileSelector(partition.path))
                        if f.type == fs.FileType.File and f.base_name.endswith(".pb") and not f.base_name.startswith((".", "_")))
        polls = sorted({PART.sub(".pb", p) for p in listed})
        kept = set(polls[::self.stride])

        def contents() -> Iterator[tuple[str, bytes]]:
            for p in listed:
                if PART.sub(".pb", p) in kept:
                    with files.open_input_stream(p) as f:
                        yield p, f.read()

        yield from decode_files(contents(), self.feed, to_arrow_schema(self.schema))


class LandingWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.root, self.feed, self.schema = options["path"].rstrip("/"), options["feed"], schema
        self.most = int(options.get("max_entities", MAX_ENTITIES))
        self.job = uuid.uuid4().hex
        self.lists = f"{LISTS}/{self.job}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from headway.sources.gtfs_rt_columns import encode_rows

        files, base = store(self.root)
        attempt = uuid.uuid4().hex
        names: list[str] = []
        made: set[str] = set()

        def hidden(name: str) -> str:
            folder, _, last = f"{base}/{name}".rpartition("/")
            if folder not in made:
                files.create_dir(folder, recursive=True)
                made.add(folder)
            return f"{folder}/.{last}.{attempt}"

        def put(name: str, content: bytes) -> None:
            with files.open_output_stream(hidden(name)) as f:
                f.write(content)

        try:
            for name, content in encode_rows(iterator, self.feed, self.most):
                put(name, content)
                names.append(name)
        except BaseException:
            for name in names:
                files.delete_file(hidden(name))
            raise
        if names:
            listed = f"{self.lists}/{attempt}.txt"
            put(listed, "\n".join(names).encode())
            for name in [listed, *names]:                  # an abort knows every file that may have become visible
                files.move(hidden(name), f"{base}/{name}")
        return Landed(len(names))

    def commit(self, messages: list) -> None:
        files, base = store(self.root)
        folder = f"{base}/{self.lists}"
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/_COMMITTED") as f:
            f.write(str(sum(m.files for m in messages if m is not None)).encode())

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        files, base = store(self.root)
        for listed in files.get_file_info(fs.FileSelector(f"{base}/{self.lists}", allow_not_found=True)):
            with files.open_input_stream(listed.path) as f:
                for name in f.read().decode().split("\n"):
                    if files.get_file_info(f"{base}/{name}").type == fs.FileType.File:
                        files.delete_file(f"{base}/{name}")
        if files.get_file_info(f"{base}/{self.lists}").type == fs.FileType.Directory:
            files.delete_dir(f"{base}/{self.lists}")


class LandingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        from headway.sources.gtfs_rt import DECODED_DDL, KINDS

        return DECODED_DDL[KINDS[self.options["feed"]]]

    def reader(self, schema: StructType) -> DataSourceReader:
        return LandingReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("landed snapshots are only ever added: use mode('append')")
        return LandingWriter(self.options, schema)
