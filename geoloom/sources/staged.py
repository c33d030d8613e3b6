"""Data source writers whose tasks write files in parallel and whose commit gives them their names.

Each task writes to a staging folder beside the target and reports what it wrote;
``commit`` takes the parts that belong to tasks that succeeded (not those of
earlier attempts), puts a manifest beside them and renames; ``abort`` deletes the
staging folder, so a failed job leaves nothing.  Folders may be in any store that
Arrow knows.

``document``: rows as text, either one file for each task, a document of its own,
or one document, which the commit joins from the tasks' bytes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Bytes copied at a time where parts are joined.
CHUNK = 1 << 20
MANIFEST = "_manifest.json"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


@dataclass
class Part(WriterCommitMessage):
    """A file that a task wrote, and the format's notes on it."""

    task: int
    name: str
    rows: int
    notes: list


class StagedWriter(DataSourceWriter):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)
        self.path = self.options["path"].rstrip("/")
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"

    def put(self, out, rows: Iterator) -> tuple[int, list]:
        """Writes a task's rows; returns their number and notes for the commit."""
        raise NotImplementedError

    def join(self, store: fs.FileSystem, staging: str, parts: list[Part], out) -> None:
        """Writes the one file of all parts."""
        for part in parts:
            self.copy(store, f"{staging}/{part.name}", out)

    def copy(self, store: fs.FileSystem, name: str, out, begin: int = 0, size: int | None = None) -> None:
        with store.open_input_file(name) as f:
            f.seek(begin)
            left = size
            while data := f.read(CHUNK if left is None else min(CHUNK, left)):
                out.write(data)
                left = None if left is None else left - len(data)

    def write(self, iterator: Iterator) -> Part:
        at = TaskContext.get()
        store, staging = store_of(self.staging)
        store.create_dir(staging, recursive=True)
        name = f"part-{at.partitionId():05d}-{at.taskAttemptId()}"
        with store.open_output_stream(f"{staging}/{name}") as out:
            rows, notes = self.put(out, iterator)
        return Part(at.partitionId(), name, rows, notes)

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        store, staging = store_of(self.staging)
        _, path = store_of(self.path)
        store.create_dir(staging, recursive=True)
        if self.options.get("single", "false") == "true":
            with store.open_output_stream(f"{staging}/whole") as out:
                self.join(store, staging, parts, out)
            self._clear(store, path)
            store.move(f"{staging}/whole", path)
            store.delete_dir(staging)
            return
        suffix, kept = self.options.get("suffix", ""), [p for p in parts if p.rows]
        for p in parts:
            if p.rows:
                store.move(f"{staging}/{p.name}", f"{staging}/part-{p.task:05d}{suffix}")
            else:
                store.delete_file(f"{staging}/{p.name}")
        with store.open_output_stream(f"{staging}/{MANIFEST}") as out:
            out.write(json.dumps({"parts": [{"name": f"part-{p.task:05d}{suffix}", "rows": p.rows} for p in kept], "rows": sum(p.rows for p in kept)}).encode())
        self._clear(store, path)
        store.move(staging, path)

    def abort(self, messages: list[Part | None]) -> None:
        store, staging = store_of(self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)

    @staticmethod
    def _clear(store: fs.FileSystem, path: str) -> None:
        """Removes what an earlier job wrote under the name."""
        kind = store.get_file_info(path).type
        if kind == fs.FileType.Directory:
            store.delete_dir(path)
        elif kind == fs.FileType.File:
            store.delete_file(path)


class DocumentWriter(StagedWriter):
    """Options: path, single, suffix, head, first (before the first row), between, tail, empty (the tail without rows), indent (spaces of JSON rows, their lines moved in by as many), ascii, escape (``</`` as ``<\\/``)."""

    def put(self, out, rows: Iterator) -> tuple[int, list]:
        o, n = self.options, 0
        indent, single = int(o.get("indent", 0)), o.get("single", "false") == "true"
        if not single:
            out.write(o.get("head", "").encode())
        for r in rows:
            text = json.dumps(r.asDict(True), indent=indent or None, ensure_ascii=o.get("ascii", "true") == "true")
            if indent:
                text = " " * indent + text.replace("\n", "\n" + " " * indent)
            if o.get("escape") == "true":
                text = text.replace("</", "<\\/")
            out.write(((o.get("between", "\n") if n else "" if single else o.get("first", "")) + text).encode())
            n += 1
        if not single:
            out.write(o["empty"].encode() if not n and "empty" in o else o.get("tail", "").encode())
        return n, []

    def join(self, store: fs.FileSystem, staging: str, parts: list[Part], out) -> None:
        o, begun = self.options, False
        out.write(o.get("head", "").encode())
        for p in parts:
            if p.rows:
                out.write(o.get(*(("between", "\n") if begun else ("first", ""))).encode())
                self.copy(store, f"{staging}/{p.name}", out)
                begun = True
        out.write((o.get("tail", "") if begun else o.get("empty", o.get("tail", ""))).encode())


class DocumentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "document"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(dict(self.options))


def save(rows: DataFrame, source: type[DataSource], path: str, **options: str) -> int:
    """Writes rows by a source's writer; returns how many there were."""
    rows.sparkSession.dataSource.register(source)
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format(source.name()).mode("append").options(path=path, **options).save()
    return int(seen.get["n"])
