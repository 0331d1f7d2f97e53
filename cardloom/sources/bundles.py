"""Bundles of frozen files as a Spark data source: objects under their SHA-256, written once, and read back with each one's check.

    spark.dataSource.register(Bundles)
    files.write.format("bundle").mode("append").save(path)   # files(target, name, uri, content)
    spark.read.format("bundle").load(path)

A bundle is a folder with objects/sha256/aa/<digest>, parts of the manifest as JSON lines, and manifest.json, which names the parts with their digests and whose own digest is the
bundle's id. Each task writes its objects and one part; the driver gathers one short message a task. All stands in a folder beside the
bundle until the job commits and renames it, so readers see a whole bundle or none; a bundle that is there is never written to.
Paths are of any file system that pyarrow knows; driver and executors must share it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

SHAPE = "target string, name string, uri string, sha256 string, size_bytes long, content binary, fault string"
GIVEN = ("target", "name", "uri", "content")


def _digest(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def object_path(digest: str) -> str:
    return f"objects/sha256/{digest[:2]}/{digest}"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):  # how Hadoop writes local paths
        path = f"file://{path[5:]}"
    system, at = fs.FileSystem.from_uri(path)
    return system, at.rstrip("/")


def _there(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


def _write(system: fs.FileSystem, path: str, content: bytes) -> None:
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(content)


def _read(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path) as given:
        return given.read()


@dataclass
class Written(WriterCommitMessage):
    part: str
    sha256: str
    files: int
    size_bytes: int


class BundleWriter(DataSourceWriter):
    """Writes files(target, name, uri, content); null content is an absence, kept in the manifest without an object. Other columns are an error."""

    def __init__(self, path: str, schema: StructType) -> None:
        if set(schema.names) != set(GIVEN):
            raise ValueError(f"a bundle takes the columns {', '.join(GIVEN)}")
        self.path = path.rstrip("/")
        head, _, tail = self.path.rpartition("/")
        self.work = f"{head}/.{tail}.tmp-{uuid.uuid4().hex}"
        self._refuse()

    def _refuse(self) -> None:
        system, at = _open(self.path)
        if _there(system, at):
            raise FileExistsError(f"a bundle is never written over: {self.path}")

    def write(self, iterator: Iterator[Row]) -> Written:
        system, work = _open(self.work)
        lines, size = [], 0
        for row in iterator:
            content = None if row["content"] is None else bytes(row["content"])
            digest = None if content is None else _digest(content)
            if digest is not None:
                path, mine = f"{work}/{object_path(digest)}", f"{work}/parts/{uuid.uuid4().hex}"
                if not _there(system, path):  # written aside and renamed: of two tasks with one content either may come last
                    _write(system, mine, content)
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    system.move(mine, path)
                size += len(content)
            lines.append(json.dumps({"target": row["target"], "name": row["name"], "uri": row["uri"], "sha256": digest, "size_bytes": None if content is None else len(content)}, ensure_ascii=False, sort_keys=True))
        part = f"manifest/{uuid.uuid4().hex}.jsonl"
        text = "".join(line + "\n" for line in sorted(lines)).encode()
        _write(system, f"{work}/{part}", text)
        return Written(part, _digest(text), len(lines), size)

    def commit(self, messages: list[Written | None]) -> None:
        done = sorted((m for m in messages if m), key=lambda m: (m.sha256, m.part))
        self._refuse()
        system, work = _open(self.work)
        manifest = {"files": sum(m.files for m in done), "size_bytes": sum(m.size_bytes for m in done), "parts": [{"path": m.part, "sha256": m.sha256, "files": m.files} for m in done]}
        _write(system, f"{work}/manifest.json", json.dumps(manifest, sort_keys=True).encode())
        system.move(work, _open(self.path)[1])

    def abort(self, messages: list[Written | None]) -> None:
        system, work = _open(self.work)
        if _there(system, work):
            system.delete_dir(work)


class Part(InputPartition):
    def __init__(self, path: str, sha256: str) -> None:
        super().__init__((path, sha256))


class BundleReader(DataSourceReader):
    """A row for each file, a task for each part of the manifest, one object in memory at a time.

    `fault` is null, or object_missing, size_differs or digest_differs; content is null then. A part that isn't what manifest.json says is an error.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Part]:
        system, at = _open(self.path)
        if not _there(system, f"{at}/manifest.json"):
            raise FileNotFoundError(f"no bundle at {self.path}")
        return [Part(p["path"], p["sha256"]) for p in json.loads(_read(system, f"{at}/manifest.json"))["parts"]]

    def read(self, partition: Part) -> Iterator[tuple]:
        system, at = _open(self.path)
        path, sha256 = partition.value
        text = _read(system, f"{at}/{path}")
        if _digest(text) != sha256:
            raise ValueError(f"part of the manifest was changed: {path}")
        for line in filter(None, text.decode().split("\n")):  # not splitlines: names may hold other line signs
            f = json.loads(line)
            content, fault = None, None
            if f["sha256"] is not None:
                place = f"{at}/{object_path(f['sha256'])}"
                if not _there(system, place):
                    fault = "object_missing"
                else:
                    content = _read(system, place)
                    fault = "size_differs" if len(content) != f["size_bytes"] else "digest_differs" if _digest(content) != f["sha256"] else None
            yield f["target"], f["name"], f["uri"], f["sha256"], f["size_bytes"], None if fault else content, fault


class Bundles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bundle"

    def schema(self) -> str:
        return SHAPE

    def reader(self, schema: StructType) -> BundleReader:
        return BundleReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> BundleWriter:
        if overwrite:
            raise ValueError("a bundle is never written over")
        return BundleWriter(self.options["path"], schema)


def bundle_id(path: str) -> str:
    """The bundle's id: the digest of its manifest's parts, which hold the digests of all files."""
    system, at = _open(path)
    parts = json.loads(_read(system, f"{at}/manifest.json"))["parts"]
    return "bundle_" + _digest("\n".join(sorted(p["sha256"] for p in parts)).encode())[:32]
