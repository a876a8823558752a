"""Versions of a table: small files that say which folders a table consists of.

``_manifests/<number>.json`` lists, for every partition, the load whose folder holds its rows, and the
table's schema. A new version is a new file, closed with the digest of its content, and the
table is what the highest whole file says. Nothing is renamed or replaced, so a
version appears in one step on any file system: a writer that dies leaves a file
without its digest, which nobody reads, and folders that no version names.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

FOLDER = "_manifests"
KEPT = 5


class CommitConflict(RuntimeError):
    """Another load committed a version since this one began."""


class Files:
    """The Hadoop file system of a table's folder, as far as the sink needs it."""

    def __init__(self, spark: SparkSession, root: str):
        try:
            jvm = spark.sparkContext._jvm
        except Exception as e:
            raise NotImplementedError("a Parquet table is written and resolved through the driver's JVM (a classic session); "
                                      "with Spark Connect use an Iceberg catalog") from e
        self.jvm = jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def folders(self, folder: str, depth: int) -> list[str]:
        """Visible folders ``depth`` levels below, relative to ``folder``."""
        level = [""]
        for _ in range(depth):
            level = [f"{up}/{s.getPath().getName()}".strip("/") for up in level
                     for s in self.fs.listStatus(self.path(f"{folder}/{up}".rstrip("/")))
                     if s.isDirectory() and not s.getPath().getName().startswith((".", "_temporary"))]
        return level

    def read(self, path: str) -> bytes:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, path: str, data: bytes) -> None:
        """A new file; an existing one of that name is an error."""
        out = self.fs.create(self.path(path), False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


@dataclass
class Version:
    number: int
    partition_cols: list[str]
    schema: StructType
    #: load id by partition folder (``a=1/b=2``; '' for a table without partition columns)
    folders: dict[str, str] = field(default_factory=dict)
    #: folders below the table that this version no longer names and the one before did
    replaced: list[str] = field(default_factory=list)

    def encode(self) -> bytes:
        body = json.dumps({"number": self.number, "partition_cols": self.partition_cols, "schema": self.schema.jsonValue(),
                           "folders": self.folders, "replaced": self.replaced}).encode()
        return body + b"\n" + hashlib.sha256(body).hexdigest().encode()

    @staticmethod
    def decode(data: bytes) -> Version | None:
        """None for a file that is not whole."""
        body, _, digest = data.rpartition(b"\n")
        if not body or hashlib.sha256(body).hexdigest().encode() != digest:
            return None
        x = json.loads(body)
        return Version(x["number"], x["partition_cols"], StructType.fromJson(x["schema"]), x["folders"], x["replaced"])


class Manifests:
    def __init__(self, files: Files, table: str):
        self.files, self.folder = files, f"{table}/{FOLDER}"

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(self.folder) if n.endswith(".json") and n[0] not in "._")

    def name(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def latest(self) -> Version | None:
        for n in reversed(self.numbers()):
            found = Version.decode(self.files.read(self.name(n)))
            if found:
                return found
        return None

    def commit(self, before: Version | None, after: Version) -> Version:
        """Put ``after`` in place of ``before``; its number is the next free one."""
        now = self.latest()
        if (now.number if now else 0) != (before.number if before else 0):
            raise CommitConflict(f"version {now.number if now else 0} was committed meanwhile")
        after.number = max([0, *self.numbers()]) + 1
        try:
            self.files.create(self.name(after.number), after.encode())
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise CommitConflict(f"version {after.number} was committed meanwhile") from e
            raise
        return after

    def forget_old(self) -> None:
        for n in self.numbers()[:-KEPT]:
            self.files.delete(self.name(n))
