"""Versioned models on shared storage.

A model is a folder with one sub-folder a version (`v00000001`, ...).  A version holds a
parameter table (Parquet), a small document (JSON: what is not per row) and, written last, an
empty marker: a version without its marker is unfinished or failed and is never read.  A
version number is claimed by creating a file that must not exist yet, so two writers never
share one; the number of a failed writer stays unused.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

MARKER, CLAIM = "_COMMITTED", "_CLAIM"


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def folder(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:08d}"

    def _numbers(self, name: str) -> list[int]:
        fs, where = self._fs(f"{self.root}/{name}")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def versions(self, name: str) -> list[int]:
        """Finished versions, ascending."""
        return [v for v in self._numbers(name) if self._exists(f"{self.folder(name, v)}/{MARKER}")]

    def _exists(self, path: str) -> bool:
        fs, where = self._fs(path)
        return fs.exists(where)

    def claim(self, name: str) -> int:
        """The next unused version number, which no other writer gets."""
        version = max(self._numbers(name), default=0) + 1
        while True:
            fs, where = self._fs(f"{self.folder(name, version)}/{CLAIM}")
            try:
                fs.create(where, False).close()
                return version
            except Exception as e:  # noqa: BLE001 - py4j wraps the exception of a file that exists
                if "FileAlreadyExists" not in str(e):
                    raise
                version += 1

    def register(self, name: str, parameters: DataFrame, document: dict) -> int:
        """Store a model as the next version of `name` and return its number."""
        version = self.claim(name)
        path = self.folder(name, version)
        parameters.write.parquet(f"{path}/parameters")
        self._put(f"{path}/document.json", json.dumps(document))
        self._put(f"{path}/{MARKER}", "")
        return version

    def _put(self, path: str, text: str) -> None:
        fs, where = self._fs(path)
        out = fs.create(where, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def load(self, name: str, version: int | None = None) -> tuple[int, DataFrame, dict]:
        """(version, parameters, document) of a finished version, by default the newest one."""
        done = self.versions(name)
        if not done or (version is not None and version not in done):
            raise LookupError(f"no finished version of {name!r}" + (f" numbered {version}" if version is not None else ""))
        version = done[-1] if version is None else version
        path = self.folder(name, version)
        text = self.spark.read.text(f"{path}/document.json", wholetext=True).first()
        return version, self.spark.read.parquet(f"{path}/parameters"), json.loads(text[0])
