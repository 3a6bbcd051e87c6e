"""Versioned tables with a commit mark.

A version's tables are written first; then a small file with their schemas and settings is put in place by a rename.
Readers list those marks, so they never see a version that is half written, and a writer that died leaves nothing but
files that nobody reads.  One writer at a time; several readers may read on while versions are added.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import check_schema


class VersionedTables:
    """Versions 0, 1, ... of a set of named tables under ``path``, which all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    @property
    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [f.getPath().getName() for f in self._files.listStatus(at)] if self._files.exists(at) else []

    def folder(self, version: int) -> str:
        """Where the files of a version are written."""
        return f"{self.path}/data/{version}"

    def versions(self) -> list[int]:
        """Committed versions in order."""
        return sorted(int(n.removesuffix(".json")) for n in self._names("commits") if n.endswith(".json"))

    def newest(self) -> int | None:
        return max(self.versions(), default=None)

    def next_version(self) -> int:
        """A number that no version has, committed or not."""
        return max([*self.versions(), *map(int, self._names("data")), -1]) + 1

    def save(self, tables: dict[str, DataFrame], settings: dict | None = None, version: int | None = None) -> int:
        """Write and commit a version; a committed number is left as it is, so a repeated job changes nothing."""
        version = self.next_version() if version is None else version
        if version in self.versions():
            return version
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.folder(version)}/{name}")
        self.commit(version, {name: df.schema for name, df in tables.items()}, settings)
        return version

    def commit(self, version: int, schemas: dict[str, T.StructType], settings: dict | None = None) -> None:
        mark = {"schemas": {name: s.jsonValue() for name, s in schemas.items()}, "settings": settings or {}}
        draft, final = self._at("commits", f".{version}.draft"), self._at("commits", f"{version}.json")
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps(mark), "utf-8"))
        out.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            raise ValueError(f"version {version} was committed by another writer")

    def settings(self, version: int | None = None) -> dict:
        return self._mark(self._known(version))["settings"]

    def _known(self, version: int | None) -> int:
        known = self.versions()
        version = max(known, default=None) if version is None else version
        if version not in known:
            raise ValueError(f"no committed version {'' if version is None else version} in {self.path}")
        return version

    def _mark(self, version: int) -> dict:
        found = self._files.open(self._at("commits", f"{version}.json"))
        try:
            return json.loads(bytes(found.readAllBytes()).decode())
        finally:
            found.close()

    def load(self, version: int | None = None, expected: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
        """Tables of a version, the newest by default, read with the schemas they were written with.

        Raises if a table of ``expected`` is missing or has other columns.
        """
        version = self._known(version)
        schemas = {n: T.StructType.fromJson(s) for n, s in self._mark(version)["schemas"].items()}
        for name, schema in (expected or {}).items():
            if name not in schemas:
                raise ValueError(f"version {version} has no table {name}")
            check_schema(schema, schemas[name])
        return {name: self.spark.read.schema(schema).parquet(f"{self.folder(version)}/{name}") for name, schema in schemas.items()}

    def clear(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, and files of versions that were never committed before them."""
        kept = self.versions()[-keep:] if keep else []
        for version in self.versions():
            if version not in kept:
                self._files.delete(self._at("commits", f"{version}.json"), False)
        for name in self._names("data"):
            if int(name) not in kept and int(name) < max(kept, default=0):
                self._files.delete(self._at("data", name), True)
