"""Models of several tables, committed in one step.

A save writes every table to a fresh folder under the model's path, with rows and checksum observed during the
write. Then the manifest, which names these folders, is written under another name and renamed to the next
``manifest-N``; a rename never replaces a file. A load reads the newest manifest and what it names. So a driver lost at
any point leaves the model before, whole; and a save that loses the race for a number takes the next.

The last two versions are kept, for a reader that has just listed the older one; what a committed save supersedes is
deleted. Folders of a save that was lost stay until ``sweep`` (no save may be running then).
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEPT = 2
_MANIFEST = re.compile(r"manifest-(\d{8})")


class _Files:
    """The Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        """False if the target exists (HDFS refuses; a local rename would replace it)."""
        return not self.fs.exists(self.path(target)) and self.fs.rename(self.path(source), self.path(target))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _sums(df: DataFrame) -> list[Column]:
    """Rows and a checksum that does not depend on their order."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]))).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("checksum")]


def _write(df: DataFrame, path: str) -> dict:
    from pyspark.sql import Observation

    seen = Observation(f"model-{uuid.uuid4().hex}")
    df.observe(seen, *_sums(df)).write.parquet(path)
    return seen.get


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(m[1]) for n in names if (m := _MANIFEST.fullmatch(n)))


def _manifest(path: str, number: int) -> str:
    return f"{path}/manifest-{number:08d}"


def is_store(spark: SparkSession, path: str) -> bool:
    """Whether a save was committed under ``path``."""
    return bool(_numbers(_Files(spark, path).names(path)))


def save(spark: SparkSession, path: str, tables: dict[str, DataFrame], settings: dict | None = None) -> None:
    """Commit ``tables`` and ``settings`` (JSON values) as the newest version of the model at ``path``."""
    files = _Files(spark, path)
    folder = f"data-{uuid.uuid4().hex}"
    entries = {name: {"path": f"{folder}/{name}", **_write(df, f"{path}/{folder}/{name}")} for name, df in tables.items()}
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    files.write(draft, json.dumps({"folder": folder, "tables": entries, "settings": settings or {}}))
    number = max(_numbers(files.names(path)), default=0) + 1
    while not files.rename(draft, _manifest(path, number)):
        number += 1
    for old in _numbers(files.names(path)):
        if old <= number - KEPT:
            superseded = json.loads(files.read(_manifest(path, old)))["folder"]
            files.delete(_manifest(path, old))  # first, so that no manifest names a folder that is gone
            files.delete(f"{path}/{superseded}")


def load(spark: SparkSession, path: str, verify: bool = False) -> tuple[dict[str, DataFrame], dict]:
    """The newest version's tables and settings; with ``verify`` a table that is not as saved is an error."""
    files = _Files(spark, path)
    numbers = _numbers(files.names(path))
    if not numbers:
        raise FileNotFoundError(f"no model was committed at {path}")
    manifest = json.loads(files.read(_manifest(path, numbers[-1])))
    tables = {name: spark.read.parquet(f"{path}/{e['path']}") for name, e in manifest["tables"].items()}
    if verify:
        for name, e in manifest["tables"].items():
            found = tables[name].agg(*_sums(tables[name])).first().asDict()
            if found != {"rows": e["rows"], "checksum": e["checksum"]}:
                raise ValueError(f"{path}: table {name} is not as it was saved: {found}")
    return tables, manifest["settings"]


def sweep(spark: SparkSession, path: str) -> None:
    """Delete drafts and folders that no manifest names, left by saves that were lost."""
    files = _Files(spark, path)
    names = files.names(path)
    kept = {json.loads(files.read(_manifest(path, n)))["folder"] for n in _numbers(names)}
    for name in names:
        if name.startswith("_draft-") or (name.startswith("data-") and name not in kept):
            files.delete(f"{path}/{name}")
