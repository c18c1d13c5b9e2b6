"""Marks of finished steps, so that a broken run can go on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from paddock.sources.tables import exists, hadoop_path


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Hash of the names, sizes and times of all files below the paths; a file that is rewritten changes it."""
    seen = []
    for path in paths:
        p, fs = hadoop_path(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            s = files.next()
            name = s.getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name.removeprefix(p.toString()).split("/")):
                seen.append((name, s.getLen(), s.getModificationTime()))
    return digest(json.dumps(sorted(seen)))


def digest(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


class Marks:
    """One small file per finished step in `_marks` below a folder: what it was built from, and what it noted."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_marks"

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}.json"

    def read(self, name: str, inputs: str) -> list | None:
        """The notes of the step if it was finished on these inputs, else None."""
        if not exists(self.spark, self._path(name)):
            return None
        p, fs = hadoop_path(self.spark, self._path(name))
        stream = fs.open(p)
        try:
            mark = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return mark["notes"] if mark["inputs"] == inputs else None

    def clear(self, name: str) -> None:
        p, fs = hadoop_path(self.spark, self._path(name))
        fs.delete(p, False)

    def write(self, name: str, inputs: str, notes: Sequence = ()) -> None:
        p, fs = hadoop_path(self.spark, self._path(name))
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps({"inputs": inputs, "notes": list(notes)}).encode()))
        finally:
            stream.close()
