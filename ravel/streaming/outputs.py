"""Outputs of a stream, written per epoch and committed by a manifest.

An epoch writes its folders (``<kind>/epoch=<n>``) and then its entry in
``manifest``; readers follow the manifest, so a half-written epoch is never
read. A replayed epoch that has an entry is left as it is; one without is
written anew over what is there. Entries are renamed into place; when there
are many small ones they are folded into one, which readers see as the same
set of epochs.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "manifest"
# Single entries that are folded into one file.
FOLD = 64


class Outputs:
    """The outputs under ``path``, on any file system Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._hadoop("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{MANIFEST}/{name}".rstrip("/"))

    def folder(self, kind: str, epoch: int) -> str:
        return f"{self.path}/{kind}/epoch={epoch}"

    def _names(self) -> list[str]:
        if not self._fs.exists(self._hadoop("")):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._hadoop(""))
                      if f.getPath().getName().endswith(".json"))

    def _lines(self, name: str) -> list[str]:
        stream = self._fs.open(self._hadoop(name))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [x for x in text.splitlines() if x]

    def _put(self, name: str, text: str) -> None:
        part = self._hadoop(f"_{name}.part")     # readers pass by names that start so
        stream = self._fs.create(part, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        self._fs.delete(self._hadoop(name), False)
        if not self._fs.rename(part, self._hadoop(name)):
            raise OSError(f"cannot commit {name} in {self.path}")

    def epochs(self) -> set[int]:
        return {json.loads(x)["epoch"] for name in self._names() for x in self._lines(name)}

    def committed(self, epoch: int) -> bool:
        return self._fs.exists(self._hadoop(f"epoch-{epoch}.json")) or any(
            json.loads(x)["epoch"] == epoch for name in self._names()
            if name.startswith("to-") for x in self._lines(name))

    def commit(self, epoch: int) -> None:
        """Make the epoch's outputs visible."""
        self._put(f"epoch-{epoch}.json", json.dumps({"epoch": epoch}) + "\n")
        names = self._names()
        if len(names) > FOLD:
            lines = sorted({x for name in names for x in self._lines(name)})
            whole = f"to-{epoch}.json"
            self._put(whole, "\n".join(lines) + "\n")
            for name in names:
                if name != whole:
                    self._fs.delete(self._hadoop(name), False)


def read_committed(spark: SparkSession, path: str, kind: str, form: str = "parquet",
                   schema: str | None = None) -> DataFrame:
    """Rows of all committed epochs of one output, with their ``epoch``."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.format(form).load(f"{path.rstrip('/')}/{kind}")
    done = spark.read.schema("epoch bigint").json(f"{path.rstrip('/')}/{MANIFEST}").distinct()
    return rows.join(done, rows["epoch"].cast("bigint") == done["epoch"], "left_semi")
