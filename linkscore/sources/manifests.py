"""Publishing the tables of one run together.

A job that writes several tables of a date can be stopped between them, and a folder that is readable
is not a date that is complete. So a run stages its tables aside, and when the last one is written
it publishes them: the old manifest goes, the folders move to their places, and one manifest per job
and slot (a date or an hour) is written last. It lists every table with its rows and its files with
their sizes. A slot is complete when its manifest is there and the files it lists are; whatever a
stopped run left behind is not, and the next run replaces it.

All file operations go through the session's Hadoop file system, so places may be on any store the
executors share; the driver lists folders and reads manifests, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Folders whose names begin like this are no data to Spark.
MANIFESTS, STAGING = "_manifests", "_staging"


class Files:
    """The file operations that publishing needs."""

    def __init__(self, spark: SparkSession, base: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utf8 = spark._jvm.java.nio.charset.StandardCharsets.UTF_8
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def sizes(self, folder: str) -> dict[str, int]:
        """Name and bytes of every data file right in a folder; none if there is no such folder."""
        place = self._path(folder)
        if not self._fs.exists(place):
            return {}
        found = ((f.getPath().getName(), f.getLen()) for f in self._fs.listStatus(place) if f.isFile())
        return {name: size for name, size in found if name[0] not in "_."}

    def read(self, path: str) -> str | None:
        place = self._path(path)
        if not self._fs.exists(place):
            return None
        stream = self._fs.open(place)
        try:
            return self._io.toString(stream, self._utf8)
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Puts a whole file in place at once: readers see the old one or the new one, never a part."""
        aside = f"{path}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.delete(path)
        self.move(aside, path)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")


@dataclass(frozen=True)
class Slot:
    """The tables that one run of a job leaves: kind to folder. ``required`` ones make it complete."""

    base: str
    job: str
    name: str
    places: Mapping[str, str]
    required: tuple[str, ...] = field(default=())

    @property
    def manifest_path(self) -> str:
        return f"{self.base}/{MANIFESTS}/{self.job}/{self.name}.json"

    def manifest(self, spark: SparkSession) -> dict | None:
        text = Files(spark, self.base).read(self.manifest_path)
        return None if text is None else json.loads(text)

    def complete(self, spark: SparkSession) -> bool:
        """True when the manifest lists every required table and all its files are as it says."""
        found, files = self.manifest(spark), Files(spark, self.base)
        if found is None or not set(self.required or self.places) <= set(found["tables"]):
            return False
        return all(files.sizes(t["folder"]) == t["files"] for t in found["tables"].values())

    def read(self, spark: SparkSession, kind: str) -> DataFrame:
        """The published rows of a table: exactly the listed files, found without listing a folder."""
        found = self.manifest(spark)
        if found is None or kind not in found["tables"]:
            raise FileNotFoundError(f"{kind} of {self.job} {self.name} is not published")
        table = found["tables"][kind]
        schema = T.StructType.fromJson(table["schema"])
        paths = [f"{table['folder']}/{name}" for name in table["files"]]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


class Publication:
    """One run: ``with Publication(spark, slot) as run: run.write(df, kind)``.

    Leaving the block publishes what was staged; an error in it leaves the slot as it was.
    """

    def __init__(self, spark: SparkSession, slot: Slot):
        self.spark, self.slot, self.files = spark, slot, Files(spark, slot.base)
        self.attempt = uuid.uuid4().hex
        self.folder = f"{slot.base}/{STAGING}/{slot.job}/{slot.name}/{self.attempt}"
        self.staged: dict[str, T.StructType] = {}

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None:
                self.publish()
        finally:
            self.files.delete(self.folder)

    def write(self, df: DataFrame, kind: str, writer: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
        """Stages a table and continues from the stored rows; ``writer`` may choose the number of files."""
        if kind not in self.slot.places:
            raise ValueError(f"{self.slot.job} has no table {kind}")
        path = f"{self.folder}/{kind}"
        if writer is None:
            df.write.parquet(path)
        else:
            writer(df, path)
        self.staged[kind] = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self) -> dict:
        """Puts all staged tables in place and returns the manifest."""
        missing = set(self.slot.required or self.slot.places) - set(self.staged)
        if missing:
            raise ValueError(f"{self.slot.job} {self.slot.name} has not written {sorted(missing)}")
        tables = {}
        for kind, schema in self.staged.items():
            path = f"{self.folder}/{kind}"
            # Counted from the files themselves, so what cannot be read is not published.
            rows = self.spark.read.schema(schema).parquet(path).count()
            files = self.files.sizes(path)
            tables[kind] = {"folder": self.slot.places[kind], "rows": rows, "files": files, "schema": schema.jsonValue()}
        self.files.delete(self.slot.manifest_path)
        for kind, table in tables.items():
            self._place(f"{self.folder}/{kind}", table["folder"])
        manifest = {"job": self.slot.job, "slot": self.slot.name, "attempt": self.attempt, "tables": tables}
        self.files.write(self.slot.manifest_path, json.dumps(manifest))
        return manifest

    def _place(self, staged: str, folder: str) -> None:
        self.files.delete(folder)
        self.files.move(staged, folder)
