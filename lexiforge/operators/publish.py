"""Several tables as one version: readers see all of the old set or all of the new one.

``Publication(folder).write(tables)`` writes every table below a folder of its own and then
names them in one small manifest, which a single rename puts in place. Until then readers
keep to the last manifest; a write that ends early leaves files that no manifest names. Two
writers cannot claim one version: the rename of the later one fails and it takes the next
number. Row counts are observed on the writes themselves, no table is read again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..staging import shuffles_end_with_their_query


class Publication:
    """The versions of a set of tables in a folder that all machines share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.names = self._path("_versions")
        self.fs = self.names.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def versions(self) -> list[int]:
        """Numbers of the versions that were put in place, in order."""
        if not self.fs.exists(self.names):
            return []
        found = [f.getPath().getName() for f in self.fs.listStatus(self.names)]
        return sorted(int(x[:-5]) for x in found if x.endswith(".json") and x[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """{table: {"path", "rows"}} of a version, the latest if none is named; empty before the first."""
        if version is None:
            known = self.versions()
            if not known:
                return {}
            version = known[-1]
        stream = self.fs.open(self._path("_versions", f"{version:010d}.json"))
        try:
            raw = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(raw)

    def write(self, tables: dict[str, DataFrame | Callable[[], DataFrame]]) -> int:
        """Write all tables as the next version and return its number; one that is a function is made when its turn comes."""
        run, told = uuid.uuid4().hex, {}
        for name, df in tables.items():
            rows = Observation()
            path = f"{self.folder}/data/{run}/{name}"
            df = df() if callable(df) else df
            with shuffles_end_with_their_query(self.spark):
                df.observe(rows, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
            told[name] = {"path": path, "rows": rows.get["rows"], "schema": df.schema.json()}
        return self._place(json.dumps(told), run)

    def _place(self, text: str, run: str) -> int:
        draft = self._path("_versions", f".{run}")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        while True:
            version = (self.versions() or [0])[-1] + 1
            target = self._path("_versions", f"{version:010d}.json")
            if not self.fs.exists(target) and self.fs.rename(draft, target):
                return version
            if not self.fs.exists(draft):
                raise RuntimeError("the draft of a version has gone")

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of one version."""
        from pyspark.sql.types import StructType

        return {name: self.spark.read.schema(StructType.fromJson(json.loads(x["schema"]))).parquet(x["path"]) for name, x in self.manifest(version).items()}

    def counts(self, version: int | None = None) -> DataFrame:
        """(table_name, n_rows) as observed when the version was written."""
        rows = [(n, x["rows"]) for n, x in self.manifest(version).items()]
        return self.spark.createDataFrame(rows, "table_name string, n_rows long")

    def drop_old(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` versions: first the manifests, then the files that no manifest names."""
        known = self.versions()
        if not known:
            return
        for v in known[: -max(1, keep)]:
            self.fs.delete(self._path("_versions", f"{v:010d}.json"), False)
        named = {x["path"].rsplit("/", 2)[1] for v in self.versions() for x in self.manifest(v).values()}
        for f in self.fs.listStatus(self._path("data")):
            if f.getPath().getName() not in named:
                self.fs.delete(f.getPath(), True)
