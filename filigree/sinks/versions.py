"""Versioned Parquet tables: new data goes to a new folder, readers take the newest published one."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK, LEDGER = "_PUBLISHED", "_BATCHES"


class VersionedTable:
    """Folders ``version=N`` below ``path``; a marker file publishes a version.

    Writing never touches what readers use, so a lost executor or a failed check
    leaves the current version as it was. With ``by``, a column that the key determines (a year,
    a range of keys), versions are written by partition, and a version may take over the
    partitions of an earlier one that did not change; the marker lists the folders it consists of.
    A version also tells which batch of each stream it holds last (``record``, ``last_batch``). That
    ledger lies in the version's folder before the marker does, so data and ledger become current at
    once; versions written by other means take it over.
    """

    def __init__(self, path: str, max_versions: int = 2, codec: str = "zstd", by: str | None = None):
        self.path = path.rstrip("/")
        self.max_versions = max_versions
        self.codec = codec
        self.by = by

    def _fs(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root, jvm.org.apache.hadoop.fs.Path

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def versions(self, spark: SparkSession, published: bool = True) -> list[int]:
        """Version numbers in order; with ``published`` only those readers may use."""
        fs, root, path = self._fs(spark)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))
        return [n for n in numbers if not published or fs.exists(path(f"{self.folder(n)}/{MARK}"))]

    def stage(self, df: DataFrame, over: int | None = None) -> int:
        """Write ``df`` as the next version without publishing it.

        With ``over``, ``df`` holds whole partitions that replace those of that version; the
        others are taken over as they are.
        """
        spark = df.sparkSession
        taken = self.versions(spark, published=False)
        version = (taken[-1] if taken else 0) + 1
        # By partition, so that each is written by the tasks that hold it and not by all of them.
        rows = df.hint("rebalance", self.by) if self.by else df
        writer = rows.write.mode("errorifexists").option("compression", self.codec)
        (writer.partitionBy(self.by) if self.by else writer).parquet(self.folder(version))
        if self.by:
            fs, _, path = self._fs(spark)
            own = [s.getPath().getName() for s in fs.listStatus(path(self.folder(version))) if s.isDirectory()]
            parts = {} if over is None else self._manifest(spark, over)["parts"]
            parts |= {name: f"version={version}/{name}" for name in own if "=" in name}
            schema = df.schema.json() if over is None else self._manifest(spark, over)["schema"]
            self._put(spark, f"{self.folder(version)}/_PARTS", json.dumps({"schema": schema, "parts": parts}))
        return version

    def _put(self, spark: SparkSession, name: str, text: str) -> None:
        fs, _, path = self._fs(spark)
        out = fs.create(path(name))
        out.write(bytearray(text.encode()))
        out.close()

    def _manifest(self, spark: SparkSession, version: int) -> dict:
        return json.loads(self._get(spark, f"{self.folder(version)}/_PARTS"))

    def _get(self, spark: SparkSession, name: str) -> str:
        fs, _, path = self._fs(spark)
        stream = fs.open(path(name))
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text

    def _ledger(self, spark: SparkSession, version: int) -> dict[str, int]:
        fs, _, path = self._fs(spark)
        name = f"{self.folder(version)}/{LEDGER}"
        return json.loads(self._get(spark, name)) if fs.exists(path(name)) else {}

    def last_batch(self, spark: SparkSession, stream: str) -> int:
        """The last batch of ``stream`` that the newest published version holds, -1 before the first."""
        found = self.versions(spark)
        return self._ledger(spark, found[-1]).get(stream, -1) if found else -1

    def record(self, spark: SparkSession, version: int, stream: str, batch: int) -> None:
        """Note in a staged version that it holds ``batch`` of ``stream``, beside what the newest published one holds."""
        found = self.versions(spark)
        held = self._ledger(spark, found[-1]) if found else {}
        self._put(spark, f"{self.folder(version)}/{LEDGER}", json.dumps(held | {stream: batch}))

    def discard_unpublished(self, spark: SparkSession, stream: str, batch: int) -> None:
        """Remove versions that a stopped run staged for ``batch`` of ``stream`` and did not publish."""
        published = set(self.versions(spark))
        for v in self.versions(spark, published=False):
            if v not in published and self._ledger(spark, v).get(stream) == batch:
                self.discard(spark, v)

    def parts(self, spark: SparkSession, version: int) -> dict[str, str]:
        """Where each partition of a version lies, below the table's folder."""
        return self._manifest(spark, version)["parts"]

    def publish(self, spark: SparkSession, version: int) -> None:
        """Make a staged version current and drop published versions beyond ``max_versions``.

        Partitions that a kept version still consists of stay.
        """
        fs, _, path = self._fs(spark)
        before = self.versions(spark)
        held = self._ledger(spark, before[-1]) if before else {}
        if held and not fs.exists(path(f"{self.folder(version)}/{LEDGER}")):
            self._put(spark, f"{self.folder(version)}/{LEDGER}", json.dumps(held))
        fs.create(path(f"{self.folder(version)}/{MARK}")).close()
        published = self.versions(spark)
        old, kept = published[: -self.max_versions], published[-self.max_versions :]
        used = {p for v in kept for p in self.parts(spark, v).values()} if self.by else set()
        for v in old:
            if not any(p.startswith(f"version={v}/") for p in used):
                fs.delete(path(self.folder(v)), True)
                continue
            fs.delete(path(f"{self.folder(v)}/{MARK}"), False)
            for s in fs.listStatus(path(self.folder(v))):
                if s.isDirectory() and f"version={v}/{s.getPath().getName()}" not in used:
                    fs.delete(s.getPath(), True)

    def discard(self, spark: SparkSession, version: int) -> None:
        """Remove a staged version that will not be published."""
        fs, _, path = self._fs(spark)
        if fs.exists(path(f"{self.folder(version)}/{MARK}")):
            raise ValueError(f"version {version} is published")
        fs.delete(path(self.folder(version)), True)

    def write(self, df: DataFrame) -> int:
        version = self.stage(df)
        self.publish(df.sparkSession, version)
        return version

    def read_version(self, spark: SparkSession, version: int, own: bool = False) -> DataFrame:
        """A version; with ``own`` only the partitions that were written with it."""
        if not self.by:
            return spark.read.parquet(self.folder(version))
        from pyspark.sql.types import StructType

        manifest = self._manifest(spark, version)
        wanted = [p for p in manifest["parts"].values() if not own or p.startswith(f"version={version}/")]
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        if not wanted:
            return spark.createDataFrame([], schema)
        folders = [f"{self.path}/{p}" for p in wanted]
        return spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(*schema.names)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The newest published version, or None before the first."""
        found = self.versions(spark)
        return self.read_version(spark, found[-1]) if found else None

    def touched(self, rows: DataFrame) -> Column:
        """A test for the partitions that ``rows`` fall into, which the scan prunes by."""
        values = [r[0] for r in rows.select(self.by).distinct().collect()]  # one for each partition
        known = [v for v in values if v is not None]
        test = F.col(self.by).isin(known) if known else F.lit(False)
        return test | F.col(self.by).isNull() if None in values else test
