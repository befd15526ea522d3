"""Running tables fed by micro-batches: newest row per key, merged in tiers, named by a manifest that is swapped whole.

A batch adds one folder of changed rows.  ``FAN`` folders of one tier are merged into one folder of the next, so after n
batches a read meets at most ``FAN`` folders on each of log(n) tiers, and a row is rewritten once for each tier.

Which folders make up the table is said by the manifest of the last batch, a small file that is written aside and renamed
to its final name, which file systems do in one step.  A batch that ends before the rename has changed nothing: its
folders are in no manifest, and the repeated batch writes new ones.  A batch that is repeated after the rename finds its
own manifest and is skipped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

FAN = 8


class RunningTable:
    """Newest row for each of ``keys`` below the folder ``path``; rows carry the number of the batch that wrote them."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...], fan: int = FAN):
        self._spark, self.path, self._keys, self._fan = spark, path.rstrip("/"), keys, fan
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _manifest(self, version: int) -> list[dict]:
        stream = self._fs.open(self._path(f"{self.path}/manifest-{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def folders(self) -> list[dict]:
        """``{folder, tier}`` of the table as it stands."""
        found = self._versions()
        return self._manifest(found[-1]) if found else []

    def _swap(self, version: int, folders: list[dict]) -> None:
        aside = self._path(f"{self.path}/.aside-{uuid.uuid4().hex}")
        stream = self._fs.create(aside, True)
        stream.write(bytearray(json.dumps(folders).encode()))
        stream.close()
        if not self._fs.rename(aside, self._path(f"{self.path}/manifest-{version:012d}.json")):
            raise OSError(f"manifest {version} could not be put in place")

    def _write(self, rows: DataFrame, tier: int) -> dict:
        folder = f"tier{tier}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return {"folder": folder, "tier": tier}

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*self._keys, "_batch")]
        best = F.max_by(F.struct(*values, "_batch"), "_batch").alias("_m")
        return rows.groupBy(*self._keys).agg(best).select(*self._keys, *[f"_m.{c}" for c in values], "_m._batch")

    def _read(self, folders: list[dict]) -> DataFrame:
        return self._spark.read.parquet(*[f"{self.path}/{f['folder']}" for f in folders])

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Add the changed rows of a batch; False if that was done before."""
        versions = self._versions()
        if versions and versions[-1] >= batch:
            return False
        folders = self._manifest(versions[-1]) if versions else []
        folders = [*folders, self._write(rows.withColumn("_batch", F.lit(batch).cast("long")), 0)]
        tier = 0
        while sum(f["tier"] == tier for f in folders) >= self._fan:
            merged = [f for f in folders if f["tier"] == tier]
            one = self._write(self._newest(self._read(merged)).hint("rebalance"), tier + 1)
            folders = [*(f for f in folders if f["tier"] != tier), one]
            tier += 1
        self._swap(batch, folders)
        return True

    def read(self, schema: str) -> DataFrame:
        """Newest row per key; ``schema`` is for a table without a batch."""
        folders = self.folders()
        if not folders:
            return self._spark.createDataFrame([], schema)
        return self._newest(self._read(folders)).drop("_batch")

    def vacuum(self, keep: int = 2) -> int:
        """Delete manifests older than the last ``keep`` and folders that none of those names; returns the number of
        folders deleted.  Not to be called while a batch is being written."""
        versions = self._versions()
        kept = {f["folder"] for v in versions[-keep:] for f in self._manifest(v)}
        gone = 0
        for status in self._fs.listStatus(self._path(self.path)):
            name = status.getPath().getName()
            if name.startswith("tier") and name not in kept:
                gone += self._fs.delete(status.getPath(), True)
            elif name.startswith(".aside-") or (name.startswith("manifest-") and int(name[9:-5]) not in versions[-keep:]):
                self._fs.delete(status.getPath(), False)
        return gone
