"""Parquet tables with versions: every write is a new snapshot that readers see whole or not at all.

A version is a small file that lists the folders of its rows. It is written once, under the next number, and never
changed, so a reader that holds a version is not disturbed by writers. Two writers that start from one version cannot both
write the next: the second appends to what the first has written, or computes its overwrite or upsert again.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import upsert
from .shared import Files

# Writers of one driver do not race for the rename, which not all file systems do in one step.
_ONE = defaultdict(threading.Lock)


class Conflict(RuntimeError):
    """Another writer was faster."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._versions = Files(spark, f"{self.path}/versions")

    def version(self) -> int:
        """The latest version; 0 without one."""
        return max((int(n.removesuffix(".json")) for n in self._versions.names() if n.endswith(".json") and not n.startswith(".")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """folders, schema, and the last batch of each named writer."""
        v = self.version() if version is None else version
        return json.loads(self._versions.read(f"{v:012d}.json")) if v else {"folders": [], "schema": None, "writers": {}}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default; they stay the same whatever is written meanwhile."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise ValueError(f"no version in {self.path}")
        schema = json.loads(found["schema"])
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(schema)
        if not found["folders"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in found["folders"]])

    def _stage(self, df: DataFrame) -> str:
        folder = f"rows/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, base: int, manifest: dict) -> int:
        with _ONE[self.path]:
            if self.version() != base or not self._versions.put_if_absent(f"{base + 1:012d}.json", json.dumps(manifest)):
                raise Conflict(f"version {base + 1} of {self.path} was written by another")
        return base + 1

    def overwrite(self, df: DataFrame, expected: int | None = None) -> int:
        """A version with just the rows of df. `expected` is the version that df was computed from, the latest by default;
        if there is a newer one, Conflict is raised and nothing changes."""
        base = self.version() if expected is None else expected
        writers = self.manifest(base)["writers"]
        return self._commit(base, {"folders": [self._stage(df)], "schema": df.schema.json(), "writers": writers})

    def append(self, df: DataFrame, writer: str | None = None, batch: int | None = None) -> int | None:
        """A version with the rows of df added. With a writer, whose batches have rising numbers, a batch that is in the
        table already is not written again (None). Another writer's append in between is kept."""
        folder = None
        while True:
            base = self.version()
            found = self.manifest(base)
            if writer is not None and found["writers"].get(writer, -1) >= batch:
                return None
            if found["schema"] is not None and json.loads(found["schema"])["fields"] and [f["name"] for f in json.loads(found["schema"])["fields"]] != df.columns:
                raise ValueError(f"columns {df.columns} do not fit {self.path}")
            folder = folder or self._stage(df)
            writers = found["writers"] | ({writer: batch} if writer is not None else {})
            try:
                return self._commit(base, {"folders": [*found["folders"], folder], "schema": found["schema"] or df.schema.json(), "writers": writers})
            except Conflict:
                continue

    def change(self, compute: Callable[[DataFrame], DataFrame], tries: int = 10) -> int:
        """A version with compute(rows); computed again from the newer rows if another writer was faster."""
        for _ in range(tries):
            base = self.version()
            try:
                return self.overwrite(compute(self.read(base)), base)
            except Conflict:
                continue
        raise Conflict(f"{self.path} changed {tries} times meanwhile")

    def upsert(self, source: DataFrame, key: list[str], order: str, policy: str = "overwrite") -> int:
        return self.change(lambda rows: upsert(rows, source, key, order, policy))

    def forget(self, keep: int = 2) -> None:
        """Deletes all but the last `keep` versions and the rows that only they list. Readers of those must be done."""
        with _ONE[self.path]:
            last = self.version()
            kept = [v for v in range(max(1, last - keep + 1), last + 1)]
            used = {f for v in kept for f in self.manifest(v)["folders"]}
            for v in range(1, kept[0] if kept else 1):
                self._versions.delete(f"{v:012d}.json")
            rows = Files(self.spark, f"{self.path}/rows")
            for name in rows.names():
                if kept and f"rows/{name}" not in used:
                    rows.delete(name)
