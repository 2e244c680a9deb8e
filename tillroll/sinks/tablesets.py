"""Tables that change together, in one step.

A table set is a folder. Its tables lie in `_data`, every write in new folders; which of them make up the
set is told by the highest numbered file in `_versions`. A draft writes new folders beside those that
readers use, and publishing it puts one more numbered file in place by a single rename: readers see the
set as it was or as it is, whatever fails before, and of two writers that started from the same version
one is refused.

A table may be divided by a column; then single parts of it can be added to or replaced, and the others
stay the folders they are. The files here name folders, so their size goes with the number of parts.

What a draft writes is counted while it is written (rows and any other sums asked for), so nobody
scans a table again to tell its size.

Finished tables of a draft leave a marker. A draft opened again under the same key, from the same
version, finds them done.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.sinks import files

WHOLE = ""
WRITE = "data_version"


class PublishedMeanwhile(RuntimeError):
    """Another writer published a version since this draft was opened."""


class TableSet:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in files.names(self.spark, f"{self.root}/_versions") if n.endswith(".json")]

    def state(self, version: int | None = None) -> dict:
        """What makes up a version, by default the last one."""
        known = self.versions()
        if not known:
            return {"version": 0, "tables": {}, "notes": {}}
        return json.loads(files.read_text(self.spark, self._version(version or known[-1])))

    def _version(self, number: int) -> str:
        return f"{self.root}/_versions/{number:010d}.json"

    def names(self) -> list[str]:
        return sorted(self.state()["tables"])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.open(name, self.state(version)["tables"][name])

    def open(self, name: str, entry: dict, parts: list[str] | None = None) -> DataFrame:
        """The rows of a table, or of some of its parts."""
        schema = StructType.fromJson(entry["schema"])
        base = f"{self.root}/_data/{name}"
        folders = [f for part, own in entry["parts"].items() if parts is None or part in parts for f in own]
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
        return found.select(*schema.names)

    def measures(self, name: str, version: int | None = None) -> dict[str, int] | None:
        """Rows and other sums of a table, taken while it was written; None once parts of it were replaced."""
        return self.state(version)["tables"][name]["measures"]

    def draft(self, key: str = "write") -> Draft:
        return Draft(self, self.state(), key)

    def drop_old(self, keep: int = 1) -> None:
        """Forget all but the last versions, and delete the folders that only older ones and broken off drafts have."""
        known = self.versions()
        kept = [self.state(v) for v in known[-keep:]]
        used = {(t, f) for s in kept for t, entry in s["tables"].items() for own in entry["parts"].values() for f in own}
        for v in known[:-keep]:
            files.delete(self.spark, self._version(v))
        for table in files.names(self.spark, f"{self.root}/_data"):
            for write in files.names(self.spark, f"{self.root}/_data/{table}"):
                # A later number is that of a draft at work.
                if known and int(write.removeprefix(f"{WRITE}=").split("-")[0]) <= known[-1]:
                    folder = f"{self.root}/_data/{table}/{write}"
                    parts = [f"{write}/{p}" for p in files.names(self.spark, folder) if "=" in p] or [write]
                    gone = [p for p in parts if (table, p) not in used]
                    for p in [write] if len(gone) == len(parts) else gone:
                        files.delete(self.spark, f"{self.root}/_data/{table}/{p}")


class Draft:
    """The next version of a table set: unchanged tables are those of the version it was opened on."""

    def __init__(self, tables: TableSet, base: dict, key: str):
        self.tables, self.base, self.key = tables, base, key
        self.spark = tables.spark
        self.entries: dict[str, dict] = dict(base["tables"])
        self.markers = f"{tables.root}/_drafts/{base['version']:010d}-{key}"
        self.resumed = {n.removesuffix(".json") for n in files.names(self.spark, self.markers) if n.endswith(".json")}
        for name in self.resumed:
            self.entries[name] = json.loads(files.read_text(self.spark, f"{self.markers}/{name}.json"))

    def has(self, name: str) -> bool:
        return name in self.entries

    def read(self, name: str) -> DataFrame:
        return self.tables.open(name, self.entries[name])

    def _write(self, name: str, df: DataFrame, by: str | None, sums: dict[str, Column] | None = None) -> dict:
        folder = f"{WRITE}={self.base['version'] + 1:010d}-{self.key}"
        path = f"{self.tables.root}/_data/{name}/{folder}"
        counted = Observation()
        wanted = {"rows": F.lit(1), **(sums or {})}
        seen = df.observe(counted, *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in wanted.items()])
        writer = seen.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        measures = dict(counted.get)
        if not by:
            return {"schema": json.loads(df.schema.json()), "parts": {WHOLE: [folder]}, "measures": measures}
        # Stored as read back: the dividing column comes last.
        columns = [f for f in df.schema.fields if f.name != by] + [df.schema[by]]
        parts = [n for n in files.names(self.spark, path) if n.startswith(f"{by}=")]
        found = {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in parts}
        return {"schema": json.loads(StructType(columns).json()), "parts": found, "measures": measures}

    def _finish(self, name: str, make: Callable[[], dict]) -> DataFrame:
        if name not in self.resumed:
            self.entries[name] = make()
            files.put_text(self.spark, f"{self.markers}/{name}.json", json.dumps(self.entries[name]))
            self.resumed.add(name)
        return self.read(name)

    def measures(self, name: str) -> dict[str, int] | None:
        return self.entries[name]["measures"]

    def rows(self, name: str) -> int:
        """Rows of a table: as counted while it was written, or counted now if parts of it were replaced since."""
        found = self.measures(name)
        return self.read(name).count() if found is None else found["rows"]

    def write(self, name: str, build: Callable[[], DataFrame], by: str | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
        """Replace a table; build is not called if that was done before."""
        return self._finish(name, lambda: self._write(name, build(), by, sums))

    def add(self, name: str, build: Callable[[], DataFrame], by: str, sums: dict[str, Column] | None = None) -> DataFrame:
        """Rows beside those of a table's parts."""

        def make() -> dict:
            old, new = self.entries[name], self._write(name, build(), by, sums)
            parts = {**old["parts"], **{p: [*old["parts"].get(p, []), *own] for p, own in new["parts"].items()}}
            had, more = old["measures"], new["measures"]
            same = had is not None and had.keys() == more.keys()
            return {"schema": old["schema"], "parts": parts, "measures": {k: had[k] + more[k] for k in had} if same else None}

        return self._finish(name, make)

    def replace(self, name: str, build: Callable[[Callable[[list[str]], DataFrame]], DataFrame], by: str, touched: Callable[[], list[str]]) -> DataFrame:
        """Put rows in place of the touched parts, and beside those of others; build gets a function that reads parts."""

        def make() -> dict:
            old, gone = self.entries[name], touched()
            kept = {p: own for p, own in old["parts"].items() if p not in gone}
            new = self._write(name, build(lambda parts: self.tables.open(name, old, parts)), by)
            parts = {**kept, **{p: [*kept.get(p, []), *own] for p, own in new["parts"].items()}}
            return {"schema": old["schema"], "parts": parts, "measures": new["measures"] if not kept else None}

        return self._finish(name, make)

    def publish(self, **notes) -> int:
        """Make this the version that readers see."""
        number = self.base["version"] + 1
        state = {"version": number, "tables": self.entries, "notes": notes}
        if not files.put_text(self.spark, self.tables._version(number), json.dumps(state)):
            raise PublishedMeanwhile(f"version {number} of {self.tables.root} is there already")
        files.delete(self.spark, f"{self.tables.root}/_drafts")
        return number
