"""Size-tiered compaction of immutable Parquet shards under a versioned manifest."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    """A folder of shards and manifests on any Hadoop file system.

    Manifest n lists the live shards with their sizes. It is written beside its place and renamed to it without
    overwriting, so of two writers of a version one fails and starts again, and a reader sees a whole version or none.
    Shards are never changed; what a compaction replaces stays for readers of older versions until `vacuum`.
    Only file names and sizes are handled on the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.root.getFileSystem(self.conf)
        self.fs.mkdirs(self._at("_manifests"))

    def _at(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self.fs.listStatus(self._at("_manifests"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "schema": None, "shards": []}
        stream = self.fs.open(self._at("_manifests", f"v{known[-1] if version is None else version:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _commit(self, base: dict, shards: list[dict], schema: str) -> int:
        version = base["version"] + 1
        waiting, place = self._at("_manifests", f".{uuid.uuid4().hex}"), self._at("_manifests", f"v{version:010d}.json")
        out = self.fs.create(waiting, False)
        out.write(bytearray(json.dumps({"version": version, "schema": schema, "shards": shards}).encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(waiting, place, options)
        except Exception as e:
            self.fs.delete(waiting, False)
            if self.fs.exists(place):
                raise Conflict(f"version {version} of {self.path} was committed by another writer") from e
            raise
        return version

    def _written(self, folder: str) -> list[dict]:
        files = self.fs.listStatus(self._at(folder))
        return [{"path": f"{folder}/{f.getPath().getName()}", "bytes": f.getLen()} for f in files if f.getPath().getName().startswith("part-")]

    def append(self, df: DataFrame, tries: int = 5) -> int:
        """Write df's partitions as they are, a small shard each, and commit them. No rows: a version without new rows, which gives the store its schema."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        schema = json.dumps(df.schema.jsonValue())
        for left in reversed(range(tries)):
            base = self.manifest()
            if base["schema"] not in (None, schema):
                raise ValueError("the schema differs from the store's")
            try:
                return self._commit(base, base["shards"] + self._written(folder), schema)
            except Conflict:
                if not left:
                    raise

    def plan(self, target: int, fanout: int) -> list[list[dict]]:
        """Runs to merge: shards under half the target, by tier of size (each `fanout` times the one before), where a tier has `fanout` or more."""
        tiers: dict[int, list[dict]] = {}
        for s in self.manifest()["shards"]:
            if 2 * s["bytes"] < target:
                tiers.setdefault(int(math.log(max(s["bytes"], 1), fanout)), []).append(s)
        return [t for _, t in sorted(tiers.items()) if len(t) >= fanout]

    def compact(self, target: int = 128 << 20, fanout: int = 4, finish: bool = False) -> int:
        """Merge runs of similar size until no tier holds `fanout` shards; with finish, then whatever is small. Returns the version.

        A run is read and rewritten by as many tasks as it fills target-sized files, without a shuffle. Each merge is a
        commit that fails if a shard it read is gone from the newest version; shards appended meanwhile stay. Rows are kept as
        they are: nulls, repeated ones, and files without rows.
        """
        if fanout < 2 or target < 1:
            raise ValueError("fanout must be 2 at least and target positive")
        while True:
            runs = self.plan(target, fanout)
            if not runs and finish:
                small = [s for s in self.manifest()["shards"] if 2 * s["bytes"] < target]
                runs = [small] if len(small) > max(1, math.ceil(sum(s["bytes"] for s in small) / target)) else []
            if not runs:
                return self.manifest()["version"]
            for run in runs:
                self._merge(run, target)

    def _merge(self, run: list[dict], target: int, tries: int = 20) -> int:
        paths = {s["path"] for s in run}
        schema = self.manifest()["schema"]
        rows = self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*(f"{self.path}/{p}" for p in sorted(paths)))
        folder = f"data/{uuid.uuid4().hex}"
        rows.coalesce(max(1, math.ceil(sum(s["bytes"] for s in run) / target))).write.parquet(f"{self.path}/{folder}")
        for left in reversed(range(tries)):
            base = self.manifest()
            if not paths <= {s["path"] for s in base["shards"]}:
                raise Conflict("a shard that was merged is gone")
            try:
                return self._commit(base, [s for s in base["shards"] if s["path"] not in paths] + self._written(folder), schema)
            except Conflict:
                if not left:
                    raise

    def vacuum(self) -> int:
        """Delete shards that the newest version doesn't list; for when no older version is read and no writer is at work."""
        live, gone = {s["path"] for s in self.manifest()["shards"]}, 0
        if not self.fs.exists(self._at("data")):
            return 0
        for d in self.fs.listStatus(self._at("data")):
            names = [f.getPath().getName() for f in self.fs.listStatus(d.getPath())]
            folder = f"data/{d.getPath().getName()}"
            dead = [n for n in names if n.startswith("part-") and f"{folder}/{n}" not in live]
            for n in dead:
                gone += bool(self.fs.delete(self._at(folder, n), False))
            if not any(f"{folder}/{n}" in live for n in names):
                self.fs.delete(d.getPath(), True)
        return gone

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError("nothing was appended yet")
        schema = StructType.fromJson(json.loads(m["schema"]))
        paths = [f"{self.path}/{s['path']}" for s in m["shards"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
