"""The stored index: rows in buckets of their key, every bucket whole in one folder, one manifest that says which folders are current.

A change rewrites only the buckets its keys fall into, into folders of a new version; the index changes at the moment the new
manifest is renamed into place. Until then, and whatever fails, readers see the old state whole. A version's number is taken by
one writer only, as a manifest is never replaced. What a manifest no longer names is removed one version later.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.index import delete_keys, upsert


class Store:
    """An index at ``path`` with rows of ``schema``, unique by ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self._buckets = buckets
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    def _names(self, folder) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []

    def manifest(self) -> dict:
        """The current state. Only a place that is absent or empty is an empty index; anything unreadable is an error."""
        names = self._names(self._root)
        numbers = sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))
        if not numbers:
            if any(not n.startswith(("part-", ".", "_")) for n in names):
                raise ValueError(f"{self.path} holds files but no manifest of an index")
            return {"version": 0, "buckets": self._buckets, "parts": {}, "notes": {}}
        stream = self._fs.open(self._at(f"manifest-{numbers[-1]:010d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def notes(self) -> dict:
        """What was noted with the last change, such as the model and the time of the last update."""
        return self.manifest()["notes"]

    def bucket(self, state: dict | None = None) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit((state or self.manifest())["buckets"])).cast("int")

    def read(self, state: dict | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows of the index, or of some of its buckets. A missing or broken file is an error when it is read."""
        state = state or self.manifest()
        folders = [f"{self.path}/part-{n:010d}/_bucket={b}" for b, n in state["parts"].items() if only is None or int(b) in only]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def touched(self, keys: DataFrame, state: dict) -> list[int]:
        """The buckets of the given keys: at most their fixed number."""
        return [r.b for r in keys.select(self.bucket(state).alias("b")).distinct().collect()]

    def replace(self, rows: DataFrame, buckets: list[int], state: dict, **notes) -> dict:
        """Put ``rows`` in place of all that stands in ``buckets``."""
        n = state["version"] + 1
        folder = f"part-{n:010d}"
        if buckets:
            placed = rows.select(*self.spark.createDataFrame([], self.schema).columns).withColumn("_bucket", self.bucket(state))
            placed.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        filled = {x.removeprefix("_bucket=") for x in self._names(self._at(folder)) if x.startswith("_bucket=")} if buckets else set()
        parts = {b: v for b, v in state["parts"].items() if int(b) not in buckets} | {b: n for b in filled}
        new = {"version": n, "buckets": state["buckets"], "parts": parts, "notes": state["notes"] | notes}
        self._commit(new)
        self._clean(state, new)
        return new

    def _commit(self, new: dict) -> None:
        name = f"manifest-{new['version']:010d}.json"
        draft, final = self._at(f".{name}.draft"), self._at(name)
        if self._fs.exists(final):
            raise RuntimeError(f"{self.path}: version {new['version']} was written by another writer")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(new).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"{self.path}: version {new['version']} was written by another writer")

    def _clean(self, old: dict, new: dict) -> None:
        """Remove folders that neither the new nor the last state names, and manifests before the last."""
        kept = {(int(v), int(b)) for state in (old, new) for b, v in state["parts"].items()}
        for name in self._names(self._root):
            if name.startswith("manifest-") and int(name[9:-5]) < old["version"]:
                self._fs.delete(self._at(name), False)
            if name.startswith("part-") and int(name[5:]) < new["version"]:
                inside = [int(x.removeprefix("_bucket=")) for x in self._names(self._at(name)) if x.startswith("_bucket=")]
                gone = [b for b in inside if (int(name[5:]), b) not in kept]
                if len(gone) == len(inside):
                    self._fs.delete(self._at(name), True)
                else:
                    for b in gone:
                        self._fs.delete(self._at(name, f"_bucket={b}"), True)

    def put(self, changes: DataFrame, **notes) -> dict:
        """Rows put in by key. ``changes`` is unique by key and is read twice."""
        state = self.manifest()
        buckets = self.touched(changes, state)
        return self.replace(upsert(self.read(state, buckets), changes, self.key), buckets, state, **notes)

    def delete(self, keys: DataFrame, **notes) -> dict:
        state = self.manifest()
        buckets = self.touched(keys, state)
        return self.replace(delete_keys(self.read(state, buckets), keys, self.key), buckets, state, **notes)

    def reset(self, **notes) -> dict:
        """Empty the index, keeping its last state for readers until the next change."""
        state = self.manifest()
        return self.replace(self.spark.createDataFrame([], self.schema), list(range(state["buckets"])), state | {"notes": {}}, **notes)

    def for_model(self, model: str) -> bool:
        """Empty the index where it was made by another model; whether it was."""
        state = self.manifest()
        stale = bool(state["parts"]) and state["notes"].get("model") != model
        if stale:
            self.reset(model=model)
        return stale

