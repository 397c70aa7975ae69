"""Keyed merge-on-read table (SNK2 for tables too large to rewrite per change).

Rows live in Parquet folders per hash bucket of the key. An upsert or a delete writes only the rows it names, as a *delta*
(a deletion is a row with ``_deleted``); ``read`` lays the newest delta row of a key over the *base*. Buckets
without deltas are scanned as they are; in the others the base loses the deltas' keys by an anti join with these few rows.
``compact`` folds deltas into new base folders, bucket by bucket.

The log has one small JSON file per commit, which names all live (folder, bucket) pairs. Creating the file is the only step
that publishes, and it is exclusive: of two writers the second finds its number taken, reads what
was committed meanwhile, and takes the next number if that touched other buckets, else raises ``ConcurrentUpdate``
with the winner's rows in place. Readers see one commit; a job that dies earlier leaves folders nobody names (``vacuum``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .io import _hadoop_fs, exists

HIDDEN = ("_commit", "_bucket", "_deleted")


class ConcurrentUpdate(RuntimeError):
    """Another writer has changed the same buckets since this one read the table."""


def _same_key(key: Sequence[str], left: str, right: str) -> Column:
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return on


class KeyedTable:
    """A table with one row per key at ``base``; ``buckets`` is fixed by the first commit.

    NULL in a key equals NULL. Columns that an upsert brings anew are appended, NULL for the other rows.
    """

    def __init__(self, spark: SparkSession, base: str, key: Sequence[str], buckets: int = 16, compact_after: int = 8):
        self.spark, self.base, self.key = spark, base.rstrip("/"), list(key)
        self.compact_after = compact_after
        self._new = {"version": 0, "buckets": buckets, "schema": None, "base": [], "delta": [], "touched": [], "op": "create"}

    # --- log ---------------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        fs, folder = _hadoop_fs(self.spark, f"{self.base}/_log")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _entry(self, version: int, wait_s: float = 10.0) -> dict:
        """One commit; a file that its writer has not closed yet is waited for."""
        fs, path = _hadoop_fs(self.spark, f"{self.base}/_log/{version:012d}.json")
        until = time.time() + wait_s
        while True:
            stream = fs.open(path)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            if text:
                return json.loads(text)
            if time.time() > until:
                raise RuntimeError(f"{path} was left empty by a writer that died; remove it")
            time.sleep(0.05)

    def state(self) -> dict:
        """The last commit."""
        versions = self._versions()
        return self._entry(versions[-1]) if versions else self._new

    def version(self) -> int:
        return self.state()["version"]

    def _publish(self, read: dict, op: str, schema: T.StructType, touched: list[int], change) -> int:
        """Commit ``change(state)`` on top of the last commit, if no commit since ``read`` rules it out."""
        while True:
            last = self.state()
            for v in range(read["version"] + 1, last["version"] + 1):
                other = self._entry(v)
                clash = set(other["touched"]) & set(touched)
                # A compaction changes no row: only two of them, or two changes, can collide.
                if clash and (other["op"] == "compact") == (op == "compact"):
                    raise ConcurrentUpdate(f"version {v} of {self.base} changed buckets {sorted(clash)}")
                if other["schema"] != read["schema"] and op != "compact":
                    schema = _merged(T.StructType.fromJson(other["schema"]), schema)
            new = change(dict(last)) | {"version": last["version"] + 1, "op": op, "touched": touched,
                                        "buckets": read["buckets"], "schema": (schema if op != "compact" or last["schema"] is None
                                                                               else T.StructType.fromJson(last["schema"])).jsonValue()}
            fs, path = _hadoop_fs(self.spark, f"{self.base}/_log/{new['version']:012d}.json")
            try:
                out = fs.create(path, False)
            except Exception as e:
                if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                    continue
                raise
            out.write(bytearray(json.dumps(new).encode()))
            out.close()
            return new["version"]

    # --- folders -----------------------------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(buckets)).cast("int")

    def _write(self, df: DataFrame, state: dict) -> tuple[str, list[int]]:
        """Write rows into a folder of their own; its name and the buckets it has."""
        commit = f"{state['version'] + 1:012d}-{uuid.uuid4().hex[:12]}"
        spread = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key], F.lit("file")), F.lit(8))
        rows = df.withColumn("_bucket", self._bucket(state["buckets"]))
        rows.repartition("_bucket", spread).write.partitionBy("_bucket").parquet(f"{self.base}/data/_commit={commit}")
        fs, folder = _hadoop_fs(self.spark, f"{self.base}/data/_commit={commit}")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return commit, sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))

    def _scan(self, pairs: list, schema: T.StructType) -> DataFrame:
        """The rows of (folder, bucket) pairs, with ``_commit`` and ``_deleted``."""
        full = T.StructType([*schema.fields, T.StructField("_deleted", T.BooleanType()), T.StructField("_commit", T.StringType()),
                             T.StructField("_bucket", T.IntegerType())])
        if not pairs:
            return self.spark.createDataFrame([], full)
        paths = [f"{self.base}/data/_commit={c}/_bucket={b}" for c, b in pairs]
        return self.spark.read.option("basePath", f"{self.base}/data").schema(full).parquet(*paths)

    # --- reading -----------------------------------------------------------------------------

    def read(self, state: dict | None = None, buckets: Sequence[int] | None = None,
             only: Sequence[str] | None = None) -> DataFrame | None:
        """The rows as of the last commit (or ``state``), of all buckets or some; None before the first commit.

        ``only`` names the columns wanted: the others are neither read nor shuffled.
        """
        state = state or self.state()
        if not state["version"]:
            return None
        schema = T.StructType.fromJson(state["schema"])
        wanted = None if buckets is None else set(buckets)
        live = lambda kind: [(c, b) for c, own in state[kind] for b in own if wanted is None or b in wanted]
        base, delta = live("base"), live("delta")
        touched = {b for _, b in delta}
        names = [f.name for f in schema.fields if only is None or f.name in only]
        columns, keys = [F.col(f"`{n}`") for n in names], [F.col(f"`{k}`") for k in self.key]
        parts = [self._scan([p for p in base if p[1] not in touched], schema).select(*columns)]
        # A commit names a key once, so where a bucket has one delta its rows are the newest as they are.
        several = {b for b in touched if sum(b == x for _, x in delta) > 1}
        for some in (touched - several, several):
            if not some:
                continue
            rows = self._scan([p for p in delta if p[1] in some], schema)
            if some is several:
                rest = [f"`{n}`" for n in names if n not in self.key]
                rows = (rows.groupBy(*keys).agg(F.max_by(F.struct("_deleted", *rest), "_commit").alias("_row"))
                        .select(*keys, "_row.*"))
            parts.append(rows.where(~F.col("_deleted")).select(*columns))
            if under := [p for p in base if p[1] in some]:
                old = self._scan(under, schema).select(*[F.col(f"`{n}`") for n in dict.fromkeys([*self.key, *names])])
                parts.append(old.alias("b").join(rows.select(*keys).alias("d"), _same_key(self.key, "b", "d"), "left_anti")
                             .select(*columns))
        return reduce(DataFrame.unionByName, parts)

    # --- writing -----------------------------------------------------------------------------

    def _change(self, rows: DataFrame, op: str, read: dict, schema: T.StructType) -> int:
        commit, buckets = self._write(rows, read)
        if not buckets:  # nothing to change; the first commit still makes the table
            if read["version"]:
                return read["version"]
        version = self._publish(read, op, schema, buckets,
                                lambda s: s | {"delta": s["delta"] + ([[commit, buckets]] if buckets else [])})
        if self.compact_after and len(self.state()["delta"]) >= self.compact_after:
            try:
                version = self.compact()
            except ConcurrentUpdate:  # another writer is folding the same buckets
                pass
        return version

    def upsert(self, updates: DataFrame, mode: str = "replace", one_per_key: bool = False) -> int:
        """Rows of ``updates`` replace those of their keys, or (``insert_only``) only add keys that are not there.

        A key that ``updates`` holds several times counts once, with its greatest row in column order;
        ``one_per_key`` says that none is, which saves grouping them.
        """
        if mode not in ("replace", "insert_only"):
            raise ValueError(f"unknown mode {mode}")
        if clash := [c for c in updates.columns if c in HIDDEN]:
            raise ValueError(f"column names in use: {clash}")
        read = self.state()
        schema = _merged(T.StructType.fromJson(read["schema"]), updates.schema) if read["schema"] else updates.schema
        rest = [f"`{c}`" for c in updates.columns if c not in self.key]
        keys = [F.col(f"`{k}`") for k in self.key]
        rows = (updates if one_per_key
                else updates.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*") if rest
                else updates.select(*keys).distinct())
        if mode == "insert_only" and read["version"]:
            hit = [r[0] for r in rows.select(self._bucket(read["buckets"]).alias("b")).distinct().collect()]  # at most ``buckets``
            there = self.read(read, hit, self.key).select(*keys)
            rows = rows.alias("u").join(there.alias("t"), _same_key(self.key, "u", "t"), "left_anti")
        return self._change(rows.withColumn("_deleted", F.lit(False)), mode, read, schema)

    def delete(self, keys: DataFrame) -> int:
        """Remove the rows of ``keys`` (tombstones until the next compaction)."""
        read = self.state()
        if not read["version"]:
            return 0
        rows = keys.select(*[F.col(f"`{k}`") for k in self.key]).distinct().withColumn("_deleted", F.lit(True))
        return self._change(rows, "delete", read, T.StructType.fromJson(read["schema"]))

    def compact(self) -> int:
        """Fold all deltas into new base folders of their buckets; the other buckets keep their files."""
        read = self.state()
        touched = sorted({b for _, own in read["delta"] for b in own})
        if not touched:
            return read["version"]
        commit, buckets = self._write(self.read(read, touched).withColumn("_deleted", F.lit(False)), read)
        folded = {c for c, _ in read["delta"]}

        def change(state: dict) -> dict:
            left = [[c, [b for b in own if b not in touched]] for c, own in state["base"]]
            return state | {"base": [x for x in left if x[1]] + ([[commit, buckets]] if buckets else []),
                            "delta": [x for x in state["delta"] if x[0] not in folded]}

        return self._publish(read, "compact", T.StructType.fromJson(read["schema"]), touched, change)

    def vacuum(self, keep: int = 2) -> None:
        """Forget all but the last ``keep`` commits and remove the folders that none of those names; no writer may be at work."""
        versions = self._versions()
        kept = [self._entry(v) for v in versions[-keep:]]
        named = {c for e in kept for kind in ("base", "delta") for c, _ in e[kind]}
        for v in versions[:-keep]:
            fs, path = _hadoop_fs(self.spark, f"{self.base}/_log/{v:012d}.json")
            fs.delete(path, False)
        if exists(self.spark, f"{self.base}/data"):
            fs, data = _hadoop_fs(self.spark, f"{self.base}/data")
            for s in fs.listStatus(data):
                if s.getPath().getName().removeprefix("_commit=") not in named:
                    fs.delete(s.getPath(), True)


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of ``old``, then those only ``new`` has; a column of both keeps its type."""
    have = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in have and have[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*old.fields, *[f for f in new.fields if f.name not in have]]])
