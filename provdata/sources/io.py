"""Readers, snapshot helpers and writers (SRC1-SRC6, SNK1-SNK5).

Raw files are read with explicit all-string schemas (no inference pass over
the data) and typed at staging. Writes never update in place: a table
version is a new directory published by a ``_commit_<n>`` marker that names it,
so a failed job leaves the previous version intact and a rerun simply
writes another directory (executor loss only retries tasks).
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.providers import RAW_COLUMNS

NULL_TOKENS = ["", "NULL", "null"]
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def string_schema(columns: Sequence[str], corrupt: str | None = "_corrupt_record") -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType(), True))
    return T.StructType(fields)


def read_npi(spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS, names: dict[str, str] | None = None,
             multi_line: bool = True) -> DataFrame:
    """SRC1: registry CSV (header, quoted fields, embedded newlines); short rows padded with NULLs.

    Columns are found by each file's own header, whatever their order: the files of a folder are read in groups of equal
    headers. ``names`` maps header names to canonical ones. Canonical ``columns`` that a file lacks are NULL, other
    columns are dropped. Bad rows keep their text in ``_corrupt_record`` instead of failing the job. Quoted newlines need
    ``multi_line``, which reads a file in one task; without them it can be off, and files split.
    """
    names = names or {}
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    groups: dict[tuple, list[str]] = {}
    for file, header in _headers(spark, path).items():
        groups.setdefault(tuple(names.get(c, c) for c in header), []).append(file)
    out = None
    for header, files in groups.items():
        rows = (spark.read.schema(string_schema(header)).options(**options).option("mode", "PERMISSIVE")
                .option("enforceSchema", True).option("columnNameOfCorruptRecord", "_corrupt_record").csv(files))
        rows = rows.select(*[F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns],
                           "_corrupt_record")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], string_schema(columns))


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Column names of each CSV file at ``path``: one row per file, its first record."""
    first = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                         F.monotonically_increasing_id().alias("row"), "value")
    # The first record of a file lies in the split that begins at 0; ids rise within a split.
    heads = first.where("at = 0").groupBy("file").agg(F.min_by("value", "row").alias("head"))
    return {r["file"]: next(csv.reader([r["head"].lstrip("\ufeff")])) for r in heads.orderBy("file").collect()}


def normalise_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """'', 'NULL', 'null' (after trimming) -> NULL; other text trimmed."""
    cols = columns or [c for c, t in df.dtypes if t == "string" and c != "_corrupt_record"]
    return df.select(*[F.when(~F.trim(F.col(c)).isin(*NULL_TOKENS), F.trim(F.col(c))).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def read_license_csv(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """SRC2/SRC3: licence extract -> (good rows with NULL tokens normalised, rejected rows).

    Column-count mismatches are tolerated as the warehouse load does: short
    rows are padded with NULLs and extra trailing fields dropped (PERMISSIVE
    parsing against an all-string schema). Rows with no usable field at all
    are set aside.
    """
    raw = (spark.read.schema(string_schema(columns, corrupt=None)).option("header", True).option("sep", sep)
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
           .option("mode", "PERMISSIVE").csv(path))
    norm = normalise_nulls(raw, columns)
    usable = F.coalesce(*[F.col(c) for c in columns]).isNotNull()
    return norm.filter(usable), norm.filter(~usable)


def read_license_pipe(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """SRC3: pipe-delimited bulk variant."""
    return read_license_csv(spark, path, columns, sep="|")


# --- snapshots (SRC4, SRC5) ---------------------------------------------------

def snapshot_dates(df: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """SRC4: the distinct valid snapshot dates."""
    return df.select(F.to_date(F.col(col)).alias("snapshot_date")).where("snapshot_date is not null").distinct()


def latest_pair(df: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """SRC4: newest date and the one before it; with a single date it is compared with itself."""
    d = snapshot_dates(df, col)
    cur = d.select(F.max("snapshot_date")).scalar()
    prev = d.filter(F.col("snapshot_date") < cur).select(F.max("snapshot_date")).scalar()
    return d.agg(F.max("snapshot_date").alias("current_date")).select(
        "current_date", F.coalesce(prev, F.col("current_date")).alias("previous_date"))


def load_snapshot(df: DataFrame, date: str | Column, col: str = "snapshot_date") -> DataFrame:
    """SRC4: one snapshot (a partition filter on a partitioned table)."""
    d = F.lit(date) if isinstance(date, str) else date
    return df.filter(F.to_date(F.col(col)) == F.to_date(d)).drop(col)


def row_digest(cols: Sequence[str]) -> Column:
    """Canonical text of a row -> 60-bit integer (first 15 hex digits of md5).

    Each value is written behind its length, so no value can pass for a separator.
    """
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")),
                                         F.lit("\\N")) for c in cols])
    return F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("decimal(38,0)")


def snapshot_fingerprint(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """SRC5: rows and an order-free content digest (sum of row digests) per group.

    Equal digests mean equal multisets of rows (up to hash collisions); it
    combines map-side, so fingerprinting a huge file is one aggregate pass.
    """
    content = [c for c in (cols or df.columns) if c not in by]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_digest(content)).alias("digest"))


def unchanged_snapshots(cur: DataFrame, prev: DataFrame, by: Sequence[str]) -> DataFrame:
    """SRC5: per group: both fingerprints and whether the content is unchanged."""
    c = cur.select(*by, F.col("rows").alias("rows_current"), F.col("digest").alias("digest_current"))
    p = prev.select(*by, F.col("rows").alias("rows_previous"), F.col("digest").alias("digest_previous"))
    j = c.join(p, list(by), "full_outer")
    return j.select("*", F.coalesce(F.col("digest_current") == F.col("digest_previous"), F.lit(False))
                    .alias("unchanged"))


# --- JSON events (SRC6) -------------------------------------------------------

def read_events_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                     array_files: bool = False) -> DataFrame:
    """SRC6: event objects — JSON lines, or (``array_files``) one JSON array per file as the
    trigger scripts write them."""
    r = (spark.read.option("multiLine", array_files).option("timestampNTZFormat", TS_FORMAT)
         .option("timestampFormat", TS_FORMAT))
    return (r.schema(schema) if schema is not None else r).json(path)


def write_events_json(df: DataFrame, path: str) -> None:
    """SRC6 (timestamps keep microseconds)."""
    df.write.mode("overwrite").option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path)


# --- writers (SNK1-SNK4) -------------------------------------------------------

def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], partition_by: Sequence[str] = (),
                    num_files: int | None = None, rows_per_file: int = 100_000) -> None:
    """SNK1: replace a table, clustered by (state, type): range-partitioned and sorted so parquet
    row-group min/max statistics let scans skip on the cluster keys.

    The cluster keys have few values (one state may hold a third of all
    rows), so a row hash is the last range key: a hot key spreads over as
    many files as its size needs while files stay ordered by the keys.
    ``num_files`` is the number for a table of up to so many times ``rows_per_file`` rows; a larger one has more
    files of that size, so that what a task sorts does not grow with the table.
    """
    spread = F.xxhash64(*df.columns).alias("_spread")
    keys = [*cluster_by, "_spread"]
    if num_files:
        num_files = max(num_files, -(-df.count() // rows_per_file))
    keyed = df.select("*", spread)
    out = keyed.repartitionByRange(num_files, *keys) if num_files else keyed.repartitionByRange(*keys)
    w = out.sortWithinPartitions(*keys).drop("_spread").write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: Sequence[str], buckets: int, sort: bool = True) -> None:
    """Write a catalog table bucketed (and sorted) on ``key``.

    Tables joined repeatedly on the same key (providers and their golden
    rows on the NPI, licences and history on the professional id) written
    with the same bucket count join without any shuffle: Spark reads each
    bucket pair as one partition.
    """
    w = df.write.mode("overwrite").bucketBy(buckets, *key)
    if sort:
        w = w.sortBy(*key)
    w.saveAsTable(table)


def write_by_type(df: DataFrame, path: str, col: str = "professional_type", max_records_per_file: int = 5_000_000) -> None:
    """SNK3: one directory per professional type (the combined table is the parent path).

    No shuffle by type: every task writes its own rows into the per-type
    directories, so the largest type is written by all tasks in parallel.
    """
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).partitionBy(col).parquet(path)


def batch_insert(df: DataFrame, path: str) -> None:
    """SNK4: append validated rows."""
    df.write.mode("append").parquet(path)


def merge_upsert(target: DataFrame, updates: DataFrame, key: Sequence[str], mode: str = "replace") -> DataFrame:
    """SNK2: keyed merge without MERGE INTO.

    ``replace``: rows of ``updates`` win for their keys. ``insert_only``:
    keys already in ``target`` keep their row (only new keys are added).
    New columns on either side are kept (missing values NULL). A key that
    ``updates`` holds several times counts once, with its greatest row (in
    column order); NULL in a key equals NULL.
    """
    key = list(key)
    rest = [c for c in updates.columns if c not in key]
    updates = (updates.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_row")).select(*key, "_row.*").select(*updates.columns)
               if rest else updates.distinct())

    def without(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*[F.col(k).alias(f"_k_{k}") for k in key]).distinct()
        on = F.lit(True)
        for k in key:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return a.join(b, on, "left_anti")

    if mode == "replace":
        return without(target, updates).unionByName(updates, allowMissingColumns=True)
    if mode == "insert_only":
        return target.unionByName(without(updates, target), allowMissingColumns=True)
    raise ValueError(f"unknown mode {mode}")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path.rstrip("/"))
    return fs.exists(p)


class ConcurrentWrite(RuntimeError):
    """Another writer has published the same version meanwhile; its rows stay."""


def _markers(spark: SparkSession, base: str) -> list[int]:
    fs, p = _hadoop_fs(spark, base.rstrip("/"))
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName()[len("_commit_"):]) for st in fs.listStatus(p)
                  if st.getPath().getName().startswith("_commit_"))


def _last_marker(spark: SparkSession, base: str) -> int:
    return max(_markers(spark, base), default=0)


def _folder(spark: SparkSession, base: str, version: int) -> str | None:
    """The data folder that the marker of ``version`` names; None while its writer has not closed it."""
    fs, marker = _hadoop_fs(spark, f"{base.rstrip('/')}/_commit_{version}")
    stream = fs.open(marker)
    name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return f"{base.rstrip('/')}/{name}" if name else None


def current_version(spark: SparkSession, base: str) -> int | None:
    """Highest committed version under ``base`` (a ``_commit_<n>`` marker per version, which names its folder)."""
    return next((v for v in reversed(_markers(spark, base)) if _folder(spark, base, v)), None)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    v = current_version(spark, base)
    return None if v is None else spark.read.parquet(_folder(spark, base, v))


def drop_versions(spark: SparkSession, base: str, keep: int) -> None:
    """Remove the data and then the markers of all but the last ``keep`` versions."""
    for v in _markers(spark, base)[:-keep]:
        fs, marker = _hadoop_fs(spark, f"{base.rstrip('/')}/_commit_{v}")
        if data := _folder(spark, base, v):
            fs.delete(_hadoop_fs(spark, data)[1], True)
        fs.delete(marker, False)


def write_version(spark: SparkSession, df: DataFrame, base: str, keep: int | None = None) -> int:
    """Write ``df`` as the next version, in a folder of its own, then publish it with a commit marker that names the folder.

    Creating ``_commit_<n>`` is exclusive: of two writers of one version the second raises ``ConcurrentWrite`` and
    what it wrote is named by no marker. Readers never see a half-written version, and a job that dies before the marker
    leaves the table as it was. ``keep`` removes all but so many of the last versions; readers of an older one must be done.
    """
    v = _last_marker(spark, base) + 1
    name = f"v={v}-{uuid.uuid4().hex}"
    df.write.parquet(f"{base.rstrip('/')}/{name}")
    fs, marker = _hadoop_fs(spark, f"{base.rstrip('/')}/_commit_{v}")
    try:
        out = fs.create(marker, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            raise ConcurrentWrite(f"version {v} of {base} was published by another writer") from e
        raise
    out.write(bytearray(name.encode()))
    out.close()
    if keep:
        drop_versions(spark, base, keep)
    return v


def upsert(spark: SparkSession, base: str, updates: DataFrame, key: Sequence[str], mode: str = "replace",
           keep: int | None = None) -> int:
    """SNK2: merge ``updates`` into the current version at ``base`` and publish a new version.

    The merged plan reads the current version, so it is written out
    (materialised) as the next version before the pointer moves — lineage
    never grows across versions.
    """
    cur = read_current(spark, base)
    merged = updates if cur is None else merge_upsert(cur, updates, key, mode)
    return write_version(spark, merged, base, keep)
