"""Product catalogue snapshots: change records merged run after run, into buckets of ids.

A snapshot is cut into buckets by a hash of the id. Below ``base`` there are

- ``data/version=V/bucket=B``: the rows of a bucket, written by the run that made version V;
- ``manifests/version=V``: for each bucket of version V with rows, the version that wrote its folder;
- ``finished``: commit records, the versions that count and their number of buckets.

A run reads and writes only the buckets that hold changed products. The others are named by the new manifest
where they are, so a run costs what changes, not what is there, and old versions share their files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from clicklake.operators.versions import latest_per_key, merged_snapshot
from clicklake.schemas import CATALOGUE_PRODUCT
from clicklake.session import scratch_path
from clicklake.sources.commits import commit, committed, folder_names, remove_path
from clicklake.sources.readers import read_json
from clicklake.sources.writers import rebalance

KEY, VERSION = "id", "timestamp"
BUCKETS = 64
_BUCKET = "bucket"
FINISHED = StructType([StructField("version", IntegerType()), StructField("buckets", IntegerType())])
MANIFEST = StructType([StructField(_BUCKET, IntegerType()), StructField("written_in", IntegerType())])


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _finished(spark: SparkSession, base: str) -> dict[int, int]:
    """Finished versions and their numbers of buckets; one short record for each run there was."""
    return {row.version: row.buckets for row in committed(spark, f"{base}/finished", FINISHED).collect()}


def current_version(spark: SparkSession, base: str) -> int:
    """Number of the last finished snapshot, 0 before the first."""
    return max(_finished(spark, base), default=0)


def manifest(spark: SparkSession, base: str, version: int) -> dict[int, int]:
    """For each bucket that has rows the version that wrote them; at most as many as there are buckets."""
    if not version:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{base}/manifests/version={version}").collect()
    return {row[_BUCKET]: row.written_in for row in rows}


def _read(spark: SparkSession, base: str, folders: dict[int, int]) -> DataFrame:
    paths = [f"{base}/data/version={version}/{_BUCKET}={bucket}" for bucket, version in sorted(folders.items())]
    if not paths:
        return spark.createDataFrame([], CATALOGUE_PRODUCT)
    return spark.read.schema(CATALOGUE_PRODUCT).parquet(*paths)


def read_snapshot(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the current one."""
    return _read(spark, base, manifest(spark, base, version or current_version(spark, base)))


def run_product_merge(
    spark: SparkSession, records_path: str, base: str, keep_versions: int | None = None, buckets: int = BUCKETS
) -> int:
    """Merge product records into the current snapshot as a new version; returns its number.

    The first run makes the snapshot from the records alone, in ``buckets`` buckets; later runs keep their
    number. Records are reduced to the latest of each product. A bucket is written anew if one of its rows
    changes, so a replay of old records writes no rows.

    The version counts once it is noted, after its rows and its manifest. A run that fails leaves the current
    version as it was, and the next one replaces what it left. One run works on a catalogue at a time.

    ``keep_versions`` removes older versions after the run, with the folders that no kept version names; by
    default all are kept.
    """
    finished = _finished(spark, base)
    version = max(finished, default=0)
    buckets = finished.get(version, buckets)
    held = manifest(spark, base, version)

    scratch = scratch_path(spark, "changes")
    latest_per_key(read_json(spark, records_path, CATALOGUE_PRODUCT), KEY, VERSION).write.parquet(f"{scratch}/latest")
    records = spark.read.schema(CATALOGUE_PRODUCT).parquet(f"{scratch}/latest")
    arriving = _buckets_of(records, buckets)
    near = _read(spark, base, {b: v for b, v in held.items() if b in arriving})
    _effective(near, records).write.parquet(f"{scratch}/effective")
    changes = spark.read.schema(CATALOGUE_PRODUCT).parquet(f"{scratch}/effective")
    touched = _buckets_of(changes, buckets)

    merged = merged_snapshot(_read(spark, base, {b: v for b, v in held.items() if b in touched}), changes, KEY, VERSION)
    data = f"{base}/data/version={version + 1}"
    remove_path(spark, data)
    if touched:
        rows = merged.withColumn(_BUCKET, bucket_of(F.col(KEY), buckets))
        rebalance(rows, _BUCKET).write.partitionBy(_BUCKET).parquet(data)
    folders = held | dict.fromkeys(touched, version + 1)
    listed = spark.createDataFrame(sorted(folders.items()), MANIFEST)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifests/version={version + 1}")
    commit(spark, f"{base}/finished", FINISHED, version=version + 1, buckets=buckets)
    if keep_versions:
        _remove_old(spark, base, sorted([*finished, version + 1])[-keep_versions:])
    return version + 1


def _buckets_of(rows: DataFrame, buckets: int) -> set[int]:
    """The buckets that hold the rows' ids; at most ``buckets`` numbers."""
    return {row[0] for row in rows.select(bucket_of(F.col(KEY), buckets)).distinct().collect()}


def _effective(snapshot: DataFrame, records: DataFrame) -> DataFrame:
    """The records (one for each id) that change a row of the snapshot or are new to it."""
    columns = snapshot.columns
    old = snapshot.select(*[F.col(c).alias(f"__old_{c}") for c in columns], F.lit(True).alias("__found"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    older = F.col(f"__old_{VERSION}").isNotNull() & F.coalesce(F.col(VERSION) < F.col(f"__old_{VERSION}"), F.lit(True))
    kept = F.col("__found").isNull() | ~(older | same)
    return records.join(old, F.col(KEY).eqNullSafe(F.col(f"__old_{KEY}")), "left").filter(kept).select(columns)


def _remove_old(spark: SparkSession, base: str, kept: list[int]) -> None:
    """Remove the manifests of other versions, and the bucket folders that those kept do not name."""
    named = {(written, bucket) for version in kept for bucket, written in manifest(spark, base, version).items()}
    for name in folder_names(spark, f"{base}/manifests"):
        if int(name.split("=")[1]) not in kept:
            remove_path(spark, f"{base}/manifests/{name}")
    for name in folder_names(spark, f"{base}/data"):
        written = int(name.split("=")[1])
        folders = [f for f in folder_names(spark, f"{base}/data/{name}") if f.startswith(_BUCKET)]
        gone = [f for f in folders if (written, int(f.split("=")[1])) not in named]
        for path in [name] if gone == folders else [f"{name}/{folder}" for folder in gone]:
            remove_path(spark, f"{base}/data/{path}")
