"""What earlier runs saw and delivered, kept as Parquet snapshots by dedup key, in buckets."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from handbill.functions.keys import content_hash, event_id
from handbill.schema import STATE_COLUMNS, STATE_SCHEMA

_KEPT_FROM_STATE = ("id", "delivered", "delivered_at")
_BUCKETED = StructType([*STATE_SCHEMA.fields, StructField("bucket", IntegerType())])


def with_content_hash(events: DataFrame) -> DataFrame:
    """Add ``id`` and ``content_hash``, from the merged fields."""
    return events.withColumns(
        {
            "id": event_id(F.col("dedup_key")),
            "content_hash": content_hash(
                F.col("start_datetime"), F.col("end_datetime"), F.col("city_norm"),
                F.col("venue_name"), F.col("price_min"), F.col("price_max"), F.col("ticket_url"),
            ),
        }
    )


def delivery_status(events: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``delivery_state``: new, unchanged or updated against the prior snapshot.

    Only three narrow state columns take part, and both sides hold a key once, so the join
    cannot skew; the planner broadcasts whichever side is measured small.
    """
    prior = state.select(
        "dedup_key", F.col("content_hash").alias("_hash"), F.col("delivered").alias("_delivered")
    )
    return (
        events.join(prior, "dedup_key", "left")
        .withColumn(
            "delivery_state",
            F.when(~F.coalesce("_delivered", F.lit(False)), F.lit("new"))
            .when(F.col("_hash") == F.col("content_hash"), F.lit("unchanged"))
            .otherwise(F.lit("updated")),
        )
        .drop("_hash", "_delivered")
    )


def suppress_unchanged(events: DataFrame, deliver_unchanged: bool = False) -> DataFrame:
    """Leave out events that were delivered in the same form, unless asked to repeat them."""
    return events if deliver_unchanged else events.where(F.col("delivery_state") != "unchanged")


def upsert(state: DataFrame, events: DataFrame) -> DataFrame:
    """The next snapshot: new keys added, known keys overwritten, delivery marks kept."""
    fresh = events
    for name, default in (("delivered", F.lit(False)), ("delivered_at", F.lit(None))):
        fresh = fresh.withColumn(name, default)
    fresh = fresh.select(*[F.col(c).cast(STATE_SCHEMA[c].dataType).alias(c) for c in STATE_COLUMNS])
    old, new = state.alias("old"), fresh.alias("new")
    is_new = F.col("new.dedup_key").isNotNull()

    def pick(name: str):
        if name in _KEPT_FROM_STATE:
            known = F.col("old.dedup_key").isNotNull()
            return F.when(known, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        return F.when(is_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    return old.join(new, F.col("old.dedup_key") == F.col("new.dedup_key"), "full_outer").select(
        *[pick(c).alias(c) for c in STATE_COLUMNS]
    )


def mark_delivered(state: DataFrame, delivered: DataFrame, run_ts: datetime) -> DataFrame:
    """Set the delivery mark of the keys a digest contained. The keys must be distinct."""
    keys = delivered.select("dedup_key", F.lit(True).alias("_now"))
    now = F.coalesce("_now", F.lit(False))
    return (
        state.join(keys, "dedup_key", "left")
        .withColumns(
            {
                "delivered": now | F.col("delivered"),
                "delivered_at": F.when(now, F.lit(run_ts).cast("timestamp_ntz")).otherwise(
                    F.col("delivered_at")
                ),
            }
        )
        .select(*STATE_COLUMNS)
    )


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class StateTable:
    """Snapshots in key-hash buckets: a listing names a folder for each bucket, a manifest the current listing.

    A merge rewrites only the buckets its keys fall in; the next listing refers to the other buckets where
    they are. Beside the rows of each bucket lie the sorted hashes of its keys, so a run that
    only looks up reads the rows of those buckets that hold one of its keys.

    A snapshot counts only once its manifest row is written, and no written folder is touched
    again, so a run that dies at any moment, also when it is repeated, leaves the previous
    snapshot in force. A repeated run starts from the newest snapshot of another run and writes
    a new one: repeating it changes nothing. The row may also name the folder of the run's outputs, so that
    these and the snapshot come into force together: see :meth:`published`.

    ``buckets`` is set by the first snapshot and kept from then on; it bounds the listing, the only thing the
    driver holds. Choose it so that a bucket fits a task.
    """

    _MANIFEST = "version BIGINT, run_id STRING, folder STRING, buckets INT, outputs STRING"
    _LISTING = "bucket INT, folder STRING"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self._listings: dict[str, dict[int, str]] = {}

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self._MANIFEST).json(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _newest(self, other_than: str | None):
        """The newest manifest rows: of all runs, and of all but one."""
        row = F.struct("version", "run_id", "folder", "buckets")
        others = F.lit(True) if other_than is None else F.col("run_id") != other_than
        manifest = self._manifest()
        if manifest is None:
            return None, None
        return manifest.agg(F.max(row), F.max(F.when(others, row))).first()

    def published(self) -> DataFrame:
        """The folder of each run's outputs in force: ``run_id``, ``version``, ``outputs``, one row a run that has some.

        A run that was repeated has the outputs of its last commit; one that died before its commit has no row.
        """
        manifest = self._manifest()
        if manifest is None:
            manifest = self.spark.createDataFrame([], self._MANIFEST)
        return manifest.where("outputs IS NOT NULL").groupBy("run_id").agg(
            F.max("version").alias("version"), F.max_by("outputs", "version").alias("outputs"))

    def _start(self, for_run: str | None):
        """The next version, the number of buckets, and the folder of each bucket a run starts from."""
        newest, before = self._newest(other_than=for_run)
        if newest is None:
            return 1, self.buckets, {}
        if before is None:
            return newest.version + 1, newest.buckets, {}
        if before.folder not in self._listings:  # written once, so it can be kept
            rows = self.spark.read.schema(self._LISTING).json(f"{self.path}/{before.folder}/listing")
            self._listings = {before.folder: {r.bucket: r.folder for r in rows.collect()}}
        return newest.version + 1, before.buckets, self._listings[before.folder]

    def listing(self, for_run: str | None = None) -> tuple[int, dict[int, str]]:
        """The number of buckets, and the folder of each one that holds rows."""
        return self._start(for_run)[1:]

    def _rows(self, folders: dict[int, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(
            *(f"{self.path}/{folder}/rows/bucket={bucket}" for bucket, folder in sorted(folders.items())))

    def read(self, for_run: str | None = None) -> DataFrame:
        """The current snapshot, or the one a given run has to start from; empty at first."""
        return self._rows(self.listing(for_run)[1])

    def read_for(self, events: DataFrame, for_run: str | None = None) -> DataFrame:
        """The rows of the buckets that hold a key of ``events``, found in the buckets' key files."""
        buckets, folders = self.listing(for_run)
        wanted = events.select(
            bucket_of(F.col("dedup_key"), buckets).alias("bucket"), F.xxhash64("dedup_key").alias("key_hash"))
        touched = {r.bucket for r in wanted.select("bucket").distinct().collect()} & set(folders)
        if not touched:
            return self._rows({})
        keys = self.spark.read.schema("key_hash BIGINT").parquet(
            *(f"{self.path}/{folders[bucket]}/keys/bucket={bucket}" for bucket in sorted(touched)))
        held = wanted.join(keys, "key_hash", "left_semi").select("bucket").distinct().collect()
        return self._rows({r.bucket: folders[r.bucket] for r in held})

    def commit(self, snapshot: DataFrame, run_id: str) -> None:
        """Write a whole snapshot and make it the current one."""
        version, buckets, _ = self._start(None)
        self._publish(snapshot, run_id, version, buckets, {})

    def merge(self, events: DataFrame, run_id: str, shown: DataFrame | None = None,
              run_ts: datetime | None = None, outputs: str | None = None) -> None:
        """Upsert ``events`` and mark the keys of ``shown`` delivered; only the buckets of those keys are rewritten.

        ``outputs`` is the folder of what the run gives out, already written: it is published with the snapshot.
        """
        version, buckets, folders = self._start(run_id)
        keys = events.select("dedup_key")
        if shown is not None:
            keys = keys.union(shown.select("dedup_key"))
        touched = {r[0] for r in keys.select(bucket_of(F.col("dedup_key"), buckets)).distinct().collect()}
        snapshot = upsert(self._rows({b: f for b, f in folders.items() if b in touched}), events)
        if shown is not None:
            snapshot = mark_delivered(snapshot, shown, run_ts)
        untouched = {b: f for b, f in folders.items() if b not in touched}
        self._publish(snapshot, run_id, version, buckets, untouched, outputs)

    def _publish(self, rows: DataFrame, run_id: str, version: int, buckets: int, untouched: dict[int, str],
                 outputs: str | None = None) -> None:
        folder = f"run={run_id}/attempt={uuid.uuid4().hex}"
        # each bucket is in one partition, so in one file; small snapshots are few partitions
        rows.select(*STATE_COLUMNS).withColumn("bucket", bucket_of(F.col("dedup_key"), buckets)).repartition("bucket") \
            .write.partitionBy("bucket").parquet(f"{self.path}/{folder}/rows")
        written = self.spark.read.schema(_BUCKETED).parquet(f"{self.path}/{folder}/rows")
        held = {int(file.split("/bucket=")[1].split("/")[0]) for file in written.inputFiles()}
        if held:
            written.select("bucket", F.xxhash64("dedup_key").alias("key_hash")) \
                .sortWithinPartitions("bucket", "key_hash").write.partitionBy("bucket").parquet(f"{self.path}/{folder}/keys")
        listed = [*((b, folder) for b in held), *untouched.items()]
        self.spark.createDataFrame(listed, self._LISTING).coalesce(1).write.json(f"{self.path}/{folder}/listing")
        self.spark.createDataFrame([(version, run_id, folder, buckets, outputs)], self._MANIFEST).coalesce(1) \
            .write.mode("append").json(f"{self.path}/manifest")
