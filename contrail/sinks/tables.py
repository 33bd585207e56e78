"""Table sinks in plain date-partitioned parquet: keyed upsert (SNK-1,
SNK-2), catalogue overwrite (SNK-3), retention (SNK-10) and reset (SNK-11).
The batch job's own tables are versioned (``sinks/versions.py``).

The upsert reads only the partitions the new rows touch, keeps the newest
row per key (new rows beat stored rows, then the higher ingest order),
stages the merge in the table's ``_pending`` folder and rewrites just those
partitions (dynamic partition overwrite). The staged copy goes only when the
rewrite is complete: a writer that was lost in between is redone from it by
the next one (:func:`recover`). Re-running the same batch gives the same
table, so a retried micro-batch is harmless. The append path writes only new
rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import constants as K
from contrail.operators.clean import keep_top_per_key
from contrail.session import delete_path, in_utc
from contrail.sinks import versions as V
from contrail.sinks.versions import names_in

STATE_VECTOR_KEYS = ["icao24", "snapshot_time"]
FLIGHT_EVENT_KEYS = ["icao24", "event_time", "event_type"]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


@in_utc
def upsert(new_rows: DataFrame, path: str, keys: list[str], time_col: str,
           part_col: str = "part_date", order: list[Column] | None = None) -> int:
    """Insert-or-replace ``new_rows`` by ``keys`` into parquet at ``path``
    partitioned by ``part_col`` = date(``time_col``). Returns the number of
    touched partitions."""
    spark = new_rows.sparkSession
    order = order or []
    recover(spark, path, keys, part_col)
    fresh = new_rows.withColumn(part_col, F.to_date(time_col)).withColumn("_src", F.lit(1))
    touched = [r[0] for r in fresh.select(part_col).distinct().collect()]  # a handful of dates
    if not touched:
        return 0  # ST-5: an empty batch is a no-op
    if _partitions(spark, path):
        stored = (spark.read.parquet(path).filter(F.col(part_col).isin(touched))
                       .withColumn("_src", F.lit(0)))
        fresh = fresh.unionByName(stored, allowMissingColumns=True)
    merged = keep_top_per_key(fresh, keys, [F.col("_src").desc(), *order]).drop("_src")
    _overwrite_partitions(merged, path, keys, part_col, "upsert")
    return len(touched)


PENDING = "_pending"


def _rewrite(staged: DataFrame, path: str, keys: list[str], part_col: str) -> None:
    """Range-partitioned on (date, keys): sampled boundaries split a hot date
    over many tasks, and every file holds a narrow sorted key range, so a
    lookup by icao24 skips files and row groups by their min/max statistics."""
    (staged.repartitionByRange(part_col, *keys).sortWithinPartitions(part_col, *keys)
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(part_col).parquet(path))


def _overwrite_partitions(merged: DataFrame, path: str, keys: list[str], part_col: str, name: str) -> None:
    """Stage ``merged`` (we overwrite what we read) in the table's pending
    folder, rewrite its partitions, then drop the staged copy. If the rewrite
    fails, the copy stays for :func:`recover`."""
    spark = merged.sparkSession
    staged_path = f"{path}/{PENDING}/{name}-{uuid.uuid4().hex}"
    try:
        merged.write.parquet(staged_path)
    except BaseException:
        delete_path(spark, staged_path)  # nothing of the table has changed
        raise
    staged = spark.read.schema(merged.schema).parquet(staged_path)
    _rewrite(staged, path, keys, part_col)
    delete_path(spark, staged_path)


@in_utc
def recover(spark: SparkSession, path: str, keys: list[str], part_col: str) -> int:
    """Redo the rewrites whose writer was lost after staging; drop what was
    staged in part. Every upsert and compaction begins with it; a reader that
    must not see a rewrite cut short calls it first. Returns the number
    redone."""
    done = 0
    for name in names_in(spark, f"{path}/{PENDING}"):
        staged_path = f"{path}/{PENDING}/{name}"
        if "_SUCCESS" in names_in(spark, staged_path):
            _rewrite(spark.read.parquet(staged_path), path, keys, part_col)
            done += 1
        delete_path(spark, staged_path)
    return done


@in_utc
def append_partitions(rows: DataFrame, path: str, time_col: str, part_col: str) -> None:
    """Append-only write into date partitions: O(rows written), whatever
    the table size. Duplicates of a key are resolved when read (the batch
    job keeps the newest write per key) and by :func:`compact`."""
    (rows.withColumn(part_col, F.to_date(time_col)).write.mode("append")
         .partitionBy(part_col).parquet(path))


@in_utc
def compact(spark: SparkSession, path: str, keys: list[str], part_col: str,
            values: list, order: list[Column]) -> int:
    """Rewrite the given partitions with one row per key (newest write
    wins), e.g. once a day for closed days of an append-only table."""
    if not values or not _exists(spark, path):
        return 0
    recover(spark, path, keys, part_col)
    if not _partitions(spark, path):
        return 0
    stored = spark.read.parquet(path).filter(F.col(part_col).isin(values))
    _overwrite_partitions(keep_top_per_key(stored, keys, order), path, keys, part_col, "compact")
    return len(values)


def compact_state_vectors(spark: SparkSession, path: str, days: list) -> int:
    """Compact closed days of the append-only state-vector table."""
    from contrail.operators.clean import ingest_order
    if not _exists(spark, path):
        return 0
    order = ingest_order(spark.read.parquet(path))
    return compact(spark, path, STATE_VECTOR_KEYS, "snapshot_date", days, order)


def upsert_state_vectors(rows: DataFrame, path: str) -> int:
    """SNK-1: key (icao24, snapshot_time), partitioned by snapshot date."""
    order = [F.col(c).desc_nulls_last() for c in ("ingest_seq", "last_contact") if c in rows.columns]
    return upsert(rows.filter(F.col("icao24").isNotNull() & F.col("snapshot_time").isNotNull()),
                  path, STATE_VECTOR_KEYS, "snapshot_time", "snapshot_date", order)


def upsert_flight_events(events: DataFrame, path: str) -> int:
    """SNK-2: key (icao24, event_time, event_type), partitioned by event
    date; the later batch wins."""
    order = [F.col("batch_id").desc_nulls_last()] if "batch_id" in events.columns else []
    return upsert(events, path, FLIGHT_EVENT_KEYS, "event_time", "event_date", order)


def write_airports(airports: DataFrame, path: str) -> None:
    """SNK-3: the catalogue is small and replaced as a whole."""
    airports.write.mode("overwrite").parquet(path)


@in_utc
def retained(df: DataFrame, time_col: str, days: int, now: dt.datetime | None = None,
             part_col: str | None = None) -> DataFrame:
    """Rows younger than ``days`` (SNK-10 as a read filter). ``part_col``:
    the date partition of ``time_col``; the same bound on it keeps older
    partitions from being listed."""
    oldest = (F.lit(now) if now is not None else F.current_timestamp()) - F.expr(f"INTERVAL {int(days)} DAYS")
    if part_col is not None:
        df = df.filter(F.col(part_col) >= F.to_date(oldest))
    return df.filter(F.col(time_col) >= oldest)


def expire_partitions(spark: SparkSession, path: str, part_col: str, days: int,
                      today: dt.date | None = None) -> list[str]:
    """SNK-10: delete whole date partitions older than ``days`` (state
    vectors 7, flight events 30). Returns the deleted partition values."""
    if not _exists(spark, path):
        return []
    cutoff = (today or dt.datetime.now(dt.timezone.utc).date()) - dt.timedelta(days=days)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(part_col + "="):
            value = name.split("=", 1)[1]
            try:
                day = dt.date.fromisoformat(value)
            except ValueError:
                continue
            if day < cutoff:
                fs.delete(status.getPath(), True)
                dropped.append(value)
    return sorted(dropped)


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``column=value`` folders of a table, in order."""
    return [n for n in names_in(spark, path) if "=" in n]


def expire_state_vectors(spark: SparkSession, path: str, today: dt.date | None = None) -> list[str]:
    return expire_partitions(spark, path, "snapshot_date", K.STATE_VECTOR_TTL_DAYS, today)


def expire_flight_events(spark: SparkSession, path: str, today: dt.date | None = None) -> list[str]:
    return expire_partitions(spark, path, "event_date", K.FLIGHT_EVENT_TTL_DAYS, today)


def reset_derived(spark: SparkSession, paths: dict[str, str], keep: tuple[str, ...] = ("airports",)) -> list[str]:
    """SNK-11: empty every derived table (same schema, zero rows); the
    airport catalogue is kept. A partitioned table keeps its layout: its
    newest partition stays, with an empty file that holds the schema."""
    done = []
    for name, path in paths.items():
        if name in keep or not _exists(spark, path):
            continue
        if V.exists(spark, path):
            V.drop_parts(spark, path, lambda part: False)
            done.append(name)
            continue
        schema = spark.read.parquet(path).schema
        parts = _partitions(spark, path)
        for part in parts[:-1]:
            delete_path(spark, f"{path}/{part}")
        if parts:
            part_col = parts[-1].split("=", 1)[0]
            schema = T.StructType([f for f in schema if f.name != part_col])
            path = f"{path}/{parts[-1]}"
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        done.append(name)
    return done
