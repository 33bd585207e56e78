"""SRC-5: the newest row of one aircraft, found by its key.

The aircraft table lies in buckets of a hash of ``icao24``, so the key names
the only folder to read. Its row says when the aircraft was last seen, which
names the only date of the state vectors to read; inside, files are sorted
by key and row groups without it are skipped. Neither read lists, plans or
scans another folder, however long the history. The answer is as of the last
cycle that wrote the tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.operators.clean import ingest_order
from contrail.session import in_utc
from contrail.sinks.versions import current, names_in, read_version


def bucket_of(spark: SparkSession, key: str, buckets: int) -> str:
    """Part of a table bucketed by one string column that holds ``key``;
    folded while planning, without a job."""
    return str(spark.sql("SELECT CAST(pmod(xxhash64(k), :n) AS INT) FROM VALUES (:k) AS t(k)",
                         args={"k": key, "n": buckets}).first()[0])


@in_utc
def newest_aircraft(spark: SparkSession, graph_dir: str, icao24: str) -> DataFrame:
    """Attributes and ``seen_at`` of one aircraft (parameter trimmed and
    lower-cased); no row if it is unknown."""
    path, key = os.path.join(graph_dir, "aircraft"), icao24.strip().lower()
    table = current(spark, path)
    if table is None:
        raise FileNotFoundError(f"no table at {path}")
    part = bucket_of(spark, key, table.buckets)
    return read_version(spark, path, [part], table.number).filter(F.col("icao24") == key)


@in_utc
def newest_state(spark: SparkSession, graph_dir: str, state_vectors_path: str, icao24: str,
                 schema: StructType | None = None) -> DataFrame:
    """The newest state vector of one aircraft; the last write, if it was
    delivered more than once. No row if it is unknown or has expired.
    ``schema`` of the stored rows, where the caller has it from an earlier
    read, saves the job that looks it up in a file."""
    seen = newest_aircraft(spark, graph_dir, icao24).select(
        "icao24", F.col("seen_at").cast("string").alias("time"), F.to_date("seen_at").cast("string").alias("day")).first()
    folder = f"{state_vectors_path}/snapshot_date={seen['day']}" if seen else None
    reader = spark.read if schema is None else spark.read.schema(schema)
    if folder is None or not names_in(spark, folder):
        rows = spark.createDataFrame([], schema) if schema is not None else reader.parquet(state_vectors_path).limit(0)
        return rows.drop("snapshot_date")
    rows = reader.parquet(folder).drop("snapshot_date")
    time = F.lit(seen["time"]).cast(rows.schema["snapshot_time"].dataType)
    return rows.filter((F.col("icao24") == seen["icao24"]) & (F.col("snapshot_time") == time)).orderBy(
        *ingest_order(rows)).limit(1)
