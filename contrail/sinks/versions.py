"""Keyed tables in versions (SNK-2, SNK-4 to SNK-8): a write never touches
what readers see until its last step.

A table's rows lie in parts: dates of a time column, hash buckets of the keys,
or pairs of blocks of two keys. A write puts the parts it changes under ``version=<n>/``, then
publishes ``_versions/<n>.json``, which names the version that holds each
part. Readers follow the newest pointer. A write that fails at any point
leaves the table as it was; its folder is overwritten by the next try.
Parts without new rows are neither read nor written, so a write costs the
parts it touches. One writer at a time; a second one's pointer is refused.

The rows are written once: AQE's rebalance cuts a hot date into files of
the advisory size and puts small buckets together. Rows that come part by part
are written as they come (``grouped``), without a shuffle or a sort.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.clean import keep_top_per_key
from contrail.operators.near import block
from contrail.session import cut_lineage, delete_path, in_utc, scratch_path, session_conf

POINTERS = "_versions"
FOLDER = "version"
KEEP = 2  # published versions whose files stay for readers that still use them


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType   # of the rows, with the part column
    part_col: str
    buckets: int           # 0: the parts are dates
    parts: dict[str, int]  # part -> number of the version whose folder holds it


@dataclass(frozen=True)
class Parts:
    """How rows are laid out: by the date of ``time_col``, or in
    ``buckets`` by the hash of ``by``; ``paired``: one for each two of some
    blocks that the two columns ``by`` fall in, in either order."""

    part_col: str
    time_col: str | None = None
    by: tuple[str, ...] = ()
    buckets: int = 0
    paired: bool = False

    def of(self) -> Column:
        if self.time_col is not None:
            return F.to_date(self.time_col)
        if self.paired:
            one, two = (block(c, self.blocks) for c in self.by)
            return self.pair(F.least(one, two), F.greatest(one, two)).cast("int")
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")


    @property
    def blocks(self) -> int:
        return (math.isqrt(8 * self.buckets + 1) - 1) // 2

    def pair(self, one, two):
        """Part of two blocks, ``one`` at most ``two``."""
        return one * self.blocks - one * (one - 1) / 2 + two - one


def dated(time_col: str, part_col: str) -> Parts:
    return Parts(part_col, time_col=time_col)


def bucketed(by: list[str], buckets: int) -> Parts:
    """The number of buckets of a table is fixed by its first write."""
    return Parts("bucket", by=tuple(by), buckets=buckets)


def paired(by: list[str], blocks: int) -> Parts:
    """The number of blocks of a table is fixed by its first write."""
    return Parts("pair_block", by=tuple(by), buckets=blocks * (blocks + 1) // 2, paired=True)


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all; it must be new."""
    fs, target = _fs(spark, path)
    _, temp = _fs(spark, f"{path}.part")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(temp, target):
        raise RuntimeError(f"{path} is there already: another writer was first")


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest published version."""
    numbers = [int(n[:-5]) for n in names_in(spark, f"{path}/{POINTERS}") if n.endswith(".json")]
    return _version(spark, path, max(numbers)) if numbers else None


def _version(spark: SparkSession, path: str, number: int) -> Version:
    d = json.loads(read_text(spark, f"{path}/{POINTERS}/{number:010d}.json"))
    return Version(number, T.StructType.fromJson(d["schema"]), d["part_col"], d["buckets"], d["parts"])


@in_utc
def read_version(spark: SparkSession, path: str, parts: list[str] | None = None,
                 number: int | None = None, part_column: bool = False) -> DataFrame:
    """Rows of the newest version (or of a kept ``number``), of all parts or
    the given ones. No other folder is listed. ``part_column`` keeps it."""
    v = current(spark, path) if number is None else _version(spark, path, number)
    if v is None:
        raise FileNotFoundError(f"no table at {path}")
    held = _folders(path, v, parts)
    if held:
        # the part column is the last; nullability as files have it
        df = spark.read.schema(v.schema).option("basePath", path).parquet(*held).select(*v.schema.names)
    else:
        df = spark.createDataFrame([], v.schema)
    return df if part_column else df.drop(v.part_col)


def _folders(path: str, v: Version, parts: list[str] | None) -> list[str]:
    return [f"{path}/{FOLDER}={n}/{v.part_col}={p}" for p, n in sorted(v.parts.items()) if parts is None or p in parts]


def stored_files(spark: SparkSession, path: str, v: Version, parts: list[str]) -> DataFrame | None:
    """The files of the given parts as they lie there: (part, content); None
    if there are none."""
    held = _folders(path, v, parts)
    if not held:
        return None
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(held)
    return files.select(F.regexp_extract("path", f"{v.part_col}=([^/]*)", 1).alias("part"), "content")


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


OPEN_FILES = 64         # that a task writes side by side, before it sorts its rows by part
FILE_ROWS = 2_000_000  # of a grouped part; such files are read as a whole
PAGE_ROWS = 200_000    # compressed at a time


def _write(rows: DataFrame, path: str, number: int, part_col: str, keys: list[str], grouped: bool = False) -> list[str]:
    """Writes the parts of ``rows`` and names them. ``grouped``: a part's rows
    come from one task, in order of the keys. Each value of the first key then
    has much the same list of the last, which zstd finds in plain texts but
    not in packed dictionary codes."""
    folder = f"{path}/{FOLDER}={number}"
    if grouped:
        with session_conf(rows.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
            rows.write.mode("overwrite").options(**{
                "compression": "zstd", f"parquet.enable.dictionary#{keys[-1]}": "false", "maxRecordsPerFile": FILE_ROWS,
                "parquet.page.row.count.limit": PAGE_ROWS, "parquet.page.size": 16 * PAGE_ROWS,
            }).partitionBy(part_col).parquet(folder)
        return _parts_in(rows.sparkSession, folder, part_col)
    rows.hint("rebalance", part_col).sortWithinPartitions(part_col, *keys).write.mode("overwrite").partitionBy(
        part_col).parquet(folder)
    return _parts_in(rows.sparkSession, folder, part_col)


def _parts_in(spark: SparkSession, folder: str, part_col: str) -> list[str]:
    return [n.split("=", 1)[1] for n in names_in(spark, folder) if n.startswith(part_col + "=")]


def _publish(spark: SparkSession, path: str, v: Version) -> Version:
    publish_text(spark, f"{path}/{POINTERS}/{v.number:010d}.json", json.dumps(
        {"schema": json.loads(v.schema.json()), "part_col": v.part_col, "buckets": v.buckets, "parts": v.parts}))
    vacuum(spark, path)
    return v


def _schema(rows: DataFrame, part_col: str) -> T.StructType:
    """``rows``' schema, all nullable, the part column last."""
    fields = [f for f in rows.schema if f.name != part_col] + [rows.schema[part_col]]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def _laid_out(new_rows: DataFrame, path: str, layout: Parts, base: Version | None) -> tuple[DataFrame, Parts]:
    if base is not None:
        if (base.buckets > 0) != (layout.buckets > 0) or base.part_col != layout.part_col:
            raise ValueError(f"{path} is laid out by {base.part_col}, not by {layout.part_col}")
        layout = replace(layout, buckets=base.buckets)
    return new_rows.withColumn(layout.part_col, layout.of()), layout


@in_utc
def merge_rows(new_rows: DataFrame, path: str, keys: list[str], layout: Parts, order: list[Column] | None = None,
               unique: bool = False) -> list[str]:
    """Insert-or-replace by ``keys``; names the touched parts. Of rows with
    one key the first by ``order`` stays (e.g. the newest by time), whether it
    is new or stored; without a difference there the new one. ``unique``: the
    new rows hold each key once."""
    spark, order = new_rows.sparkSession, list(order or [])
    base = current(spark, path)
    rows, layout = _laid_out(new_rows, path, layout, base)
    if base is None:
        if not unique:
            rows = keep_top_per_key(rows, keys, order or [F.lit(0)])
        parts = _write(rows, path, 1, layout.part_col, keys)
        _publish(spark, path, Version(1, _schema(rows, layout.part_col), layout.part_col, layout.buckets, dict.fromkeys(parts, 1)))
        return parts
    scratch = scratch_path(spark, "incoming")
    try:
        # the new rows are computed once; their folders name the touched parts
        rows.hint("rebalance", layout.part_col).write.partitionBy(layout.part_col).parquet(scratch)
        touched = _parts_in(spark, scratch, layout.part_col)
        if not touched:
            return []
        fresh = spark.read.schema(_schema(rows, layout.part_col)).parquet(scratch).withColumn("_src", F.lit(1))
        stored = [p for p in touched if p in base.parts]
        if stored:
            fresh = fresh.unionByName(read_version(spark, path, stored, base.number, True).withColumn("_src", F.lit(0)),
                                      allowMissingColumns=True)
        if stored or not unique:
            fresh = keep_top_per_key(fresh, keys, [*order, F.col("_src").desc()])
        merged = fresh.drop("_src")
        written = _write(merged, path, base.number + 1, layout.part_col, keys)
        _publish(spark, path, Version(base.number + 1, _schema(merged, layout.part_col), layout.part_col, layout.buckets,
                                      base.parts | dict.fromkeys(written, base.number + 1)))
        return touched
    finally:
        delete_path(spark, scratch)


@in_utc
def replace_parts(new_rows: DataFrame, path: str, keys: list[str], layout: Parts, parts: list[str], grouped: bool = False) -> None:
    """``new_rows`` hold everything that ``parts`` shall hold from now on;
    no stored row is read. A part without rows goes. ``grouped``: see
    :func:`_write`."""
    spark = new_rows.sparkSession
    base = current(spark, path)
    rows, layout = _laid_out(new_rows, path, layout, base)
    number = base.number + 1 if base is not None else 1
    written = _write(rows, path, number, layout.part_col, keys, grouped)
    if not set(written) <= set(parts):
        raise ValueError(f"{path}: rows of {sorted(set(written) - set(parts))} stand outside the parts to replace")
    rest = {p: n for p, n in base.parts.items() if p not in parts} if base is not None else {}
    _publish(spark, path, Version(number, _schema(rows, layout.part_col), layout.part_col, layout.buckets,
                                  rest | dict.fromkeys(written, number)))


def drop_parts(spark: SparkSession, path: str, keep) -> list[str]:
    """Publishes a version without the parts ``keep(part)`` is false for
    (SNK-10, SNK-11: their files go once no kept version names them)."""
    base = current(spark, path)
    gone = sorted(p for p in base.parts if not keep(p)) if base is not None else []
    if gone:
        _publish(spark, path, Version(base.number + 1, base.schema, base.part_col, base.buckets,
                                      {p: n for p, n in base.parts.items() if p not in gone}))
    return gone


def expire_parts(spark: SparkSession, path: str, days: int, today: dt.date | None = None) -> list[str]:
    """SNK-10: drops the dates older than ``days``."""
    cutoff = (today or dt.datetime.now(dt.timezone.utc).date()) - dt.timedelta(days=days)
    return drop_parts(spark, path, lambda p: dt.date.fromisoformat(p) >= cutoff)


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Deletes the folders that none of the newest ``keep`` versions names,
    and older pointers. What an unpublished write left goes with the next."""
    pointers = [n for n in names_in(spark, f"{path}/{POINTERS}") if n.endswith(".json")]
    live = [_version(spark, path, int(n[:-5])) for n in pointers[-keep:]]
    for name in pointers[:-keep]:
        delete_path(spark, f"{path}/{POINTERS}/{name}")
    used = {(n, p) for v in live for p, n in v.parts.items()}
    newest = live[-1].number
    for folder in names_in(spark, path):
        if not folder.startswith(FOLDER + "="):
            continue
        number = int(folder.split("=", 1)[1])
        held = _parts_in(spark, f"{path}/{folder}", live[-1].part_col)
        if number <= newest and not any((number, p) in used for p in held):
            delete_path(spark, f"{path}/{folder}")
            continue
        for p in held:
            if number <= newest and (number, p) not in used:
                delete_path(spark, f"{path}/{folder}/{live[-1].part_col}={p}")
