"""Small Spark helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from docflow.session import work_dir
from docflow.sinks.writers import delete_path

Batches = Iterator[pa.RecordBatch]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20  # of rows that go to a Python worker at once


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    It cuts the lineage: a lost executor costs only the tasks at hand, and several
    readers do not compute the rows again. The shuffles that led to the rows are let go
    when they are written. Rows go to Python workers in batches of at most BATCH_BYTES, so
    neither side of a task holds thousands of long texts.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    ours = {_CLEANUP: "true", _BATCH: str(BATCH_BYTES)}
    before = {key: spark.conf.get(key, None) for key in ours}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


FEW = 1 << 17  # rows of a narrow table that one partition holds: a few MB


def dealt(df: DataFrame) -> DataFrame:
    """df, on one partition if it has at most FEW rows: grouping, ranking and joining such tables
    needs no exchange then. For narrow tables that `saved` returned."""
    return df.coalesce(1) if df.count() <= FEW else df


def tidy(spark: SparkSession) -> None:
    """From now on the session lets go of an execution's shuffles when it ends."""
    spark.conf.set(_CLEANUP, "true")


def forget(*tables: DataFrame | None) -> None:
    """Delete the folders of tables that `saved` returned; what was written from them stays.

    For tables whose last reader has been written. Others, and None, are left alone.
    """
    for table in tables:
        path = _PATHS.pop(table, None) if table is not None else None
        if path is not None:
            delete_path(table.sparkSession, path)


def named(rows: DataFrame, names: DataFrame, keys: list[str], copies: str, share: int = 1_000) -> DataFrame:
    """rows left-joined with names, which has a row for each of the keys' values and, in
    `copies`, how many of the rows have them. Rows with a null key get nulls.

    Keys that hold more than 1/share of the rows are at most `share` values, so those go
    to the rows, and a hot key is not dealt to one task; all others are shuffled.
    """
    total = names.agg(F.sum(copies)).first()[0] or 0
    hot = F.col(copies) > total // share
    often = F.broadcast(names.filter(hot).drop(copies))
    rare = names.filter(~hot).drop(copies)
    return rows.join(often, keys).unionByName(rows.join(often.select(*keys), keys, "left_anti").join(rare, keys, "left"))


def widened(
    df: DataFrame,
    fields: list[tuple[str, str]],
    rows: Callable[[pa.RecordBatch], list],
    without: tuple[str, ...] = (),
) -> DataFrame:
    """df with further columns, which `rows` gives by batch as Arrow arrays.

    Columns named in `without` are read by `rows` and not returned; a column of df with
    the name of a new one gives way to it.
    """
    new = [name for name, _ in fields]
    kept = [f for f in df.schema.fields if f.name not in without and f.name not in new]
    extra = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields]
    names = [f.name for f in [*kept, *extra]]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            arrays = [batch.column(f.name) for f in kept] + rows(batch)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, T.StructType([*kept, *extra]))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with numbers for names, but for the column `text`, so that new columns of any name
    go beside them and each text passes once. `toDF(*docs.columns)` names them again."""
    text = "text" if "text" in docs.columns else next(c for c in docs.columns if c.lower() == "text")
    return docs.toDF(*["text" if c == text else f"__{i}" for i, c in enumerate(docs.columns)])


def ranked(df: DataFrame, group: list[str], order: list[str], spread: str, name: str, bits: int = 6) -> DataFrame:
    """A rank from 0, gapless within each group, in the order of (spread, order).

    `spread` is a 64-bit hash, ordered as unsigned. Rows are numbered by (group, first
    bits of the hash), so a group that holds a third of all rows is sorted by many tasks;
    the counts of these parts are then added up. The ranks do not depend on `bits`.
    Columns of `group` hold no nulls; no rows give no rows.
    """
    df = df.withColumn("__part", F.shiftrightunsigned(F.col(spread), 64 - bits))
    keys = ", ".join(f"`{c}`" for c in group)
    sort = ", ".join(f"`{c}`" for c in [spread, *order])
    own = df.withColumn("__own", F.expr(f"row_number() over (partition by {keys}, __part order by {sort})"))
    counts = df.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__count"))
    running = f"sum(__count) over (partition by {keys} order by __part rows between unbounded preceding and current row)"
    before = counts.withColumn("__before", F.expr(running) - F.col("__count")).drop("__count")
    out = own.join(before, [*group, "__part"])
    rank = (F.col("__before") + F.col("__own") - 1).cast("long")
    return out.withColumn(name, rank).drop("__part", "__own", "__before")


def doc_crc(column: str) -> Column:
    """crc32 of the id as text, an unsigned long."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
