"""Writers: stage, load, promote, load log, tables and chunk parts.

Keys are columns, not file names: one file per document would give billions of
tiny objects. Stage, prod and the tables are versioned (:mod:`docflow.sinks.versions`):
every write is one commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from docflow.config import (
    ARTICLES,
    DOCUMENTS_TABLE,
    FILINGS,
    FILINGS_TABLE,
    METADATA,
    METADATA_TABLE,
)
from docflow.functions.layout import (
    PROD_ARTICLES,
    PROD_FILINGS,
    STAGE_ARTICLES,
    STAGE_FILINGS,
    STAGE_METADATA,
    chunk_key,
    metadata_stage_key,
)
from docflow.operators.records import (
    add_filing_columns,
    cast_stage_types,
    family_records,
)
from docflow.schemas import ARTICLE_RECORD, FILING_RECORD, INDEX_COLUMN, METADATA_ROW
from docflow.sinks import versions
from docflow.sources.readers import path_exists

CLUSTERING = ("company_ticker", "document_type")  # fixed value
# Files are cut by bytes; their rows are in this order, so a date or ticker prunes files.
SORTED = ("date", *CLUSTERING)
STAGE_FOLDERS = {ARTICLES: STAGE_ARTICLES + "documents", FILINGS: STAGE_FILINGS.rstrip("/")}
PROD_FOLDERS = {ARTICLES: PROD_ARTICLES + "documents", FILINGS: PROD_FILINGS.rstrip("/")}


RECORDS = {ARTICLES: ARTICLE_RECORD, FILINGS: FILING_RECORD}
TABLES = {ARTICLES: DOCUMENTS_TABLE, FILINGS: FILINGS_TABLE, METADATA: METADATA_TABLE}


def _join(root: str, key: str) -> str:
    return f"{root.rstrip('/')}/{key}"


def prod_path(root: str, family: str) -> str:
    return _join(root, PROD_FOLDERS[family])


def table_path(root: str, family: str) -> str:
    """Folder of a family's warehouse table; the three families never share one."""
    return _join(root, f"tables/{TABLES[family]}")


def latest_per_key(
    rows: DataFrame, keys: tuple[str, ...], order: str = "ingestion_timestamp"
) -> DataFrame:
    """The latest row per key; cut to one row per key before the shuffle.

    Rows of one run share their time, so the source, then the date decides.
    """
    by = [c for c in (order, "source_url", "source_gcs_uri", "date") if c in rows.columns]
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in by])
    return (
        rows.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert(spark: SparkSession, new: DataFrame, path: str, key: str) -> None:
    """Commit rows so that a key has one row, the new one, whatever its date."""
    versions.upsert(spark, latest_per_key(new, (key,)), path, key, SORTED)


def stage_documents(spark: SparkSession, records: DataFrame, root: str) -> dict[str, str]:
    """Write both families of records below the stage prefixes; returns the paths."""
    paths = {}
    for family, folder in STAGE_FOLDERS.items():
        paths[family] = _join(root, folder)
        upsert(spark, family_records(records, family), paths[family], "document_id")
    return paths


def _metadata_types(rows: DataFrame) -> DataFrame:
    declared = {f.name: f.dataType for f in METADATA_ROW}
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in declared.items()])


def stage_company_metadata(spark: SparkSession, rows: DataFrame, root: str) -> str:
    """Commit metadata rows to stage; same id replaces."""
    path = _join(root, STAGE_METADATA.rstrip("/"))
    upsert(spark, _metadata_types(rows), path, "metadata_id")
    return path


def read_company_metadata_rows(spark: SparkSession, path: str) -> DataFrame:
    """Stored metadata rows, every column in its declared type."""
    return versions.read(spark, path, METADATA_ROW)


def append_load(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Append to a table; new columns are allowed, rows before them have nulls."""
    versions.append(spark, df, path, SORTED)


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path)


def bulk_load(spark: SparkSession, paths: list[str], table: str, among: DataFrame | None = None) -> bool:
    """Load the rows of many staged paths that the table lacks, at once; an empty list does nothing.

    The files of all paths, tables or folders of Parquet files, are one scan under the columns
    of all; a column that a path lacks is null there. Two types of one column are an error.
    ``among``: only rows with one of these document ids.
    """
    files: list[str] = []
    schema = T.StructType([])
    for path in paths:
        version = versions.current(spark, path)
        if version is not None:
            files += [f"{path.rstrip('/')}/{f}" for f in version.files]
            schema = versions.merged_schema(schema, version.schema)
    plain = [p for p in paths if versions.current(spark, p) is None and path_exists(spark, p)]
    if plain:  # one distributed pass over the footers of all
        files += plain
        schema = versions.merged_schema(schema, spark.read.option("mergeSchema", True).parquet(*plain).schema)
    if not files:
        return False
    rows = spark.read.schema(schema).parquet(*files)
    if among is not None:
        rows = rows.join(among.select("document_id"), "document_id", "left_semi")
    if "document_id" in schema.names and versions.current(spark, table) is not None:
        stored = versions.read(spark, table, T.StructType([T.StructField("document_id", T.StringType())]))
        rows = rows.join(stored, "document_id", "left_anti")
    append_load(spark, rows.select(*schema.names), table)
    return True


def create_filings_table(spark: SparkSession, source: DataFrame, table: str) -> None:
    """Create the filings table if absent; an existing one is left as it is.

    Columns are the source's without the index column, plus the filing columns it lacks, each
    in its declared type; rows will be sorted by date and the clustering columns in each file.
    """
    shape = cast_stage_types(add_filing_columns(source.drop(INDEX_COLUMN)), FILING_RECORD).schema
    versions.create(spark, table, shape)


def rewrite_prod(spark: SparkSession, rows: DataFrame, root: str) -> str:
    """Migrated rows with forced types below ``prod/edgar/v1/date=``.

    A migrated document replaces its own older row; all other rows stay.
    """
    path = _join(root, PROD_FOLDERS[FILINGS])
    typed = cast_stage_types(add_filing_columns(rows), FILING_RECORD)
    upsert(spark, typed, path, "document_id")
    return path


def write_chunks(chunks: DataFrame, root: str, prefix: str, doc: str = "document_id") -> str:
    """Chunk parts keyed by their object key; what was there before is replaced."""
    path = _join(root, prefix.strip("/"))
    _keyed_chunks(chunks, prefix, doc).hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def _keyed_chunks(chunks: DataFrame, prefix: str, doc: str) -> DataFrame:
    return chunks.select(
        doc, "chunk_no", chunk_key(prefix, doc).alias("key"),
        F.col("chunk_text").alias("content"),
    )


def append_chunks(
    spark: SparkSession, chunks: DataFrame, root: str, prefix: str, work: str
) -> DataFrame:
    """Add a run's chunk parts to those of earlier runs; returns them as written.

    Parts are computed once, into the work folder. A part that is there already (a run
    that is done again) is not added twice.
    """
    path = _join(root, prefix.strip("/"))
    keyed = _keyed_chunks(chunks, prefix, "document_id")
    keyed.write.parquet(work)
    new = spark.read.schema(keyed.schema).parquet(work)
    stored = versions.read(spark, path, T.StructType([T.StructField("key", T.StringType())]))
    fresh = new.join(stored, "key", "left_anti").select(*new.columns)
    versions.append(spark, fresh, path, ("key",))
    return new.select("document_id", "chunk_no", F.col("content").alias("chunk_text"))


def read_chunks(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Chunk parts of all runs: document_id, chunk_no, key, content."""
    return versions.read(spark, _join(root, prefix.strip("/")))


def _log_value(field: T.StructField) -> Column:
    """Dates and times as ISO texts with milliseconds."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        c = F.date_format(c, "yyyy-MM-dd'T'00:00:00.000")
    elif isinstance(field.dataType, T.TimestampType):
        c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    return c.alias(field.name)


def read_staged(spark: SparkSession, path: str, family: str) -> DataFrame:
    """Staged records of a family; no rows where nothing is staged."""
    return versions.read(spark, path, RECORDS[family])


def loaded_ids(spark: SparkSession, root: str, family: str) -> DataFrame:
    """Document ids of a family's table; empty where the table does not exist yet."""
    only = T.StructType([T.StructField("document_id", T.StringType())])
    return versions.read(spark, table_path(root, family), only)


def read_prod(spark: SparkSession, root: str, family: str) -> DataFrame:
    """A family's prod records with every stored column; no rows where there are none."""
    path = _join(root, PROD_FOLDERS[family])
    version = versions.current(spark, path)
    return versions.read(spark, path, RECORDS[family] if version is None else version.schema)


def _stage_object(family: str) -> Column:
    """Key of the stage object that a stored row stands for."""
    if family == METADATA:
        return metadata_stage_key()
    file = F.concat(F.col("document_id"), F.lit(".parquet"))
    if family == FILINGS:
        return F.concat(F.lit(STAGE_FILINGS + "date="), F.col("date").cast("string"), F.lit("/"), file)
    return F.concat(F.lit(STAGE_ARTICLES), file)


def load_log_lines(rows: DataFrame, family: str, bucket: str = "b") -> DataFrame:
    """JSON log lines, one a load: table, staged object, row count and the rows.

    A load is one staged object, and an object one document or metadata row, so lines need no
    grouping and no line grows with the run.
    """
    values = [_log_value(f) for f in sorted(rows.schema.fields, key=lambda f: f.name)]
    return rows.select(
        F.to_json(
            F.struct(
                F.lit(1).cast("long").alias("row_count"),
                F.array(F.struct(*values)).alias("rows"),
                F.concat(F.lit(f"gs://{bucket}/"), _stage_object(family)).alias("source_uri"),
                F.lit(TABLES[family]).alias("table_id"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )


def append_load_log(rows: DataFrame, family: str, log_path: str, bucket: str = "b") -> None:
    load_log_lines(rows, family, bucket).write.mode("append").text(log_path)


def promote(spark: SparkSession, root: str, family: str) -> str:
    """Commit a family's staged records to prod, then clear stage.

    Stage is cleared only after prod has committed; a failure in between leaves both, and
    promoting again gives the same prod rows.
    """
    if family not in STAGE_FOLDERS:
        raise ValueError(f"unsupported stage family: {family!r}")
    stage, prod = _join(root, STAGE_FOLDERS[family]), _join(root, PROD_FOLDERS[family])
    if versions.current(spark, stage) is not None:
        upsert(spark, read_staged(spark, stage, family), prod, "document_id")
        versions.clear(spark, stage)
    return prod


def promote_metadata(spark: SparkSession, root: str) -> str:
    """Metadata objects follow the general stage rule to the prod prefix."""
    stage = _join(root, STAGE_METADATA.rstrip("/"))
    prod = stage.replace(_join(root, STAGE_ARTICLES), _join(root, PROD_ARTICLES), 1)
    if versions.current(spark, stage) is not None:
        upsert(spark, read_company_metadata_rows(spark, stage), prod, "metadata_id")
        versions.clear(spark, stage)
    return prod


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
