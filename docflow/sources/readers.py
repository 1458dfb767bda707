"""Readers of landed files, listings, staged Parquet and tables."""

from __future__ import annotations

import re
from urllib.parse import unquote, urlsplit

from pyarrow.fs import LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.functions.items import item_fields
from docflow.schemas import ITEM
from docflow.sinks import versions
from docflow.sources import json_values, listing

# Company context comes from the landing folders:
# .../company_ticker=<T>/year=<Y>/<response files>
CONTEXT = "company_ticker string, year int"


def landed_text(
    spark: SparkSession, path: str | list[str], context: str = CONTEXT, whole_file: bool = False
) -> DataFrame:
    """Raw texts with their folder context and exact position.

    Line mode is splittable, so a landing file of any size is read in parallel.
    ``whole_file`` is for responses that span several lines; each is one row.
    The position (file, split, line) orders rows the way the files do, however
    splits are packed into tasks.
    """
    return with_positions(text_lines(spark, path, context, whole_file))


def text_lines(
    spark: SparkSession, path: str | list[str], context: str = CONTEXT, whole_file: bool = False
) -> DataFrame:
    schema = "value string" + (f", {context}" if context else "")
    reader = spark.read.schema(schema).option("wholetext", whole_file)
    # A folder nobody has landed in yet (no response) is an empty input.
    found = [p for p in ([path] if isinstance(path, str) else path) if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], schema + ", file string, split_start long")
    return with_file(reader.format("text").load(found))


def with_file(lines: DataFrame) -> DataFrame:
    """Keep the file and split of each line; must stay next to the scan."""
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )


def with_positions(lines: DataFrame) -> DataFrame:
    line = F.monotonically_increasing_id()
    return lines.withColumn(
        "line_pos", F.struct("file", "split_start", line.alias("line"))
    ).drop("file", "split_start")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has anything behind it, on any Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm_path)
    return found is not None and len(found) > 0


def whole_value(text: Column) -> Column:
    """A text that is one JSON value, as VARIANT; null if it is none or if more follows."""
    return _only(_wrapped(text))


def _wrapped(text: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<variant>")


def _only(values: Column) -> Column:
    return F.when(F.array_size(values) == 1, values[0])


def _qualified(spark: SparkSession, path: str) -> str:
    """The whole, encoded address of a path, as files below it are named."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(jvm_path).toUri().toString()


def explode_items(lines: DataFrame) -> DataFrame:
    """One row per discovery item: its read fields ``item`` and its number.

    A text is a JSON array of items or one item. Any other text, also one with several
    values in a row, becomes one null item, which validation rejects, so nothing disappears
    silently. The fields are taken inside the explode: later filters work on the result and
    never parse again. A text is parsed in a step of its own, since the explode would parse
    again at each mention of the value. A blank text is no filter, which would make texts that
    are built of columns twice, but an explode of nothing.
    """
    rest = [c for c in lines.columns if c != "value"]
    text = F.col("value")
    wrapped = lines.select(*rest, text.rlike(r"\S").alias("_filled"), _wrapped(text).alias("_values"))
    single = wrapped.select(*rest, "_filled", _only(F.col("_values")).alias("_value"))
    parsed = F.coalesce(F.try_variant_get("_value", "$", "array<variant>"), F.array("_value"))
    items = F.when(F.col("_filled"), F.transform(parsed, item_fields))
    return single.select(*rest, F.posexplode(items).alias("item_no", "item"))


def cut_items(cut: DataFrame) -> DataFrame:
    """Items of values that were cut out of landed texts, with their exact position ``pos``.

    Text that is no object gives a null item for each of its values, or one if it cannot be
    read; separators alone give none.
    """
    text = F.col("text").cast("string")
    other = F.btrim(text, F.lit(" \t\r\n,[]\ufeff"))
    values = F.array_size(F.from_json(F.concat(F.lit("["), other, F.lit("]")), "array<variant>"))
    count = F.when(other == "", F.lit(0)).otherwise(F.coalesce(values, F.lit(1)))
    none = F.lit(None).cast(f"struct<{ITEM}>")
    items = F.when(
        F.col("kind") == json_values.ITEM, F.array(item_fields(F.try_parse_json(text)))
    ).otherwise(F.array_repeat(none, count))
    place = [c for c in ("file", "split_start", "line") if c in cut.columns]
    rest = [c for c in cut.columns if c not in (*place, "kind", "text", "at")]
    return cut.select(*rest, F.struct(*place, "at").alias("pos"), F.explode(items).alias("item"))


def read_items(spark: SparkSession, path: str, context: str = CONTEXT, whole_file: bool = True) -> DataFrame:
    """Items of landed files: objects, arrays of them, several in a row, or a line each.

    Files of any size are cut in parallel. With ``whole_file`` off a value may not span
    lines, and what cannot be read in a line does not touch the next.
    """
    if whole_file:
        if not path_exists(spark, path):
            return cut_items(_nothing_cut(spark, context))
        return cut_items(json_values.cut_files(spark, [path], context))
    lines = text_lines(spark, path, context).withColumn("line", F.monotonically_increasing_id())
    return cut_items(json_values.cut_texts(lines))


def _nothing_cut(spark: SparkSession, context: str) -> DataFrame:
    columns = "file string, split_start long, kind int, at long, text binary"
    return spark.createDataFrame([], f"{context}, {columns}" if context else columns)


def read_articles(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Landed article discovery responses as items with company context."""
    return read_items(spark, path, whole_file=whole_file)


def read_filings(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Landed filing discovery responses; the same reader takes the wider item."""
    return read_items(spark, path, whole_file=whole_file)


def read_company_metadata(
    spark: SparkSession, path: str, whole_file: bool = True
) -> DataFrame:
    """One JSON response per company: its text ``body`` and VARIANT ``response``.

    The text is kept because the free-form parts are stored as they came; VARIANT
    would turn ``1.0`` into ``1``.
    """
    lines = text_lines(spark, path, "company_ticker string, year int, provider string", whole_file)
    return lines.where(F.col("value").rlike(r"\S")).select(
        "company_ticker", "year", "provider", F.col("value").alias("body"),
        whole_value(F.col("value")).alias("response"),
    )


def read_holdings(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Holdings lines (file_no, line_no, ticker, name) of an ordered list of files.

    All files are one read. A file's number is the place of its path, or of the folder it
    lies in, in the list: the whole path counts, not a part of it.
    """
    lines = landed_text(spark, paths, context="")
    record = F.from_json("value", "ticker string, name string")
    scheme = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"
    numbers: dict[str, int] = {}
    for number, path in enumerate(paths):
        numbers.setdefault(re.sub(scheme, r"\1:/", _qualified(spark, path)), number)
    known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    file = F.regexp_replace("line_pos.file", scheme, "$1:/")
    place = F.coalesce(
        F.try_element_at(known, file), F.try_element_at(known, F.regexp_replace(file, "/[^/]*$", ""))
    )
    return lines.where(F.col("value").rlike(r"\S")).select(
        place.cast("int").alias("file_no"),
        F.col("line_pos").alias("line_no"),
        record["ticker"].alias("ticker"),
        record["name"].alias("name"),
    )


def list_objects(
    spark: SparkSession, root: str, pattern: str | None = None, prefix: str = "",
    filesystem: listing.FileSystem | None = None,
) -> DataFrame:
    """(key, size) of every file below ``root``; contents are never read.

    Folders are opened in tasks, and the driver holds no listing, where tasks can open the
    store: for local and shared folders, and wherever ``filesystem`` says how (a function
    that gives a ``pyarrow.fs.FileSystem``; ``root`` without its scheme is the path in it).
    Any other store is listed by Spark's file index, which the driver holds and which passes
    over empty files.
    """
    address = urlsplit(_qualified(spark, root))
    if filesystem is None and address.scheme == "file":
        filesystem = LocalFileSystem
    if filesystem is not None:
        path = unquote(address.path) if address.scheme == "file" else f"{address.netloc}{unquote(address.path)}"
        return listing.list_in_tasks(spark, filesystem, path, pattern, prefix)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root).select("path", F.col("length").alias("size"))
    return files.select(_below(root).alias("key"), "size").where(F.startswith("key", F.lit(prefix)))


def _below(root: str) -> Column:
    """Key of a listed path: what follows the root, whatever scheme it carries."""
    folder = "/" + root.split("://", 1)[-1].strip("/") + "/"
    return F.substr("path", F.locate(folder, "path") + len(folder))


def latest_snapshot(
    spark: SparkSession, root: str, name: str = "companies.json", multi_line: bool = True,
    filesystem: listing.FileSystem | None = None,
) -> DataFrame:
    """Rows of the newest ``date=.../companies.json`` below ``root``.

    The snapshot may be one JSON array file or a folder of JSON lines files
    (``multi_line=False``). Each task gives the greatest key it lists, and one, a short text,
    reaches the driver.
    """
    newest = None
    if path_exists(spark, root):
        snapshot = f"(?s)^(.*{re.escape(name)})(?:/[^/]+)?$"
        keys = list_objects(spark, root, filesystem=filesystem).select(
            F.nullif(F.regexp_extract("key", snapshot, 1), F.lit("")).alias("key")
        )
        newest = keys.agg(F.max("key").alias("key")).head()["key"]
    if newest is None:
        raise FileNotFoundError(f"no {name} under {root}")
    return spark.read.option("multiLine", multi_line).json(f"{root.rstrip('/')}/{newest}")


def read_raw_documents(
    spark: SparkSession, path: str, pattern: str | None = None, filesystem: listing.FileSystem | None = None
) -> DataFrame:
    """(path, n_bytes, content) of raw files; ``content`` is pruned if unused.

    Where tasks can open the store (as for :func:`list_objects`) they open folders and files, so
    the driver holds no listing and a task reads many files; a file is in memory with its batch
    only. Any other store, a path that is no folder and a pattern beyond ``*`` and ``?`` are
    read by Spark's reader. Empty files are passed over by both.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = fs.makeQualified(jvm_path)
    address = urlsplit(whole.toUri().toString())
    if filesystem is None and address.scheme == "file":
        filesystem = LocalFileSystem
    plain = not re.search(r"[\[\]{}\\]", pattern or "") and not re.search(r"[*?\[\]{}\\]", path)
    if filesystem is not None and plain and fs.exists(whole) and fs.getFileStatus(whole).isDirectory():
        root = unquote(address.path) if address.scheme == "file" else f"{address.netloc}{unquote(address.path)}"
        files = listing.list_in_tasks(spark, filesystem, root, pattern).where("size > 0")
        content = listing.contents(filesystem, root)
        above = whole.toString().rstrip("/") + "/"
        return files.select(F.concat(F.lit(above), "key").alias("path"), F.col("size").alias("n_bytes"), content("key").alias("content"))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.col("length").alias("n_bytes"), "content"
    )


def raw_texts(raw: DataFrame) -> DataFrame:
    """Raw files with their text decoded as UTF-8."""
    return raw.select("path", "n_bytes", F.decode("content", "UTF-8").alias("text"))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a staged or promoted table, of its newest version."""
    return versions.read(spark, path)


def read_table(spark: SparkSession, name: str, where: str = "true", **args) -> DataFrame:
    """Table scan with a condition whose values are bound as parameters.

    >>> read_table(spark, "edgar", "company_ticker = :t", t="AA")
    """
    return spark.sql(f"SELECT * FROM {name} WHERE {where}", args=args)
