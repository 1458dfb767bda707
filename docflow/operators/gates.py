"""The gates before the costly work: stored already, loaded already, asked twice.

The gate joins are kept as plain exchange-sort-join shapes on purpose: no
aggregate sits between the exchange and the join, so AQE can split a hot key on
the document side over many tasks. Semi and anti joins keep one match per key
of the other side, however often that key is repeated there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docflow.config import ARTICLES, FILINGS
from docflow.functions.identity import document_id, ingestion_key
from docflow.functions.items import hashed_filepath
from docflow.functions.layout import source_filename, source_prefix
from docflow.operators.split import Split

# A source prefix has four segments (source/family/ticker/period); a ticker with
# slashes makes it longer, never shorter.
MIN_PREFIX_DEPTH = 4


def object_names(objects: DataFrame, key: str = "key") -> DataFrame:
    """(prefix, filename) for every folder above each object.

    A listing under a prefix is recursive, so a nested object answers for each
    of its ancestor folders; the fan-out is the depth of the path.
    """
    parts = F.split(F.col(key), "/")
    depth = F.size(parts) - 1
    folders = F.when(
        depth >= MIN_PREFIX_DEPTH, F.sequence(F.lit(MIN_PREFIX_DEPTH), depth)
    )
    return (
        objects.where(F.col(key).startswith("source/"))
        .withColumn("_depth", F.explode(folders))
        .select(
            F.concat(
                F.array_join(F.slice(parts, F.lit(1), F.col("_depth")), "/"), F.lit("/")
            ).alias("prefix"),
            F.element_at(parts, -1).alias("filename"),
        )
    )


def with_source_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"prefix": source_prefix(), "filename": source_filename()})


def anti_join_stored(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Gate 1: documents whose file is not in the listing; repeats are kept.

    Documents are dealt and sorted by a hash of prefix and file name, eight bytes instead of both
    texts. Where hashes agree the texts are compared, as a range so that they are no join keys,
    so a hash that two names share changes nothing. Both texts, and a path that is a hash of the
    URL, are made anew of what is left.
    """
    stored = names.select(
        F.xxhash64("prefix", "filename").alias("_stored_key"),
        F.col("prefix").alias("_stored_prefix"), F.col("filename").alias("_stored_filename"),
    )
    keyed = docs.withColumns(
        {
            "_key": F.xxhash64(source_prefix(), source_filename()),
            "_hashed": F.col("filepath").eqNullSafe(hashed_filepath()),
        }
    ).withColumn("filepath", F.when(~F.col("_hashed"), F.col("filepath")))
    filepath = F.when(F.col("_hashed"), hashed_filepath()).otherwise(F.col("filepath"))
    prefix, filename = source_prefix(), source_filename(filepath)
    same = (
        (F.col("_key") == F.col("_stored_key"))
        & prefix.between(F.col("_stored_prefix"), F.col("_stored_prefix"))
        & filename.between(F.col("_stored_filename"), F.col("_stored_filename"))
    )
    fresh = keyed.join(stored, same, "left_anti").withColumn("filepath", filepath)
    return with_source_key(fresh.drop("_key", "_hashed"))


def stored_names_by_prefix(names: DataFrame) -> DataFrame:
    """The set of file names per prefix, as rows rather than one array a prefix."""
    return names.select("prefix", "filename").distinct()


def known_documents(documents: DataFrame, filings: DataFrame) -> DataFrame:
    """(source_kind, document_id) of both tables, key columns only."""
    return documents.select(F.lit(ARTICLES).alias("source_kind"), "document_id").unionAll(
        filings.select(F.lit(FILINGS).alias("source_kind"), "document_id")
    )


def _own_table_key(docs: DataFrame) -> DataFrame:
    """Filings are looked up in their own table, everything else among articles."""
    family = F.when(F.col("source_kind") == FILINGS, FILINGS).otherwise(ARTICLES)
    if "document_id" not in docs.columns:
        docs = docs.withColumn("document_id", document_id())
    return docs.withColumn("_family", family)


def split_known(docs: DataFrame, known: DataFrame) -> Split:
    """Gate 2: ``valid`` are new, ``rejected`` are in their family's table already."""
    keyed = _own_table_key(docs)
    known = known.select(F.col("source_kind").alias("_family"), "document_id")
    on = ["_family", "document_id"]
    return Split(
        keyed.join(known, on, "left_anti").drop("_family"),
        keyed.join(known, on, "left_semi").drop("_family"),
    )


def mark_known(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Gate 2 as a flag: one join that asks for existence, so documents are made once and a
    repeated id of the other side does not repeat them."""
    keyed = _own_table_key(docs).withColumn("_own_id", F.col("document_id"))
    theirs = known.select(
        F.col("source_kind").alias("_known_family"), F.col("document_id").alias("_known_id")
    )
    # Outer names must not be among those of the other side, or they would mean its columns.
    same = (F.col("_known_family") == F.col("_family").outer()) & (
        F.col("_known_id") == F.col("_own_id").outer()
    )
    return keyed.withColumn("skipped", theirs.where(same).exists()).drop("_family", "_own_id")


def exists_probe(table: DataFrame, doc_id: str) -> bool:
    """Whether one id is in the table; stops at the first match."""
    return not table.where(F.col("document_id") == doc_id).limit(1).isEmpty()


def one_per_ingestion_key(docs: DataFrame, pos: str = "pos") -> DataFrame:
    """The first document of each ingestion key and ``n_same_key``, how many had it.

    One aggregate gives both. It keeps the least row and the count of a key in every input
    partition before the exchange, so documents are made once and a hot key sends one row
    per partition.
    """
    rest = [c for c in docs.columns if c not in (pos, "url")]
    row = F.struct(pos, "url", *rest)
    found = docs.groupBy(ingestion_key().alias("ingestion_key")).agg(
        F.min_by(row, F.struct(pos, "url")).alias("_first"), F.count("*").alias("n_same_key")
    )
    columns = [c for c in docs.columns if c != pos]
    return found.select("ingestion_key", "n_same_key", f"_first.{pos}", *[f"_first.{c}" for c in columns])


def mark_duplicates(docs: DataFrame, pos: str = "pos") -> DataFrame:
    """All documents with ``duplicate``: true for all but the first of each key.

    A position counts within its family only, so winners, a combined ``min`` per key,
    are matched back by key and position; null-free keys keep the join even.
    """
    keyed = docs.withColumn("ingestion_key", ingestion_key())
    on = ["ingestion_key", pos]
    winners = keyed.groupBy("ingestion_key").agg(F.min(pos).alias(pos))
    first = keyed.join(winners, on, "left_semi").withColumn("duplicate", F.lit(False))
    later = keyed.join(winners, on, "left_anti").withColumn("duplicate", F.lit(True))
    return first.unionByName(later)


def discovery_counts(discovered: DataFrame, survivors: DataFrame) -> DataFrame:
    """Documents found and left after gate 1, per source family."""
    found = discovered.groupBy("source_kind").agg(F.count("*").alias("discovered"))
    left = survivors.groupBy("source_kind").agg(F.count("*").alias("new_documents"))
    return found.join(left, "source_kind", "left").fillna(0, ["new_documents"])
