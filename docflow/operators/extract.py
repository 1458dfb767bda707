"""Size routing, feature extraction and the merge of per-chunk features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docflow.config import DIRECT_PDF_MAX_BYTES
from docflow.functions.errors import error_outcome
from docflow.functions.features import placeholder_features, standard_features
from docflow.functions.layout import chunk_key, mime_type
from docflow.operators.packing import chunk_texts, pack_pages
from docflow.operators.split import Split
from docflow.schemas import FEATURES

# Takes a batch of texts, gives their summary, key_entities and topics, row by row.
Extractor = Callable[[pd.Series], pd.DataFrame]

# Chunks merged at once inside one document before the final merge.
MERGE_FAN_IN = 1000


def route_by_size(
    docs: DataFrame, max_bytes: int = DIRECT_PDF_MAX_BYTES, size: str = "n_bytes"
) -> DataFrame:
    """``route``: ``chunk`` for a PDF above the limit, else ``direct``."""
    oversized = (mime_type() == "application/pdf") & (F.col(size) > max_bytes)
    return docs.withColumn(
        "route", F.when(F.coalesce(oversized, F.lit(False)), "chunk").otherwise("direct")
    )


def classify_errors(errors: DataFrame) -> DataFrame:
    """Add ``outcome`` to (message, mime_type, stage) rows."""
    return errors.withColumn("outcome", error_outcome("message"))


def extract_features(
    texts: DataFrame, extractor: Extractor | None = None, text: str = "text"
) -> DataFrame:
    """Add ``features`` to every row.

    The default is a column expression. A custom extractor is called once per Arrow
    batch, so it may send its texts in one request; a missing row or summary is an
    error and fails the job.
    """
    if extractor is None:
        return texts.withColumn("features", standard_features(text))
    schema = T.StructType(texts.schema.fields + [T.StructField("features", FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = extractor(batch.column(text).to_pandas())
            if found is None or len(found) != batch.num_rows or found["summary"].isna().any():
                raise ValueError("extractor returned an empty answer")
            lists = pa.list_(pa.string())
            features = pa.StructArray.from_arrays(
                [
                    pa.array(found["summary"].tolist(), pa.string()),
                    pa.array([list(x) for x in found["key_entities"]], lists),
                    pa.array([list(x) for x in found["topics"]], lists),
                ],
                names=FEATURES.names,
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, features], names=[*batch.schema.names, "features"]
            )

    return texts.mapInArrow(run, schema)


def apply_outcome(features: Column, outcome: Column) -> Column:
    """Placeholder features where the service called a document empty."""
    return F.when(outcome == "empty", placeholder_features()).otherwise(features)


def placeholder_for_errors(errors: DataFrame) -> DataFrame:
    """Features of errored calls: the placeholder for ``empty``, else null."""
    none = F.lit(None).cast(FEATURES)
    return classify_errors(errors).withColumn(
        "features", apply_outcome(none, F.col("outcome"))
    )


_FEATURES = ("summary", "key_entities", "topics")


def _merge(df: DataFrame, keys: list[str]) -> DataFrame:
    part = F.struct("chunk_no", *_FEATURES)
    merged = df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(part)).alias("_parts"), F.sum("n").alias("n")
    )

    def first_seen(name: str) -> Column:
        return F.array_distinct(F.flatten(F.transform("_parts", lambda p: p[name])))

    return merged.select(
        *keys,
        "n",
        F.get("_parts", F.lit(0))["chunk_no"].alias("chunk_no"),
        F.array_join(F.transform("_parts", lambda p: p["summary"]), " ").alias("summary"),
        first_seen("key_entities").alias("key_entities"),
        first_seen("topics").alias("topics"),
    )


def merge_chunk_features(chunks: DataFrame, doc: str = "document_id") -> DataFrame:
    """One (features, chunk_count) row per document from its chunks, in chunk order.

    Summaries are joined, entities and topics keep their first occurrence; a
    single chunk passes through. Merging is associative, so a document with
    very many chunks is merged in groups of bounded size first.
    """
    flat = chunks.select(
        doc,
        F.col("chunk_no").cast("long").alias("chunk_no"),
        F.floor(F.col("chunk_no") / MERGE_FAN_IN).alias("_group"),
        F.lit(1).cast("long").alias("n"),
        "features.*",
    )
    whole = _merge(_merge(flat, [doc, "_group"]), [doc])
    return whole.select(
        doc, F.struct(*_FEATURES).alias("features"), F.col("n").alias("chunk_count")
    )


def chunk_uris(
    chunk_root: str, doc: str = "document_id", count: str = "chunk_count"
) -> Column:
    """Ordered URIs of a document's chunks; they follow from their number."""
    return F.transform(
        F.sequence(F.lit(1).cast("long"), F.col(count)),
        lambda n: chunk_key(chunk_root, doc, n),
    )


def with_chunk_metadata(
    docs: DataFrame, chunk_root: str, doc: str = "document_id"
) -> DataFrame:
    return docs.withColumns(
        {
            "gemini_chunk_uris": chunk_uris(chunk_root, doc),
            "gemini_chunk_count": F.col("chunk_count"),
        }
    ).drop("chunk_count")


def chunk_metadata(
    chunks: DataFrame, chunk_root: str, doc: str = "document_id"
) -> DataFrame:
    """Ordered chunk URIs and their number, per document; only counts are shuffled."""
    counted = chunks.groupBy(doc).agg(F.count("*").alias("chunk_count"))
    return with_chunk_metadata(counted, chunk_root, doc)


def chunks_to_documents(
    chunks: DataFrame, docs: DataFrame, chunk_root: str, doc: str = "document_id"
) -> DataFrame:
    """Per-chunk features returned to their document with the chunk list."""
    merged = merge_chunk_features(chunks, doc)
    return with_chunk_metadata(docs.join(merged, doc), chunk_root, doc)


def chunk_parts(pages: DataFrame, target_bytes: int, doc: str = "document_id") -> Split:
    """(doc, chunk_no, chunk_text) of packed pages; ``rejected`` cannot be packed."""
    packed = pack_pages(pages.select(doc, "page_no", "n_bytes"), target_bytes, doc)
    return Split(chunk_texts(pages, packed.valid, doc), packed.rejected)


def extract_chunked(
    pages: DataFrame,
    target_bytes: int,
    extractor: Extractor | None = None,
    doc: str = "document_id",
) -> Split:
    """Oversized documents: pack pages, extract each chunk, merge per document.

    ``pages`` is (doc, page_no, page_text, n_bytes). ``valid`` is (doc, features,
    chunk_count); ``rejected`` lists the documents that cannot be packed.
    """
    parts, rejected = chunk_parts(pages, target_bytes, doc)
    features = extract_features(parts, extractor, "chunk_text")
    return Split(merge_chunk_features(features, doc), rejected)
