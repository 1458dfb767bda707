"""Default feature extraction as column expressions over a whole text.

* topics: the most frequent lower-case words of five or more letters, ties by word
  (``topic_count`` of them, five unless said otherwise);
* key_entities: distinct capitalised words, sorted;
* summary: the paragraphs that mention the most topics, in text order
  (``paragraphs`` of them, two unless said otherwise; earlier ones win ties).

Everything stays inside one row: no shuffle, no Python worker. Word counts come
from run lengths in the sorted word array, so a text costs n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docflow.functions.text import ColumnOrName, bind, col, strip

TOPIC_WORD = "([a-z]{5,})"
ENTITY_WORD = "([A-Z][a-z]{3,})"
TOPIC_COUNT = 5
SUMMARY_PARAGRAPHS = 2
PLACEHOLDER_SUMMARY = "Document parsing failed or document is empty."  # fixed value


def _words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _most_frequent(sorted_words: Column, count: int) -> Column:
    def from_starts(starts: Column) -> Column:
        def run(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(sorted_words))
            return F.struct((start - end).alias("n"), F.get(sorted_words, start).alias("w"))

        ranked = F.slice(F.sort_array(F.transform(starts, run)), 1, count)
        return F.transform(ranked, lambda r: r["w"])

    positions = F.when(
        F.size(sorted_words) > 0, F.sequence(F.lit(0), F.size(sorted_words) - 1)
    ).otherwise(F.array().cast("array<int>"))
    first_of_run = F.filter(
        positions,
        lambda i: (i == 0) | (F.get(sorted_words, i) != F.get(sorted_words, i - 1)),
    )
    return bind(first_of_run, from_starts)


def topics(text: ColumnOrName, count: int = TOPIC_COUNT) -> Column:
    words = F.sort_array(_words(F.lower(col(text)), TOPIC_WORD))
    return bind(words, lambda found: _most_frequent(found, count))


def key_entities(text: ColumnOrName) -> Column:
    return F.sort_array(F.array_distinct(_words(col(text), ENTITY_WORD)))


def summary(
    text: ColumnOrName, topic_words: Column, count: int = SUMMARY_PARAGRAPHS
) -> Column:
    def pick(lines: Column) -> Column:
        def rank(line: Column, i: Column) -> Column:
            mentioned = bind(
                F.lower(line),
                lambda low: F.size(F.filter(topic_words, lambda t: low.contains(t))),
            )
            return F.when(line != "", F.struct((-mentioned).alias("s"), i.alias("i")))

        ranked = F.filter(F.transform(lines, rank), lambda r: r.isNotNull())
        best = F.slice(F.sort_array(ranked), 1, count)
        in_order = F.sort_array(F.transform(best, lambda r: r["i"]))
        return F.array_join(F.transform(in_order, lambda i: F.get(lines, i)), " ")

    paragraphs = F.transform(F.split(col(text), "\n"), lambda line: strip(line))
    return bind(paragraphs, pick)


def standard_features(
    text: ColumnOrName,
    topic_count: int = TOPIC_COUNT,
    paragraphs: int = SUMMARY_PARAGRAPHS,
) -> Column:
    """STRUCT(summary, key_entities, topics) of a text; null for a null text."""
    text = col(text)
    made = bind(
        topics(text, topic_count),
        lambda found: F.struct(
            summary(text, found, paragraphs).alias("summary"),
            key_entities(text).alias("key_entities"),
            found.alias("topics"),
        ),
    )
    return F.when(text.isNotNull(), made)


def placeholder_features() -> Column:
    empty = F.array().cast("array<string>")
    return F.struct(
        F.lit(PLACEHOLDER_SUMMARY).alias("summary"),
        empty.alias("key_entities"),
        empty.alias("topics"),
    )


def features_json(features: ColumnOrName) -> Column:
    """Compact JSON of the features, fields in order."""
    return F.to_json(col(features))
