"""Operator 10: token counts by a Viterbi pass that keeps counts only.

The vocabulary's scores are read as a unigram model. An Aho-Corasick automaton finds every
piece that ends at a character; over the characters a dynamic programme carries the best
score and the number of pieces on the best path, no path itself. Ties follow the tokenizer:
of equal scores for one end, the piece that begins first (the longest) stands. A character
that is no piece scores 10 below the lowest piece, and counts as its UTF-8 bytes.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docflow.llm import words as w
from docflow.llm.frames import documents, widened
from docflow.llm.pieces import SIGN, units, vocabulary

UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer
MODEL = "piece_bpe_32k.model"


@cache
def _automaton(path: str):
    import ahocorasick

    found = ahocorasick.Automaton()
    for piece, (_, score) in vocabulary(path).pieces.items():
        found.add_word(piece, (len(piece), score))
    found.make_automaton()
    return found


def best(unit: str, path: str) -> tuple[int, float]:
    """(tokens, score) of the best segmentation of one unit, its spaces written as pieces do."""
    pieces, unknown = vocabulary(path).pieces, vocabulary(path).least - UNKNOWN_PENALTY
    n = len(unit)
    score, count = [0.0] * (n + 1), [0] * (n + 1)
    done = 0  # characters whose end is settled

    def unknown_until(end: int) -> None:
        nonlocal done
        while done < end:  # no piece ends here
            score[done + 1] = score[done] + unknown
            count[done + 1] = count[done] + len(unit[done].encode())
            done += 1

    for last, (size, own) in _automaton(path).iter(unit):
        end, start = last + 1, last + 1 - size
        if done < end:
            unknown_until(last)
            score[end], count[end], done = own + score[start], count[start] + 1, end
            if unit[last] not in pieces and size > 1:
                lone = score[last] + unknown
                if lone > score[end]:
                    score[end], count[end] = lone, count[last] + len(unit[last].encode())
        else:
            value = own + score[start]
            if value > score[end]:
                score[end], count[end] = value, count[start] + 1
    unknown_until(n)
    return count[n], score[n]


def token_counts(docs: DataFrame, path: str, text: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """docs with n_tokens and token_score of each text; null and empty texts have 0 and 0.0.

    Rows pass in place. Distinct units are solved once and kept for the worker's next
    rows, at most a bounded number; a text of one enormous unit takes time in proportion.
    """

    def make(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        pairs = [best(raw.decode("utf-8", "replace").replace(" ", SIGN), path) for raw in found]
        return np.array(pairs, np.float64).ravel(), np.full(len(found), 2, np.int64)

    memo: list[w.Memo] = []

    def rows(batch: pa.RecordBatch) -> list:
        if not memo:
            memo.append(w.Memo(make))
        counts, scores = [np.zeros(0)], [np.zeros(0)]
        for block in w.blocks(batch.column(text)):
            buf, found = units(block)
            values = memo[0](buf, found)[0].reshape(-1, 2)
            total = np.concatenate([np.zeros((1, 2)), np.cumsum(values, axis=0)])
            both = total[found.offs[1:]] - total[found.offs[:-1]]
            counts.append(both[:, 0])
            scores.append(both[:, 1])
        return [pa.array(np.concatenate(counts).astype(np.int64)), pa.array(np.concatenate(scores))]

    return widened(docs, [("n_tokens", "long"), ("token_score", "double")], rows, without)


def op10_count_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public vocabulary, and the best path's score."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path(MODEL), without=("text",))
