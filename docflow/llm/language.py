"""Operator 4: the languages of a text, span by span.

Training counts, over all labelled texts, the byte n-grams of words by language (hashed to
SLOTS slots) and the scripts its words are written in. To label a text, each word's script
narrows the candidates to the languages written in it, each candidate gets the word's log
likelihood, and a Viterbi pass over the words finds the best sequence of languages, where
every change costs SWITCH. Runs of one language are the spans; a text's language is that
of most of its words.

The model has a fixed size for each language (SLOTS numbers), whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from docflow.llm import words as w
from docflow.llm.frames import Batches, doc_crc, documents, numbered, widened

SLOTS = 1 << 15
ORDERS = (2, 3, 4)
SWITCH = 12.0
RARE_SCRIPT = 0.005
UNKNOWN = "und"
BLOCK = 2 << 20  # of texts that go through the Viterbi pass together; its arrays take some 60 times as much

# First code point of each script's main ranges; a range ends where the next begins.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1780, "Khmer"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Other"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0x20000, "Han"), (0x2FA20, "Other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([at for at, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True


def _slots(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams that end at each byte of the words: (orders, bytes), and word lengths.

    A word is lower-cased (A-Z) and has a space before it; an n-gram may begin there.
    """
    lens = ends - starts
    at = w.ragged(starts, lens)
    place = at - np.repeat(starts, lens)
    text = w.LOWER[buf]
    code = text[at].astype(np.uint32) + np.uint32(1)
    found, back = [], code
    for n in range(1, max(ORDERS)):
        near = text[np.maximum(at - n, 0)].astype(np.uint32) + np.uint32(1)
        near = np.where(place >= n, near, np.where(place == n - 1, np.uint32(33), np.uint32(0)))
        back = back * np.uint32(0x01000193) + near
        if n + 1 in ORDERS:
            h = back * np.uint32(0x9E3779B1)
            found.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(17))
    return np.stack(found).astype(np.int32), lens


def _scripts(words: list[bytes]) -> np.ndarray:
    """Script of each word's first letter; -1 for a word without letters."""
    out = np.empty(len(words), np.int64)
    latin = SCRIPT_NAMES.index("Latin")
    for i, raw in enumerate(words):
        if raw.isalpha():
            out[i] = latin
            continue
        text = raw.decode("utf-8", "replace")
        first = next((c for c in text if c.isalpha()), None)
        out[i] = -1 if first is None else latin if first < "ɐ" else _SCRIPT[np.searchsorted(_FIRST, ord(first), side="right") - 1]
    return out


@dataclass
class Model:
    """names of the languages; log likelihood by (slot, language); candidates by (script, language)."""

    names: list[str]
    loglik: np.ndarray
    written: np.ndarray


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows that have a language; null texts teach nothing.

    Counts are summed within each task, then by slot, so a language with a third of all
    rows sends no more than any other.
    """

    def run(batches: Batches) -> Batches:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        script_of = w.Memo(lambda ws: (_scripts(ws), np.ones(len(ws), np.int64)), 300_000)
        for batch in batches:
            names = batch.column(lang).to_pylist()
            for block in w.blocks(batch.column(text)):
                words = w.split_words(block)
                script, _ = script_of(block.buf, words)
                mine = np.array(names[block.first : block.last], dtype=object)
                for name in set(mine.tolist()):
                    pick = np.repeat(mine == name, words.counts) & (script >= 0)
                    slots, _ = _slots(block.buf, words.starts[pick], words.ends[pick])
                    grams[name] = grams.get(name, 0) + np.bincount(slots.ravel(), minlength=SLOTS)
                    scripts[name] = scripts.get(name, 0) + np.bincount(script[pick], minlength=len(SCRIPT_NAMES))
        for name, counts in grams.items():
            both = np.concatenate([counts, scripts[name]])
            some = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(both[some], pa.int64())],
                names=["lang", "slot", "n"],
            )

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    counts = rows.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    table = np.zeros((SLOTS + len(SCRIPT_NAMES), len(names)))
    which = np.searchsorted(np.array(names, dtype=object), np.array(found.column("lang").to_pylist(), dtype=object))
    table[np.array(found.column("slot")), which.astype(int)] = np.array(found.column("n"))
    grams, scripts = table[:SLOTS], table[SLOTS:]
    loglik = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * SLOTS)) / len(ORDERS)
    written = scripts > RARE_SCRIPT * np.maximum(scripts.sum(axis=0), 1)
    return Model(names, loglik.astype(np.float32), written)


def word_scores(model: Model, words: list[bytes]) -> np.ndarray:
    """Log likelihood of each word by language; all zero for a word without letters.

    Languages not written in the word's script get a score no candidate can fall below.
    """
    lens = np.array([len(x) for x in words], np.int64)
    ends = np.cumsum(lens)
    slots, _ = _slots(np.frombuffer(b"".join(words), np.uint8), ends - lens, ends)
    each = model.loglik[slots].sum(axis=0)
    out = np.add.reduceat(each, ends - lens, axis=0) if len(words) else each
    out = out - out.max(axis=1, keepdims=True)
    script = _scripts(words)
    allowed = model.written[np.maximum(script, 0)]
    allowed[~allowed.any(axis=1)] = True
    best = np.where(allowed, out, -np.inf).max(axis=1, keepdims=True)
    out = np.where(allowed, out - best, np.minimum(out - best, 0) - 50)
    out[script < 0] = 0
    return out.astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, for texts of `counts` words one after another.

    Texts advance together, word by word, the longest first. A tie keeps the language;
    between languages to change to, the first by name wins.
    """
    total, width = scores.shape
    label = np.zeros(total, np.int32)
    if total == 0 or width == 1:
        return label
    begin = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    begin, counts = begin[order], counts[order]
    longest = int(counts[0])
    active = np.searchsorted(-counts, -np.arange(longest), side="left")  # texts longer than t
    come = np.zeros((total, width), np.int8 if width < 128 else np.int32)
    own = np.arange(width, dtype=come.dtype)
    value = scores[begin[: active[0]]].copy()
    final = np.zeros(len(counts), np.int64)
    for t in range(1, longest + 1):
        n = int(active[t]) if t < longest else 0
        if n < len(value):
            final[n : len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        if n == 0:
            break
        best = value.argmax(axis=1)
        jump = value[np.arange(n), best][:, None] - np.float32(switch)
        stay = value >= jump
        row = begin[:n] + t
        come[row] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, jump) + scores[row]
    at = final
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        row = begin[:n] + t
        label[row] = at[:n]
        at[:n] = come[row, at[:n]]
    return label


def _memo(model: Model) -> w.Memo:
    """Of each word its scores by language, and whether it has a letter."""
    width = len(model.names)

    def make(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        both = np.concatenate([word_scores(model, found), (_scripts(found) >= 0)[:, None]], axis=1)
        return both.astype(np.float32).ravel(), np.full(len(found), width + 1, np.int64)

    return w.Memo(make, max(50_000, 2_000_000 // (width + 1)))


def _label(model: Model, memo: w.Memo, block: w.Block) -> tuple[np.ndarray, np.ndarray, tuple]:
    """By text: language number (-1: none) and score; spans as (text, first word, words, language)."""
    words = w.split_words(block)
    width = len(model.names)
    flat, _ = memo(block.buf, words)
    table = flat.reshape(-1, width + 1)
    lettered = table[:, width] > 0
    doc = words.doc[lettered]
    counts = np.bincount(doc, minlength=block.n)
    label = viterbi(np.ascontiguousarray(table[lettered, :width]), counts)
    by = np.bincount(doc * width + label, minlength=block.n * width).reshape(block.n, width)
    pick = by.argmax(axis=1)
    total = by.sum(axis=1)
    score = by[np.arange(block.n), pick] / np.maximum(total, 1)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])
    at = np.flatnonzero(new)
    place = np.flatnonzero(lettered) - words.offs[doc]
    last = np.append(at[1:], len(doc))[: len(at)] - 1
    spans = (doc[at], place[at], place[last] + 1 - place[at], label[at])
    return np.where(total > 0, pick, -1), score, spans


def identify(docs: DataFrame, model: Model, text: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """docs with lang_pred, score and spans (language, first word, number of words).

    A text that is null or has no letter, or any text when no language was learned, is
    `und` with score 0 and no spans. Score is the share of the text's words in lang_pred.
    """
    names = np.array([*model.names, UNKNOWN], dtype=object)
    width = len(model.names)
    span_type = T._parse_datatype_string("array<struct<lang: string, first: int, words: int>>")

    memo: list[w.Memo] = []

    def rows(batch: pa.RecordBatch) -> list:
        if not memo:
            memo.append(_memo(model))
        picks, scores, spans, lens = [], [], [], []
        for block in w.blocks(batch.column(text), BLOCK) if width else []:
            pick, score, (doc, first, size, label) = _label(model, memo[0], block)
            picks.append(pick)
            scores.append(score)
            spans.append((first, size, label))
            lens.append(np.bincount(doc, minlength=block.n))
        if not width:
            picks, scores, lens = [np.full(batch.num_rows, -1)], [np.zeros(batch.num_rows)], [np.zeros(batch.num_rows, int)]
        first, size, label = (np.concatenate([s[i] for s in spans]) if spans else np.zeros(0, int) for i in range(3))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lens))]) if lens else np.zeros(1, int)
        body = pa.StructArray.from_arrays(
            [pa.array(names[label], pa.string()), pa.array(first, pa.int32()), pa.array(size, pa.int32())],
            names=["lang", "first", "words"],
        )
        pick = np.concatenate(picks) if picks else np.zeros(0, int)
        return [
            pa.array(names[pick], pa.string()),
            pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), body),
        ]

    fields = [("lang_pred", "string"), ("score", "double"), ("spans", span_type.simpleString())]
    return widened(docs, fields, rows, without)


def accept(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents with a language, most of whose words are in it, with their own columns."""
    model = learn(docs)
    inner = numbered(docs)
    found = identify(inner, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*inner.columns).toDF(*docs.columns)


def op4_viterbi_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held = F.coalesce(doc_crc("doc_id") % 4 == 2, F.lit(False))
    model = learn(docs.filter(~held))
    found = identify(docs.select("doc_id", "text"), model, without=("text",))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
