"""Plain, slow versions of what the operators compute, and awkward inputs for them."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = {
    "score": "double", "ids": "array<int>", "n_words": "string", "shard": "string", "slot": "string", "spans": "string",
    "fingerprint": "int", "sequence_id": "string", "kept": "string", "lang_pred": "int", "n_tokens": "string", "part": "int",
    "component_id": "string", "start": "string", "id": "string", "word": "string",
}


def words(text):
    return WORD.findall(text or "")


def awkward():
    """(doc_id, text, lang, source, n_chars): nulls, empty, blank, long, repeated and foreign texts."""
    base = " ".join(f"word{i} of the text" for i in range(40))
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
    texts = [
        (1, base), (2, None), (3, ""), (4, " \n\t\x0b "), (5, long), (6, base), (7, base + " and one more"), (8, base),
        (9, "日本語 の テキスト é ñ ß\n\n日本語 の"), (10, "x"), (11, "one two three four"), (12, "ONE two THREE four"),
        (13, "same line\nsame line\n\n \nsame line\r\n"), (14, "a" * 5000), (15, "### $$$ !!! 123 <>"), (8, base), (-3, long),
        (None, base), (None, None), (16, "▁ under▁bar  two  spaces "), (17, "the cat " * 60),
    ]
    langs = ["en", None, "fr", "de"]
    return [(i, t, langs[k % 4], None if k % 3 == 0 else "src", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=None, clash=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if clash:
        df = df.withColumns({c: F.lit(None).cast(t) for c, t in CLASHING.items()})
    return df


def rule_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j + k for j, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[x] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows):
    """doc_id -> (set size, least doc_id reachable)."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def removed(rows, size=13):
    """doc_id -> which words of its text are duplicate."""
    first = {}
    split = [(i, words(t)) for i, t in rows if i is not None]
    for i, w in split:
        for j in range(len(w) - size + 1):
            key = tuple(w[j : j + size])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            if first[tuple(w[j : j + size])] < i:
                gone[j : j + size] = [True] * size
        out[i] = (w, gone)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
