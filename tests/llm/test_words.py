import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from docflow.llm import measures, words as w
from tests.llm import plain

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab #|\n\t\r\x0b é日A9 ", max_size=60)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_counts_equal_plain_ones(texts, size):
    found, row = [], 0
    for block in w.blocks(pa.array(texts, pa.string()), size):
        got = w.split_words(block)
        raw = [x.decode() for x in w.strings(block.buf, got.starts, got.ends)]
        m = measures.measure(block)
        for i in range(block.n):
            assert raw[got.offs[i] : got.offs[i + 1]] == plain.words(texts[row])
            counts = tuple(int(m[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert counts == plain.rule_counts(texts[row])
            row += 1
        found.append(got)
    assert row == len(texts)


def test_hash_depends_on_the_bytes_alone():
    a = w.split_words(next(w.blocks(pa.array(["x abc", "abc abd cba ab"]))))
    names = ["x", "abc", "abc", "abd", "cba", "ab"]
    for i, p in enumerate(names):
        for j, q in enumerate(names):
            assert (a.hashes[i] == a.hashes[j]) == (p == q)


def test_memo_gives_the_same_with_any_size():
    texts = pa.array([f"w{i % 7} w{i % 5} x" for i in range(50)])

    def make(found):
        return np.array([x for word in found for x in word], np.int64), np.array([len(x) for x in found])

    for size in (1, 3, 1000):
        memo = w.Memo(make, size)
        for block in w.blocks(texts, 40):
            got = w.split_words(block)
            values, lens = memo(block.buf, got)
            raw = w.strings(block.buf, got.starts, got.ends)
            assert values.tolist() == [x for word in raw for x in word] and lens.tolist() == [len(x) for x in raw]
