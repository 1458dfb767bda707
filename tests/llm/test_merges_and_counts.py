import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from docflow.llm import merge_dropout as m, pieces, token_counts as t, words as w
from tests.llm import plain

PATH = public_tokenizers.path(m.MODEL)
SIGN = pieces.SIGN


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def unigram(processor):
    vocab = [(processor.id_to_piece(i), processor.get_score(i)) for i in range(processor.get_piece_size())]
    return Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))


def texts():
    rng = random.Random(2)
    own = ["".join(rng.choice("aeinort  \n.é日😀TH") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    return own + [x or "" for _, x, *_ in plain.awkward() if len(x or "") < 9000]


def test_rate_0_is_the_tokenizer(spark, processor):
    rows = list(enumerate(texts()))
    got = m.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH, rate=0.0).collect()
    for r in got:
        if SIGN not in r["text"]:
            assert r["ids"] == processor.encode(r["text"]), r["text"]


def test_dropout_varies_and_decodes_whole(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    coded = m.encode(docs, PATH, rate=0.3)
    back = m.decode(coded.withColumnRenamed("text", "was"), PATH).collect()
    assert all(r["text"] == r["was"] for r in back)
    first = {r["doc_id"]: r["ids"] for r in coded.collect()}
    again = {r["doc_id"]: r["ids"] for r in m.encode(docs.repartition(7), PATH, rate=0.3).collect()}
    other = {r["doc_id"]: r["ids"] for r in m.encode(docs, PATH, rate=0.3, seed=21).collect()}
    assert first == again and first != other
    draws = {tuple(r["ids"]) for r in m.encode(spark.createDataFrame([(i, "international transportation") for i in range(40)], "doc_id long, text string"), PATH, rate=0.3).collect()}
    assert 2 <= len(draws) <= m.DRAWS


def test_every_occurrence_has_its_own_draw(spark):
    rows = [(i, " ".join(["international transportation"] * 50)) for i in range(40)]
    coded = m.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH, rate=0.3)
    texts = pieces.vocabulary(PATH).texts
    seen, within = set(), []
    for r in coded.collect():
        mine, unit = [], []
        for piece in r["ids"]:
            unit.append(piece)
            if b"".join(texts[i] for i in unit) in (b" international", b" transportation"):
                mine.append(tuple(unit))
                unit = []
        assert len(mine) == 100 and not unit
        within.append(len(set(mine)))
        seen |= set(mine)
    assert min(within) > 4 and len(seen) > 100  # 4 of each word was once the most of all


def test_remembered_results_equal_units_merged_alone():
    rng = random.Random(5)
    some = ["".join(rng.choice("etaoinshr日é😀T.,") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    some += [" international", " the", " x▁y", " transportation"]
    units = [(" " + rng.choice(some).lstrip()).encode() for _ in range(3000)]
    keys = np.array([rng.getrandbits(64) for _ in units], np.uint64)
    buf = np.frombuffer(b"".join(units), np.uint8)
    ends = np.cumsum([len(u) for u in units])
    starts = ends - [len(u) for u in units]
    none = np.zeros(0, np.int64)
    words = w.Words(starts, ends, none, none, w.hash_segments(buf, starts, ends))
    for rate in (0.0, 0.1, 0.4):
        make = m.Occurrences(PATH, rate)
        for _ in range(2):  # from empty memos, and from full ones
            got = make(buf, words, keys)
            want = m.encode_units(units, PATH, rate, keys)
            assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_units_merged_together_equal_those_merged_alone():
    words, rng = pieces.vocabulary(PATH), random.Random(4)
    units = [" " * rng.randint(1, 3) + "".join(rng.choice("etaoinshr日é😀T.,") for _ in range(rng.randint(0, 70))) for _ in range(1500)]
    keys = np.arange(len(units), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for rate in (0.0, 0.25):
        flat, lens = m.encode_units([u.encode() for u in units], PATH, rate, keys)
        at = 0
        for unit, key, n in zip(units, keys.tolist(), lens.tolist(), strict=True):
            skip = m.skips(key, rate) if rate else None
            assert flat[at : at + n].tolist() == m.merge(unit.replace(" ", SIGN), words, skip)
            at += n


def test_share_of_skipped_merges():
    skip = m.skips(99, 0.1)
    assert abs(np.mean([skip(a, b, c) for a in range(30) for b in range(1, 10) for c in range(1, 10)]) - 0.1) < 0.025


def test_counts_equal_the_tokenizer_on_ties_too(spark, unigram):
    rows = list(enumerate(texts()))
    got = t.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    scores = {p: s for p, (_, s) in pieces.vocabulary(PATH).pieces.items()}
    for r in got:
        text = r["text"]
        if SIGN in text or "<" in text:
            continue
        want = unigram.encode(SIGN + text.replace(" ", SIGN), add_special_tokens=False) if text else None
        assert r["n_tokens"] == (len(want.ids) if want else 0), text
        if want and all(x in scores for x in want.tokens):
            assert r["token_score"] == sum(scores[x] for x in want.tokens)


def test_awkward_rows(spark):
    docs = plain.frame(spark)
    n = len(plain.awkward())
    counted = t.token_counts(docs, PATH).collect()
    assert len(counted) == n and all((r["n_tokens"] == 0) == (not r["text"]) for r in counted)
    coded = m.encode(docs, PATH).collect()
    assert len(coded) == n and all((r["ids"] == []) == (not r["text"]) for r in coded)
    empty = docs.filter("false")
    assert t.token_counts(empty, PATH).count() == 0 and m.encode(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        m.encode(docs, PATH, rate=1.0)


def test_query_digests(spark, tmp_path):
    plain.frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    rows = m.op8_merge_dropout(spark, str(tmp_path)).collect()
    by = sorted((str(r["doc_id"]), r["decoded_sha256"]) for r in rows)
    assert by == sorted((str(i), plain.sha(x or "")) for i, x, *_ in plain.awkward())
    ids = {r["doc_id"]: r["ids"] for r in m.encode(spark.createDataFrame([(1, dict((a, b) for a, b, *_ in plain.awkward())[1])], "doc_id long, text string"), PATH).collect()}
    assert next(r["ids_crc32"] for r in rows if r["doc_id"] == 1) == zlib.crc32(np.array(ids[1], "<u4").tobytes())
