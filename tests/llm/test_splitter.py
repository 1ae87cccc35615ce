import os
import random

import pytest

from ledgerloom.llm import splitter
from ledgerloom.llm.tokens import DEFAULT_RANKS, encoding

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_RANKS), reason="no tokenizer files")


@pytest.fixture(scope="module")
def enc():
    return encoding(DEFAULT_RANKS)


def _split(enc, text, limit=100, overlap=10):
    got = splitter.split(text, enc.encode_ordinary, enc.decode_single_token_bytes, limit, overlap)
    if got:
        assert "".join(text[b:c] for _, b, c, _ in got) == text
    for i, (a, b, c, n) in enumerate(got):
        assert n == len(enc.encode_ordinary(text[a:c])) <= limit and a <= b < c
        if i and overlap:
            before = enc.encode_ordinary(text[got[i - 1][0] : got[i - 1][2]])
            assert enc.decode(before[-overlap:]).lstrip("�") in text[a:b] and len(text[a:b]) > 0
    return got


def test_round_trip_of_many_shapes(enc):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdeé漢🙂 .\n") for _ in range(r.randint(1, 9)))
    for _ in range(30):
        _split(enc, " ".join(word() for _ in range(r.randint(1, 400))))
    for text in ("x" * 5000, "漢字" * 800, "🙂" * 400, " " * 5000, "\n" * 3000, "a\r\n\r\n" * 500, "é" * 3000, "1" * 4000):
        assert len(_split(enc, text)) > 1
        _split(enc, text, overlap=0)


def test_natural_boundaries(enc):
    para = "The crew set forms. They poured at noon, approx. 40 ft. of wall. Rain came later."
    text = "\n\n".join([para] * 30)
    got = _split(enc, text)
    assert all(text[:c].endswith("\n\n") for _, _, c, _ in got[:-1])
    one = " ".join([para] * 30)
    assert all(one[:c].rstrip().endswith((".",)) and not one[:c].rstrip().endswith(("approx.", "ft.")) for _, _, c, _ in _split(enc, one)[:-1])
    words = "alpha beta " * 300
    assert all(words[c] == " " for _, _, c, _ in _split(enc, words)[:-1])


def test_within_the_limit(enc):
    assert _split(enc, "short") == [] and _split(enc, "") == []
    with pytest.raises(ValueError):
        _split(enc, "x", 100, 50)


def test_operator(spark, enc):
    long = "A day of work. " * 2000
    df = spark.createDataFrame([(1, long, "x"), (2, "short", "x"), (3, None, "x"), (4, "", "x"), (1, long, "x"), (5, "z" * 300_000, "x")], "doc_id long, text string, piece string")
    rows = splitter.pieces(df).collect()
    assert {r.doc_id for r in rows} == {1, 5} and all(r.tokens <= 2048 for r in rows)
    five = sorted((r for r in rows if r.doc_id == 5), key=lambda r: r.piece)
    assert "".join(r.text[r.new_start - r.start :] for r in five) == "z" * 300_000
    assert splitter.pieces(df.limit(0)).count() == 0
