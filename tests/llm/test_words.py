import re

import pyarrow as pa
import pytest

from orrery.llm import words as T

TEXTS = ["", None, "  ", "One two\tTHREE", "é漢 字\x0bx", "a-b c_d\n\n9", "x" * 700_000, "ends "]


@pytest.mark.parametrize("separators, pattern", [(T.SPACES, r"[^\x20\x09-\x0D]+"), (T.NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_the_pattern(separators, pattern):
    w = T.words(pa.array(TEXTS), separators)
    for i, text in enumerate(TEXTS):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        got = [bytes(w.data[s:e]).decode() for s, e in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])]
        assert got == re.findall(pattern, low)


def test_hashes_depend_on_the_word_only():
    a = T.words(pa.array(["x yy zzz " * 50_000]), T.SPACES).hash
    b = T.words(pa.array(["q", "zzz x", "yy"]), T.SPACES).hash
    assert len(set(a.tolist())) == 3 and {b[1], b[2], b[3]} == set(a.tolist())


def test_short_texts_are_one_shingle():
    s, first = T.shingles(T.words(pa.array(["", "a b", "a b c d e", "a b c d e f", "a b"]), T.SPACES), 5)
    assert first.tolist() == [0, 0, 1, 2, 4, 5] and s[0] == s[4] and s[1] == s[2] and len(set(s.tolist())) == 3


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab" * i for i in range(200)])], ["text"])
    parts = list(T.slices([batch, batch.slice(0, 0)], "text", 500))
    assert sum(p.num_rows for p in parts) == 200 and len(parts) > 10
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()


@pytest.mark.parametrize("separators", [T.SPACES, T.NOT_ALNUM])
def test_counts_are_those_of_words(separators):
    texts = pa.array(["cut off", *TEXTS]).slice(1)
    assert T.counts(texts, separators).tolist() == T.words(texts, separators).counts().tolist()
    assert T.counts(pa.array([], pa.string()), separators).tolist() == []
