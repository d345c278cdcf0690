import re

import numpy as np
import pyarrow as pa
from conftest import blank_words, lower
from hypothesis import given, settings, strategies as st

from tagtable.llm import words as W
from tagtable.llm.decontamination import winnow

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\t.9é日 \x0b-", max_size=40)), max_size=12)


def spelled(texts, letters):
    out = []
    for _, _, part in W.chunks(pa.array(texts, pa.string()), 16):
        low = part.lower()
        words, data = low.words(letters), low.data.tobytes()
        cuts = [data[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)]
        out += [cuts[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    assert spelled(texts, W.NOT_BLANK) == [blank_words(t) for t in texts]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    assert spelled(texts, W.LETTERS_DIGITS) == [re.findall(pattern, lower(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_shingle_sets_are_equal_as_the_sets_are(texts, k):
    wanted = []
    for t in texts:
        w = blank_words(t)
        wanted.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    got = []
    for _, _, part in W.chunks(pa.array(texts, pa.string()), 16):
        flat, bounds = W.shingle_sets(part, k)
        got += [tuple(flat[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [len(g) for g in got] == [len(w) for w in wanted]
    assert all(list(g) == sorted(g) for g in got)
    for i in range(len(texts)):
        for j in range(i):
            assert len(set(got[i]) & set(got[j])) == len(wanted[i] & wanted[j])


def test_hash_depends_on_the_word_alone():
    texts = W.Texts(np.frombuffer(b"ab abc ab  zab ab", np.uint8), np.array([0, 17]))
    h = texts.words(W.NOT_BLANK).hashes()
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.integers(1, 6))
def test_winnowing_keeps_the_last_smallest_of_every_window(values, span):
    wanted = set()
    for i in range(len(values) - span + 1):
        window = values[i : i + span]
        wanted.add(i + max(j for j in range(span) if window[j] == min(window)))
    assert winnow(np.array(values, dtype=np.uint64), span).tolist() == sorted(wanted)
