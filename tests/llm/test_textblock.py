import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tallyloom.llm.textblock import WORDPUNCT, blocks, windows

from .helpers import WORD

TEXTS = st.lists(st.none() | st.text(alphabet="ab .\n\té日", max_size=40), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_hashes_and_windows(texts, size):
    seen = {}
    for lo, hi, block in blocks(pa.array(texts, pa.string()), size):
        t = block.tokens()
        h = t.hashes()
        win, at = windows(t, h, 3)
        owner = t.doc()
        for i in range(lo, hi):
            words = WORD.findall(texts[i] or "")
            got = h[t.first[i - lo] : t.first[i - lo + 1]].tolist()
            assert len(words) == len(got) == t.counts[i - lo]
            for w, v in zip(words, got, strict=True):
                assert seen.setdefault(v, w) == w
            assert int((owner[at] == i - lo).sum()) == max(0, len(words) - 2)
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_wordpunct_tokens(texts):
    import re

    for lo, hi, block in blocks(pa.array(texts, pa.string()), 30):
        t = block.tokens(WORDPUNCT)
        for i in range(lo, hi):
            got = [block.u[s:e].tobytes().decode() for s, e in zip(t.start[t.first[i - lo] : t.first[i - lo + 1]], t.end[t.first[i - lo] : t.first[i - lo + 1]], strict=True)]
            assert got == re.findall(r"[A-Za-z0-9_\x80-\U0010ffff]+|[^\sA-Za-z0-9_\x80-\U0010ffff]+", texts[i] or "")


def test_slices_of_a_larger_array_keep_their_texts():
    a = pa.array(["one", None, "two words", "three"]).slice(1, 2)
    (lo, hi, block), = blocks(a)
    assert (lo, hi, block.text(0), block.text(1)) == (0, 2, "", "two words")
    assert np.array_equal(block.tokens().counts, [0, 2])
