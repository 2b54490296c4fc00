import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import packing
from tallyloom.llm.queries import tokenizer_path
from tallyloom.llm.textblock import blocks
from tallyloom.llm.tokens import WordTokens

from .helpers import awkward, empty, prose

ODD = "it's I'M “x.” a≠b café. café! ×a÷b 12ab3 <|endoftext|> É.!É  ΑΣ. İstanbul ǅ. won''t 's \x1c \x85"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="abzÀéß×ø'\n .,!1_2<|>“日" + chr(0x301) + chr(0x85), max_size=30) | st.sampled_from([ODD]), max_size=6))
def test_word_ids_equal_the_tokenizer(texts):
    t = Tokenizer.from_file(tokenizer_path()) if not hasattr(test_word_ids_equal_the_tokenizer, "t") else test_word_ids_equal_the_tokenizer.t
    test_word_ids_equal_the_tokenizer.t = t
    t.encode_special_tokens = True
    for lo, _, block in blocks(pa.array(texts, pa.string()), 50):
        flat, first = WordTokens.of(tokenizer_path())(block)
        for i in range(block.n):
            assert flat[first[i] : first[i + 1]].tolist() == t.encode(texts[lo + i] or "", add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 500), max_size=60), st.integers(1, 9))
def test_differencing_parts_every_item_once(sizes, m):
    parts = packing.difference(sizes, m)
    assert sorted(i for p in parts for i in p) == list(range(len(sizes)))
    assert len(parts) <= m


def test_differencing_is_near_equal():
    sums = [sum(p) for p in [[(37 * i) % 91 + 1 for i in part] for part in packing.difference([(37 * i) % 91 + 1 for i in range(200)], 8)]]
    assert max(sums) - min(sums) <= 5
    assert packing.difference([8, 7, 6, 5, 4], 2) and {sum([8, 7, 6, 5, 4][i] for i in p) for p in packing.difference([8, 7, 6, 5, 4], 2)} == {14, 16}


def test_window_count_rises_when_capacity_is_exceeded():
    assert len(packing.windows([6, 6, 6], 2, 10)) == 3


def check(pieces, want, capacity):
    """Every id in exactly one piece, windows gapless, little padding."""
    by_doc, by_window = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_window.setdefault(p.sequence_id, []).append(p)
    for doc, ids in want.items():
        own, at = sorted(by_doc[doc], key=lambda p: p.start), 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    pad = 0
    for own in by_window.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        pad += 0 if at & (at - 1) == 0 else capacity - at
    return pad


def test_round_trip(spark, plain):
    rows = [(i, prose(i, (i * 613) % 900 + (9000 if i % 40 == 0 else 0))) for i in range(160)] + [(1000, ODD), (1001, ""), (1002, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    want = {i: [*plain(t), packing.END_ID] for i, t in rows}
    pieces = packing.pack(docs, tokenizer_path()).collect()
    assert check(pieces, want, packing.CAPACITY) <= 0.03 * sum(map(len, want.values()))
    assert sum(p.length for p in pieces) == sum(map(len, want.values()))


def test_awkward_rows(spark, plain):
    docs = awkward(spark)
    rows = docs.collect()
    pieces = packing.pack(docs, tokenizer_path()).collect()
    assert sum(p.length for p in pieces) == sum(len(plain(r.text)) + 1 for r in rows)
    assert sum(p.start == 0 for p in pieces if p.doc_id == 1) == 2
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0
