from collections import Counter

import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import rules
from tallyloom.llm.textblock import blocks

from .helpers import WORD, awkward, empty, prose


def base(text):
    t = text or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return [len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab \n#é", max_size=60), min_size=1, max_size=8), st.integers(1, 60))
def test_measures_equal_brute_force(texts, size):
    got = []
    for _, _, block in blocks(pa.array(texts, pa.string()), size):
        got += [list(map(int, r)) for r in zip(*rules.measure(block)[:5], strict=True)]
    assert got == [base(t) for t in texts]


def test_awkward_rows(spark):
    docs = awkward(spark)
    led = rules.ledger(docs, keep=["doc_id", "text"]).collect()
    assert len(led) == docs.count()
    for r in led:
        assert [r[m] for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == base(r.text)
        if not r.text:
            assert r.failed == rules.mask_of(["too_few_words"]) + (r.failed & ~rules.mask_of(["too_few_words"]))
    assert rules.ledger(empty(spark)).count() == 0


def test_policies_and_ablations(spark):
    texts = [prose(1, 80), prose(2, 80).upper(), "few words", " ".join(f"{w} %%%" for w in prose(3, 60).split()), "same words again " * 30]
    led = rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), keep=["doc_id"])
    kept = {r.doc_id for r in led.filter(rules.passes()).collect()}
    assert kept == {0}
    assert {r.doc_id for r in led.filter(rules.passes("base")).collect()} == {0, 1, 3}
    got = {r.rule: r for r in rules.ablations(led).collect()}
    for rule in rules.RULES:
        bit = rules.mask_of([rule])
        inside = F.col("failed").bitwiseAND(rules.mask_of(rules.POLICIES[rules.PRODUCTION]))
        assert got[rule].n_failed == led.filter(F.col("failed").bitwiseAND(bit) != 0).count()
        assert got[rule].n_only == led.filter(inside == bit).count()
        assert got[rule].n_without == led.filter(inside.bitwiseAND(~bit) != 0).count()
