import hashlib
import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import mixing

from .helpers import WORD, awkward, empty, prose


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.none() | st.text(max_size=3), st.integers(0, 10_000), min_size=1, max_size=8))
def test_shares(sizes):
    got, total = mixing.shares(sizes, (5, 2, 1)), sum(sizes.values())
    assert sum(got.values()) == pytest.approx(total)
    assert all(t <= 3 * sizes[s] + 1e-6 for s, t in got.items())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    free = [(got[s] / (5, 2, 1)[i % 3], s) for i, s in enumerate(names) if got[s] < 3 * sizes[s] - 1e-6]
    assert not free or max(f for f, _ in free) == pytest.approx(min(f for f, _ in free))


def rank(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:12], 16) >> (48 - mixing.BITS * mixing.LEVELS)


def brute(rows):
    """copies by (doc_id, source): rows are (doc_id, source, size)."""
    totals = {}
    for _, s, n in rows:
        totals[s] = totals.get(s, 0) + n
    target, out = mixing.shares(totals, (5, 2, 1)), {}
    for s, total in totals.items():
        whole = min(3, int(target[s] // total)) if total else 0
        left, own, taken = target[s] - whole * total, [r for r in rows if r[1] == s], set()
        for turn in range(1 + mixing.FILLS):
            offer = [r for r in own if r not in taken and (not turn or r[2] <= left)]
            run = 0
            for k in sorted({rank(r[0]) for r in offer}):
                tied = [r for r in offer if rank(r[0]) == k]
                mass = sum(r[2] for r in tied)
                if run + mass > left:
                    break
                run += mass
                taken |= set(tied)
            left -= run
        for r in own:
            out[r[0], s] = whole + (r in taken and whole < 3)
    return out


def test_mix_equals_brute_force(spark):
    sources = ["a", "b", "c", "d", None]
    rows = [(i, sources[0 if i % 3 else i % 5], 1 + (i * 7919) % 300) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").withColumn("rank", mixing.row_hash("doc_id"))
    got = {(r.doc_id, r.source): r.copies for r in mixing.mix(df).collect()}
    assert got == brute(rows)
    again = {(r.doc_id, r.source): r.copies for r in mixing.mix(df.repartition(7)).collect()}
    assert again == got


def test_hot_source_meets_its_target(spark):
    docs = spark.createDataFrame([(i, prose(i, 20 + i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(300)], "doc_id bigint, text string, source string")
    out = mixing.mix_documents(docs)
    by = out.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("t"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    assert all(abs(r.taken - r.t) <= 70 and r.most <= 3 for r in by)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = mixing.mix_documents(docs).collect()
    assert len(got) == docs.count()
    want = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    assert all(r["size"] == want[r.doc_id] and r.taken <= 3 * r["size"] and not math.isnan(r.target) for r in got)
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns
    taken = {(r.doc_id, r.source_size): r.taken // r["size"] for r in got if r["size"]}
    n = {}
    for r in out.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    assert n.get(1, 0) == 2 * next(v for (d, _), v in taken.items() if d == 1)
    assert mixing.mix_documents(empty(spark)).count() == 0
    assert mixing.repeat_documents(empty(spark)).count() == 0


def test_sources_of_null_or_repeated_ids_meet_their_targets(spark):
    rows = [(None, prose(i, 20 + i % 30), "a") for i in range(200)]  # no ids, different texts
    rows += [(None if i % 2 else 7, prose(1, 25), "b") for i in range(300)]  # copies of two rows
    rows += [(i, prose(i, 30), "c") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    words = lambda t: len(t.split())
    size = {s: sum(words(t) for _, t, own in rows if own == s) for s in "abc"}
    target = mixing.shares(size, (5, 2, 1))
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(rows) and all(r.taken % r["size"] == 0 and r.taken <= 3 * r["size"] for r in got)
    out = mixing.repeat_documents(docs).collect()
    for s in "abc":
        own = sum(r.taken for r in got if r.source_size == size[s])
        assert target[s] - 50 < own <= target[s]
        assert own == sum(words(r.text) for r in out if r.source == s)
    assert {target[s] % size[s] > 50 for s in "abc"} == {True}
