import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import pii

from .helpers import awkward, empty, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return sum(d[::2] + [sum(divmod(2 * v, 10)) for v in d[1::2]]) % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@+-_ 2(é%05", max_size=40))
def test_patterns_equal_the_plain_expressions(text):
    assert pii.exact(text) == base(text)


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a@" * 50_000, "+1 " * 60_000, "a" * 200_000 + "@"):
        assert isinstance(pii.exact(text), list)


CARDS = ["4539578763621486", "4716 1089 9971 6531", "6011-0009-9013-9424"]


def document(i):
    phone = f"+1 ({200 + i % 700}) 555-{1000 + i:04d}"
    kind = [f"mail user{i}@example{i % 9}.com now", f"host 10.{i % 256}.3.{(7 * i) % 256} is up", f"card {CARDS[i % 3]} paid", f"call {phone} or {phone} today", f"order {10**15 + 3 * i} and {10**7 + i}"][i % 5]
    return f"{prose(i, 20)} {kind} {prose(i + 1, 20)}"


def fitted(spark):
    docs = spark.createDataFrame([(i, document(i)) for i in range(300)], "doc_id bigint, text string")
    return docs, pii.fit(docs)


def test_base_columns_and_consistency(spark):
    docs, crf = fitted(spark)
    more = spark.createDataFrame([(1000, "call +1 (487) 555-7209 now, later 487-555-7209 or 1 487 555 7209; order 1234567890123456"), (1001, "order 1234567890123456 and 1234567890123456 again"), (1002, "")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find(docs.unionByName(more), crf, keep=["doc_id", "text"]).collect()}
    for r in got.values():
        want = base(r.text)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == k for b in want) for k in range(4)]
        shown = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))
    assert got[1000].spans == "phone:5:22,phone:34:46,phone:50:64"  # distant mentions take the label
    assert got[1001].spans == "" and got[1002].spans == ""
    assert all(r.spans == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base(r.text)) for i, r in got.items() if i < 300 and i % 5 == 4)


def test_redact(spark):
    docs, crf = fitted(spark)
    extra = docs.withColumns({"spans": F.lit("other"), "n_email": F.lit(1)})
    got = {r.doc_id: r.text for r in pii.redact(extra, crf).collect()}
    assert all(base(t) == [] for t in got.values())
    assert "[EMAIL]" in got[0] and "[PHONE] or [PHONE]" in got[3] and got[4] == document(4)
    assert pii.redact(extra, crf).columns == extra.columns


def test_awkward_rows(spark):
    docs, crf = awkward(spark), fitted(spark)[1]
    got = pii.find(docs, crf, keep=["doc_id", "text"]).collect()
    assert len(got) == docs.count() and all(r.spans == "" for r in got if not r.text)
    assert pii.redact(docs, crf).count() == docs.count()
    assert pii.redact(docs, crf).filter("doc_id = 2 and text is null").count() == 1
    assert pii.find(empty(spark), pii.fit(empty(spark))).count() == 0


def test_labels_reach_every_repeat_of_a_long_document(spark):
    crf = fitted(spark)[1]
    far = f" {'word ' * 60}"
    repeats = ["4875557209"] * 40
    for parts in (["+1 (487) 555-7209", *repeats], [*repeats, "+1 (487) 555-7209"]):
        text = far.join(parts)
        got = pii.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), crf).first().spans
        assert got.count("phone:") == len(parts)
    text = far.join(repeats)  # nothing matched: nothing to agree with
    assert not any(kind == 1 and (a == 0 and b > 2) for a, b, kind in pii.graph(text)[3])


def test_messages_stand_still(spark):
    """Labels along a chain of repeats alone are those of the exact chain, however long."""
    n, k = 60, pii.NONE + 1
    unary = np.zeros((pii.FEATURES, k))
    unary[0] = [-9, -9, -9, -4, 0]
    pot = np.eye(k) * 4.5
    pot[pii.NONE, pii.NONE] = 0
    crf = pii.Crf(unary, np.zeros((k, k)), pot)
    x = np.zeros((n, pii.FEATURES))
    x[:, 0] = 1
    known = np.array([3] + [pii.NONE] * (n - 1))
    edges = np.array([(i, i + 1, 1) for i in range(n - 1)])
    u = np.tile(unary[0], (n, 1))
    u[:, 0] = -30
    u[0] = [-30, -30, -30, 0, -30]
    ahead, behind = np.zeros((n, k)), np.zeros((n, k))
    for i in range(1, n):
        ahead[i] = np.log(np.exp((u[i - 1] + ahead[i - 1])[:, None] + pot).sum(0))
    for i in range(n - 2, -1, -1):
        behind[i] = np.log(np.exp(pot + (u[i + 1] + behind[i + 1])[None]).sum(1))
    want = (u + ahead + behind).argmax(1)
    assert crf.labels(x, known, edges, np.zeros(n, int)).tolist() == want.tolist()
    assert (want == 3).sum() > 10


def exact_beliefs(crf, x, known, edges):
    """Marginals by going through every labelling."""
    n, k = len(x), pii.NONE + 1
    u = x @ crf.unary + np.where(x[:, 1:2] > 0, *pii._BARRED)
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        if any(f < pii.NONE and v != f for v, f in zip(labels, known, strict=True)):
            continue
        e = sum(u[i, v] for i, v in enumerate(labels)) + sum((crf.skip if kind else crf.chain)[labels[i], labels[j]] for i, j, kind in edges)
        for i, v in enumerate(labels):
            total[i, v] += np.exp(e)
    return total / total.sum(1, keepdims=True)


def test_beliefs_equal_enumeration():
    """Exact on trees; on small loops near enough to give the same labels."""
    rng, k = np.random.default_rng(6), pii.NONE + 1
    for case in range(12):
        skip = rng.normal(size=(k, k)) * 0.8
        crf = pii.Crf(rng.normal(size=(pii.FEATURES, k)) * 0.3, rng.normal(size=(k, k)), (skip + skip.T) / 2 + np.eye(k))
        n = 5
        x = rng.random((n, pii.FEATURES)).round()
        known = np.where(rng.random(n) < 0.3, rng.integers(1, pii.NONE, n), pii.NONE)
        x[known < pii.NONE, 1] = 0
        edges = [(int(rng.integers(0, j)), j, int(rng.integers(0, 2))) for j in range(1, n)]
        loops = case % 3 == 2
        if loops:
            edges.append((0, n - 1, 1))
        got = crf.beliefs(x, known, np.array(edges), np.zeros(n, int))
        got = np.exp(got - got.max(1, keepdims=True))
        got /= got.sum(1, keepdims=True)
        want = exact_beliefs(crf, x, known.tolist(), edges)
        free = known == pii.NONE
        assert np.abs(got - want)[free].max(initial=0) < (0.15 if loops else 2e-3)


def test_fit_climbs_the_pseudo_likelihood():
    """The fitted tables reach the likelihood's top: no small change of one weight betters it."""
    rng, k = np.random.default_rng(1), pii.NONE + 1
    n = 400
    y = rng.integers(1, k, n)
    x = np.zeros((n, pii.FEATURES))
    x[:, 0], x[:, 3], x[:, 9] = 1, y == 3, rng.random(n)
    near = np.zeros((n, 3 * k))
    near[np.arange(n), 2 * k + np.where(rng.random(n) < 0.8, y, rng.integers(1, k, n))] = 1
    crf = pii.Crf.fit(x, y, near, np.ones(n))
    assert all(crf.skip[v, v] == crf.skip[v].max() for v in range(1, k)) and np.allclose(crf.skip, crf.skip.T)

    def value(unary, skip):
        q = x @ unary + near[:, 2 * k :] @ skip + np.where(x[:, 1:2] > 0, *pii._BARRED)
        q -= np.log(np.exp(q - q.max(1, keepdims=True)).sum(1, keepdims=True)) + q.max(1, keepdims=True)
        prior = np.zeros_like(unary)
        prior[0, pii.NONE] = 2
        return q[np.arange(n), y].mean() - pii.RIDGE / 2 * (((unary - prior) ** 2).sum() + (skip**2).sum())

    top = value(crf.unary, crf.skip)
    for i in (0, 3, 9):
        for v in range(1, k):
            for d in (-0.3, 0.3):
                moved = crf.unary.copy()
                moved[i, v] += d
                assert value(moved, crf.skip) < top + 1e-3


def test_a_look_alike_that_repeats_a_match_is_no_example_of_none():
    text = "call +1 (487) 555-7209 or 4875557209, order 1234567890123456"
    _, found, texts, edges = pii.graph(text)
    got = pii.cases([pii.features(t) for t in texts], texts, [k for _, _, k in found], edges)
    assert [k for _, _, k in found] == [3, pii.NONE, pii.NONE] and [y for _, y, _ in got] == [3, pii.NONE]
