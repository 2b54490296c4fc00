"""Importance resampling, language, toxicity and URL trees: brute force and held-out accuracy."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import importance, language, toxicity, urls
from tallyloom.llm.boosting import Boosted
from tallyloom.llm.textblock import blocks

from .helpers import awkward, empty, prose

TOKEN = re.compile(r"[A-Za-z0-9_\u0080-\U0010ffff]+|[^A-Za-z0-9_\u0080-\U0010ffff\x20\x09-\x0D]+")
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    """300 clean documents, 100 of junk; a third labelled."""
    rows, labels = [], []
    for i in range(400):
        text = ". ".join(prose(i * 10 + j, 12).capitalize() for j in range(4 + i % 9)) + "."
        junk = i % 4 == 3
        if junk:
            text = " ".join(w + "&&&" for w in text.split()) if i % 8 == 3 else text.upper().replace(".", "!!")
        rows.append((i, text, "en", "s", len(text)))
        if i % 3 == 0:
            labels.append((i, int(not junk), 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, LABELS)


def test_importance_keeps_clean_documents_it_has_no_label_for(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in importance.select(docs, labels).collect()}
    clean = [i for i in got if i % 4 != 3]
    assert sum(got[i].selected for i in clean) >= 0.98 * len(clean)
    assert sum(got[i].selected for i in got if i % 4 == 3) <= 3
    assert {r.doc_id for r in importance.keep_selected(docs, labels).collect()} == {i for i in got if got[i].selected}


def test_importance_top_k_is_exact(corpus):
    got = importance.select(*corpus).collect()
    k = sum(r.log_weight >= -importance.MARGIN for r in got)
    assert sum(r.selected for r in got) == k
    assert min(r.gumbel_key for r in got if r.selected) > max(r.gumbel_key for r in got if not r.selected)


def test_importance_scores_equal_brute_force(corpus):
    docs, labels = corpus
    rows = docs.orderBy("doc_id").collect()
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    # n-grams as strings of this test's own, each put in the bucket that the operator's hash gives its tokens
    names, found = {}, []
    for r in rows:
        w = TOKEN.findall(r.text)
        own = [(t,) for t in w] + list(itertools.pairwise(w)) + [("again",)] * sum(a == b and a.isalnum() for a, b in itertools.pairwise(w))
        own += [("capitals", "")] * sum(len(t.encode()) > 1 and bool(re.search("[A-Z]", t)) and not re.search("[a-z]", t) for t in w)
        found.append(own)
        (_, _, block), = blocks(pa.array([r.text]))
        for g, b in zip(own, importance.grams(block)[0].tolist(), strict=True):
            assert names.setdefault(g, b) == b
    assert len(set(names.values())) > 0.9 * len(names) or len(names) > 20_000
    raw, target = np.ones(1 << importance.BUCKET_BITS), np.zeros(1 << importance.BUCKET_BITS)
    for r, g in zip(rows, found, strict=True):
        for x in g:
            raw[names[x]] += 1
            target[names[x]] += r.doc_id in good
    raw /= raw.sum()
    model = raw * (target + importance.PRIOR) / (target.sum() * raw + importance.PRIOR)
    ratio = np.log(model / model.sum() / raw)
    got = {r.doc_id: r.log_weight for r in importance.select(docs, labels).collect()}
    for r, g in zip(rows, found, strict=True):
        assert got[r.doc_id] == pytest.approx(float(sum(ratio[names[x]] for x in g)), abs=1e-6)


def test_importance_on_labels_it_was_not_fitted_on(spark):
    """Both error rates on the driver's table, with half of the labels held out."""
    from pathlib import Path

    sf = Path("/root/testdata/sf0.01")
    if not sf.exists():
        pytest.skip("needs the driver's tables")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    half = toxicity.held_out("doc_id", 2, 0)
    got = importance.select(docs, labels.filter(~half)).join(labels.filter(half), "doc_id")
    good, bad = (got.filter(f"quality = {q}").agg(F.avg(F.col("selected").cast("int"))).first()[0] for q in (1, 0))
    assert good >= 0.99 and bad <= 0.05


def test_importance_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 1), (6, None, None), (1, 1, 0)], LABELS)
    assert importance.select(docs, labels).count() == docs.count()
    out = importance.keep_selected(docs, labels)
    assert out.columns == docs.columns and out.count() <= docs.count()
    none = spark.createDataFrame([], LABELS)
    assert importance.select(docs, none).filter("selected").count() == docs.count()
    assert importance.select(empty(spark), labels).count() == 0 and importance.keep_selected(empty(spark), none).count() == 0


def best(scores, penalty):
    """The value of the best path, one word after another."""
    v = scores[0].copy()
    for s in scores[1:]:
        v = np.maximum(v, v.max() - penalty) + s
    return v.max()


def test_viterbi_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(40):
        k = int(rng.integers(1, 6))
        first = np.concatenate([[0], np.cumsum(rng.integers(0, 300, size=int(rng.integers(1, 10))))])
        scores = (rng.normal(size=(first[-1], k)) * 2).astype(np.float32)
        path = language.viterbi(scores, first, 3.0)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b > a:
                s, p = scores[a:b].astype(float), path[a:b]
                assert s[np.arange(b - a), p].sum() - 3 * (p[1:] != p[:-1]).sum() == pytest.approx(best(s, 3.0), abs=1e-2)


WORDS = {"xa": "the of and thing worth with ring shout over under night".split(), "xb": "der und schön nicht ein über straße weiß zeit haus".split(), "xc": "и не что это быть весь человек год".split()}


def sentence(r, lang, n):
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def lang_model(spark):
    r = random.Random(1)
    rows = [(i, sentence(r, lang, 40), lang) for i, lang in enumerate(sorted(WORDS) * 30)] + [(999, "no language", None)]
    return language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_language_held_out_and_mixed(spark, lang_model):
    r = random.Random(2)
    rows = [(i, sentence(r, lang, 1 + i % 30), lang) for i, lang in enumerate(sorted(WORDS) * 20)]
    mixed = sentence(r, "xa", 30) + ". " + sentence(r, "xc", 20) + ", " + sentence(r, "xb", 12)
    docs = spark.createDataFrame([*rows, (500, mixed, "xa"), (501, "123 ... !!", None), (502, "日本", None)], "doc_id bigint, text string, lang string")
    got = {x.doc_id: x for x in language.identify(docs, lang_model, keep=["doc_id"]).collect()}
    right = sum(got[i].lang_pred == lang for i, _, lang in rows)
    assert right >= 0.97 * len(rows)
    assert got[500].spans == "xa:0:30,xc:30:50,xb:50:62" and got[500].lang_pred == "xa" and got[500].score == pytest.approx(30 / 62)
    assert got[501].lang_pred == "und" and got[501].score == 0
    assert got[502].lang_pred in WORDS


def test_scripts_narrow_candidates(lang_model):
    (_, _, block), = blocks(pa.array(["человек the"]))
    vocab, back, _ = language.distinct(block)
    s = lang_model.word_scores(vocab)[back]
    cyr = lang_model.langs.index("xc")
    assert s[0].argmax() == cyr and (np.delete(s[0], cyr) == language.FOREIGN).all() and s[1][cyr] == language.FOREIGN


def test_narrowing_changes_no_path():
    rng = np.random.default_rng(4)
    for _ in range(30):
        k = int(rng.integers(2, 70))
        first = np.concatenate([[0], np.cumsum(rng.integers(0, 90, size=8))])
        owner = np.repeat(np.arange(8), np.diff(first))
        texts = rng.random((8, k)) < 0.4
        texts[:, 0] = True
        may = texts[owner] & (rng.random((first[-1], k)) < 0.8)
        scores = np.where(may, rng.normal(size=may.shape) * 2, language.FOREIGN).astype(np.float32)
        path, want = language.narrowed(scores, may, first, 3.0), language.viterbi(scores, first, 3.0)
        for p in (path, want):
            assert p.shape == (first[-1],)
        for a, b in zip(first[:-1], first[1:], strict=True):
            value = lambda p: scores[np.arange(a, b), p[a:b]].astype(float).sum() - 3 * (np.diff(p[a:b]) != 0).sum()  # noqa: E731, B023
            assert value(path) == pytest.approx(value(want), rel=1e-5, abs=1e-2)


@pytest.mark.parametrize("step", [0, 2000, 10**9])
def test_both_ways_of_viterbi_are_exact(monkeypatch, step):
    monkeypatch.setattr(language, "STEP", step)
    monkeypatch.setattr(language, "HELD", 3000)
    test_viterbi_is_exact()


def test_word_scores_equal_brute_force(spark, lang_model):
    """Sums of log shares of a word's n-grams, with a space on either side, tempered."""
    (_, _, block), = blocks(pa.array(["schön the worth der"]))
    vocab, back, _ = language.distinct(block)
    got = lang_model.word_scores(vocab)[back]
    for i, word in enumerate("schön the worth der".split()):
        want = np.zeros(len(lang_model.langs))
        for n in language.ORDERS:
            for j in range(len(word) + 3 - n):
                (_, _, g), = blocks(pa.array([f" {word} "[j : j + n]]))
                want += lang_model.logp[int(g.hashes(np.array([0]), np.array([len(g.u)]), lower=True)[0]) >> (64 - language.BUCKET_BITS)]
        fits = [lang for lang in range(len(want)) if got[i][lang] != language.FOREIGN]
        assert [got[i][x] for x in fits] == pytest.approx([language.TEMPER * (want[x] - max(want[y] for y in fits)) for x in fits], abs=1e-3)


def test_a_rare_language_is_learned(spark):
    r = random.Random(5)
    rows = [(i, sentence(r, "xa", 12), "xa") for i in range(600)] + [(1000 + i, sentence(r, "xc", 30), "xc") for i in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample=50)
    assert model.langs == ["xa", "xc"]


def test_language_awkward(spark, lang_model):
    docs = awkward(spark)
    all_of_it = language.identify(docs, lang_model)
    assert all_of_it.columns == ["score_" if x == "score" else x for x in docs.columns] + ["lang_pred", "score", "spans"]
    assert all_of_it.filter("score_ = 'other' and score between 0 and 1").count() == docs.count()
    got = all_of_it.collect()
    assert len(got) == docs.count()
    assert all((r.lang_pred == "und") == (not r.text or not any(c.isalpha() for c in r.text)) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    nothing = language.fit(empty(spark))
    assert {r.lang_pred for r in language.identify(docs.select("doc_id", "text"), nothing).collect()} == {"und"}
    assert language.identify(empty(spark), lang_model).count() == 0


INSULTS = ["idiotic", "worthless", "scumbag"]


@pytest.fixture(scope="module")
def toxic(spark):
    rows, labels = [], []
    for i in range(400):
        words = prose(5000 + i, 40 + i % 60, 2000).split()
        if i % 5 == 0:
            words.insert(i % len(words), INSULTS[i % 3])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS)


def test_toxicity_held_out(toxic):
    docs, labels = toxic
    held = toxicity.held_out("doc_id", 4, 0)
    model = toxicity.fit(docs, labels.filter(~held))
    got = toxicity.score(docs.withColumn("held", held), model, keep=["doc_id", "held"]).filter("held").collect()
    pos, neg = ([r.score for r in got if (r.doc_id % 5 == 0) == side] for side in (True, False))
    auc = np.mean([[(p > n) + (p == n) / 2 for n in neg] for p in pos])
    assert auc > 0.97
    assert np.mean([p >= 0.5 for p in pos]) > 0.8 and np.mean([n >= 0.5 for n in neg]) < 0.05


def buckets_of(text):
    """The distinct n-grams of a text by order, as buckets, one hash at a time."""
    low, out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text), []
    for n in toxicity.ORDERS:
        grams = {low[j : j + n] for j in range(len(low) - n + 1)}
        hashed = set()
        for g in grams:
            (_, _, b), = blocks(pa.array([g]))
            hashed.add(int(b.hashes(np.array([0]), np.array([len(b.u)]))[0]) >> (64 - toxicity.BUCKET_BITS))
        out += sorted(hashed)
    return out


def test_toxicity_equals_brute_force(spark):
    """Features, ratios, fit and scores from plain sets and dicts."""
    texts = {i: f"{'Idiotic' if i % 3 == 0 else 'pleasant'} würde {prose(i, 6)} {prose(i, 3)}" for i in range(24)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in texts], LABELS)
    found = {i: buckets_of(t) for i, t in texts.items()}
    model = toxicity.fit(docs, labels)
    n = [{}, {}]
    for i, own in found.items():
        for b in own:
            side = n[int(i % 3 == 0)]
            side[b] = side.get(b, 0) + 1
    prior = [toxicity.PRIOR * 16 / 24, toxicity.PRIOR * 8 / 24]
    scale = {}
    for b in set(n[0]) | set(n[1]):
        r = math.log((n[1].get(b, 0) + prior[1]) / (8 + prior[1])) - math.log((n[0].get(b, 0) + prior[0]) / (16 + prior[0]))
        scale[b] = r * abs(r)
    assert {b: float(model.square[b]) for b in scale} == pytest.approx({b: s * s for b, s in scale.items()}, rel=1e-4)
    order = sorted(found, key=lambda i: (i % 3 == 0, i))
    y = np.array([float(i % 3 == 0) for i in order])
    dense = np.zeros((24, 1 << toxicity.BUCKET_BITS), np.float32)
    for k, i in enumerate(order):
        for b in found[i]:
            dense[k, b] += scale[b]
        dense[k] /= np.sqrt(sum(scale[b] ** 2 for b in found[i]))
    used = np.flatnonzero(dense.any(0))
    x = dense[:, used].astype(float)
    share = toxicity.BALANCE * 24 / 2 / np.where(y == 1, 8, 16) + 1 - toxicity.BALANCE
    share /= share.sum()
    w, b = np.zeros(len(used)), math.log(share[y == 1].sum() / share[y == 0].sum())
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, toxicity.STEPS + 1):
        err = share * (1 / (1 + np.exp(-(x @ w + b))) - y)
        g = np.append(x.T @ err + toxicity.RIDGE * w, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = toxicity.RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    want = dict(zip(order, (1 / (1 + np.exp(-(x @ w + b)))).tolist(), strict=True))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    assert got == pytest.approx(want, abs=0.02)
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in got)


def test_toxicity_awkward(spark):
    docs = awkward(spark)
    clash = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame([], LABELS)))
    assert clash.columns == ["score_" if x == "score" else x for x in docs.columns] + ["score"] and clash.filter("score_ = 'other'").count() == docs.count()
    labels = spark.createDataFrame([(1, 1, 1), (5, 0, 0), (None, 1, 1), (6, 1, None), (1, 1, 0), (7, 1, 0)], LABELS)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.select("doc_id", "text"), model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    alone = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert len({r.score for r in toxicity.score(docs.select("doc_id", "text"), alone).collect()}) == 1
    assert toxicity.score(empty(spark), model).count() == 0 and toxicity.fit(empty(spark), labels) is not None


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.3)).astype(float)
    model = Boosted().fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.93
    assert np.allclose(Boosted().fit(x[:0], y[:0]).score(x[:3]), 0.5)
    assert np.unique(Boosted().fit(x[:50], np.ones(50)).score(x)).size == 1


def judge(url):
    """Host, path and rule verdict in plain Python."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest] + [len(rest)])]
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    "https://A.Example.COM/en/7?x=1", "http://example.com/en/8", "http://com/en/", "http://xcom/en/", "https://b.net/de/1", "http://example.net/de/8#t", "http://example.net/de/9",
    "http://z.org/es/a", "ftp://x.org?es/", "http://x.org#/es/", "no scheme/en/", "", None, "http://", "http:///en/", "a://b://c.com/en/", "http://ÄB.com/en/1", "http://x.com/en/\nnext",
]


def test_url_rules_equal_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").withColumns({"host": F.lit("other"), "key": F.lit(0)})
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = judge(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or ("block" if got[i].score >= 0.5 else "allow"))


def test_url_trees_on_urls_they_were_not_fitted_on(spark):
    rows = [f"http://{'spam' if i % 2 else 'good'}{i}.com/{'en' if i % 2 else 'fr'}/{'9' * (i % 2 * 30)}{i}" for i in range(400)]
    rows += [f"http://ok{i}.net/de/{i}" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    known, y = urls.labelled(pages)
    held = np.arange(len(known)) % 4 == 0
    model = urls.UrlModel([u for u, h in zip(known, held, strict=True) if not h], y[~held])
    assert ((model.score([u for u, h in zip(known, held, strict=True) if h]) >= 0.5) == y[held]).mean() > 0.97


def test_url_suffix_rates_come_from_other_folds(monkeypatch):
    """With random labels and a suffix of its own for every URL, fitted features hold no label."""
    seen = []
    monkeypatch.setattr(urls.Boosted, "fit", lambda self, x, y: (seen.append(x), self)[1])
    rng = np.random.default_rng(2)
    known = [f"http://a.s{i}/x" for i in range(300)]
    urls.UrlModel(known, rng.integers(0, 2, 300).astype(float))
    assert len({round(v, 12) for v in seen[0][:, 10].tolist()}) <= urls.FOLDS  # nothing but the other folds' share


def test_url_sample_is_of_distinct_urls(spark):
    rows = ["http://hot.com/en/1"] * 500 + [f"http://x{i}.com/en/{i}" for i in range(60)] + [f"http://y{i}.net/de/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    known, y = urls.labelled(pages, sample=40)
    assert len(set(known)) == len(known) and 10 < (y == 1).sum() < 61 and 10 < (y == 0).sum() < 61
    assert urls.labelled(pages.repartition(5), sample=40)[0] == known


def test_url_awkward(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (None, "http://a.com/en/1"), (2, "x" * 100_000)], "page_id bigint, url string")
    got = urls.judge(pages).collect()
    assert len(got) == 4 and all(r.verdict in ("allow", "block") and not math.isnan(r.score) for r in got)
    assert urls.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
