"""Personal data: exact patterns, and a skip-chain CRF that makes labels agree across a document.

Nodes of a document's graph are strings that look like personal data, among them every match of
the exact patterns (those labels are clamped). Neighbouring nodes share a chain potential. Nodes
whose text is the same or ends in the same digits share a skip potential, however far apart they
stand. Loopy sum-product message passing, until the messages stand still, gives each node's label;
a node that the patterns left out but that the graph labels becomes an added span.

All weights are fitted here together, by the pseudo-likelihood of the labels that the patterns give
in a bounded sample of documents. A look-alike that repeats a match has no known label: it and its
potentials are left out of the fit, so that the patterns' own misses are not learned as NONE. Of
some nodes all features are hidden but whether they are addresses, so that the potentials have to
tell the rest. The executors send sums; no document reaches the driver.
"""

from __future__ import annotations

import ast
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.textblock import Block, append, blocks, freeing
from tallyloom.shipping import ship

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Documents that the weights are fitted on, about; change of a message that counts as none; characters between neighbours on the chain.
SAMPLE, STILL, NEAR = 20_000, 1e-4, 200
#: One in HIDE nodes is fitted without its features; steps and ridge of the fit; kinds of cases (a node with its neighbours) at most.
HIDE, STEPS, RIDGE, CASES = 3, 300, 1e-3, 200_000
#: Digits at its end that make two numbers similar.
TAIL = 7
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: What may be personal data beyond the patterns: an address without a dotted domain or with its signs spelt out, a longer number.
_LOOSE = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,64}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,64})+|\+?[0-9(](?:[ ().-]{0,2}[0-9]){6,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def exact(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, leftmost and non-overlapping within a kind."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= len(d := _DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shown(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def nodes(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) in text order: the base spans, and look-alikes that touch none (NONE)."""
    out, b = [(s, e, k) for s, k, e in base], 0
    spans = sorted((s, e) for s, _, e in base)
    for m in _LOOSE.finditer(text):
        while b < len(spans) and spans[b][1] <= m.start():
            b += 1
        if b == len(spans) or spans[b][0] >= m.end():
            out.append((m.start(), m.end(), NONE))
    return sorted(out)


FEATURES = 14
#: Only an address can be an email, and an address can be nothing else: what is added to the weights of either.
_BARRED = np.array([[0.0, *[-30.0] * (NONE - 1), 0.0], [-30.0, *[0.0] * NONE]])


def features(text: str) -> list[float]:
    """Shape of a node's text, without its place."""
    d = _DIGITS.sub("", text)
    n = len(d)
    return [float(v) for v in (
        1.0, "@" in text or "at)" in text or "at]" in text, text.startswith("("), text.startswith("+"), text.count(".") == 3, text.count(".") / 4, "(" in text, " " in text,
        "-" in text, n / 10, 9 <= n <= 11, 12 <= n <= 15, n > 15, 12 <= n <= 19 and luhn(d),
    )]


def links(texts: list[str], starts: list[int], kinds: list[int]) -> list[tuple[int, int, int]]:
    """Edges (node, later node, 0 chain or 1 skip) of one document, at most five per node besides those of a key's first match.

    Equal or similar nodes are linked as a chain of repeats, never all with all, and look-alikes
    also with the first match of a pattern that they repeat, before or after them.
    """
    out, last, first, keyed = [], {}, {}, []
    for i, t in enumerate(texts):
        if i and starts[i] - starts[i - 1] <= NEAR:
            out.append((i - 1, i, 0))
        d = _DIGITS.sub("", t)
        keys = {("same", t.lower())}
        if len(d) >= TAIL:
            keys |= {("tail", d[-TAIL:])}
        for j in {last[k] for k in keys if k in last}:
            out.append((j, i, 1))
        last |= dict.fromkeys(keys, i)
        if kinds[i] != NONE:
            first = dict.fromkeys(keys, i) | first
        keyed.append(keys)
    there = {(i, j) for i, j, kind in out if kind}
    for i, keys in enumerate(keyed):
        if kinds[i] == NONE:
            anchors = {(min(i, j), max(i, j)) for j in {first[k] for k in keys if k in first}}
            out += [(a, b, 1) for a, b in sorted(anchors - there)]
    return out


def shown_features(x: list[float], i: int, text: str) -> list[float]:
    """A node's features in the fit: of one node in HIDE only the first ones, which say whether it is an address."""
    return x if zlib.crc32(f"{i}:{text}".encode()) % HIDE else [*x[:2], *[0.0] * (FEATURES - 2)]


def cases(x: list[list[float]], texts: list[str], kinds: list[int], edges: list[tuple[int, int, int]]) -> list[tuple]:
    """(features, label, neighbours by edge kind and label) of each node of a document whose label is known.

    Known are the matches, and as NONE the look-alikes that repeat no match. Neighbours without a
    known label do not count.
    """
    repeats = {j if kinds[i] != NONE else i for i, j, kind in edges if kind and (kinds[i] == NONE) != (kinds[j] == NONE)}
    near = [[0] * (3 * (NONE + 1)) for _ in kinds]  # what comes before on the chain, after on it, and skips
    for i, j, kind in edges:
        if i not in repeats and j not in repeats:
            near[j][(2 if kind else 0) * (NONE + 1) + kinds[i]] += 1
            near[i][(2 if kind else 1) * (NONE + 1) + kinds[j]] += 1
    return [(tuple(shown_features(x[i], i, texts[i])), k, tuple(near[i])) for i, k in enumerate(kinds) if i not in repeats]


class Crf:
    """Unary weights by kind, chain potentials (label before, label after) and symmetric skip potentials."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, near: np.ndarray, n: np.ndarray) -> Crf:
        """Maximise the pseudo-likelihood of cases: features, label, neighbours and how many are equal. Without any nothing is ever added."""
        k = NONE + 1
        prior = np.zeros((FEATURES + 3 * k, k))
        prior[0, NONE] = 2  # where nothing is known, no personal data
        z = np.concatenate([x.reshape(-1, FEATURES), near.reshape(-1, 3 * k)], 1)
        w, one, weight = prior.copy(), np.eye(k)[y.astype(np.int64)], n / max(1, n.sum())
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, 1 + (STEPS if len(y) else 0)):
            q = z @ w
            q += np.where(x[:, 1:2] > 0, *_BARRED) if len(x) else 0
            p = np.exp(q - q.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = z.T @ (weight[:, None] * (p - one)) + RIDGE * (w - prior)
            # one table serves both directions of an edge: chain[a, b] as seen from b and from a, skip[a, b] from either
            c = g[FEATURES : FEATURES + k] + g[FEATURES + k : FEATURES + 2 * k].T
            g[FEATURES : FEATURES + k], g[FEATURES + k : FEATURES + 2 * k] = c, c.T
            g[FEATURES + 2 * k :] += g[FEATURES + 2 * k :].T.copy()
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(w[:FEATURES], w[FEATURES : FEATURES + k], w[FEATURES + 2 * k :])

    def labels(self, x: np.ndarray, known: np.ndarray, edges: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The likeliest label of each node; nodes with a known kind keep it. doc: the document of each node."""
        return self.beliefs(x, known, edges, doc).argmax(1)

    def beliefs(self, x: np.ndarray, known: np.ndarray, edges: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Logs of each node's marginals but for a constant, exact where the graph has no loops.

        Only an address can be an email, and an address can be nothing else. A message is passed on
        for as long as it, or one that it depends on, changes. Messages that swing are damped ever
        more, from a round on that any label has crossed the document by.
        """
        k = NONE + 1
        u = x @ self.unary + np.where(x[:, 1:2] > 0, *_BARRED)
        u -= u.max(1, keepdims=True)
        fixed = known < NONE
        u[fixed] = -30
        u[fixed, known[fixed]] = 0
        total = u.copy()
        if len(edges):
            # both directions of each edge; messages in logs
            src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            half, m = len(edges), np.zeros((2 * len(edges), k))
            pot = np.where((edges[:, 2] == 1)[:, None, None], self.skip[None], self.chain[None])
            pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
            calm, turn, at = 100 + 2 * np.bincount(doc)[doc[src]], 0, np.arange(2 * half)
            while len(at):
                inner = (total[src[at]] - m[(at + half) % (2 * half)])[:, :, None] + pot[at]
                top = inner.max(1)
                new = top + np.log(np.exp(inner - top[:, None, :]).sum(1))
                step = 0.5 * 0.9 ** np.maximum(0, turn - calm[at])
                change = step[:, None] * (new - new.max(1, keepdims=True) - m[at])
                m[at] += change
                np.add.at(total, dst[at], change)
                moved = at[np.abs(change).max(1) > STILL]
                due = np.zeros(len(u), bool)
                due[dst[moved]] = True
                due = due[src]
                due[moved] = True
                at, turn = np.flatnonzero(due), turn + 1
        return total


_MARK = np.isin(np.arange(256), list(b"0123456789@[("))


def _marked(block: Block) -> np.ndarray:
    """Texts that can hold a node at all."""
    hit = np.zeros(len(block.u) + 1, np.int64)
    np.cumsum(_MARK[block.u], out=hit[1:])
    return np.flatnonzero(hit[block.off[1:]] > hit[block.off[:-1]])


def graph(text: str) -> tuple[list, list, list, list]:
    """Base spans, nodes, their texts, edges."""
    base = exact(text)
    found = nodes(text, base)
    texts = [text[s:e] for s, e, _ in found]
    return base, found, texts, links(texts, [s for s, _, _ in found], [k for _, _, k in found])


CASE_FIELDS = "x string, y int, near string, n bigint"


@freeing
def _cases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal cases of a batch once, with their number; what a batch can send is bounded by its own texts."""
    for b in batches:
        for _, _, block in blocks(b.column(0)):
            seen = Counter()
            for i in _marked(block).tolist():
                _, found, texts, edges = graph(block.text(i))
                if found:
                    seen.update((repr(x), y, repr(near)) for x, y, near in cases([features(t) for t in texts], texts, [k for _, _, k in found], edges))
            cols = list(zip(*((*case, n) for case, n in seen.items()), strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())], names=["x", "y", "near", "n"])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, most: int = CASES) -> Crf:
    """Fit on about `sample` documents, those whose key has a hash below a threshold.

    Nodes that are alike in features, label and neighbours are one case; of more than `most` cases
    the commonest count.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).filter("k is not null")
    share = sample / max(1, rows.count())
    rows = rows.filter(F.shiftrightunsigned(F.xxhash64("k"), 11) / float(1 << 53) < share).select("t")
    found = rows.mapInArrow(_cases, CASE_FIELDS).groupBy("x", "y", "near").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "x", "y", "near").limit(most).collect()
    x, near = (np.array([ast.literal_eval(r[c]) for r in found], float) for c in ("x", "near"))
    return Crf.fit(x.reshape(-1, FEATURES), np.array([r.y for r in found]), near, np.array([r.n for r in found], float))


def annotate(block: Block, crf: Crf) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text of the block, as (start, kind, end)."""
    out: list[tuple[list, list]] = [([], [])] * block.n
    x, known, edges, of = [], [], [], []
    for i in _marked(block).tolist():
        base, found, texts, own = graph(block.text(i))
        if base:
            out[i] = base, base
        if any(k == NONE for _, _, k in found):
            edges += [(a + len(x), b + len(x), kind) for a, b, kind in own]
            x += map(features, texts)
            known += [k for _, _, k in found]
            of += [(i, s, e) for s, e, _ in found]
    if x:
        labels = crf.labels(np.array(x, float), np.array(known), np.array(edges, np.int64).reshape(-1, 3), np.array([i for i, _, _ in of]))
        added = defaultdict(list)
        for (i, s, e), k, was in zip(of, labels.tolist(), known, strict=True):
            if was == NONE and k != NONE:
                added[i].append((s, k, e))
        for i, spans in added.items():
            out[i] = out[i][0], sorted(out[i][0] + spans)
    return out


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans by the first one's."""
    parts, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            parts += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*parts, text[at:]])


FIELDS = [*((f"n_{k}", "bigint") for k in KINDS), ("base_sha256", "string"), ("spans", "string")]


def _digests(crf: Crf):
    def work(block: Block) -> list:
        found = annotate(block, crf)
        counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(NONE)]
        return [*counts, [hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found], [shown(spans) for _, spans in found]]

    return work


def _masks(crf: Crf):
    def work(block: Block) -> list:
        found = annotate(block, crf)
        texts = [mask(block.text(i), spans) if spans else None for i, (_, spans) in enumerate(found)]
        return [texts, [len(spans) for _, spans in found]]

    return work


def find(docs: DataFrame, crf: Crf, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, base counts by kind, base_sha256 and all spans of every row.

    Offsets are code points. Null and empty texts have no spans (the digest of an empty string).
    Each document is its own graph, so repeated rows get equal spans. Texts count whole; one of n
    look-alikes has at most 5 n edges. An empty table gives no rows. A kept column that has the name
    of a new one gets `_` appended.
    """
    return append(docs, text, partial(_digests, crf), FIELDS, keep)


def redact(docs: DataFrame, crf: Crf, text: str = "text") -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets; other rows and columns as they were.

    Null and empty texts stay as they are. Overlapping spans become one mark, the first one's.
    Repeated rows are masked alike; very long texts count whole; an empty table stays empty; columns
    of any names stay.
    """
    own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # names of docs may clash with the added ones
    at = f"c{docs.columns.index(text)}"
    out = append(own, at, partial(_masks, crf), [("masked", "string"), ("found", "bigint")])
    return out.withColumn(at, F.coalesce("masked", at)).drop("masked", "found").toDF(*docs.columns)
