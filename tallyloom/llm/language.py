"""Language identification of mixed-language text.

Script ranges narrow each word's candidate languages, and a text's to those of its words. Character
n-gram scores per word go into a Viterbi pass with a switching penalty over each text's words, which
labels spans. The pass runs over all texts of a block with the same candidates at once. Where a text
is very long, words are cut into runs: each run's best value between any two end states comes from
one batched pass, only runs are then chained one after another, and a second pass finds the path
within each run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.scratch import written
from tallyloom.llm.textblock import WORDPUNCT, Block, Tokens, append, blocks, freeing, sums
from tallyloom.shipping import ship

UND = "und"
#: Characters of an n-gram, buckets of n-grams, training rows of a language (about), weight of an n-gram's score, penalty of a switch, words of a run.
ORDERS, BUCKET_BITS, SAMPLE, TEMPER, SWITCH, RUN = (1, 2, 3, 4), 15, 1500, 0.35, 6.0, 64
#: Score of a word in a language that its script rules out; least share of a language's letters that makes a script its own.
FOREIGN, OWN = -1e4, 0.005
#: Values between end states of runs that are held at once; what a step costs besides, as transitions of a word.
HELD, STEP = 1 << 22, 2000
#: Languages at most: each is a state, and a row of sums on the driver.
MOST = 1000
#: First code points of script ranges, in order, and the script that begins there.
SCRIPTS = (
    (0x0, "none"), (0x41, "latin"), (0x5B, "none"), (0x61, "latin"), (0x7B, "none"), (0xC0, "latin"), (0x250, "none"), (0x370, "greek"),
    (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "none"), (0x900, "devanagari"), (0x980, "bengali"),
    (0xA00, "indic"), (0xE00, "thai"), (0xE80, "none"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "none"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "none"), (0x3040, "kana"), (0x3100, "none"), (0x3400, "han"), (0xA000, "none"), (0xAC00, "hangul"),
    (0xD7B0, "none"), (0xF900, "han"), (0xFB00, "none"), (0x20000, "han"), (0x30000, "none"),
)
NAMES = sorted({s for _, s in SCRIPTS} - {"none"})
_FROM = np.array([c for c, _ in SCRIPTS])
_BIT = np.array([0 if s == "none" else 1 << NAMES.index(s) for _, s in SCRIPTS], np.int64)
_LEAD = (np.arange(256) & 0xC0) != 0x80
_U = np.uint64


def words(block: Block) -> Tokens:
    """Runs of word characters; ASCII punctuation belongs to no word."""
    t = block.tokens(WORDPUNCT)
    keep = WORDPUNCT[block.u[t.start]] == 2 if len(t.start) else np.zeros(0, bool)
    return Tokens(block, t.start[keep], t.end[keep])


def distinct(block: Block) -> tuple[Block, np.ndarray, Tokens]:
    """The block's distinct words (A-Z as a-z) as a block with a space on either side, each word's number, the words."""
    t = words(block)
    _, first, back = np.unique(t.hashes(lower=True), return_index=True, return_inverse=True)
    n = t.end[first] - t.start[first]
    off = np.concatenate([[0], np.cumsum(n + 2)]).astype(np.int64)
    u = np.full(int(off[-1]), 32, np.uint8)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    u[np.repeat(off[:-1] + 1, n) + inside] = block.u[np.repeat(t.start[first], n) + inside]
    return Block(u, off), back, t


def scripts(vocab: Block) -> np.ndarray:
    """A bit for each script that occurs in each word."""
    wide = np.frombuffer(vocab.u.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero(_LEAD[vocab.u])
    if len(lead) != len(wide):  # not valid UTF-8: decode word by word
        bits = [np.bitwise_or.reduce(_BIT[np.searchsorted(_FROM, np.array([ord(c) for c in vocab.text(i)]), "right") - 1]) for i in range(vocab.n)]
        return np.array(bits, np.int64)
    bit = _BIT[np.searchsorted(_FROM, wide, "right") - 1]
    return np.bitwise_or.reduceat(bit, np.searchsorted(lead, vocab.off[:-1])) if vocab.n else np.zeros(0, np.int64)


def grams(vocab: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of the words' n-grams in word order, and where each word's begin."""
    lead = np.flatnonzero(_LEAD[vocab.u])
    doc = np.searchsorted(vocab.off, lead, "right") - 1
    ends = np.append(lead, len(vocab.u))
    for n in ORDERS:
        if len(lead) >= n:
            at = np.flatnonzero(doc[: len(lead) - n + 1] == doc[n - 1 :])
            h = vocab.hashes(lead[at], ends[at + n], lower=True)
            yield (h >> _U(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(doc[at], np.arange(vocab.n + 1))


class Model:
    """Log-probabilities of buckets by language, scripts of each language, training words of each."""

    def __init__(self, langs: list[str], counts: np.ndarray, script: np.ndarray, n_words: np.ndarray):
        """counts: languages by buckets. script: languages by NAMES."""
        self.langs = langs
        c = counts + 0.5
        self.logp = np.log(c / c.sum(1, keepdims=True)).T.astype(np.float32) if len(langs) else np.zeros((1 << BUCKET_BITS, 0), np.float32)
        share = script / np.maximum(1, script.sum(1, keepdims=True))
        self.allowed = (share >= OWN) @ (1 << np.arange(len(NAMES)))
        self.prior = (n_words / max(1, n_words.sum())).astype(np.float32)

    def candidates(self, script: np.ndarray) -> np.ndarray:
        """Which languages each word may be in by its scripts; all, where it has no letters or none is written so."""
        fits = (script[:, None] & self.allowed[None, :]) != 0
        return fits | ~fits.any(1, keepdims=True)

    def word_scores(self, vocab: Block) -> np.ndarray:
        """Words by languages; FOREIGN where the word's script rules the language out."""
        out = np.zeros((vocab.n, len(self.langs)), np.float32)
        for bucket, first in grams(vocab):
            g = self.logp[bucket]
            for j in range(out.shape[1]):
                out[:, j] += sums(g[:, j].astype(np.float64), first)
        script = scripts(vocab)
        may = self.candidates(script)
        out = TEMPER * (out - np.where(may, out, -np.inf).max(1, keepdims=True)) if out.size else out
        out[~may] = FOREIGN
        out[(script == 0) | ((script[:, None] & self.allowed[None, :]) == 0).all(1)] = 0  # no letters, or a script of none of them: says nothing
        return out


def _step(value: np.ndarray, switch: float) -> np.ndarray:
    """The best value of being in each state (last axis) one word on, before that word's score: staying, or a switch from the best one."""
    return np.maximum(value, value.max(-1, keepdims=True) - switch)


def _across(scores: np.ndarray, start: np.ndarray, size: np.ndarray, switch: float) -> np.ndarray:
    """For runs, longest first: best value of a path from each state just before the run to each at its last row."""
    k = scores.shape[1]
    value = np.where(np.eye(k, dtype=bool), 0, -switch).astype(np.float32)[None].repeat(len(start), 0)
    for t in range(int(size[0])):
        a = np.searchsorted(-size, -t, "left")  # runs longer than t
        value[:a] = (_step(value[:a], switch) if t else value[:a]) + scores[start[:a] + t][:, None, :]
    return value


def _paths(scores: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray | None, last: np.ndarray | None, switch: float, out: np.ndarray) -> None:
    """Writes the best path of each run, longest first, from the state before it to that of its last row; without them, of any."""
    k, steps, rows = scores.shape[1], int(size[0]), np.arange(len(start))
    value = np.zeros((len(start), k), np.float32)
    if before is not None:
        value[np.arange(k)[None] != before[:, None]] = -switch
    back = np.zeros((int(size.sum()), k), np.int8 if k < 128 else np.int16)
    at = np.cumsum(size) - size
    active = np.searchsorted(-size, -np.arange(steps), "left")
    for t in range(steps):
        a = active[t]
        v = value[:a]
        if t:
            best = v.argmax(1)
            move = v[rows[:a], best][:, None] - switch
            back[at[:a] + t] = np.where(v >= move, np.arange(k), best[:, None])
            v = np.maximum(v, move)
        value[:a] = v + scores[start[:a] + t]
    j = value.argmax(1) if last is None else last.copy()
    for t in range(steps - 1, -1, -1):
        a = active[t]
        out[start[:a] + t] = j[:a]
        if t:
            j[:a] = back[at[:a] + t, j[:a]]


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best state of every row; rows first[i] to first[i + 1] are one sequence.

    A path's value is the sum of its scores minus `switch` for each change of state. Sequences are
    gone through side by side, a step of all at a time; where one is so long that steps would cost
    most, in runs, of which k * k values are kept. A word's k states are kept while its path is found.
    """
    total, k = scores.shape
    if not total or not k:
        return np.zeros(total, np.int64)
    counts, out = np.diff(first), np.zeros(total, np.int64)
    if counts.max() * STEP < total * k * k:  # few enough steps to go through whole texts
        order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
        _paths(scores, first[:-1][order], counts[order], None, None, switch, out)
        return out
    n_runs = -(-counts // RUN)
    run_doc = np.repeat(np.arange(len(counts)), n_runs)
    nth = np.arange(len(run_doc)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
    start = first[run_doc] + nth * RUN
    size = np.minimum(RUN, first[run_doc + 1] - start)
    order = np.argsort(-size, kind="stable")
    value = np.empty((len(start), k, k), np.float32)
    for at in np.array_split(order, max(1, -(-len(order) * k * k // HELD))):
        if len(at):
            value[at] = _across(scores, start[at], size[at], switch)
    # Chain runs of each text; a first run begins in any state at no cost.
    head = np.cumsum(n_runs) - n_runs
    longest = int(n_runs.max())
    into, state = np.zeros((len(run_doc), k), np.float32), np.zeros(len(run_doc), np.int64)
    many = np.argsort(-n_runs, kind="stable")
    alive = np.searchsorted(-n_runs[many], -np.arange(longest), "left")
    at_end = np.zeros((len(run_doc), k), np.float32)
    for r in range(longest):
        at = head[many[: alive[r]]] + r
        if r:
            into[at] = at_end[at - 1]
            at_end[at] = (into[at][:, :, None] + value[at]).max(1)
        else:
            at_end[at] = value[at].max(1)
    for r in range(longest - 1, -1, -1):
        docs = many[: alive[r]]
        at = head[docs] + r
        end = n_runs[docs] == r + 1
        state[at[end]] = at_end[at[end]].argmax(1)
        if r:
            state[at - 1] = (into[at] + value[at, :, state[at]]).argmax(1)
    before = np.zeros(len(run_doc), np.int64)
    inner = nth > 0
    before[inner] = state[np.flatnonzero(inner) - 1]
    zero = np.flatnonzero(~inner)
    before[zero] = value[zero, :, state[zero]].argmax(1)
    _paths(scores, start[order], size[order], before[order], state[order], switch, out)
    return out


def narrowed(scores: np.ndarray, may: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best state of every row, where each text's states are only those that some of its words may be in.

    A state that no word of a text may be in is on no best path of it, so this equals viterbi().
    may: rows by states. Texts with the same candidates go together.
    """
    out, n = np.zeros(len(scores), np.int64), np.diff(first)
    if not out.size or not scores.shape[1]:
        return out
    use = np.zeros((len(n), scores.shape[1]), bool)
    full = np.flatnonzero(n)
    use[full] = np.logical_or.reduceat(may, first[full], axis=0)
    packed = np.packbits(use, axis=1)
    _, group = np.unique(packed, axis=0, return_inverse=True)
    for g in np.unique(group[full]).tolist():
        docs = np.flatnonzero((group == g) & (n > 0))
        states = np.flatnonzero(use[docs[0]])
        size = n[docs]
        rows = np.arange(int(size.sum())) + np.repeat(first[docs] - (np.cumsum(size) - size), size)
        out[rows] = states[viterbi(scores[np.ix_(rows, states)], np.concatenate([[0], np.cumsum(size)]), switch)]
    return out


def label(block: Block, model: Model) -> list:
    """lang_pred, score and spans of each text of the block."""
    vocab, back, t = distinct(block)
    bits = scripts(vocab)
    script = bits[back] > 0 if vocab.n else np.zeros(0, bool)
    # a word without letters is open to all, and adds no candidate of its own where the text has another word
    own = model.candidates(bits)
    k, n = len(model.langs), block.n
    lettered = sums(script, t.first) > 0
    may = own[back] & (script | ~np.repeat(lettered, t.counts))[:, None]
    states = narrowed(model.word_scores(vocab)[back], may, t.first)
    doc = t.doc()
    letters = sums(script, t.first)
    size = np.zeros((n, max(1, k)))
    if k:
        np.add.at(size, (doc[script], states[script]), 1)
        best = (size + 1e-6 * model.prior[None]).argmax(1)
        share = size[np.arange(n), best] / np.maximum(1, letters)
    spans = [""] * n
    if k:
        turn = np.ones(len(states), bool)
        turn[1:] = (states[1:] != states[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(turn)
        stop = np.append(at[1:], len(states))
        owner = doc[at]
        cut = np.searchsorted(owner, np.arange(n + 1))
        names, a0 = states[at].tolist(), (at - t.first[owner]).tolist()
        a1 = (stop - t.first[owner]).tolist()
        for i in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
            spans[i] = ",".join(f"{model.langs[names[q]]}:{a0[q]}:{a1[q]}" for q in range(cut[i], cut[i + 1]))
    known = [bool(m) or (m == 0 and any(c.isalpha() for c in block.text(i))) for i, m in enumerate(letters.tolist())]
    pred = [UND if not ok else (model.langs[best[i]] if k else UND) for i, ok in enumerate(known)]
    conf = [float(share[i]) if ok and k else 0.0 for i, ok in enumerate(known)]
    return [pred, conf, [s if ok else "" for s, ok in zip(spans, known, strict=True)]]


@freeing
def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets, scripts and words by language: key is a bucket, then -1 - script, then -100 for words."""
    total: dict[str, tuple[np.ndarray, np.ndarray, list]] = {}
    for b in batches:
        langs = b.column(1).to_pylist()
        for lo, hi, block in blocks(b.column(0)):
            vocab, back, t = distinct(block)
            script, doc = scripts(vocab), t.doc()
            own = np.array([*langs[lo:hi], None], object)[:-1]
            for lang in sorted(set(own.tolist())):
                use = np.bincount(back[(own == lang)[doc]], minlength=vocab.n)
                use[script == 0] = 0
                c, s, w = total.setdefault(lang, (np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(len(NAMES), np.int64), [0]))
                for bucket, first in grams(vocab):
                    c += np.bincount(bucket, np.repeat(use, np.diff(first)), 1 << BUCKET_BITS).astype(np.int64)
                s += [(use * ((script >> i) & 1)).sum() for i in range(len(NAMES))]
                w[0] += int(use.sum())
    for lang, (c, s, w) in total.items():
        at = np.flatnonzero(c)
        key = np.concatenate([at, -1 - np.arange(len(NAMES)), [-100]])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key.astype(np.int32)), pa.array(np.concatenate([c[at], s, w]).astype(np.int64))], names=["lang", "key", "n"])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit on about `sample` rows of each language: those whose key has a hash below the language's threshold.

    The driver gets one sum per language and bucket.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).filter("k is not null and l is not null")
    share = written(rows.groupBy("l").count().select("l", (F.lit(float(sample)) / F.col("count")).alias("share")), "lang-shares")
    if (n := share.count()) > MOST:
        raise ValueError(f"{n} languages; {MOST} at most are learned at once")
    place = F.shiftrightunsigned(F.xxhash64("k"), 11) / float(1 << 53)
    rows = rows.join(F.broadcast(share), "l").filter(place < F.col("share")).select("t", "l")
    rows = written(rows, "lang-sample").coalesce(4)
    got = rows.mapInArrow(_counts, "lang string, key int, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    which = np.array([langs.index(v) for v in got.column("lang").to_pylist()], np.int64)
    k, n = got.column("key").to_numpy(), got.column("n").to_numpy()
    counts, script, seen = np.zeros((len(langs), 1 << BUCKET_BITS)), np.zeros((len(langs), len(NAMES))), np.zeros(len(langs))
    counts[which[k >= 0], k[k >= 0]] = n[k >= 0]
    own = (k < 0) & (k > -100)
    script[which[own], -1 - k[own]] = n[own]
    seen[which[k == -100]] = n[k == -100]
    return Model(langs, counts, script, seen)


def _make(model: Model):
    return partial(label, model=model)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, lang_pred, score (share of its words with letters in that language) and spans.

    spans: lang:first word:word after the last, comma-joined. Null texts and texts without a letter
    are `und`, 0 and no spans. A text in no learned script gets the language learned most from, as
    does a tie. Repeated rows get equal labels. Texts count whole. Without training rows all are
    `und`. An empty table gives no rows. A kept column called lang_pred, score or spans gets `_`
    appended to its name.
    """
    return append(docs, text, partial(_make, model), [("lang_pred", "string"), ("score", "double"), ("spans", "string")], keep)
