"""Byte-level text kernels over Arrow batches.

A block is a run of whole texts held as one byte buffer with offsets. Tokens and hashes of all
texts in a block come from a few numpy passes, with no Python work per word. A block holds about
BLOCK_BYTES, or one text where that is longer, so memory follows the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.shipping import ship

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = mix(np.arange(1, 257, dtype=_U) * _BASE)
_TABLE_LOWER = _TABLE.copy()
_TABLE_LOWER[65:91] = _TABLE[97:123]
#: Byte classes. WORDS: runs of anything but ASCII white space. WORDPUNCT: word characters (2)
#: and punctuation (1) make tokens of their own; bytes of non-ASCII characters count as word.
WORDS = np.ones(256, np.uint8)
WORDS[[32, *range(9, 14)]] = 0
WORDPUNCT = WORDS.copy()
WORDPUNCT[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 2
_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _power(which: str, n: int) -> np.ndarray:
    """Powers of the base (up) or of its inverse (down), at least n of them."""
    if len(_powers[which]) < n:
        p = np.full(max(n, BLOCK_BYTES + 1), _BASE if which == "up" else _INVERSE, _U)
        p[0] = 1
        _powers[which] = np.multiply.accumulate(p)
    return _powers[which][:n]


class Block:
    """Texts of a run of rows: bytes `u`, byte offsets `off` (one more than texts)."""

    def __init__(self, u: np.ndarray, off: np.ndarray):
        self.u, self.off, self.n = u, off, len(off) - 1

    def text(self, i: int) -> str:
        return self.u[self.off[i] : self.off[i + 1]].tobytes().decode("utf-8", "replace")

    def edges(self) -> np.ndarray:
        e = np.zeros(len(self.u) + 1, bool)
        e[self.off] = True
        return e

    def tokens(self, classes: np.ndarray = WORDS) -> Tokens:
        c = classes[self.u]
        if not len(c):
            return Tokens(self, np.zeros(0, np.int64), np.zeros(0, np.int64))
        turn = self.edges()
        turn[1:-1] |= c[1:] != c[:-1]
        start = np.flatnonzero(turn[:-1] & (c > 0))
        end = np.flatnonzero(turn[1:] & (c > 0)) + 1
        return Tokens(self, start, end)

    def hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = False, skip: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each byte range; equal bytes, equal hash, wherever they stand.

        lower: A-Z as a-z. skip: byte classes, bytes of class 0 count as absent from the sum.
        """
        if not len(start):
            return np.zeros(0, _U)
        v = (_TABLE_LOWER if lower else _TABLE)[self.u]
        v *= _power("up", len(v))
        total = np.zeros(len(v) + 1, _U)
        np.cumsum(v, out=total[1:])
        h = total[end] - total[start]
        h *= _power("down", len(v) + 1)[start]
        return mix(h ^ ((end - start).astype(_U) << _U(40)))


class Tokens:
    """Byte ranges of tokens in text order; `first[i]` is the first token of text i."""

    def __init__(self, block: Block, start: np.ndarray, end: np.ndarray):
        self.block, self.start, self.end = block, start, end
        self.first = np.searchsorted(start, block.off)
        self.counts = np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return self.block.hashes(self.start, self.end, lower)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.block.n), self.counts)


def windows(tokens: Tokens, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-token windows inside one text, and the index of each one's first token."""
    n = len(h)
    if n < k:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    inside = np.ones(n - k + 1, bool)
    for j in range(1, k):  # a window must not start so late that it reaches the next text
        late = tokens.first[1:-1] - j
        inside[late[(late >= 0) & (late < len(inside))]] = False
    at = np.flatnonzero(inside)
    v = h[at].copy()
    for j in range(1, k):
        v = v * _BASE + h[at + j]
    return mix(v), at


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over consecutive ranges bounded by `first`; empty ranges give 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def as_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) is False:
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    u = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return u[off[0] : off[-1]], off - off[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """The column's texts in blocks: first row, row after the last, block."""
    u, off = as_texts(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, hi, Block(u[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def trim() -> None:
    """Give memory that nothing uses back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def freeing(f: Callable) -> Callable:
    """f, a generator over Arrow batches, which gives memory back to the system when a task ends.

    Workers live on between tasks; what their allocators would keep counts against the executor.
    """

    @wraps(f)
    def run(*args, **kwargs):
        try:
            yield from f(*args, **kwargs)
        finally:
            trim()

    return run


def arrow_type(spec: str) -> pa.DataType:
    return to_arrow_schema(T._parse_datatype_string(f"x {spec}")).field(0).type


@freeing
def _appended(batches: Iterable[pa.RecordBatch], make, text: str, keep: list[str], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    work = make()
    for batch in batches:
        for lo, hi, block in blocks(batch.column(batch.schema.get_field_index(text))):
            got = work(block)
            own = [batch.column(batch.schema.get_field_index(k)).slice(lo, hi - lo) for k in keep]
            yield pa.RecordBatch.from_arrays([*own, *(v if isinstance(v, pa.Array) else pa.array(v, t) for v, (_, t) in zip(got, fields, strict=True))], names=[*keep, *(f for f, _ in fields)])


def freed(names: Sequence[str], taken: Iterable[str]) -> list[str]:
    """The names, those among `taken` (whatever their case) with `_` appended until none clashes."""
    used, out = {t.lower() for t in taken} | {n.lower() for n in names}, []
    own = {t.lower() for t in taken}
    for n in names:
        if n.lower() in own:
            while n.lower() in used:
                n += "_"
            used.add(n.lower())
        out.append(n)
    return out


def append(df: DataFrame, text: str, make: Callable[[], Callable[[Block], list]], fields: list[tuple[str, str]], keep: list[str] | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Add columns computed from the text column, block by block, without a shuffle.

    make() runs once per task and returns a function from a Block to one value list per field.
    keep: the columns of df that stay (all by default). One of them that has the name of a new
    column, or of one in `also` that the caller is to add, stays under that name with `_` appended.
    """
    ship(df.sparkSession)
    keep = list(df.columns if keep is None else keep)
    src = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate([*keep, text])])
    new = [f for f, _ in fields]
    names, at = [f"c{i}" for i in range(len(keep))], f"c{len(keep)}"
    schema = T.StructType([src.schema[k] for k in names] + [T.StructField(f, T._parse_datatype_string(t)) for f, t in fields])
    out = src.mapInArrow(partial(_appended, make=make, text=at, keep=names, fields=[(f, arrow_type(t)) for f, t in fields]), schema)
    return out.toDF(*freed(keep, [*new, *also]), *new)
