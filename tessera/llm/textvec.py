"""Vectorised words over Arrow string buffers.

Operators that look at every word of every text work on the UTF-8 bytes of an Arrow
batch with numpy: word edges come from a byte-class table, word hashes from prefix sums
of a polynomial hash, so no Python object is made per word.  All word classes used here
separate words by ASCII bytes only, so bytes >= 0x80 never split and byte rules equal
code-point rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20  # text bytes handled at once; temporaries are some 60 bytes per byte


def _stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random uint64 values (splitmix64 of seed, seed+1, ...)."""
    return mix(np.arange(n, dtype=U64) + U64(seed << 32))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of uint64 whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


BYTE_CODE = _stream(256, 7)
BASE = U64(0x5851F42D4C957F2D)  # odd, so it has an inverse modulo 2^64
BASE_INV = U64(pow(int(BASE), -1, 1 << 64))
_POW: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_CODE = BYTE_CODE[LOWER]  # codes of the lower-cased bytes
#: word characters [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z: digits, letters, all non-ASCII
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: word characters [^\x20\x09-\x0D]
NONSPACE = np.ones(256, bool)
NONSPACE[[32, 9, 10, 11, 12, 13]] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["up"]) < n:
        size = max(1 << (n - 1).bit_length(), CHUNK_BYTES)
        for name, base in (("up", BASE), ("down", BASE_INV)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps, dtype=U64)
    return _POW["up"], _POW["down"]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty, offsets start at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]: off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slice batches so that each holds at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffers(batch.column(text))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop


@dataclass
class Words:
    """Words of a chunk: row number, byte span and hash of each, and the word count per row."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    per_row: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each row's first word, with the total at the end."""
        return np.concatenate([[0], np.cumsum(self.per_row)])


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of maximal runs of True that do not cross a row's edge."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = member.copy()
    start[1:] &= ~member[:-1] | edge[1:n]
    end = member.copy()
    end[:-1] &= ~member[1:] | edge[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """64-bit hash of each byte span (start < end), equal for equal bytes wherever they stand."""
    up, down = _powers(len(data) + 1)
    if not len(start):
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        sums = code[data]  # in place from here: arrays of eight bytes a byte of text cost more to make than to fill
        sums *= up[: len(data)]
        np.cumsum(sums, out=sums)
        own = sums[end - 1]
        before = sums[start - 1]
        before[start == 0] = 0
        own -= before
        own *= down[start]
        own += (end - start).astype(U64)
        return mix(own)


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = ALNUM, lower: bool = True) -> Words:
    """Words of every row: maximal runs of ``member`` bytes; hashes are of the A-Z lower-cased bytes."""
    start, end = runs(member[data], offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, start, end, span_hash(data, start, end, LOWER_CODE if lower else BYTE_CODE),
                 np.bincount(row, minlength=len(offsets) - 1).astype(np.int64))


def hash_words(texts: list[str], member: np.ndarray = ALNUM) -> list[np.ndarray]:
    """Word hashes of a few texts."""
    w = words(*text_buffers(pa.array(texts, pa.large_string())), member)
    return np.split(w.hash, w.first[1:-1]) if len(texts) else []


def ngram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values (len(h) - n + 1 of them, rows not regarded)."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, U64)
    if not m:
        return out
    place = _stream(n, 11) | U64(1)
    with np.errstate(over="ignore"):
        for k in range(n):
            out += mix(h[k: k + m] + U64(k)) * place[k]
    return mix(out + U64(n))


def within_row(w: Words, n: int) -> np.ndarray:
    """True for each n-gram start (as in ``ngram_hash``) whose words stand in one row."""
    m = max(0, len(w.row) - n + 1)
    return w.row[:m] == w.row[len(w.row) - m:] if m else np.zeros(0, bool)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte, one more entry than bytes."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def in_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the values in ascending order, the values so ordered) of whole numbers, none negative.

    Value and place are sorted as one number, far quicker than ``argsort``: small values whole, hashes by their
    leading bits.  Hashes that agree in those and not in the rest are rare; then all are sorted in full.
    """
    if len(x) < 2:
        return np.arange(len(x)), x
    bits, place, whole = U64((len(x) - 1).bit_length()), np.arange(len(x), dtype=U64), x.astype(U64, copy=False)
    small = int(whole.max()) >> (64 - int(bits)) == 0
    both = whole << bits if small else whole >> bits << bits
    both |= place
    both.sort()
    both &= (U64(1) << bits) - U64(1)
    order = both.view(np.int64)
    ordered = x[order]
    if not small and (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(x)
        ordered = x[order]
    return order, ordered


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, a place of each, which of them stands at each place) of values as in ``in_order``."""
    order, ordered = in_order(x)
    first = np.ones(len(x), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(first) - 1
    return ordered[first], order[first], back


def counted(x: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, how often each stands or the sum of its weights)."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    if weight is None:
        x = np.sort(x)
    else:
        order = np.argsort(x, kind="stable")
        x, weight = x[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return x[first], (np.diff(np.append(first, len(x))) if weight is None else np.add.reduceat(weight, first)).astype(np.int64)
