"""Vectorised text kernels over Arrow string buffers: words, hashes, shingles.

Everything works on the UTF-8 bytes of one record batch.  Intermediate arrays of eight bytes a
text byte exist for `CHUNK` bytes at a time only; what is kept is a few numbers a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
MASK = (1 << 64) - 1
P = 0x9E3779B97F4A7C15 | 1
P_INV = pow(P, -1, 1 << 64)
Q = 0xD1B54A32D192ED03


def word_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of the bytes that belong to words."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Digits, letters and every byte of a non-ASCII character.
ALNUM = word_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but ASCII white space.
NON_SPACE = ~word_class((0x09, 0x0D), (0x20, 0x20))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def _byte_codes() -> np.ndarray:
    """One odd 64-bit code a byte, equal for both cases of a letter."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(P)
    return (mix(x) | np.uint64(1))[LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public MurmurHash3: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


CODES = _byte_codes()


def _powers(base: int, n: int = CHUNK + 1) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Powers of P and of its inverse, made once in each process that hashes words.
POWERS: dict[int, np.ndarray] = {}


def powers() -> tuple[np.ndarray, np.ndarray]:
    if not POWERS:
        POWERS.update({P: _powers(P), P_INV: _powers(P_INV)})
    return POWERS[P], POWERS[P_INV]


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string column and the n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


class Words:
    """The words of a batch: byte spans, 64-bit hashes (case of A-Z folded), first word of each text."""

    def __init__(self, data: np.ndarray, off: np.ndarray, table: np.ndarray = ALNUM):
        inside = table[data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        if len(inside):
            before[0] = after[-1] = False
            edges = off[(off > 0) & (off < len(data))]
            before[edges], after[edges - 1] = False, False
        self.data = data
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, off)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        return self.hash_spans(self.starts, self.ends)

    def prefixes(self, size: int) -> np.ndarray:
        """Hashes of the first `size` bytes of every word (of all, if it has fewer), unlike those of whole words."""
        return mix(self.hash_spans(self.starts, np.minimum(self.ends, self.starts + size)) + np.uint64(size))

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of spans of bytes that ascend and don't overlap."""
        out = np.empty(len(starts), np.uint64)
        up, down = powers()
        i = 0
        while i < len(out):
            base = starts[i]
            j = int(np.searchsorted(ends, base + CHUNK, "right"))
            if j <= i:  # one word longer than a chunk: piece by piece
                total = 0
                for at in range(int(base), int(ends[i]), CHUNK):
                    piece = CODES[self.data[at : min(at + CHUNK, int(ends[i]))]]
                    total += int((piece * up[: len(piece)]).sum(dtype=np.uint64)) * pow(P, at - int(base), 1 << 64)
                out[i] = np.uint64(total & MASK)
                i += 1
                continue
            sums = np.zeros(int(ends[j - 1] - base) + 1, np.uint64)
            np.cumsum(CODES[self.data[base : ends[j - 1]]] * up[: len(sums) - 1], out=sums[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (sums[b] - sums[a]) * down[a]
            i = j
        return mix(out)

    def text(self, i: int) -> bytes:
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()

    def texts(self, i: int, n: int) -> bytes:
        return b" ".join(self.text(k) for k in range(i, i + n))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self, word: np.ndarray) -> np.ndarray:
        """The text that holds each given word (texts without words hold none)."""
        return np.searchsorted(self.first, word, "right") - 1


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Unmixed hash of every run of n consecutive words, runs across texts included."""
    out = hashes[: max(0, len(hashes) - n + 1)].copy()
    for k in range(1, n):
        out *= np.uint64(Q)
        out += hashes[k : k + len(out)]
    return out


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of every text, in order, and each text's first one.

    A text of fewer words has its whole sequence as one; a text without words has none.
    """
    counts = words.counts()
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    first = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(int(first[-1]), np.uint64)
    whole = windows(words.hashes, n)
    full = counts >= n
    if full.any():
        # position of every full shingle in the word array: its rank in the text past the text's first word
        which = np.repeat(np.flatnonzero(full), made[full])
        rank = np.arange(len(which)) - np.repeat(np.cumsum(made[full]) - made[full], made[full])
        out[first[which] + rank] = whole[words.first[which] + rank]
    for length in range(1, n):
        short = np.flatnonzero(counts == length)
        if len(short):
            value = np.full(len(short), length, np.uint64)
            for k in range(length):
                value = value * np.uint64(Q) + words.hashes[words.first[short] + k]
            out[first[short]] = value
    return mix(out), first


def distinct(values: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct values of every text."""
    return [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Parts of a batch whose texts hold about `limit` bytes, at least one row each."""
    if not batch.num_rows:
        return
    _, off = string_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
