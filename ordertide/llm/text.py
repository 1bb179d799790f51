"""Arrow string columns as flat byte arrays: words, lines and their hashes, without a row loop.

A chunk is a run of whole documents. Words are maximal runs of bytes outside
``\\x20 \\x09-\\x0D``; hashes are polynomials over the bytes modulo 2**64, mixed.
"""

from functools import cached_property

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SHINGLE = 5
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(h):
    """A bijection of 64-bit values that spreads every bit (the splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_KNOWN_POWERS = {}


def powers(base, n):
    """base**0 .. base**(n-1) modulo 2**64, not to be changed; those for a chunk are kept by the process."""
    n = max(n, 1)
    known = _KNOWN_POWERS.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    out = np.full(n, base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    out.setflags(write=False)
    if n <= CHUNK_BYTES + 1:
        _KNOWN_POWERS[base] = out
    return out


def flat(column):
    """Bytes and document offsets of a string column; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch, column="text", most=CHUNK_BYTES):
    """(rows from, rows to, Chunk) over a record batch, each of at most ``most`` bytes or one document."""
    data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, Chunk(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


class Chunk:
    def __init__(self, data, offsets):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1

    @cached_property
    def solid(self):
        return ~SPACE[self.data]

    def per_doc(self, flags):
        """How many flags are set in each document; flags are by byte."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def words(self):
        """Starts, ends and documents of all words, in order."""
        if not len(self.data):
            none = np.zeros(0, np.int64)
            return none, none, none
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], self.solid))
        after = np.concatenate((self.solid, [False]))
        starts = np.flatnonzero(after & (~before | edge))
        ends = np.flatnonzero(before & (~after | edge))
        return starts, ends, np.repeat(np.arange(self.n), np.diff(np.searchsorted(starts, self.offsets)))

    def prefix(self, fold=False):
        out = np.zeros(len(self.data) + 1, np.uint64)
        values = out[1:]
        values[:] = FOLD[self.data] if fold else self.data
        values += np.uint64(1)
        values *= powers(_BASE, len(values))[: len(values)]
        np.cumsum(values, out=values)
        return out

    def hashes(self, starts, ends, prefix):
        """A 64-bit hash of each byte span."""
        down = powers(_BASE_INVERSE, len(self.data) + 1)[starts]
        return mix((prefix[ends] - prefix[starts]) * down + (ends - starts).astype(np.uint64))

    def windows(self, size, prefix):
        """``hashes`` of the ``size`` bytes from each position that has them."""
        sums = prefix[size:] - prefix[:-size]
        sums *= powers(_BASE_INVERSE, len(self.data) + 1)[: len(sums)]
        sums += np.uint64(size)
        return mix(sums)


def shingles(words, docs, n_docs, size=SHINGLE):
    """Hashes of the ``size``-word windows and their documents.

    A document with fewer words, but at least one, has its whole sequence as one window.
    """
    count = np.bincount(docs, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    acc = np.zeros(len(words), np.uint64)
    room = first[docs] + count[docs] - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
    for k in range(size):
        here = np.flatnonzero(room > k)
        acc[here] += mix(words[here + k] + np.uint64(k + 1)) * np.uint64(2 * k + 3)
    keep = (room >= size) | ((count[docs] < size) & (np.arange(len(words)) == first[docs]))
    short = np.minimum(count, size).astype(np.uint64)
    return mix(acc[keep] + short[docs[keep]]), docs[keep]


def sort_each(values, docs):
    """The values of each document, which lie together, in ascending order."""
    out = values.copy()
    edges = [0, *(np.flatnonzero(np.diff(docs)) + 1).tolist(), len(out)]
    for a, b in zip(edges, edges[1:]):
        out[a:b].sort()
    return out


def distinct(hashes, docs):
    """Sorted distinct hashes of each document: (hashes, documents); a document's hashes lie together."""
    h = sort_each(hashes, docs)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (docs[1:] != docs[:-1])
    return h[new], docs[new]
