"""Periodic runs of words: maximal stretches that repeat with one period, and texts without the repeats.

A run is a stretch of words with smallest period q and a length of at least ``LEAST`` and
``TIMES`` * q that no neighbouring word extends. Each text is judged alone, in one pass without
a shuffle:

1. Every word of a run lies in a window of ``WINDOW`` = LEAST - LEAST / TIMES words that occurs twice in
   the text. Hashes of all windows, made by doubling, give the covered stretches; nothing outside
   of them can be in a run, and a run never leaves its stretch. False hits only widen a stretch.
2. A suffix automaton of the stretch is built over exact word numbers. Its suffix links form a
   tree in which the path from the root to the state of a prefix holds all suffixes of the prefix.
3. Words are appended in order. ``access`` exposes the path of each prefix as one preferred path
   of a link-cut tree and recolours it with the new end. The old path segments on it name, for
   the longest suffix of each, where it ended last: if the distance p of the two ends is at most the
   suffix's length l, the stretch of l + p words has smallest period p and nothing on its left extends it
   (a square). It is a run where the next word breaks the period. All segments of all
   words are O(n log n).

Defined cases: null and empty texts and texts without a word have no runs and an empty collapsed
text; repeated rows are judged alike; a text of any length is read whole, memory grows with its
longest covered stretch; null ids are kept; an empty table gives an empty result; columns other
than doc_id and text are ignored.
"""

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Fixed values of the contract: words and periods that a run has at least.
LEAST, TIMES = 24, 3
#: Of a run's words, so many repeat at a distance of one period at least.
WINDOW = LEAST - LEAST // TIMES

_STEP = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start:bigint,length:bigint,period:bigint>"


def covered(words):
    """(from, to) of the maximal stretches covered by windows that occur twice; words are numbers."""
    h, width = (words.astype(np.uint64) + np.uint64(1)) * _STEP, 1
    h ^= h >> np.uint64(29)
    while width < WINDOW:
        h = h[:-width] * (_STEP + np.uint64(2 * width)) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(same):
        return []
    twice = np.zeros(len(words) + 2, np.int32)
    at = np.unique(np.concatenate((order[same], order[same + 1])))
    twice[at + 1] += 1
    twice[at + 1 + WINDOW] -= 1
    inside = np.cumsum(twice) > 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def automaton(words):
    """Suffix links, longest lengths, and the state of each prefix; state 0 is the empty word."""
    link, length, then, prefix = [-1], [0], [{}], []
    last = 0
    for w in words:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        then.append({})
        p = last
        while p >= 0 and w not in then[p]:
            then[p][w] = new
            p = link[p]
        if p >= 0:
            q = then[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                split = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                then.append(then[q].copy())
                while p >= 0 and then[p].get(w) == q:
                    then[p][w] = split
                    p = link[p]
                link[q] = link[new] = split
        prefix.append(new)
        last = new
    return link, length, prefix


class PathColours:
    """A link-cut tree over fixed parents whose preferred paths have one colour each.

    Paths are splay trees by depth; the root of a splay tree holds the colour of its path, and its
    ``up`` is the path's parent.
    """

    def __init__(self, parents):
        self.up = list(parents)
        self.shallow = [-1] * len(parents)
        self.deep = [-1] * len(parents)
        self.colour = [-1] * len(parents)

    def splay(self, x):
        """Makes x the root of its splay tree."""
        up, shallow, deep = self.up, self.shallow, self.deep
        old = None
        while True:
            p = up[x]
            if p < 0 or (shallow[p] != x and deep[p] != x):
                break
            g = up[p]
            first = shallow[p] == x
            if g >= 0 and (shallow[g] == p or deep[g] == p):
                if first == (shallow[g] == p):
                    self._rotate(p)
                else:
                    self._rotate(x)
                old = g
            else:
                old = p
            self._rotate(x)
        if old is not None:
            self.colour[x] = self.colour[old]

    def _rotate(self, x):
        up, shallow, deep = self.up, self.shallow, self.deep
        p = up[x]
        g = up[p]
        if shallow[p] == x:
            child = shallow[p] = deep[x]
            deep[x] = p
        else:
            child = deep[p] = shallow[x]
            shallow[x] = p
        if child >= 0:
            up[child] = p
        up[p] = x
        up[x] = g
        if g >= 0:
            if shallow[g] == p:
                shallow[g] = x
            elif deep[g] == p:
                deep[g] = x

    def access(self, node, colour):
        """Gives the path from the root to ``node`` one colour; (deepest node, old colour) of its segments."""
        up, deep, colours = self.up, self.deep, self.colour
        out, below, x = [], -1, node
        while x >= 0:
            self.splay(x)
            out.append((x, colours[x]))
            if deep[x] >= 0:
                colours[deep[x]] = colours[x]
            deep[x] = below
            below, x = x, up[x]
        self.splay(node)
        colours[node] = colour
        return out


def runs_of(words, offset=0):
    """(start, length, period) of all runs of a list of numbers, by their ends."""
    link, length, prefix = automaton(words)
    paths = PathColours(link)
    n, out = len(words), []
    for end, state in enumerate(prefix):
        for node, before in paths.access(state, end):
            if before < 0:
                continue
            period, suffix = end - before, length[node]
            if period > suffix:  # no square
                continue
            total = suffix + period
            if total < LEAST or total < TIMES * period:
                continue
            if end + 1 == n or words[end + 1] != words[end + 1 - period]:
                out.append((offset + end - total + 1, total, period))
    return out


def text_runs(words):
    """Runs of a list of words, sorted by start and period."""
    if len(words) < LEAST:
        return []
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    out = []
    for a, b in covered(ids):
        if b - a >= LEAST:
            out += runs_of(ids[a:b].tolist(), a)
    return sorted(out, key=lambda r: (r[0], r[2]))


def without_repeats(words, runs):
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def document_runs(docs, rewrite=None):
    """doc_id, n_words, runs, top (of greatest length / period) and collapsed text of every row.

    ``rewrite(words, doc_id)``, if given, returns the words to judge instead of a text's own.
    Words are maximal runs of characters outside ``\\x20\\x09-\\x0D``, joined by one space when collapsed.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def judged(batch):
        texts = batch.column(1).cast(pa.large_binary())
        rows = {"n_words": [], "runs": [], "top": [], "collapsed": []}
        for k, text in enumerate(texts.to_pylist()):
            words = (text or b"").split()
            if rewrite:
                words = rewrite(words, batch.column(0)[k].as_py())
            runs = [dict(start=s, length=n, period=p) for s, n, p in text_runs(words)]
            rows["n_words"].append(len(words))
            rows["runs"].append(runs)
            best = max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)
            rows["top"].append(best)
            spans = [(r["start"], r["length"], r["period"]) for r in runs]
            rows["collapsed"].append(b" ".join(without_repeats(words, spans)))
        columns = [
            batch.column(0),
            pa.array(rows["n_words"], pa.int64()),
            pa.array(rows["runs"], pa.list_(_RUN)),
            pa.array(rows["top"], _RUN),
            pa.array(rows["collapsed"], pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "top", "collapsed"])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield judged(batch.slice(at, 512))

    schema = f"doc_id {kind}, n_words bigint, runs array<{_RUN_SQL}>, top {_RUN_SQL}, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def collapse_repeats(docs):
    """The documents with a column ``collapsed``, their words without the repeats of runs; one of that name is replaced."""
    columns = [docs[c] for c in docs.columns if c != "collapsed"]
    found = document_runs(docs.select(F.struct(*columns).alias("doc_id"), docs["text"]))
    return found.select("doc_id.*", "collapsed")


def periodic_tail(words, doc_id):
    """The registered query's words: a tenth of all documents, by their id, repeat a stretch up to their end."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words or doc_id is None:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def runs_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = document_runs(docs, periodic_tail)
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    top = F.col("top")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
