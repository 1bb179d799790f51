"""Quality rules: gradient-boosted trees over document statistics, as flat node arrays.

``statistics`` measures every whole text in one pass of array operations;
``fit`` grows small trees on a bounded labelled sample, with a sign of monotony for chosen
statistics; ``judge`` adds the verdict. Defined cases: a null text is an empty one, a text
without words fails the base rules, repeated rows are judged alike, an empty table gives an
empty result, and columns other than ``doc_id`` and ``text`` are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.shared import labelled_sample
from ordertide.llm.text import SHINGLE, chunks, mix, shingles

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
#: A document stays while its chance of being good is at least this.
KEEP_AT = 0.2
#: Labelled rows that a fit may use.
SAMPLE = 20_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = {  # name: +1 / -1 (quality may only rise / fall with it) or 0
    "log_words": 0,
    "mean_word": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeats": -1,
    "digits": 0,
    "upper": 0,
    "stops": 0,
    "distinct": 0,
    "words_per_line": 0,
    "bytes_per_char": 0,
}

_IS = {name: np.zeros(256, bool) for name in ("symbol", "digit", "upper", "stop")}
_IS["symbol"][list(SYMBOLS)] = True
_IS["digit"][48:58] = True
_IS["upper"][65:91] = True
_IS["stop"][list(b".,;:!?")] = True


def measure(chunk):
    """Counts (documents x BASE) and statistics (documents x FEATURES) of a chunk."""
    n = chunk.n
    starts, ends, docs = chunk.words()
    prefix = chunk.prefix()
    words = chunk.hashes(starts, ends, prefix)
    n_words = np.bincount(docs, minlength=n)
    head = (chunk.data & 0xC0) != 0x80
    chars = chunk.per_doc(chunk.solid & head)

    # lines: cut at every \n and at document edges
    cut = np.flatnonzero(chunk.data == 0x0A)
    l_start = np.union1d(chunk.offsets[:-1], cut + 1)
    l_start = l_start[l_start < len(chunk.data)]
    l_doc = np.searchsorted(chunk.offsets, l_start, "right") - 1
    l_end = np.append(cut, len(chunk.data))[np.searchsorted(cut, l_start, "left")]
    l_end = np.minimum(l_end, chunk.offsets[1:][l_doc])
    solid = np.concatenate(([0], np.cumsum(chunk.solid)))
    worded = solid[l_end] > solid[l_start]
    l_start, l_end, l_doc = l_start[worded], l_end[worded], l_doc[worded]
    lines = chunk.hashes(l_start, l_end, prefix) if len(l_start) else np.zeros(0, np.uint64)
    n_lines = np.bincount(l_doc, minlength=n)
    _, at = np.unique(mix(lines + l_doc.astype(np.uint64)), return_index=True)
    n_dup = n_lines - np.bincount(l_doc[at], minlength=n)

    # words covered by a window that is found twice or more
    covered = np.zeros(n, np.int64)
    if len(words):
        grams, g_doc = shingles(words, docs, n)
        first = np.concatenate(([0], np.cumsum(n_words)))[:-1]
        long = n_words[g_doc] >= SHINGLE
        grams, g_doc = grams[long], g_doc[long]
        g_first = np.concatenate(([0], np.cumsum(np.bincount(g_doc, minlength=n))))[:-1]
        g_at = first[g_doc] + np.arange(len(g_doc)) - g_first[g_doc]
        _, same, times = np.unique(mix(grams + g_doc.astype(np.uint64)), return_inverse=True, return_counts=True)
        step = np.zeros(len(words) + SHINGLE, np.int64)
        twice = g_at[times[same] > 1]
        np.add.at(step, twice, 1)
        np.add.at(step, twice + SHINGLE, -1)
        covered = np.bincount(docs[np.cumsum(step)[: len(words)] > 0], minlength=n)
    _, at = np.unique(mix(words + docs.astype(np.uint64)), return_index=True)
    n_distinct = np.bincount(docs[at], minlength=n)

    symbols = chunk.per_doc(_IS["symbol"][chunk.data])
    counts = np.column_stack([n_words, chars, symbols, n_dup, covered]).astype(np.int64)
    some_words, some_chars = np.maximum(n_words, 1), np.maximum(chars, 1)
    some_lines = np.maximum(n_lines, 1)
    stats = np.column_stack(
        [
            np.log1p(n_words),
            chars / some_words,
            symbols / some_chars,
            n_dup / some_lines,
            covered / some_words,
            chunk.per_doc(_IS["digit"][chunk.data]) / some_chars,
            chunk.per_doc(_IS["upper"][chunk.data]) / some_chars,
            chunk.per_doc(_IS["stop"][chunk.data]) / some_words,
            n_distinct / some_words,
            n_words / some_lines,
            chunk.per_doc(chunk.solid) / some_chars,
        ]
    )
    return counts, stats


class Trees:
    """Complete trees of one depth: node arrays ``feature`` and ``cut`` (trees x inner nodes), leaf values."""

    def __init__(self, feature, cut, value, base):
        self.feature, self.cut, self.value, self.base = feature, cut, value, base

    def margin(self, x):
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (len(value) - 1)]
        return out

    def good(self, x):
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x, y, signs, trees=60, depth=3, rate=0.15, bins=32, ridge=1.0, least=8):
    """Newton boosting of the logistic loss on quantile bins, histogram by histogram.

    A split that breaks the sign of its statistic is refused, and the middle of its two values
    bounds what lies below either side, so every tree is monotone in that statistic.
    """
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    rate_good = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_good / (1 - rate_good)))
    margin = np.full(len(y), base)
    features, places, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, place = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        low, high = np.full(2 ** (depth + 1) - 1, -np.inf), np.full(2 ** (depth + 1) - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for at in range(2**depth - 1):
            rows = np.flatnonzero(node == at)
            best = (1e-6, None)
            for f in range(x.shape[1]):
                if len(rows) < 2 * least or not len(cuts[f]):
                    continue
                k = binned[rows, f]
                width = len(cuts[f]) + 1
                gs, hs, cs = (np.cumsum(np.bincount(k, v, width)) for v in (g[rows], h[rows], None))
                left = np.clip(gs[:-1] / (hs[:-1] + ridge), low[at], high[at])
                right = np.clip((gs[-1] - gs[:-1]) / (hs[-1] - hs[:-1] + ridge), low[at], high[at])
                whole = np.clip(gs[-1] / (hs[-1] + ridge), low[at], high[at])

                def won(value, gradient, weight):
                    return gradient * value - (weight + ridge) * value**2 / 2

                gain = won(left, gs[:-1], hs[:-1]) + won(right, gs[-1] - gs[:-1], hs[-1] - hs[:-1])
                gain -= won(whole, gs[-1], hs[-1])
                bad = (cs[:-1] < least) | (cs[-1] - cs[:-1] < least) | (signs[f] * (right - left) < 0)
                gain[bad] = -1
                top = int(np.argmax(gain))
                if gain[top] > best[0]:
                    best = (gain[top], f, top, left[top], right[top])
            if best[1] is not None:
                _, f, top, left, right = best
                feature[at], place[at] = f, cuts[f][top]
                middle = (left + right) / 2
                for child, sign in ((2 * at + 1, signs[f]), (2 * at + 2, -signs[f])):
                    low[child], high[child] = low[at], high[at]
                    if sign > 0:
                        high[child] = min(high[at], middle)
                    elif sign < 0:
                        low[child] = max(low[at], middle)
                node[rows] = 2 * at + 1 + (binned[rows, f] > top)
            else:
                low[2 * at + 1 : 2 * at + 3], high[2 * at + 1 : 2 * at + 3] = low[at], high[at]
                node[rows] = 2 * at + 1  # an infinite cut sends all rows left
        leaf = node - (2**depth - 1)
        gs, hs = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
        value = rate * np.clip(gs / (hs + ridge), low[-(2**depth) :], high[-(2**depth) :])
        margin += value[leaf]
        features.append(feature)
        places.append(place)
        values.append(value)
    return Trees(np.array(features), np.array(places), np.array(values), base)


def _measured(rows, extra, spark_type):
    """doc_id, the ``extra`` columns, the base counts and all statistics."""

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                counts, stats = measure(chunk)
                part = batch.slice(at, to - at)
                columns = [part.column(0), *(part.column(2 + i) for i in range(len(extra)))]
                columns += [pa.array(c) for c in counts.T] + [pa.array(c) for c in stats.T]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *extra, *BASE, *FEATURES])

    kinds = [*spark_type, *(f"{c} bigint" for c in BASE), *(f"{c} double" for c in FEATURES)]
    return rows.select("doc_id", "text", *extra).mapInArrow(run, ", ".join(kinds))


def statistics(docs):
    """doc_id, the counts of the base rules and the statistics that the trees read."""
    return _measured(docs, [], [f"doc_id {dict(docs.dtypes)['doc_id']}"])


def fit(docs, labels, label="quality", sample=SAMPLE, **grown):
    """Trees for P(label = 1) from at most ``sample`` labelled documents; None without both classes."""
    known = labelled_sample(docs, labels, label, sample)
    found = _measured(known, ["label"], [f"doc_id {dict(docs.dtypes)['doc_id']}", "label int"])
    table = found.drop("doc_id", *BASE).toPandas()
    y = table.pop("label").to_numpy(float)
    if len(set(y)) < 2:
        return None
    return grow(table[list(FEATURES)].to_numpy(), y, list(FEATURES.values()), **grown)


def judge(docs, trees, keep_at=KEEP_AT):
    """Per document: the base counts, base_failed, good (the trees' chance) and kept.

    Without trees only the base rules decide.
    """
    names = ["doc_id", *BASE, "base_failed", "good", "kept"]

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                counts, stats = measure(chunk)
                n_words, repeated = counts[:, 0], counts[:, 4]
                failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
                good = trees.good(stats) if trees else np.ones(len(counts))
                columns = [batch.slice(at, to - at).column(0), *(pa.array(c) for c in counts.T)]
                columns += [pa.array(failed), pa.array(good), pa.array(~failed & (good >= keep_at))]
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = [f"doc_id {dict(docs.dtypes)['doc_id']}", *(f"{c} bigint" for c in BASE)]
    kinds += ["base_failed boolean", "good double", "kept boolean"]
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(kinds))


def quality_filter(docs, trees, keep_at=KEEP_AT):
    """The documents that are kept, with all their columns, in one pass without a shuffle.

    Rows are filtered inside the pass, so repeated ids need no join.
    """
    names = docs.columns

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                counts, stats = measure(chunk)
                n_words, repeated = counts[:, 0], counts[:, 4]
                failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
                good = trees.good(stats) if trees else np.ones(len(counts))
                yield batch.slice(at, to - at).filter(pa.array(~failed & (good >= keep_at))).select(names)

    return docs.mapInArrow(run, docs.schema)


def rules_query(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, fit(docs, labels)).withColumn("good", F.round("good", 12))
