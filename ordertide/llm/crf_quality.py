"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is a node that is good or bad. Its features are its own statistics and those
of the lines before and after it; transitions tie neighbours. Lines of labelled documents take
their document's label, at most ``SAMPLE`` documents by a hash of the id. Exact marginals by the
forward-backward recursion, weighted by line length, give a document's share of good text, and
a logistic curve fitted on the same sample turns that into a chance.

Defined cases: a null text, an empty one and one without words score 0; very long texts are one
long chain; labels of one class only, or none, give every other text a score of 0.5; repeated rows
are scored alike; extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.shared import fold_of, labelled_sample
from ordertide.llm.text import chunks, mix
from ordertide.llm.toxicity import logistic

#: Fixed values of the contract.
FOLDS, HELD, CALLED_AT = 5, 0, 0.3
#: Labelled documents that the fit may use.
SAMPLE = 4000

_CLASS = {name: np.zeros(256, bool) for name in ("symbol", "digit", "upper", "stop")}
_CLASS["symbol"][list(b"#*$%&|<>{}[]=_~^@\\/+")] = True
_CLASS["digit"][48:58] = True
_CLASS["upper"][65:91] = True
_CLASS["stop"][list(b".,;:!?")] = True


def line_features(chunk):
    """Features of each line with a word (own, before, after), its length in bytes and its document."""
    data, offsets = chunk.data, chunk.offsets
    cut = np.flatnonzero(data == 0x0A)
    start = np.union1d(offsets[:-1], cut + 1)
    start = start[start < len(data)]
    doc = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(np.append(cut, len(data))[np.searchsorted(cut, start, "left")], offsets[1:][doc])
    solid = np.concatenate(([0], np.cumsum(chunk.solid)))
    worded = solid[end] > solid[start]
    start, end, doc = start[worded], end[worded], doc[worded]
    size = solid[end] - solid[start]
    if not len(start):
        return np.zeros((0, 31)), size, doc
    prefix = chunk.prefix()
    w_start, w_end, w_doc = chunk.words()
    words = chunk.hashes(w_start, w_end, prefix)
    first = np.searchsorted(w_start, start)
    n_words = np.searchsorted(w_start, end) - first
    of_line = np.repeat(np.arange(len(start)), n_words)
    _, at, times = np.unique(mix(words + mix(w_doc.astype(np.uint64))), return_inverse=True, return_counts=True)
    often = np.bincount(of_line, np.log(times[at]), len(start)) / n_words
    grams = mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else np.zeros(0, np.uint64)
    grams = np.append(grams, np.uint64(0)) + mix(w_doc.astype(np.uint64))
    _, at, times = np.unique(grams, return_inverse=True, return_counts=True)
    twice = np.bincount(of_line, times[at] > 1, len(start)) / n_words
    name = chunk.hashes(start, end, prefix) + mix(doc.astype(np.uint64))
    _, at, times = np.unique(name, return_inverse=True, return_counts=True)

    def share(flag):
        sums = np.concatenate(([0], np.cumsum(flag[data])))
        return (sums[end] - sums[start]) / size

    own = np.column_stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            size / n_words,
            share(_CLASS["symbol"]),
            share(_CLASS["digit"]),
            share(_CLASS["upper"]),
            share(_CLASS["stop"]) * size / n_words,
            np.log(times[at]),
            often,
            twice,
        ]
    )
    new, old = np.diff(doc, prepend=-1) != 0, np.diff(doc, append=-1) != 0
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[new], after[old] = own[new], own[old]
    return np.column_stack([own, before, after, new.astype(float)]), size, doc


def _chains(doc):
    """First line and number of lines of each document with lines, longest first, and which document."""
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    n = np.diff(first, append=len(doc))
    order = np.argsort(-n, kind="stable")
    return first[order], n[order], doc[first[order]]


def marginals(unary, transition, first, n):
    """P(good) of every line, and the expected transitions of each kind, by forward-backward.

    unary: log-potential of good against bad. All chains advance together, line by line; chains
    come longest first, so those still open are a prefix.
    """
    alpha, beta = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
    psi = np.column_stack([np.zeros(len(unary)), unary])
    open_at = np.searchsorted(-n, -np.arange(n[0] if len(n) else 0), "left")  # chains longer than t

    def step(values):
        top = values.max(axis=(1), keepdims=True)
        return np.squeeze(top, 1) + np.log(np.exp(values - top).sum(axis=1))

    for t, k in enumerate(open_at):
        at = first[:k] + t
        alpha[at] = psi[at]
        if t:
            alpha[at] += step(alpha[at - 1][:, :, None] + transition)
            alpha[at] -= alpha[at].max(axis=1, keepdims=True)  # only differences matter
    expected = np.zeros((2, 2))
    for t in range(len(open_at) - 1, 0, -1):
        at = first[: open_at[t]] + t
        inner = (psi[at] + beta[at])[:, None, :] + transition
        joint = alpha[at - 1][:, :, None] + inner
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = step(inner.transpose(0, 2, 1))
        beta[at - 1] = back - back.max(axis=1, keepdims=True)
    both = alpha + beta
    return 1 / (1 + np.exp(-np.clip(both[:, 1] - both[:, 0], -60, 60))), expected


class Field:
    def __init__(self, mean, scale, weights, transition, curve):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.transition, self.curve = transition, curve

    def unary(self, features):
        x = (features - self.mean) / self.scale
        return np.column_stack([np.ones(len(x)), x]) @ self.weights

    def shares(self, chunk):
        """Length-weighted share of good text of each document; NaN without words."""
        features, size, doc = line_features(chunk)
        out = np.full(chunk.n, np.nan)
        if len(doc):
            good, _ = marginals(self.unary(features), self.transition, *_chains(doc)[:2])
            weight = np.bincount(doc, size, chunk.n)
            some = weight > 0
            out[some] = np.bincount(doc, size * good, chunk.n)[some] / weight[some]
        return out

    def scores(self, chunk):
        share = self.shares(chunk)
        score = 1 / (1 + np.exp(-np.clip(_inputs(np.nan_to_num(share)) @ self.curve, -30, 30)))
        return np.where(np.isnan(share), 0.0, score)


def _inputs(share):
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.column_stack([np.ones(len(share)), np.log(share / (1 - share))])


def learn(features, doc, y, steps=120, rate=0.1, ridge=1e-2):
    """A Field from line features, the document of each line (0 .. n-1, sorted) and document labels.

    Adam on the conditional log-likelihood, each document with the same weight per line.
    """
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = np.column_stack([np.ones(len(features)), (features - mean) / scale])
    first, n, _ = _chains(doc)
    line_y = y[doc]
    pairs = np.zeros((2, 2))
    follows = np.flatnonzero(np.diff(doc) == 0)
    np.add.at(pairs, (line_y[follows].astype(int), line_y[follows + 1].astype(int)), 1)
    params, m, v = np.zeros(x.shape[1] + 4), 0.0, 0.0
    for t in range(1, steps + 1):
        good, expected = marginals(x @ params[:-4], params[-4:].reshape(2, 2), first, n)
        grad = np.concatenate([x.T @ (line_y - good), (pairs - expected).ravel()]) / len(x) - ridge / 100 * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Field(mean, scale, params[:-4], params[-4:].reshape(2, 2), None)


def fit(docs, labels, label="quality", folds=FOLDS, held=HELD, sample=SAMPLE):
    """A Field from at most ``sample`` labelled documents outside the held-out fold, or None."""
    rows = labelled_sample(docs, labels, label, sample, folds, held).toArrow()
    features, owners, y, at = [], [], [], 0
    parts = []
    for batch in rows.to_batches():
        for a, b, chunk in chunks(batch):
            f, size, doc = line_features(chunk)
            features.append(f)
            owners.append(doc + at)
            at += chunk.n
            y.append(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False) > 0)
            parts.append(chunk)
    y = np.concatenate(y).astype(float) if y else np.zeros(0)
    if len(set(y)) < 2 or not sum(map(len, features)):
        return None
    field = learn(np.concatenate(features), np.concatenate(owners), y)
    share = np.concatenate([field.shares(chunk) for chunk in parts])
    some = ~np.isnan(share)
    field.curve = logistic(_inputs(share[some]), y[some], ridge=0.1)
    return field


def score(docs, field):
    """doc_id and score (0 to 1, higher: good likelier) of every text."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                if field is None:
                    found = np.where(chunk.per_doc(chunk.solid) > 0, 0.5, 0.0)
                else:
                    found = field.scores(chunk)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(found)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def crf_query(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, fit(docs, labels))
    held = F.coalesce(fold_of("doc_id", FOLDS) == HELD, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CALLED_AT).cast("int").alias("predicted"))
