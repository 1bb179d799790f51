"""Toxicity by two Kneser-Ney models of the letters of words, one of toxic and one of ordinary texts.

Both models count every labelled text outside the held-out fold, as runs of ``ORDER`` bytes inside
words, word ends included. Orders ``ORDER`` down to 4 are each class's own, order 3 is shared by
both classes: where a class has not seen an expression it backs off to shorter runs and at last
to what both share, so rare words cost both alike. Runs of letters also meet inflected and
compound forms that a model of whole words would not know.

The score compares the two log-likelihoods, normalised by the number of words; a logistic curve
over the difference and its part from decisive words, fitted on labelled texts that were not
counted, turns it into a chance. The models are tables of all counts, whatever their size. Tasks
look up the most frequent runs, at most ``OFTEN``, in memory. The distinct words that hold any
other run are judged by joins with the tables, each run once, and joined to the texts; the most
frequent of these words, at most ``HOT``, are broadcast, so that none of the others is a hot key.

Defined cases: a null or empty text has no words and the score of the curve at no difference;
unlabelled rows are scored, not counted; conflicting labels of an id count as the larger; labels
of one class only, or none, give every text a score of 0.5; repeated rows are scored alike; extra
columns are ignored.
"""

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ordertide.llm.ngram_join import _has, bloom_of
from ordertide.llm.shared import fold_of, known_labels, saved
from ordertide.llm.text import FOLD, chunks

#: Fixed values of the contract.
FOLDS, HELD, CALLED_AT = 3, 1, 0.7
#: Bytes of the longest run and of the shortest a class counts by itself, and the discount of all orders.
ORDER, LOWEST, DISCOUNT = 6, 4, 0.75
#: Runs that a task looks up in memory, and words that a join broadcasts; the rest is joined.
OFTEN, HOT = 1 << 20, 1 << 16
#: Parts of the runs that open words, which many words share.
SALTS = 16
#: One labelled text in so many fits the curve instead of being counted, at most CURVE of them.
APART, CURVE = 5, 6000
FILTER_WORDS = 1 << 19
#: Log ratio of a word from which it speaks for itself.
STRONG = 3.0

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def distinct_words(chunk):
    """Words are runs of letters, digits and non-ASCII, without case.

    Returns the distinct words' place for each word, the words' documents, and hash, start and size
    of the distinct words.
    """
    chunk.solid = _WORD[chunk.data]
    starts, ends, docs = chunk.words()
    names = chunk.hashes(starts, ends, chunk.prefix(fold=True))
    names, first, which = np.unique(names, return_index=True, return_inverse=True)
    return which, docs, names.view(np.int64), starts[first], (ends - starts)[first]


def _ramp(sizes):
    """0, 1, .. size - 1 for each size, and the place of the size."""
    place = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes), place


def word_runs(chunk, starts, sizes):
    """Packed runs (up to the byte in question, padded before the first) and the place of their word."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    block = sizes + ORDER  # ORDER - 1 bytes of padding, the word, an end
    last = np.cumsum(block)
    flat = np.ones(last[-1], np.int64)
    at, word = _ramp(sizes)
    flat[(last - block + ORDER - 1)[word] + at] = FOLD[chunk.data][starts[word] + at]
    flat[last - 1] = 2
    at, word = _ramp(sizes + 1)
    key = np.zeros(len(at), np.int64)
    for k in range(ORDER):
        key = (key << 8) | flat[(last - block)[word] + at + k]
    return key, word


def training_texts(docs, known):
    """doc_id, text and label of the rows with a label in known (l_id, label).

    A Bloom filter of bounded size over the labelled ids keeps the other texts out of the join.
    """
    bloom = docs.sparkSession.sparkContext.broadcast(
        bloom_of(known.select(F.col("l_id").cast("long").alias("token")), FILTER_WORDS)
    )

    def run(batches):
        for batch in batches:
            hit = _has(bloom.value, batch.column(0).cast(pa.int64()).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit))

    rows = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    rows = rows.mapInArrow(run, rows.schema)
    return rows.join(known, F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "label")


def run_counts(texts):
    """run, n0 and n1: how often the words of class 0 and 1 have each run of ORDER bytes."""

    def run(batches):
        for batch in batches:
            labels = batch.column(1).to_numpy() > 0
            for at, to, chunk in chunks(batch):
                which, docs, names, starts, sizes = distinct_words(chunk)
                key, word = word_runs(chunk, starts, sizes)
                toxic = labels[at:to][docs]
                n = [np.bincount(which[toxic == c], minlength=len(names)) for c in (False, True)]
                key, same = np.unique(key, return_inverse=True)
                sums = [np.bincount(same, m[word], len(key)).astype(np.int64) for m in n]
                yield pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, sums)], ["run", "n0", "n1"])

    counts = texts.select("text", "label").mapInArrow(run, "run bigint, n0 bigint, n1 bigint")
    return counts.groupBy("run").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _last(n):
    """The last n bytes of a run."""
    return F.col("run").bitwiseAND((1 << 8 * n) - 1)


def _context():
    return F.shiftright("run", 8).alias("context")


def _frequent(rows, n, most):
    """The rows with a column bin of their n (eight to a factor of two), and the least bin from which
    on there are at most ``most`` rows."""
    rows = rows.withColumn("bin", F.floor(F.log2(n) * 8).cast("int"))
    sizes = rows.groupBy("bin").count().orderBy(F.desc("bin")).collect()  # a few hundred rows
    fits = sum(total <= most for total in accumulate(r["count"] for r in sizes))
    return rows, sizes[fits - 1]["bin"] if fits else 1 << 30


def fit(counts, often=OFTEN):
    """The model, or None if a class has no word: tables of all counts, from the shared order to the
    longest, and the ratios of the most frequent runs as arrays sorted by run.

    counts: rows of run_counts. Lower orders count in how many longer runs a run is found.
    """
    if not all(counts.agg(F.sum("n0"), F.sum("n1")).first()):
        return None
    levels = [counts]
    for order in range(ORDER - 1, LOWEST - 1, -1):
        kinds = (F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in ("n0", "n1"))
        levels.append(saved(levels[-1].groupBy(_last(order).alias("run")).agg(*kinds), "run-counts"))
    shared = levels[-1].groupBy(_last(LOWEST - 1).alias("run")).agg(F.count("*").alias("n"))
    tables = [saved(shared, "run-counts"), *reversed(levels)]
    rows, least = _frequent(counts, F.col("n0") + F.col("n1"), often)
    known = run_ratios(tables, rows.where(F.col("bin") >= least).select("run")).toArrow()
    run, ratio = (known.column(c).to_numpy() for c in ("run", "ratio"))
    order = np.argsort(run)
    return tables, (run[order], ratio[order])


def run_ratios(tables, runs):
    """run and ratio: log P(last byte | run before it, toxic) - the same for ordinary, of distinct runs."""
    shared, *levels = tables
    heads = shared.groupBy(_context()).agg(F.sum("n").alias("whole"), F.count("*").alias("kinds"))
    need = runs.select(_last(LOWEST - 1).alias("run")).distinct().withColumn("context", _context())
    need = need.join(shared, "run", "left").join(heads, "context", "left")
    own = F.coalesce(F.col("n") - DISCOUNT, F.lit(0.0))
    p = F.coalesce((own + F.col("kinds") * (DISCOUNT / 256)) / F.col("whole"), F.lit(1 / 256))
    chances = saved(need.select("run", p.alias("p0"), p.alias("p1")), "run-chances")
    for order, level in enumerate(levels, LOWEST):
        wholes = [F.sum(f"n{c}").alias(f"whole{c}") for c in (0, 1)]
        less = [F.sum(F.when(F.col(f"n{c}") > 0, DISCOUNT).otherwise(0.0)).alias(f"less{c}") for c in (0, 1)]
        heads = level.groupBy(_context()).agg(*wholes, *less)
        need = runs.select(_last(order).alias("run")).distinct()
        need = need.select("run", _context(), _last(order - 1).alias("short"))
        need = need.join(level, "run", "left").join(heads, "context", "left")
        need = need.join(chances.withColumnRenamed("run", "short"), "short")
        ps = []
        for c in (0, 1):
            n, whole, left, p = (F.col(f"{name}{c}") for name in ("n", "whole", "less", "p"))
            own = F.greatest(F.coalesce(n, F.lit(0)) - DISCOUNT, F.lit(0.0))
            ps.append(F.when(whole > 0, (own + left * p) / whole).otherwise(p).alias(f"p{c}"))
        chances = saved(need.select("run", *ps), "run-chances")
    logs = [F.log(F.greatest(F.col(c), F.lit(1e-30))) for c in ("p0", "p1")]
    return chances.select("run", (logs[1] - logs[0]).alias("ratio"))


def _look_up(known, keys):
    """Ratio of each run, 0 where it is not known, and whether it is known."""
    runs, ratios = known
    if not len(runs):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(runs, keys), len(runs) - 1)
    there = runs[at] == keys
    return np.where(there, ratios[at], 0.0), there


def rare_pieces(words, known):
    """word, run and times of each distinct run that is not known; words: word (a hash) and text."""

    def run(batches):
        for batch in batches:
            word = batch.column(0).to_numpy()
            for at, to, chunk in chunks(batch):
                key, place = word_runs(chunk, chunk.offsets[:-1], np.diff(chunk.offsets))
                rare = ~_look_up(known.value, key)[1]
                key, place = key[rare], place[rare]
                order = np.lexsort((key, place))
                key, place = key[order], place[order]
                new = np.flatnonzero(np.diff(key, prepend=-1) | np.diff(place, prepend=-1))
                times = np.diff(new, append=len(key)).astype(np.int64)
                columns = [word[at:to][place[new]], key[new], times]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "run", "times"])

    return words.mapInArrow(run, "word bigint, run bigint, times bigint")


def rare_ratios(model, known, words):
    """word and more, the sum over its runs that are not known, of each row of words."""
    pieces = saved(rare_pieces(words, known), "word-runs")
    ratios = run_ratios(model[0], saved(pieces.select("run").distinct(), "runs"))
    opens = F.shiftright("run", 8 * (ORDER - 1)) == 1
    part = F.when(opens, F.pmod("word", F.lit(SALTS))).otherwise(0).cast("int")
    parts = F.when(opens, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    found = pieces.withColumn("part", part).join(ratios.withColumn("part", F.explode(parts)), ["run", "part"])
    return found.groupBy("word").agg(F.round(F.sum(F.col("ratio") * F.col("times")), 9).alias("more"))


def measured(model, rows, hot=HOT):
    """The columns of rows but text, the mean log ratio of the words, the mean of the part above
    ``STRONG``, and the number of words."""
    known = rows.sparkSession.sparkContext.broadcast(model[1])
    others = [c for c in rows.columns if c != "text"]

    def run(batches):
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at, to, chunk in chunks(batch):
                which, docs, names, starts, sizes = distinct_words(chunk)
                key, word = word_runs(chunk, starts, sizes)
                ratio, there = _look_up(known.value, key)
                ratio = np.bincount(word, ratio, len(names))
                rare = np.bincount(word, ~there, len(names)) > 0
                sure = np.where(rare, 0.0, ratio)[which]
                sums = [np.bincount(docs, v, chunk.n) for v in (sure, np.maximum(sure - STRONG, 0))]
                sums.append(np.bincount(docs, minlength=chunk.n).astype(np.int64))
                left = rare[which]
                pairs, n = np.unique(docs[left] * (len(names) + 1) + which[left], return_counts=True)
                doc, name = np.divmod(pairs, len(names) + 1)
                step, place = _ramp(sizes[name])
                spelt = FOLD[chunk.data][starts[name][place] + step].tobytes() if len(name) else b""
                ends = np.concatenate(([0], np.cumsum(sizes[name]))).astype(np.int64)
                text = pa.LargeStringArray.from_buffers(len(name), pa.py_buffer(ends), pa.py_buffer(spelt))
                items = [pa.array(names[name]), pa.array(n.astype(np.int64)), pa.array(ratio[name]), text.cast(pa.string())]
                rest = pa.StructArray.from_arrays(items, ["word", "n", "less", "text"])
                ends = np.searchsorted(doc, np.arange(chunk.n + 1)).astype(np.int32)
                columns = [batch.column(c).slice(at, to - at) for c in others]
                columns += [pa.array(row + np.arange(chunk.n)), *map(pa.array, sums)]
                columns.append(pa.ListArray.from_arrays(pa.array(ends), rest))
                row += chunk.n
                yield pa.RecordBatch.from_arrays(columns, [*others, *made])

    made = ["row", "whole", "strong", "words", "rest"]
    kinds = ["bigint", "double", "double", "bigint", "array<struct<word:bigint,n:bigint,less:double,text:string>>"]
    schema = [f"`{c}` {k}" for c, k in (*rows.drop("text").dtypes, *zip(made, kinds, strict=True))]
    found = saved(rows.select("text", *others).mapInArrow(run, ", ".join(schema)), "word-sums")
    pairs = found.select("row", F.inline("rest"))
    vocabulary = saved(pairs.groupBy("word", "text").agg(F.sum("n").alias("all")), "rare-words")
    rare = rare_ratios(model, known, vocabulary.select("word", "text"))
    rare, least = _frequent(saved(rare.join(vocabulary.select("word", "all"), "word"), "rare-ratios"), F.col("all"), hot)
    pairs = pairs.select("row", "word", "n", "less")
    more = pairs.join(F.broadcast(rare.where(F.col("bin") >= least).select("word", "more")), "word")
    more = more.unionByName(pairs.join(rare.where(F.col("bin") < least).select("word", "more"), "word"))
    ratio = F.col("less") + F.col("more")
    over = F.greatest(ratio - STRONG, F.lit(0.0))
    more = more.groupBy("row").agg(F.sum(F.col("n") * ratio).alias("m"), F.sum(F.col("n") * over).alias("s"))
    size = F.greatest(F.col("words"), F.lit(1))
    means = [
        ((F.col(a) + F.coalesce(F.col(b), F.lit(0.0))) / size).alias(name)
        for a, b, name in (("whole", "m", "ratio"), ("strong", "s", "strong"))
    ]
    return found.drop("rest").join(more, "row", "left").select(*others, *means, "words")


def curve_inputs():
    """Columns of the curve; the strong part also as a total, which tells one such word from none."""
    ratio, strong, words = F.col("ratio"), F.col("strong"), F.col("words")
    clipped = F.least(F.greatest(ratio, F.lit(-5.0)), F.lit(5.0))
    return [F.lit(1.0), clipped, strong, F.log1p(strong * words), F.log1p(words) / 5]


def logistic(x, y, ridge=1e-3, steps=50):
    """Weights of a logistic curve by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs, labels, label="toxic", folds=FOLDS, held=HELD):
    """(model, curve), or None where a class has no labelled text."""
    known = known_labels(labels, label, folds, held)
    apart = F.pmod(F.xxhash64("l_id"), F.lit(APART)) == 0
    counts = run_counts(training_texts(docs, known.where(~apart)))
    model = fit(saved(counts, "run-counts"))
    if model is None:
        return None
    # a bounded table, so no text is shuffled
    chosen = F.broadcast(known.where(apart).orderBy(F.xxhash64("l_id", F.lit(1)), "l_id").limit(CURVE))
    rest = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("l_id"))
    inputs = [c.alias(f"x{i}") for i, c in enumerate(curve_inputs())]
    table = measured(model, rest.select("label", "text")).select("label", *inputs).toPandas()
    if table["label"].nunique() < 2:
        return None
    return model, logistic(table.drop(columns="label").to_numpy(), (table["label"] > 0).to_numpy(float))


def score(docs, trained):
    """doc_id and score (0 to 1, higher: toxic likelier) of every text."""
    if trained is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"))
    model, curve = trained
    z = sum(F.lit(float(w)) * x for w, x in zip(curve, curve_inputs(), strict=True))
    z = F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))
    return measured(model, docs.select("doc_id", "text")).select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def toxicity_query(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels))
    held = F.coalesce(fold_of("doc_id", FOLDS) == HELD, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CALLED_AT).cast("int").alias("predicted"))
