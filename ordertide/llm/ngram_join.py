"""Exact Jaccard join of 5-word shingle sets by prefix trees, as components of linked documents.

Two documents link when ``100 * |A n B| >= 80 * |A u B|``. Sets are ordered alike everywhere:
shingles known to be frequent last, then by hash. Linked sets share a shingle among the first
``n - ceil(0.8 n) + 1``, so only documents that share such a shingle ever meet:

1. Shingles in the low part of the hash range are counted over all documents. The counts give
   two Bloom filters of bounded size: frequent shingles (they define the order, so a false hit
   only changes the order, for all documents alike) and shingles of more than one document.
2. Each text becomes a light row: set size, the first possible shingles that others share, and a
   bitmap of the parity of its shingle hashes. Equal sets are one class, under its smallest id.
3. Classes that share one of their first few shingles, and a size range, meet in blocks of
   bounded size. The bits in which two bitmaps differ are a lower bound of the symmetric
   difference, so most pairs are ruled out without their sets; classes with a partner left get
   their sets, and a prefix tree over the block's sets finds links. This joins groups of near
   copies at little cost.
4. Whatever shingle of any prefix is still shared by different components brings their classes
   together again, block against block, until every possible link has been judged likewise.

No group is collected whole: a shingle's classes are cut in blocks of ``BLOCK``, members of
its largest component meet only classes outside it. Defined cases: no words, empty and null
texts have an empty set and link with nothing; a text of one to four words is one shingle of
all its words; rows that repeat an id are linked by their own texts; a null id never represents
a class; an empty table gives an empty result; other columns are ignored. Shingles are 63-bit
hashes, and class identity is two independent 64-bit sums of them with the set size.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.components import components
from ordertide.llm.shared import saved
from ordertide.llm.text import chunks, distinct, mix, shingles, sort_each

#: Fixed values of the contract: similarity of at least 80 / 100.
NEED, OF = 80, 100
#: Part of the hash range whose shingles are counted. Prefixes are a fifth of a set.
COUNTED = 0.25
#: A shingle of more documents than this is ordered last.
FREQUENT = 200
#: Sets that meet in one block.
BLOCK = 256
#: 64-bit words of the Bloom filters: frequent shingles, and at most so many for shared ones.
FREQUENT_WORDS, SHARED_WORDS = 1 << 16, 1 << 22
#: 64-bit words of the filter over ids whose sets are wanted.
FILTER_WORDS = 1 << 19
#: Shingles of a prefix that bring near copies together first.
FIRST = 3
#: First shingles that a row carries, to see whether two classes have met before.
HEAD = 8
#: Shingles of a tree edge that are compared before the bound is tested again.
PIECE = 64
#: Words of bitmaps that are compared in one step.
PAIR_WORDS = 1 << 19
#: Parts in which the rows of one class are given its component; at most 64, one bit each.
PARTS = 32

_FREQUENT_BIT = np.uint64(1 << 63)
_RANGE = np.uint64(int(COUNTED * (1 << 63)))


def prefix_length(n):
    return n - -(-NEED * n // OF) + 1


def least_overlap(n, m):
    """The smallest overlap at which sets of n and m shingles link."""
    return -(-NEED * (n + m) // (OF + NEED))


def _sets(chunk, below=None):
    """Distinct 63-bit shingle hashes of each document of a chunk, sorted: (hashes, documents).

    With ``below``, only the smaller ones.
    """
    starts, ends, docs = chunk.words()
    words = chunk.hashes(starts, ends, chunk.prefix(fold=True))
    grams, owner = shingles(words, docs, chunk.n)
    grams >>= np.uint64(1)
    if below is not None:
        low = grams < below
        grams, owner = grams[low], owner[low]
    return distinct(grams, owner)


def _bits(tokens, words):
    """Filter word and mask (three bits) of each token; ``words`` is a power of two."""
    h = mix(tokens)
    mask = np.uint64(1) << (h & np.uint64(63))
    mask |= np.uint64(1) << ((h >> np.uint64(6)) & np.uint64(63))
    mask |= np.uint64(1) << ((h >> np.uint64(12)) & np.uint64(63))
    return (h >> np.uint64(20)) & np.uint64(words - 1), mask


def _has(bloom, tokens):
    word, mask = _bits(tokens, len(bloom))
    return (bloom[word.astype(np.int64)] & mask) == mask


def bloom_of(tokens, words):
    """A Bloom filter over the column ``token`` as an array of ``words`` 64-bit words.

    Words are combined by aggregation; the driver gets one row per word at most.
    """

    def run(batches):
        for batch in batches:
            word, mask = _bits(batch.column(0).to_numpy().view(np.uint64), words)
            order = np.argsort(word)
            word, mask = word[order], mask[order]
            first = np.flatnonzero(np.diff(word, prepend=np.uint64(words)))
            if len(first):
                joined = np.bitwise_or.reduceat(mask, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[first].view(np.int64)), pa.array(joined.view(np.int64))], ["word", "mask"]
                )

    rows = tokens.select("token").mapInArrow(run, "word bigint, mask bigint")
    rows = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(words, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return out


def token_counts(docs):
    """token and n, the number of documents, of each shingle in the counted range found twice or more."""

    def run(batches):
        for batch in batches:
            for _, _, chunk in chunks(batch):
                tokens, _ = _sets(chunk, _RANGE)
                tokens, n = np.unique(tokens, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], ["token", "n"])

    counts = docs.select("text").mapInArrow(run, "token bigint, n bigint")
    return counts.groupBy("token").agg(F.sum("n").alias("n")).where("n > 1")


def _ordered(chunk, frequent):
    """Shingles of each document in the global order: (hashes, order keys, documents)."""
    tokens, owner = _sets(chunk)
    keys = sort_each(np.where(_has(frequent, tokens), tokens | _FREQUENT_BIT, tokens), owner)
    return keys & ~_FREQUENT_BIT, keys, owner


def _binary(values, counts):
    """A binary column from the values of all rows, one after the other, ``counts`` for each."""
    ends = np.concatenate(([0], np.cumsum(counts * values.itemsize))).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _parities(tokens, owner, n):
    """Bitmaps of the parity of hashed shingles; a document's has the power of two of at least n bits."""
    bits = np.left_shift(1, np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64))
    first = np.cumsum(bits) - bits
    at = first[owner] + (mix(tokens + np.uint64(1)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(at, minlength=int(bits.sum())) & 1
    return _binary(np.packbits(odd.astype(bool), bitorder="little"), bits // 8)


def _sums(tokens, n, salt):
    """The sum of the salted hashes of each set; ``n`` are the sets' sizes."""
    total = np.cumsum(mix(tokens * np.uint64(salt)), dtype=np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), total))
    first = np.concatenate(([0], np.cumsum(n)))
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def light_rows(docs, frequent, shared):
    """One row per document: n, two sums that identify the set, the prefix shingles that others may
    share (``live``) and the parity bitmap. The filters are broadcast."""
    context = docs.sparkSession.sparkContext
    frequent, shared = context.broadcast(frequent), context.broadcast(shared)

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                tokens, keys, owner = _ordered(chunk, frequent.value)
                n = np.bincount(owner, minlength=chunk.n)
                first = np.concatenate(([0], np.cumsum(n)))
                live = np.flatnonzero(np.arange(len(owner)) < (first[:-1] + prefix_length(n))[owner])
                live = live[(tokens[live] >= _RANGE) | _has(shared.value, tokens[live])]
                lists = np.concatenate(([0], np.cumsum(np.bincount(owner[live], minlength=chunk.n))))
                sums = [_sums(tokens, n, salt) for salt in (3, 5)]
                live = pa.array(tokens[live].view(np.int64))
                columns = [batch.column(0).slice(at, to - at), pa.array(n), *map(pa.array, sums)]
                columns.append(pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), live))
                columns.append(_parities(tokens, owner, n))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "sum1", "sum2", "live", "bits"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n bigint, sum1 bigint, sum2 bigint, live array<bigint>, bits binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def sets_of(docs, ids, frequent):
    """cls and the ordered set as bytes of the documents with an id in ``ids`` (column cls), once for each set.

    A Bloom filter of bounded size spares the other texts; false hits go with the next join. A task
    gives a set of one id once, however many rows hold it, so few copies meet where they are reduced.
    """
    context = docs.sparkSession.sparkContext
    wanted = context.broadcast(bloom_of(ids.select(F.col("cls").cast("long").alias("token")), FILTER_WORDS))
    frequent = context.broadcast(frequent)

    def run(batches):
        seen = set()
        for batch in batches:
            hit = _has(wanted.value, batch.column(0).cast(pa.int64()).to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(hit))
            for at, to, chunk in chunks(batch):
                tokens, keys, owner = _ordered(chunk, frequent.value)
                n = np.bincount(owner, minlength=chunk.n)
                name = _sums(tokens, n, 3)
                cls = batch.column(0).slice(at, to - at)
                new = np.zeros(chunk.n, bool)
                for k, who in enumerate(zip(cls.to_pylist(), name.tolist())):
                    new[k] = who not in seen
                    seen.add(who)
                sets = _binary(keys[new[owner]], n[new])
                columns = [cls.filter(pa.array(new)), pa.array(name[new]), sets]
                yield pa.RecordBatch.from_arrays(columns, ["cls", "name", "keys"])

    schema = f"cls {dict(docs.dtypes)['doc_id']}, name bigint, keys binary"
    sets = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, schema)
    return sets.repartition("cls").dropDuplicates(["cls", "name"]).select("cls", "keys")


class PrefixTree:
    """Ordered sets as a tree whose edges hold what several sets have in common from the start.

    ``sets`` must be sorted; a node covers sets ``lo`` to ``hi`` and the positions ``start`` to
    ``end`` of any of them.
    """

    def __init__(self, sets):
        self.sets = sets
        self.sizes = [len(s) for s in sets]
        common = [0] * (len(sets) + 1)
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[i] = int(differ[0]) if len(differ) else m
        self.common = common

    def children(self, lo, hi, depth):
        """Nodes below the prefix of length ``depth`` that sets lo..hi-1 share: (lo, hi, end)."""
        at = lo
        while at < hi:
            to = at + 1
            end = self.sizes[at]
            while to < hi and self.common[to] > depth:
                end = min(end, self.common[to])
                to += 1
            yield at, to, end if to > at + 1 else self.sizes[at]
            at = to

    def matches(self, i, skip):
        """Sets after i that link with set i; ``skip(j)`` leaves out sets known to be linked."""
        x, n = self.sets[i], self.sizes[i]
        stack = [(i + 1, len(self.sets), 0, 0)]
        while stack:
            lo, hi, depth, overlap = stack.pop()
            for a, b, end in self.children(lo, hi, depth):
                if b == a + 1 and skip(a):
                    continue
                small, large = min(self.sizes[a:b]), max(self.sizes[a:b])
                if OF * n < NEED * small or OF * large < NEED * n:
                    continue
                need, got, at, edge = least_overlap(n, small), overlap, depth, self.sets[a]
                while at < end:
                    left = n - int(np.searchsorted(x, edge[at]))
                    if got + min(left, large - at) < need:
                        break
                    piece = edge[at : min(end, at + PIECE)]
                    place = np.minimum(np.searchsorted(x, piece), n - 1)
                    got += int(np.count_nonzero(x[place] == piece))
                    at += len(piece)
                if at < end:
                    continue
                while a < b and self.sizes[a] == end:  # sets that end here
                    if not skip(a) and OF * got >= NEED * (n + end - got):
                        yield a
                    a += 1
                if a < b:
                    stack.append((a, b, end, got))


def block_links(block):
    """Links (a, b) that join the components of one block: cls, comp and keys of each set."""
    keys = [np.frombuffer(k, np.uint64) for k in block["keys"]]
    order = sorted(range(len(keys)), key=lambda i: keys[i].astype(">u8").tobytes())
    cls, tree = block["cls"].to_numpy()[order], PrefixTree([keys[i] for i in order])
    known = pd.factorize(block["comp"].to_numpy()[order])[0].tolist()
    parent = list(range(len(known)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    apart, out = len(set(known)), []
    for i in range(len(order)):
        if apart < 2:
            break
        for j in tree.matches(i, lambda j, i=i: root(known[j]) == root(known[i])):
            a, b = root(known[i]), root(known[j])
            if a != b:
                parent[b] = a
                apart -= 1
                out.append((cls[i], cls[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


GROUP = ["key", "kind", "i", "j"]


class Bitmaps:
    """The bitmaps of many rows, each decoded once: a matrix for each width, and one folded to half of it.

    Sizes that can link differ by a factor of 1.25 at most, so widths are equal or neighbours.
    """

    def __init__(self, bits):
        self.width = np.array([len(x) // 8 for x in bits])
        self.place, self.whole, self.half = np.zeros(len(bits), np.int64), {}, {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            table = np.frombuffer(b"".join(bits[k] for k in rows), np.uint64).reshape(len(rows), w)
            self.whole[w] = table
            if w > 1:
                self.half[w] = table[:, : w // 2] ^ table[:, w // 2 :]

    def differing(self, a, b):
        """In how many bits the bitmaps of rows a and b differ at least; the wider one is folded."""
        out = np.zeros(len(a), np.int64)
        wide = np.maximum(self.width[a], self.width[b])
        for w in np.unique(wide).tolist():
            same = self.width[a] == self.width[b]
            for pairs, folded in ((np.flatnonzero((wide == w) & same), False), (np.flatnonzero((wide == w) & ~same), True)):
                step = max(1, PAIR_WORDS // w)
                for at in range(0, len(pairs), step):
                    here = pairs[at : at + step]
                    x, y = a[here], b[here]
                    if folded:
                        swap = self.width[x] < self.width[y]
                        x, y = np.where(swap, y, x), np.where(swap, x, y)
                        left, right = self.half[w], self.whole[w // 2]
                    else:
                        left = right = self.whole[w]
                    out[here] = np.bitwise_count(left[self.place[x]] ^ right[self.place[y]]).sum(axis=1, dtype=np.int64)
        return out


def partners(rows):
    """The rows of blocks that may link with a row of another component of their block.

    Rows: GROUP, cls, comp, n, bits, pos (of the shingle among the class's), step (0 or 1: the
    size range), head (its first shingles). Two classes are skipped where they meet a second time.
    """
    names = [*GROUP, "cls", "comp"]

    def judged(table):
        group = table.select(GROUP).to_pandas().to_numpy()
        change = np.any(group[1:] != group[:-1], axis=1)
        start = np.concatenate(([0], np.cumsum(change)))
        cls, comp, n, pos, step = (table.column(c).to_numpy() for c in ("cls", "comp", "n", "pos", "step"))
        bitmaps = Bitmaps(table.column("bits").to_pylist())
        heads = np.full((len(n), HEAD), -1, np.int64)
        for k, h in enumerate(table.column("head").to_pylist()):
            heads[k, : len(h)] = h
        keep = np.zeros(len(n), bool)
        ends = np.cumsum(np.bincount(start))[start]  # where each row's block ends
        left, gap = np.arange(len(start)), 0
        while True:
            gap += 1
            left = left[left + gap < ends[left]]  # rows that have one so far behind them in their block
            if not len(left):
                break
            a, b = left, left + gap
            fit = (comp[a] != comp[b]) & (cls[a] != cls[b]) & (step[a] + step[b] < 2) & ~(keep[a] & keep[b])
            fit &= OF * np.minimum(n[a], n[b]) >= NEED * np.maximum(n[a], n[b])
            a, b = a[fit], b[fit]
            if not len(a):
                continue
            same = (heads[a][:, :, None] == heads[b][:, None, :]) & (heads[a] >= 0)[:, :, None]
            before = np.any(same.any(axis=2) & (np.arange(HEAD) < pos[a][:, None]), axis=1)
            a, b = a[~before], b[~before]
            total = n[a] + n[b]
            near = bitmaps.differing(a, b) <= total - 2 * least_overlap(n[a], n[b])
            keep[a[near]] = keep[b[near]] = True
        return table.filter(pa.array(keep)).select(names)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            ends = [held.column(c).combine_chunks() for c in GROUP]
            last = [e[-1].as_py() for e in ends]
            inside = np.ones(len(held), bool)
            for e, v in zip(ends, last, strict=True):
                inside &= e.to_numpy() == v
            cut = int(len(held) - inside.sum())  # the last block may go on
            if cut:
                yield from judged(held.slice(0, cut).combine_chunks()).to_batches()
                held = held.slice(cut).combine_chunks()
        if held is not None and len(held):
            yield from judged(held.combine_chunks()).to_batches()

    rows = rows.repartition(*GROUP).sortWithinPartitions(*GROUP)
    rows = rows.select(*names, "n", "bits", "pos", "step", "head")
    return rows.mapInArrow(run, "key bigint, kind int, i bigint, j bigint, cls bigint, comp bigint")


def verified(docs, frequent, left):
    """Links between rows of one block, found by a prefix tree over their sets."""
    left = saved(left, "partners")
    sets = sets_of(docs, left.select("cls").distinct(), frequent)
    groups = left.join(sets, "cls").groupBy(*GROUP)
    return saved(groups.applyInPandas(lambda p: block_links(p), "a bigint, b bigint"), "found-links")


def _cut(n):
    return F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("long")


def _part(parts, salt=0):
    return F.pmod(F.xxhash64("cls", F.lit(salt)), parts)


def _meeting(reps):
    """cls, key, pos and step: a row for each live shingle and each of the two size ranges of a class.

    Sizes of linked sets differ by a factor of 1.25 at most, so their ranges are equal or next to
    each other, and they share a key.
    """
    size = F.floor(F.log(1.2501, "n")).cast("long")
    rows = reps.select("cls", size.alias("size"), F.posexplode("live").alias("pos", "token"))
    rows = rows.select("cls", "size", "pos", "token", F.explode(F.array(F.lit(0), F.lit(1))).alias("step"))
    return rows.select("cls", F.xxhash64("token", F.col("size") + F.col("step")).alias("key"), "pos", "step")


def _with_bits(rows, reps):
    light = reps.select("cls", "n", "bits", F.slice("live", 1, HEAD).alias("head"))
    return rows.join(light, "cls")


def first_partners(reps):
    """Classes that share one of their first live shingles, in blocks, each shingle cut differently."""
    rows = _meeting(reps).where(F.col("pos") < FIRST)
    sizes = rows.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    rows = rows.join(sizes, "key").select("key", "cls", F.col("cls").alias("comp"), "pos", "step", "k")
    block = F.pmod(F.xxhash64("cls", "pos"), _cut(F.col("k")))
    rows = rows.withColumns({"kind": F.lit(0), "i": block, "j": F.lit(0).cast("long")}).drop("k")
    return partners(_with_bits(rows, reps))


def open_partners(reps, found):
    """Classes of different components that share any live shingle, block against block."""
    rows = _meeting(reps).join(found.withColumnRenamed("node", "cls"), "cls", "left")
    rows = rows.select("cls", "key", "pos", "step", F.coalesce("root", "cls").alias("comp"))
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("k"))
    keys = sizes.groupBy("key").agg(
        F.count("*").alias("comps"), F.sum("k").alias("all"), F.max(F.struct("k", "comp")).alias("main")
    )
    keys = keys.where("comps > 1").select(
        "key",
        F.col("main.comp").alias("main"),
        _cut(F.col("main.k")).alias("mains"),
        _cut(F.col("all") - F.col("main.k")).alias("others"),
    )
    rows = rows.join(keys, "key")
    inside, outside = F.col("comp") == F.col("main"), F.col("comp") != F.col("main")
    fixed = ["key", "cls", "comp", "pos", "step"]

    def to(parts):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    def meet(kind, rows, i, j):
        return rows.select(*fixed, F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    out = meet(0, rows.where(inside), _part(F.col("mains")), to("others"))
    out = out.unionByName(meet(0, rows.where(outside), to("mains"), _part(F.col("others"))))
    pairs = rows.where(outside & (F.col("others") > 1)).select(*fixed, _part(F.col("others")).alias("b"), to("others").alias("o"))
    out = out.unionByName(meet(1, pairs.where("b <> o"), F.least("b", "o"), F.greatest("b", "o")))
    return partners(_with_bits(out, reps))


def jaccard_components(docs):
    """doc_id, n_shingles and component_id of every document (rows with a null id included)."""
    docs = docs.select("doc_id", "text")
    counts = saved(token_counts(docs), "shingle-counts")
    shared_words = min(SHARED_WORDS, 1 << max(10, int(counts.count() // 8).bit_length()))
    frequent = bloom_of(counts.where(F.col("n") > FREQUENT), FREQUENT_WORDS)
    light = saved(light_rows(docs, frequent, bloom_of(counts, shared_words)), "light-rows")
    light = light.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
    same = ["sum1", "sum2", "n"]
    classes = light.where("n > 0").groupBy(*same)
    # equal sets have equal live shingles and bitmaps: a class is one row, however many rows hold its text
    bits = F.first(F.when(F.size("live") > 0, F.col("bits"))).alias("bits")
    mask = F.expr("bit_or(shiftleft(1L, part))").alias("mask")
    classes = saved(classes.agg(F.min("doc_id").alias("cls"), mask, F.first("live").alias("live"), bits), "sets")
    reps = classes.where("cls IS NOT NULL AND size(live) > 0").select("cls", "n", "live", "bits")
    classes = classes.select(*same, "cls", "mask")
    links = verified(docs, frequent, first_partners(reps))
    found = components(links)
    links = links.unionByName(verified(docs, frequent, open_partners(reps, found)))
    roots = components(links)
    # a class may hold a third of all rows: its component goes to each part that has rows of it
    classes = classes.join(roots, F.col("cls") == F.col("node"), "left")
    held = F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.getbit(F.col("mask"), p) == 1)
    classes = classes.select(*same, F.explode(held).alias("part"), F.coalesce("root", "cls").alias("root"))
    out = light.select("doc_id", "part", *same).join(classes, [*same, "part"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))


def keep_first(docs):
    """One row of each component: the one with the smallest id, a null id last; rows without words stay.

    Rows are told apart by id and text, so texts that share an id are judged each for itself. Of
    rows that repeat both any one stays.
    """
    key = F.xxhash64(docs["doc_id"], docs["text"])
    ids = docs.select(key.alias("key"), "doc_id")
    found = jaccard_components(docs.select(key.alias("doc_id"), "text")).where("n_shingles > 0")
    found = found.groupBy(F.col("doc_id").alias("key"), F.col("component_id").alias("comp")).agg(F.count("*").alias("k"))
    # a component of one row needs no choice
    sizes = found.groupBy("comp").agg(F.sum("k").alias("all")).where(F.col("all") > 1).select("comp")
    found = saved(found.join(sizes, "comp"), "grouped-rows")
    named = found.join(ids.distinct(), "key")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    kept = named.groupBy("comp").agg(F.min(order).alias("first")).select(F.col("first.key").alias("key"), F.lit(True).alias("stays"))
    marks = found.join(kept, "key", "left").where("stays IS NULL OR k > 1")
    marks = saved(marks.select(F.col("key").alias("_key"), F.coalesce("stays", F.lit(False)).alias("_stays")), "marked-rows")
    rest = docs.join(marks, key == marks["_key"], "left_anti")
    twice = marks.where("_stays")
    if twice.isEmpty():
        return rest
    # copies are reduced where they are read, before rows of one key meet
    wanted = bloom_of(twice.select(F.col("_key").alias("token")), FILTER_WORDS)
    wanted = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            hit = _has(wanted.value, batch.column(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit))

    keyed = docs.select(key.alias("at"), F.struct(*docs.columns).alias("row"))
    copies = keyed.mapInArrow(run, keyed.schema).dropDuplicates(["at"])
    copies = copies.join(twice, copies["at"] == twice["_key"], "left_semi")
    return rest.unionByName(copies.select("row.*"))


def ngram_join_query(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
s AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM s JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents
      UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.reached) AS component_id
FROM documents d JOIN r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
