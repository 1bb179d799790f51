"""Search for short test items inside documents: MinHash containment by item size, verified exactly.

Items are partitioned by their number of distinct 5-word shingles. Each has a bottom-k MinHash
sketch of its shingles, k by partition, and a document is a candidate if it holds enough of the
sketch: items of the first partition are their own sketch, so their search is exact; in the
others an item of which 80 % are in the document misses with a chance below 1e-9. A document
needs no sketch of its own, however long it is: one pass over its whole text keeps those of its
shingles that a Bloom filter of bounded size over all item shingles lets through. They are joined with the
sketches alone; only for the candidates found so are all shingles of an item looked up
and verified by exact containment: shared shingles over item shingles of at least 0.8.

Defined cases: items of fewer than five words have no shingle and match nothing, as do null and
empty texts; items with equal texts match alike; rows that repeat an id count as one document
and rows with a null id are not searched, but ``clean`` judges every row by itself; an empty table on either side gives an empty result; other
columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.ngram_join import _has, bloom_of
from ordertide.llm.shared import saved
from ordertide.llm.text import SHINGLE, chunks, distinct, mix, shingles

#: Containment of at least this part of an item's shingles, in percent.
NEED_PERCENT = 80
#: Partitions by item size: (largest size, sketch size k, shingles of the sketch that are needed).
PARTITIONS = ((32, 32, None), (256, 32, 8), (2**62, 48, 16))
#: 64-bit words of the Bloom filter over item shingles.
FILTER_WORDS = 1 << 19


def _shingles(chunk):
    """Distinct full shingles of each document, as 63-bit hashes."""
    starts, ends, docs = chunk.words()
    words = chunk.hashes(starts, ends, chunk.prefix(fold=True))
    grams, owner = shingles(words, docs, chunk.n)
    full = np.bincount(docs, minlength=chunk.n)[owner] >= SHINGLE
    return distinct(grams[full] >> np.uint64(1), owner[full])


def item_sketches(items):
    """item_id, n (shingles), need (of the sketch), and each shingle with whether it is in the sketch."""

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                tokens, owner = _shingles(chunk)
                rank = np.lexsort((mix(tokens), owner))  # a second hash, so the sketch is a random one
                tokens, owner = tokens[rank], owner[rank]
                n = np.bincount(owner, minlength=chunk.n)
                place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
                part = np.searchsorted([p[0] for p in PARTITIONS], n)
                size = np.array([p[1] for p in PARTITIONS])[part]
                exact = -(-NEED_PERCENT * n // 100)
                need = np.where(part == 0, exact, np.array([p[2] or 0 for p in PARTITIONS])[part])
                ids = batch.column(0).slice(at, to - at).take(pa.array(owner))
                columns = [ids, pa.array(n[owner]), pa.array(need[owner]), pa.array(tokens.view(np.int64))]
                columns.append(pa.array(place < size[owner]))
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "n", "need", "token", "sketched"])

    schema = f"item_id {dict(items.dtypes)['item_id']}, n bigint, need bigint, token bigint, sketched boolean"
    return items.select("item_id", "text").where("item_id IS NOT NULL").mapInArrow(run, schema).distinct()


def document_hits(docs, bloom):
    """doc_id and shingle for each distinct shingle of a document that may be an item's."""
    bloom = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch):
                tokens, owner = _shingles(chunk)
                hit = _has(bloom.value, tokens)
                ids = batch.column(0).slice(at, to - at).take(pa.array(owner[hit]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(tokens[hit].view(np.int64))], ["doc_id", "token"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, token bigint"
    return docs.select("doc_id", "text").where("doc_id IS NOT NULL").mapInArrow(run, schema).distinct()


def candidates(hits, sketches):
    """doc_id, item_id, n_item and in_sketch of every pair in which enough of the item's sketch is found."""
    found = hits.join(sketches.where("sketched"), "token").groupBy("doc_id", "item_id")
    found = found.agg(F.count("*").alias("in_sketch"), F.max("need").alias("need"), F.max("n").alias("n_item"))
    return saved(found.where("in_sketch >= need").drop("need"), "item-candidates")


def contaminated(docs, items):
    """doc_id, item_id, n_item and n_shared of every item that a document contains."""
    sketches = saved(item_sketches(items), "item-shingles")
    bloom = bloom_of(sketches.select("token").distinct(), FILTER_WORDS)
    hits = saved(document_hits(docs, bloom), "item-hits")
    found = candidates(hits, sketches)
    whole = found.where(F.col("n_item") <= PARTITIONS[0][0])  # the sketch is the item, its count exact
    large = found.where(F.col("n_item") > PARTITIONS[0][0]).select("doc_id", "item_id", "n_item")
    pairs = large.join(sketches.select("item_id", "token"), "item_id").join(hits, ["doc_id", "token"])
    shared = pairs.groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_shared"))
    both = shared.unionByName(whole.select("doc_id", "item_id", "n_item", F.col("in_sketch").alias("n_shared")))
    return both.where(100 * F.col("n_shared") >= NEED_PERCENT * F.col("n_item"))


def clean(docs, items):
    """The rows that contain no item, each judged by its own text, whatever its id."""
    key = F.xxhash64(docs["doc_id"], docs["text"])
    dirty = contaminated(docs.select(key.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("_dirty")).distinct()
    return docs.join(dirty, key == dirty["_dirty"], "left_anti")


def decontaminate_query(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, items)


_WORDS = r"""list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '')"""
DECONTAMINATE_SQL = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g
      FROM dw WHERE len(w) >= 5),
i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g
      FROM iw WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared FROM s JOIN n USING (item_id) WHERE 100 * n_shared >= {NEED_PERCENT} * n_item
"""
