"""Removal of bytes covered by 200-byte strings that start more than once, by winnowed fingerprints.

Only some suffixes are kept: of every 200 bytes, the position with the smallest bucket identifier
among their 50-byte strings (the leftmost of equals). Equal 200-byte strings choose the same
position, so a repeated string is found in the bucket of its chosen suffix, whatever surrounds it.

1. Initial buckets are the 50-byte strings at chosen positions. Those with one suffix are done.
2. A suffix stands for the strings that chose it; if all of them, with all their bytes, occur at
   another suffix of the bucket, they are repeated. Suffixes that are alike are one from here on.
3. Buckets with unlike suffixes are split: a suffix gives a row for each step of 25 in how far before
   it a string starts, under one fingerprint of the 176 bytes that all strings of a step share, made
   of the text's hashes at offsets 0, 50, 76 and 126.
4. Steps whose fingerprint still has unlike ends are split once more, string by string.

Nothing is sorted, and no identifier of another suffix is read: this takes the place of a recursive
bucket-pointer refinement. Strings have a fixed length, so a fixed depth settles every bucket.

Identifiers are 64-bit hashes, and every decision rests on two of them, of a bucket and of what it
was refined by. Work is spread by identifiers; counts are partial aggregations, so a string that a
third of all rows hold is one row per task. Only documents with a bucket left to refine, or a byte
to remove, have their texts moved (found by filters of bounded size whose false hits do no harm).

Defined cases: a null text is an empty one; texts under 200 bytes lose nothing; rows are places of
their own, so a repeated row repeats every string of it, and rows of one id and text get the same
result; very long texts are one array each; an empty table gives an empty result.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.ngram_join import _binary, _has, bloom_of
from ordertide.llm.sentencepiece_bpe import spread
from ordertide.llm.shared import saved, small_batches
from ordertide.llm.text import chunks, mix

#: Bytes of a string that must repeat, of an initial bucket, and of a step.
LENGTH, GRAM, STEP = 200, 50, 25
CORE = LENGTH - STEP + 1
#: Bytes of texts that a task works on at once; its arrays hold some hundred bytes for each.
CHUNK = 1 << 18
#: 64-bit words of the filters over buckets and rows.
BUCKET_WORDS, ROW_WORDS = 1 << 21, 1 << 19

_PLACE_BITS = np.uint64(30)
_OFFSETS = LENGTH - GRAM + 1


def _grams(chunk, prefix, at):
    """Bucket identifiers of the GRAM bytes from each position."""
    return chunk.hashes(at, at + GRAM, prefix)


def _longer(shorter, later):
    """The identifier of a string from those of two parts of it."""
    return mix(shorter * np.uint64(0x9E3779B97F4A7C15) + mix(later))


def suffixes(chunk):
    """Chosen positions: document, position, first and last start of the strings that chose it,
    bucket identifier, and an identifier of all bytes of those strings."""
    n = len(chunk.data)
    size = np.diff(chunk.offsets)
    room = np.maximum(size - LENGTH + 1, 0)
    if not room.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = chunk.prefix()
    count = n - GRAM + 1
    rank = chunk.windows(GRAM, prefix)
    rank >>= _PLACE_BITS
    rank <<= _PLACE_BITS
    rank |= np.arange(count, dtype=np.uint64)
    wide = -(-count // _OFFSETS) * _OFFSETS
    rank = np.append(rank, np.full(wide - count, ~np.uint64(0))).reshape(-1, _OFFSETS)
    ahead = np.minimum.accumulate(rank, axis=1).ravel()
    behind = np.minimum.accumulate(rank[:, ::-1], axis=1)[:, ::-1].ravel()
    del rank
    starts = spread(chunk.offsets[:-1], room)
    chosen = np.minimum(behind[starts], ahead[starts + _OFFSETS - 1])
    chosen = (chosen & np.uint64((1 << 30) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(chunk.n), room)
    new = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    last = np.append(new[1:], len(starts)) - 1
    place, low, high, doc = chosen[new], starts[new], starts[last], doc[new]
    whole = chunk.hashes(low, high + LENGTH, prefix)
    whole = _longer(whole, (place - low).astype(np.uint64))
    return doc, place, low, high, _grams(chunk, prefix, place), whole


def _keyed(docs):
    return docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )


def bucket_sizes(rows):
    """bucket and whether its suffixes are unlike (mixed), for buckets of two suffixes or more."""

    def run(batches):
        for batch in batches:
            for _, _, chunk in chunks(batch, most=CHUNK):
                *_, bucket, whole = suffixes(chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64)), pa.array(whole.view(np.int64))], ["bucket", "whole"]
                )

    found = rows.select("text").mapInArrow(run, "bucket bigint, whole bigint")
    sizes = found.groupBy("bucket").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
    return sizes.where("n > 1").select("bucket", (F.col("a") != F.col("b")).alias("mixed"))


def kept_suffixes(rows, bloom):
    """Suffixes whose bucket passes the filter: bucket, whole, row, id, place, low and high."""
    bloom = rows.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch, most=CHUNK):
                doc, place, low, high, bucket, whole = suffixes(chunk)
                keep = np.flatnonzero(_has(bloom.value, bucket))
                doc = doc[keep]
                own = chunk.offsets[doc]
                who = [batch.column(i).slice(at, to - at).take(pa.array(doc)) for i in (0, 1)]
                columns = [pa.array(x[keep].view(np.int64)) for x in (bucket, whole)] + who
                columns += [pa.array((x[keep] - own).astype(np.int32)) for x in (place, low, high)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "whole", "row", "id", "place", "low", "high"])

    kind = dict(rows.dtypes)["id"]
    schema = f"bucket bigint, whole bigint, row bigint, id {kind}, place int, low int, high int"
    return rows.mapInArrow(run, schema)


def steps(texts):
    """Rows of one step of a suffix: key (bucket and fingerprint of the step), row, id, start (of the
    step's strings that begin last), and the bytes before and after what they share.

    texts: row, id, text and ``at``, the bucket, place, low and high of the row's suffixes.
    """
    kind = dict(texts.dtypes)["id"]

    def run(batches):
        for batch in batches:
            for a, b, chunk in chunks(batch, most=CHUNK):
                lists = batch.column(3).slice(a, b - a)
                flat = lists.flatten()
                bucket, place, low, high = (
                    flat.field(c).to_numpy(zero_copy_only=False) for c in ("bucket", "place", "low", "high")
                )
                doc = np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                first = (place - high) // STEP
                n = (place - low) // STEP - first + 1
                which = np.repeat(np.arange(len(place)), n)
                k = spread(first, n)
                base = chunk.offsets[doc][which]
                core = (base + place[which] - STEP * k).astype(np.int64)
                most = np.minimum(STEP * k + STEP - 1, (place - low)[which]) - STEP * k
                least = np.maximum(STEP * k, (place - high)[which]) - STEP * k
                prefix = chunk.prefix()
                two = [_longer(_grams(chunk, prefix, core + s), _grams(chunk, prefix, core + s + GRAM)) for s in (0, CORE - 2 * GRAM)]
                refined = _longer(bucket.view(np.uint64)[which], _longer(two[0], two[1]) + k.astype(np.uint64))
                sides = []
                for start, size in ((core - most, most), (core + CORE, STEP - 1 - least)):
                    sides.append(_binary(chunk.data[spread(start, size)], size))
                who = [batch.column(i).slice(a, b - a).take(pa.array(doc[which])) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(refined.view(np.int64)), *who, pa.array((core - base).astype(np.int32)), *sides],
                    ["key", "row", "id", "start", "before", "after"],
                )

    return texts.select("row", "id", "text", "at").mapInArrow(
        run, f"key bigint, row bigint, id {kind}, start int, before binary, after binary"
    )


def _alike(rows, bucket, by, firsts):
    """One row per (bucket, by): how many there are (n) and the columns of one of them."""
    return rows.groupBy(bucket, *by).agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in firsts))


def repeated_spans(rows):
    """row, id, a and b: spans of bytes that repeated strings cover."""
    sizes = saved(bucket_sizes(rows), "buckets")
    words = min(BUCKET_WORDS, 1 << max(10, int(sizes.count() // 8).bit_length()))
    found = kept_suffixes(rows, bloom_of(sizes.select(F.col("bucket").alias("token")), words))
    found = saved(found.join(sizes, "bucket"), "suffixes")

    alike = saved(_alike(found, "bucket", ["whole"], ["mixed", "row", "id", "place", "low", "high"]), "alike")
    twice = alike.where("n > 1").select("bucket", "whole")
    spans = found.join(twice, ["bucket", "whole"]).select("row", "id", F.col("low").alias("a"), (F.col("high") + LENGTH).alias("b"))

    unlike = alike.where("mixed").select("row", F.struct("bucket", "place", "low", "high").alias("s"))
    unlike = saved(unlike.groupBy("row").agg(F.collect_list("s").alias("at")), "to-refine")
    texts = _texts_of(rows, _row_filter(unlike)).join(unlike, "row")
    refined = saved(steps(texts), "refined")
    open_keys = refined.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    refined = refined.join(open_keys, "key")
    ends = saved(_alike(refined, "key", ["before", "after"], ["row", "id", "start"]), "ends")
    first, last = F.col("start") - F.length("before"), F.col("start") - (STEP - 1 - F.length("after"))
    twice = ends.where("n > 1").select("key", "before", "after")
    spans = spans.unionByName(
        refined.join(twice, ["key", "before", "after"]).select("row", "id", first.alias("a"), (last + LENGTH).alias("b"))
    )

    still = ends.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    each = ends.join(still, "key").withColumn("j", F.explode(F.sequence(STEP - 1 - F.length("after"), F.length("before"))))
    ahead = F.substring("before", F.length("before") - F.col("j") + 1, F.col("j"))
    name = F.xxhash64(ahead, F.substring("after", F.lit(1), STEP - 1 - F.col("j")))
    each = each.select("key", "j", name.alias("string"), "row", "id", (F.col("start") - F.col("j")).alias("a"))
    twice = each.groupBy("key", "j", "string").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    return spans.unionByName(
        each.join(twice, ["key", "j", "string"]).select("row", "id", "a", (F.col("a") + LENGTH).alias("b"))
    )


def _row_filter(wanted):
    """A filter over the keys in ``wanted`` (column row), for all tasks."""
    names = wanted.select(F.col("row").alias("token"))
    return wanted.sparkSession.sparkContext.broadcast(bloom_of(names, ROW_WORDS))


def _texts_of(rows, bloom):
    """The rows whose key may be in the filter."""

    def run(batches):
        for batch in batches:
            hit = _has(bloom.value, batch.column(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit))

    return rows.mapInArrow(run, rows.schema)


def _cut(chunk, ids, doc, a, b, keep_text):
    """One batch of results: the texts of the chunk without the bytes from ``a`` to ``b`` of each ``doc``."""
    edge = np.zeros(len(chunk.data) + 1, np.int64)
    np.add.at(edge, chunk.offsets[doc] + a, 1)
    np.add.at(edge, chunk.offsets[doc] + b, -1)
    gone = np.cumsum(edge)[:-1] > 0
    n_gone = chunk.per_doc(gone)
    begins = gone & ~np.concatenate(([False], gone[:-1])) if len(gone) else gone
    heads = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
    begins[heads] = gone[heads]
    n_spans = chunk.per_doc(begins)
    kept = chunk.data[~gone].tobytes()
    ends = np.concatenate(([0], np.cumsum(np.diff(chunk.offsets) - n_gone)))
    kept = [kept[a:b] for a, b in zip(ends, ends[1:])]
    if not keep_text:
        kept = [hashlib.sha256(k).hexdigest() for k in kept]
    columns = [ids, pa.array(np.diff(chunk.offsets)), pa.array(n_gone), pa.array(n_spans)]
    columns.append(pa.array(kept, pa.binary() if keep_text else pa.string()))
    return pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(rows, keep_text):
    """id, n_bytes, n_removed, n_spans and the remaining bytes (or their sha256) of every row."""
    # rows of one key have the same text, so their spans are the same set
    spans = repeated_spans(rows).groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    spans = saved(spans, "spans")
    bloom = _row_filter(spans)
    none = F.array().cast("array<struct<a:int,b:int>>")
    cut = _texts_of(rows, bloom).join(spans, "row", "left").select("id", "text", F.coalesce("spans", none).alias("spans"))

    def run(batches):
        for batch in batches:
            for at, to, chunk in chunks(batch, most=CHUNK):
                lists = batch.column(2).slice(at, to - at)
                flat = lists.flatten()
                doc = np.repeat(np.arange(chunk.n), np.diff(lists.offsets.to_numpy()))
                a, b = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
                yield _cut(chunk, batch.column(0).slice(at, to - at), doc, a, b, keep_text)

    def run_plain(batches):
        """The texts that are surely without spans, in the pass that picks them."""
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            batch = batch.filter(pa.array(~_has(bloom.value, batch.column(0).to_numpy().view(np.uint64))))
            for at, to, chunk in chunks(batch, most=CHUNK):
                yield _cut(chunk, batch.column(1).slice(at, to - at), nothing, nothing, nothing, keep_text)

    schema = f"id {dict(rows.dtypes)['id']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept "
    schema += "binary" if keep_text else "string"
    return rows.mapInArrow(run_plain, schema).unionByName(cut.mapInArrow(run, schema))


def remove_repeats(docs):
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the remaining bytes (they may cut a character)."""
    with small_batches(docs.sparkSession):
        found = without_repeats(_keyed(docs), True)
    return found.withColumnRenamed("id", "doc_id")


def repeats_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with small_batches(spark):
        found = saved(without_repeats(_keyed(docs), False), "digests")  # one short row for each text
    return found.withColumnsRenamed({"id": "doc_id", "kept": "kept_sha256"})
