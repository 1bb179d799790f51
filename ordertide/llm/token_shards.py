"""Token ids in training order: fixed-stride shard files that are read in sequence and resumed anywhere.

Texts are encoded and cut into sequences of ``LENGTH`` ids, the last one padded. Sequences are
numbered as Spark numbers rows: a first pass counts those of each partition and digests its rows in
their order, a second adds the partition's base, and fails if a partition does not repeat its count and its
digest. A keyed Feistel network over
the next even number of bits, walked until it lands inside, turns the number into the sequence's
global slot: a permutation that needs no sort of the corpus and no memory. Slots are dealt out in
ranges of equal length, one shard and one partition each; a shard is written by one task, in slot order, by
Spark's own writer, so a lost executor leaves no half shard. A record is the ids as little-endian unsigned 16-bit integers
and one closing byte, so slot s is at byte ``(s % per_shard) * STRIDE`` of shard ``s // per_shard``.

Defined cases: null and empty texts have one sequence of a begin and an end id; each of several
equal rows has its own sequences; very long texts are many sequences; an empty table gives no
shard and an empty result; extra columns are ignored.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ordertide.llm.sentencepiece_bpe import CHUNK, codec_of, load, model_path, spread, with_ends
from ordertide.llm.shared import saved
from ordertide.llm.text import chunks, mix
from ordertide.session import run_folder

#: Ids of a sequence, bytes of a record, sequences of a shard, rounds of the network.
LENGTH, PER_SHARD, ROUNDS, KEY = 256, 1 << 15, 4, 20240229
STRIDE = 2 * LENGTH + 1


def permute(index, n, key=KEY):
    """The slot of each index below n: a Feistel network on 2k bits, walked while it is not below n."""
    half = np.uint64(max(1, (int(n - 1).bit_length() + 1) // 2)) if n > 1 else np.uint64(1)
    low = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    left = np.arange(len(out))
    while len(left):
        a, b = out[left] >> half, out[left] & low
        for r in range(ROUNDS):
            a, b = b, a ^ (mix(b + np.uint64((key + r * 0x9E3779B97F4A7C15) % (1 << 64))) & low)
        out[left] = (a << half) | b
        left = left[out[left] >= np.uint64(n)]
    return out.astype(np.int64)


def _sequences(counts):
    return -(-counts // LENGTH)


class Order:
    """A digest of a partition's ids and texts in their order, however they are cut into chunks."""

    def __init__(self):
        self.ids = self.lengths = self.bytes = 0

    def add(self, ids, chunk):
        self.ids = zlib.crc32("".join(f"{i}\n" for i in ids.to_pylist()).encode(), self.ids)
        self.lengths = zlib.crc32(np.diff(chunk.offsets).tobytes(), self.lengths)
        self.bytes = zlib.crc32(chunk.data, self.bytes)

    def value(self):
        return (self.ids << 31) ^ (self.lengths << 16) ^ self.bytes


def count_sequences(docs, tables):
    """doc_id, n_tokens, part (the partition), first (sequences before it there) and seen (digest of
    the partition up to the end of the row's chunk) of every row."""

    def run(batches):
        codec, done, part, order = codec_of(tables.value), 0, TaskContext.get().partitionId(), Order()
        for batch in batches:
            for at, to, chunk in chunks(batch, most=CHUNK):
                counts = codec.encode(chunk)[1] + 2
                n = _sequences(counts)
                first = done + np.cumsum(n) - n
                done += int(n.sum())
                ids = batch.column(0).slice(at, to - at)
                order.add(ids, chunk)
                columns = [ids, pa.array(counts), pa.array(np.full(to - at, part, np.int32)), pa.array(first)]
                columns.append(pa.array(np.full(to - at, order.value(), np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "part", "first", "seen"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, part int, first bigint, seen bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def records(docs, tables, bases, total):
    """slot and record of every sequence. bases: partition -> (sequences before it, its own, its digest)."""
    bases = docs.sparkSession.sparkContext.broadcast(bases)

    def run(batches):
        base, own, seen = bases.value.get(TaskContext.get().partitionId(), (0, 0, 0))
        codec, done, order = codec_of(tables.value), 0, Order()
        for batch in batches:
            for at, to, chunk in chunks(batch, most=CHUNK):
                order.add(batch.column(0).slice(at, to - at), chunk)
                ids, counts = with_ends(*codec.encode(chunk), codec.t["bos"], codec.t["eos"])
                n = _sequences(counts)
                flat = np.zeros((int(n.sum()), STRIDE), np.uint8)
                place = spread((np.cumsum(n) - n) * LENGTH, counts)
                wide = np.zeros(len(flat) * LENGTH, "<u2")
                wide[place] = ids
                flat[:, :-1] = wide.view(np.uint8).reshape(len(flat), 2 * LENGTH)
                slots = permute(np.arange(base + done, base + done + len(flat)), total)
                done += len(flat)
                body = np.ascontiguousarray(flat[:, :-1])
                ends = (np.arange(len(flat) + 1) * 2 * LENGTH).astype(np.int32)
                body = pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(ends), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays([pa.array(slots), body], ["slot", "record"])
        if (done, order.value()) != (own, seen):
            raise RuntimeError("a partition did not repeat its rows in order; write the input to a table first")

    return docs.select("doc_id", "text").mapInArrow(run, "slot bigint, record binary")


def write_shards(docs, model, path, per_shard=PER_SHARD):
    """Writes the shards under ``path`` and returns doc_id, sequence, n_tokens, slot, shard and offset
    (in bytes) of every sequence."""
    tables = docs.sparkSession.sparkContext.broadcast(load(model))
    docs = docs.select("doc_id", "text")
    counted = saved(count_sequences(docs, tables), "sequence-counts")
    n = F.ceil(F.col("n_tokens") / LENGTH)
    last = F.max_by("seen", "first").alias("seen")
    parts = counted.groupBy("part").agg(F.sum(n).cast("long").alias("n"), last).orderBy("part").collect()  # one row a partition
    bases, total = {}, 0
    for row in parts:
        bases[row.part] = (total, row.n, row.seen)
        total += row.n
    shards = -(-total // per_shard)
    if total:
        rows = records(docs, tables, bases, total)
        rows = rows.select(F.floor(F.col("slot") / per_shard).cast("int").alias("shard"), "slot", F.col("record").cast("string").alias("value"))
        rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "slot")
        rows.select("shard", "value").write.partitionBy("shard").option("lineSep", "\n").text(path)

    first = {part: base for part, (base, _, _) in bases.items()}

    def run(batches):
        for batch in batches:
            part, index = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            base = np.array([first[p] for p in part.tolist()], np.int64)
            slot = permute(base + index, total)
            columns = [batch.column(i) for i in range(3)] + [pa.array(slot), pa.array(slot // per_shard)]
            columns.append(pa.array(slot % per_shard * STRIDE))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sequence", "n_tokens", "slot", "shard", "offset"])

    pieces = counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).alias("sequence"), "n_tokens", "part", "first")
    left = F.least(F.lit(LENGTH), F.col("n_tokens") - F.col("sequence") * LENGTH).cast("long")
    pieces = pieces.select("doc_id", "sequence", left.alias("n_tokens"), "part", (F.col("first") + F.col("sequence")).alias("index"))
    kind = dict(docs.dtypes)["doc_id"]
    return pieces.mapInArrow(run, f"doc_id {kind}, sequence bigint, n_tokens bigint, slot bigint, shard bigint, offset bigint")


def read_slots(spark, path, first, count, per_shard=PER_SHARD):
    """slot and record (ids as bytes) of ``count`` slots from ``first`` on; opens only their shards."""
    files = spark.read.format("binaryFile").load(path)
    files = files.where(F.col("shard").between(first // per_shard, (first + count - 1) // per_shard))
    local = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / STRIDE) - 1)).alias("k")
    rows = files.where("length > 0").select("shard", "content", local)
    slot = F.col("shard") * per_shard + F.col("k")
    record = F.substring("content", (F.col("k") * STRIDE + 1).cast("int"), F.lit(2 * LENGTH))
    return rows.select(slot.alias("slot"), record.alias("record")).where(F.col("slot").between(first, first + count - 1))


def shards_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return write_shards(docs, model_path(), run_folder(spark, "token-shards"))
