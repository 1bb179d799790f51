"""SentencePiece BPE encoding and decoding in rounds of array operations.

Texts become flat code points; a segment ends wherever no piece of the vocabulary holds the
two neighbouring characters, so no merge can cross it. Every distinct segment is merged once:
in each round the least pair rank of every open segment is found, all its occurrences are
merged from the left, and finished segments leave the arrays. The result equals merging the
best, then leftmost pair one at a time: where a merged piece could open a pair that ranks no
lower (or ranks tie), a round merges only the first occurrence in that segment.

Defined cases: null and empty texts have no pieces (only the begin and end ids); characters
outside the vocabulary become byte pieces; bytes that are no UTF-8 decode to U+FFFD; repeated
rows are encoded alike; an empty table gives an empty result; extra columns are ignored. The
model must be BPE with byte pieces, a leading blank and no text normalisation.
"""

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.text import chunks, mix, powers

#: Bytes of text that are encoded at a time (or one document), and segments that a process remembers (with 4 pieces for each).
CHUNK, REMEMBER = 2 << 20, 1_000_000
#: Rounds after which what is left of a segment is merged with a heap.
ROUNDS = 48
BLANK = 0x2581
_FAR = np.int32(2**31 - 1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def load(model):
    """Tables of a model file: pieces, ranks, merges and neighbours, as arrays small enough to broadcast."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    size = sp.get_piece_size()
    kinds = [sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
    if any(sp.is_unused(i) for i in range(size)) or not any(sp.is_byte(i) for i in range(size)):
        raise ValueError("a BPE model with byte pieces and without unused pieces is needed")
    text = [sp.id_to_piece(i) for i in range(size)]
    normal = [i for i in range(size) if not kinds[i] and not sp.is_byte(i)]
    alphabet = sorted({c for i in normal for c in text[i]})
    symbol = {text[i]: i for i in normal}
    for k, c in enumerate(alphabet):
        symbol.setdefault(c, size + k)
    scores = sorted({sp.get_score(i) for i in normal}, reverse=True)
    place = {s: r for r, s in enumerate(scores)}
    rank = {i: place[sp.get_score(i)] for i in normal}
    times = np.bincount(list(rank.values()), minlength=len(scores))
    careful = np.zeros(size + len(alphabet), bool)
    careful[[i for i in normal if times[rank[i]] > 1]] = True
    merges, neighbours = {}, set()
    for i in normal:
        piece = text[i]
        neighbours.update(zip(piece, piece[1:]))
        for k in range(1, len(piece)):
            a, b = symbol.get(piece[:k]), symbol.get(piece[k:])
            if a is not None and b is not None:
                merges[a * len(careful) + b] = (rank[i], i)
                for part in (a, b):
                    if part < size and rank[i] <= rank[part]:
                        careful[part] = True
    at = {c: k + 1 for k, c in enumerate(alphabet)}
    keys = np.array(sorted(merges), np.int64)
    out = [b"" if kinds[i] else text[i].replace("▁", " ").encode() for i in range(size)]
    out[sp.unk_id()] = " ⁇ ".encode()
    byte_ids = [0] * 256
    for i in range(size):
        if sp.is_byte(i):
            byte = int(text[i][3:5], 16)
            byte_ids[byte], out[i] = i, bytes([byte])
    with open(model, "rb") as file:
        name = hashlib.sha256(file.read()).hexdigest()
    return {
        "name": name,
        "size": size,
        "symbols": len(careful),
        "bos": sp.bos_id(),
        "eos": sp.eos_id(),
        "alphabet": np.array([ord(c) for c in alphabet], np.int32),
        "first": np.array([symbol[c] for c in alphabet], np.int32),
        "keys": keys,
        "ranks": np.array([merges[k][0] for k in keys.tolist()], np.int32),
        "pieces": np.array([merges[k][1] for k in keys.tolist()], np.int32),
        "careful": careful,
        "neighbours": np.array(sorted(at[a] * (len(alphabet) + 1) + at[b] for a, b in neighbours), np.int64),
        "byte_ids": np.array(byte_ids, np.int32),
        "piece_bytes": np.frombuffer(b"".join(out), np.uint8),
        "piece_ends": np.cumsum([0, *map(len, out)]),
    }


def spread(starts, sizes):
    """The positions starts[i] .. starts[i] + sizes[i] - 1 of all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def distinct_names(values):
    """``np.unique`` with the first place and the number of each value, sorting only the distinct ones."""
    coded = pa.array(values).dictionary_encode()
    names, inverse = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    first = np.empty(len(names), np.int64)
    first[inverse[::-1]] = np.arange(len(values) - 1, -1, -1)
    order = np.argsort(names)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    return names[order], first[order], place[inverse]


_CODECS = {}


def codec_of(tables):
    """The process's codec of a model: tasks that share a worker merge a segment once. Only the last model's is kept."""
    codec = _CODECS.get(tables["name"])
    if codec is None:
        _CODECS.clear()
        codec = _CODECS[tables["name"]] = Codec(tables)
    return codec


class Codec:
    """Encoder and decoder; remembers the pieces of segments seen before."""

    def __init__(self, tables):
        self.t = tables
        width = len(tables["alphabet"]) + 1
        self.width = width
        self.char = np.zeros(0x110000, np.int32)
        self.char[tables["alphabet"]] = np.arange(1, width)
        self.joined = np.zeros(width * width, bool)
        self.joined[tables["neighbours"]] = True
        bits = int(len(tables["keys"]) * 4).bit_length()
        self._slots(bits)
        self.known = np.zeros(0, np.uint64)
        self.known_at, self.known_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.again = np.zeros(0, np.int32), np.zeros(0, bool)

    def _slots(self, bits):
        """An open-addressed table of the merges: probing it beats a binary search."""
        keys, size = self.t["keys"], 1 << bits
        self.mask = np.int64(size - 1)
        self.slot_key, self.slot_at = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        left, step = np.arange(len(keys)), np.int64(0)
        while len(left):
            slot = self._slot(keys[left], step)
            free = self.slot_key[slot] < 0
            self.slot_key[slot[free]], self.slot_at[slot[free]] = keys[left[free]], left[free]
            left = left[self.slot_key[slot] != keys[left]]
            step += 1
        self.probes = int(step)

    def _slot(self, keys, step):
        return (mix(keys.astype(np.uint64)).astype(np.int64) + step) & self.mask

    def lookup(self, a, b):
        """Index of the merge of each pair of symbols, or -1."""
        keys = a.astype(np.int64) * self.t["symbols"] + b
        out = np.full(len(keys), -1, np.int32)
        left = np.flatnonzero((a < self.t["symbols"]) & (b < self.t["symbols"]))
        for step in range(self.probes):
            slot = self._slot(keys[left], np.int64(step))
            there = self.slot_key[slot]
            hit = there == keys[left]
            out[left[hit]] = self.slot_at[slot[hit]]
            left = left[~hit & (there >= 0)]
            if not len(left):
                break
        return out

    def forget(self):
        """Segments that were not met again since the last time go, or all if that would be few."""
        keep = np.flatnonzero(self.again)
        if 2 * len(keep) > REMEMBER or self.known_n[keep].sum() > 2 * REMEMBER:
            keep = keep[:0]
        self.known, n = self.known[keep], self.known_n[keep]
        self.ids = self.ids[spread(self.known_at[keep], n)]
        self.known_at, self.known_n, self.again = np.cumsum(n) - n, n, np.zeros(len(keep), bool)

    def _unknown(self, names):
        at = np.searchsorted(self.known, names)
        hit = np.zeros(len(names), bool)
        inside = at < len(self.known)
        hit[inside] = self.known[at[inside]] == names[inside]
        self.again[at[hit]] = True
        return np.flatnonzero(~hit)

    def encode(self, chunk):
        """All ids of a chunk's documents, without begin and end, and the number of each document."""
        points = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        sizes = chunk.per_doc((chunk.data & 0xC0) != 0x80)
        if sizes.sum() != len(points):  # bytes that are no UTF-8
            parts = [
                chunk.data[a:b].tobytes().decode("utf-8", "replace")
                for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)
            ]
            sizes = np.array([len(p) for p in parts], np.int64)
            points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        full = sizes > 0
        ends = np.cumsum(sizes)
        points = np.insert(points, (ends - sizes)[full], BLANK)
        points[points == 0x20] = BLANK
        sizes = sizes + full
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(chunk.n, np.int64)
        char = self.char[points]
        new = np.ones(len(points), bool)
        new[1:] = ~self.joined[char[:-1] * self.width + char[1:]]
        new[(np.cumsum(sizes) - sizes)[full]] = True
        starts = np.flatnonzero(new)
        lengths = np.diff(starts, append=len(points))
        values = points.astype(np.uint64)
        values += np.uint64(1)
        values *= powers(_BASE, len(points))
        sums = np.add.reduceat(values, starts) * powers(_BASE_INVERSE, len(points))[starts]
        names, first, inverse = distinct_names(mix(sums + lengths.astype(np.uint64)))
        miss = self._unknown(names)
        if len(miss):
            if len(self.known) + len(miss) > REMEMBER or len(self.ids) > 4 * REMEMBER:
                self.forget()
                miss = self._unknown(names)
            ids, counts = self.merge(points, char, starts[first[miss]], lengths[first[miss]])
            where = np.searchsorted(self.known, names[miss])
            self.known = np.insert(self.known, where, names[miss])
            self.known_at = np.insert(self.known_at, where, len(self.ids) + np.cumsum(counts) - counts)
            self.known_n = np.insert(self.known_n, where, counts)
            self.again = np.insert(self.again, where, False)
            self.ids = np.concatenate((self.ids, ids))
        at = np.searchsorted(self.known, names)[inverse]
        n = self.known_n[at]
        ids = self.ids[spread(self.known_at[at], n)]
        tokens = np.concatenate(([0], np.cumsum(n)))
        edges = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))), "left")
        return ids, np.diff(tokens[edges])

    def merge(self, points, char, starts, lengths):
        """Ids of the given segments, one after the other, and how many each has."""
        take = spread(starts, lengths)
        t, owner = self.t, np.repeat(np.arange(len(starts)), lengths)
        chars = char[take]
        symbol = np.where(chars > 0, t["first"][np.maximum(chars, 1) - 1], t["symbols"] + points[take]).astype(np.int32)
        done = []

        def ranks(at):
            found = self.lookup(symbol[at], symbol[at + 1])
            return np.where(found >= 0, t["ranks"][found], _FAR), np.where(found >= 0, t["pieces"][found], -1)

        def compute(at, rank, piece):
            at = at[(at >= 0) & (at < len(symbol) - 1)]
            at = at[owner[at] == owner[at + 1]]
            rank[at], piece[at] = ranks(at)

        rank, piece = np.full(len(symbol), _FAR), np.full(len(symbol), -1, np.int32)
        compute(np.arange(len(symbol)), rank, piece)
        for step in range(ROUNDS + 1):
            if not len(symbol):
                break
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(heads, append=len(symbol))
            least = np.minimum.reduceat(rank, heads)
            ready = np.repeat(least == _FAR, sizes)
            done.append((owner[ready], symbol[ready]))
            least = np.repeat(least, sizes)[~ready]
            symbol, owner, rank, piece = symbol[~ready], owner[~ready], rank[~ready], piece[~ready]
            if step == ROUNDS or not len(symbol):
                break
            best = np.flatnonzero(rank == least)
            run = np.flatnonzero(np.diff(best, prepend=-2) != 1)
            turn = np.arange(len(best)) - np.repeat(run, np.diff(run, append=len(best)))
            lead = np.diff(owner[best], prepend=-1) != 0
            best = best[(turn % 2 == 0) & (lead | ~t["careful"][piece[best]])]
            symbol[best] = piece[best]
            gone = np.zeros(len(symbol), bool)
            gone[best + 1] = True
            fresh = best - np.cumsum(gone)[best]
            symbol, owner, rank, piece = symbol[~gone], owner[~gone], rank[~gone], piece[~gone]
            near = np.zeros(len(symbol) + 1, bool)
            near[fresh], near[fresh - 1] = True, True  # the one before the first is the spare last one
            touched = np.flatnonzero(near[:-1])
            rank[touched], piece[touched] = _FAR, -1
            compute(touched, rank, piece)
        if len(symbol):
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            for part, who in zip(np.split(symbol, heads[1:]), owner[heads], strict=True):
                rest = self._heap(part.tolist())
                done.append((np.full(len(rest), who), np.array(rest, np.int32)))
        owner, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return self._bytes(owner[order], symbol[order], len(starts))

    def _heap(self, symbols):
        """The best, then leftmost pair again and again; for the few long segments left."""
        size, keys = len(symbols), self.t["keys"]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def push(i):
            j = after[i]
            if j < size:
                key = symbols[i] * self.t["symbols"] + symbols[j]
                at = int(np.searchsorted(keys, key))
                if at < len(keys) and keys[at] == key:
                    heapq.heappush(heap, (int(self.t["ranks"][at]), i, symbols[i], symbols[j], int(self.t["pieces"][at])))

        for i in range(size - 1):
            push(i)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= size or symbols[j] != b:
                continue
            symbols[i], symbols[j] = whole, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s >= 0]

    def _bytes(self, owner, symbol, n):
        """Ids of symbols: those that are no piece become the byte pieces of their character."""
        t = self.t
        odd = np.flatnonzero(symbol >= t["size"])
        if len(odd):
            point = symbol[odd] - t["symbols"]
            own = point < 0
            point[own] = t["alphabet"][symbol[odd][own] - t["size"]]
            kinds, which = np.unique(point, return_inverse=True)
            parts = [t["byte_ids"][list(chr(p).encode("utf-8", "replace"))] for p in kinds.tolist()]
            wide = np.ones(len(symbol), np.int64)
            wide[odd] = np.array([len(p) for p in parts])[which]
            ends = np.cumsum(wide)
            out = np.repeat(symbol, wide)
            flat, from_ = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
            out[spread((ends - wide)[odd], wide[odd])] = flat[spread(from_[which], wide[odd])]
            symbol, owner = out, np.repeat(owner, wide)
        return symbol.astype(np.int32), np.bincount(owner, minlength=n)

    def decode(self, ids, counts):
        """Texts as bytes and their offsets; one leading blank of each text goes."""
        t = self.t
        sizes = np.diff(t["piece_ends"])[ids]
        data = t["piece_bytes"][spread(t["piece_ends"][ids], sizes)]
        tokens = np.concatenate(([0], np.cumsum(counts)))
        ends = np.concatenate(([0], np.cumsum(sizes)))[tokens]
        lead = ends[:-1][ends[1:] > ends[:-1]]
        lead = lead[data[lead] == 0x20]
        keep = np.ones(len(data), bool)
        keep[lead] = False
        return data[keep], np.concatenate(([0], np.cumsum(keep)))[ends]


def with_ends(ids, counts, bos, eos):
    """The ids with a begin and an end id around each document, and the new counts."""
    out = np.empty(len(ids) + 2 * len(counts), np.uint32)
    first = np.cumsum(counts) - counts + 2 * np.arange(len(counts))
    out[first], out[first + counts + 1] = bos, eos
    out[spread(first + 1, counts)] = ids
    return out, counts + 2


def encode_documents(docs, model, ends=True):
    """doc_id and ids (int array) of every text."""
    tables = docs.sparkSession.sparkContext.broadcast(load(model))

    def run(batches):
        codec = codec_of(tables.value)
        for batch in batches:
            for at, to, chunk in chunks(batch, most=CHUNK):
                ids, counts = codec.encode(chunk)
                if ends:
                    ids, counts = with_ends(ids, counts, codec.t["bos"], codec.t["eos"])
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), ids], ["doc_id", "ids"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(encoded, model):
    """doc_id and text of rows with ids; byte pieces that form no UTF-8 become U+FFFD."""
    tables = encoded.sparkSession.sparkContext.broadcast(load(model))

    def run(batches):
        codec = codec_of(tables.value)
        for batch in batches:
            rows = batch.column(1)
            counts = np.diff(rows.offsets.to_numpy())
            data, offsets = codec.decode(rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def token_digests(docs, model):
    """doc_id, n_tokens, and hashes of the ids and of the text they decode to, in one pass."""
    tables = docs.sparkSession.sparkContext.broadcast(load(model))

    def run(batches):
        codec = codec_of(tables.value)
        for batch in batches:
            for at, to, chunk in chunks(batch, most=CHUNK):
                ids, counts = with_ends(*codec.encode(chunk), codec.t["bos"], codec.t["eos"])
                data, offsets = codec.decode(ids, counts)
                ends, ids, data = np.concatenate(([0], np.cumsum(counts))), ids.astype("<u4"), data.tobytes()
                columns = [
                    batch.column(0).slice(at, to - at),
                    pa.array(counts),
                    pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]),
                    pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:])]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def model_path(name="piece_bpe_32k.model"):
    import public_tokenizers

    return str(public_tokenizers.path(name))


def sentencepiece_query(spark, sf_dir):
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path())


def token_table(docs, model):
    """All columns of the documents with n_tokens, ids and the decoded text in place of the text."""
    encoded = encode_documents(docs, model)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))
