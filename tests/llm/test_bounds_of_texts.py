"""What the text operators hold at once, and that sorting by document gives what one sort gave."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrameWriter

from ordertide.llm import ngram_join, repeats, sentencepiece_bpe
from ordertide.llm.text import chunks, distinct, sort_each

_DICE = np.random.default_rng(3)


def _batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])


def test_repeats_hold_few_bytes_for_each_chunk():
    texts = [bytes(_DICE.integers(97, 123, 2000, dtype=np.uint8)).decode() for _ in range(2000)]
    tracemalloc.start()
    for _, _, chunk in chunks(_batch(texts), most=repeats.CHUNK):
        repeats.suffixes(chunk)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6  # 2 MB chunks held 163 MB


def test_repeats_hold_no_more_for_many_texts_than_for_few():
    texts = [bytes(_DICE.integers(97, 123, 2000, dtype=np.uint8)).decode() for _ in range(2000)]
    tracemalloc.start()
    for _, _, chunk in chunks(_batch(texts), most=repeats.CHUNK):
        repeats.suffixes(chunk)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6  # 1 MB chunks held 68 MB


def test_repeats_move_few_texts_at_once_and_plain_ones_once(spark, tmp_path, monkeypatch):
    same = "".join(chr(97 + i * i % 23) + str(i) for i in range(150))
    rows = [(1, same), (2, f"{same} and more"), (3, "plain"), (4, None), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    name, seen, plans, parquet = "spark.sql.execution.arrow.maxRecordsPerBatch", [], [], DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return parquet(self, path, *args, **kwargs)

    def kept(df, what, keep=repeats.saved):
        if what == "digests":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, what)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    monkeypatch.setattr(repeats, "saved", kept)
    before = spark.conf.get(name)
    got = sorted(tuple(r)[:4] for r in repeats.repeats_query(spark, str(tmp_path)).collect())
    n = len(same)
    assert got == [(1, n, n, 1), (2, n + 9, n, 1), (3, 5, 0, 0), (4, 0, 0, 0), (4, 0, 0, 0)]
    assert max(seen) <= 1000 < int(before) and spark.conf.get(name) == before
    # the filter and the cut of texts with spans, and one pass for the others
    assert len(plans) == 1 and plans[0].count("MapInArrow") == 3


def test_segments_are_named_without_sorting_them_all(monkeypatch):
    values = _DICE.integers(0, 1 << 63, 500).astype(np.uint64)[_DICE.integers(0, 500, 20_000)] * np.uint64(2)
    for some in (values, values[:1]):
        want = np.unique(some, return_index=True, return_inverse=True)
        got = sentencepiece_bpe.distinct_names(some)
        assert all((a == b).all() for a, b in zip(got, want, strict=True))
    words = ["bake", "cakes", "lake", "\u00f1", "x" * 90]
    texts = [" ".join(words[i] for i in _DICE.integers(0, 5, 40)) for _ in range(300)] + ["", None]
    codec = sentencepiece_bpe.Codec(sentencepiece_bpe.load(sentencepiece_bpe.model_path()))
    sizes, unique = [], np.unique

    def spy(x, *args, **kwargs):
        sizes.append(len(x))
        return unique(x, *args, **kwargs)

    monkeypatch.setattr(np, "unique", spy)
    ((_, _, chunk),) = chunks(_batch(texts))
    _, counts = codec.encode(chunk)
    assert len(counts) == 302 and counts[-1] == counts[-2] == 0 and max(sizes, default=0) < 100


def test_each_document_is_sorted_for_itself():
    docs = np.repeat(np.arange(40), _DICE.integers(0, 30, 40))
    values = _DICE.integers(0, 20, len(docs)).astype(np.uint64)
    order = np.lexsort((values, docs))
    assert (sort_each(values, docs) == values[order]).all()
    got = list(zip(*(x.tolist() for x in distinct(values, docs))))
    assert got == [(v, d) for d, v in sorted({*zip(docs.tolist(), values.tolist())})]
    assert [len(x) for x in distinct(values[:0], docs[:0])] == [0, 0]


def test_shingles_below_a_bound_are_those_of_all():
    texts = ["", "a b c d e f", None, " \n", "a b", "a b c d e f g h i j k l " * 3, "x", ""]
    (one,) = (chunk for _, _, chunk in chunks(_batch(texts)))
    assert one.words()[2].tolist() == [1] * 6 + [4] * 2 + [5] * 36 + [6]
    tokens, owner = ngram_join._sets(one)
    low = tokens < ngram_join._RANGE
    few = ngram_join._sets(one, ngram_join._RANGE)
    assert few[0].tolist() == tokens[low].tolist() and few[1].tolist() == owner[low].tolist()


def test_tasks_of_a_process_merge_a_segment_once(monkeypatch):
    tables, merged, merge = sentencepiece_bpe.load(sentencepiece_bpe.model_path()), [], sentencepiece_bpe.Codec.merge
    monkeypatch.setattr(sentencepiece_bpe, "_CODECS", {})

    def spy(self, points, char, starts, lengths):
        merged.append(len(starts))
        return merge(self, points, char, starts, lengths)

    monkeypatch.setattr(sentencepiece_bpe.Codec, "merge", spy)
    ((_, _, chunk),) = chunks(_batch(["bake a cake", None, "a cake by the lake \u00f1", ""]))
    want = [x.tolist() for x in sentencepiece_bpe.Codec(tables).encode(chunk)]
    alone = merged.pop()
    for _ in range(3):  # every task has its own copy of the tables
        assert [x.tolist() for x in sentencepiece_bpe.codec_of(dict(tables)).encode(chunk)] == want
    assert merged == [alone]
    other = sentencepiece_bpe.codec_of(tables | {"name": "another model"})
    assert len(other.known) == 0 and list(sentencepiece_bpe._CODECS) == ["another model"]


def test_segments_met_again_are_remembered_when_others_go(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "REMEMBER", 40)
    tables, merged, merge = sentencepiece_bpe.load(sentencepiece_bpe.model_path()), [], sentencepiece_bpe.Codec.merge

    def spy(self, points, char, starts, lengths):
        merged.append(len(starts))
        return merge(self, points, char, starts, lengths)

    codec = sentencepiece_bpe.Codec(tables)
    texts = [" ".join(["bake", "cake", "lake", *(f"w{k}x{j}" for j in range(k % 7 * 4))]) for k in range(40)]
    for text in [*texts, "x" * 3000, " ".join("abcdefghijklmnopqrstuvwxyz" * 3), *texts]:
        ((_, _, chunk),) = chunks(_batch([text, None, text]))
        want = [x.tolist() for x in sentencepiece_bpe.Codec(tables).encode(chunk)]
        monkeypatch.setattr(sentencepiece_bpe.Codec, "merge", spy)
        assert [x.tolist() for x in codec.encode(chunk)] == want
        monkeypatch.setattr(sentencepiece_bpe.Codec, "merge", merge)
        assert len(codec.known) == len(codec.known_at) == len(codec.again) <= 80 and codec.known_n.sum() == len(codec.ids)
    codec.forget()
    ((_, _, chunk),) = chunks(_batch(["lake bake", "cake"]))
    monkeypatch.setattr(sentencepiece_bpe.Codec, "merge", spy)
    before = len(merged)
    codec.encode(chunk)
    assert len(codec.known) >= 3 and len(merged) == before
