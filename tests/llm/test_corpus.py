"""The corpus operators against brute force on small tables with nulls, ties, repeats and clashing names."""

import functools
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide.llm import (
    components,
    crf_quality,
    decontaminate,
    line_dedup,
    ngram_join,
    quality_rules,
    repeats,
    sentencepiece_bpe,
    token_shards,
    toxicity,
    url_filter,
)

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, source string, key string, row string, n long, block int"


@pytest.fixture(scope="module")
def texts(spark):
    given = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]
    rng = random.Random(3)
    base = (given[0] + "\n" + given[1]).split(" ")
    out = dict(enumerate(given))
    for k in range(30):  # near copies, far copies and passages
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(99)}"
        out[1000 + k] = " ".join(words[: len(words) - rng.randrange(60)])
    out |= {2000: None, 2001: "", 2002: " \n\t", 2003: "One two", 2004: "one TWO", 2005: "a b c d e", 2006: "x" * 700}
    out |= {2007: "ab " * 400, 2008: "é" * 150, 2009: "same line of five words\n" * 3, 2010: base[0]}
    out[2011] = "\n".join(given[:40])
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, f"s{d % 7}" if d % 11 else None, "k", "r", 1, 2) for d, t in texts.items()]
    rows += [rows[0], rows[0], rows[-1]]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def shingle_set(text, whole=True):
    w = words_of((text or "").translate(FOLD))
    if len(w) < 5:
        return {tuple(w)} if w and whole else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_jaccard_components(docs, texts, empty):
    sets = {d: shingle_set(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    want = {d: (len(sets[d]), root(d)) for d in sets}
    rows = ngram_join.jaccard_components(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert len(rows) == docs.count() and len({v[1] for v in want.values()}) < len(want) - 10
    kept = {r.doc_id for r in ngram_join.keep_first(docs).collect()}
    assert kept == {d for d in want if want[d][1] == d}
    assert ngram_join.jaccard_components(empty).count() == 0


def test_large_groups_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    rng = random.Random(1)
    line = [f"c{i}" for i in range(40)]
    rows = []
    for d in range(60):
        words = list(line)
        words[rng.randrange(40)] = f"z{rng.randrange(5)}"
        rows.append((d, " ".join(words if d % 3 else words[:6] + [f"u{d}x{i}" for i in range(50)])))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = {d: shingle_set(t) for d, t in rows}
    label = {d: d for d in sets}
    for _ in range(60):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[b] = min(label[a], label[b])
    assert {r.doc_id: r.component_id for r in got} == label


def test_bitmaps_differ_like_folded_ones(monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIR_WORDS", 3)
    rng = np.random.default_rng(6)
    rows = [rng.integers(0, 1 << 63, w, np.uint64) for w in (1, 2, 2, 4, 4, 8, 2, 1)]
    pairs = [(i, j) for i in range(8) for j in range(8) if max(len(rows[i]), len(rows[j])) <= 2 * min(len(rows[i]), len(rows[j]))]
    a, b = map(np.array, zip(*pairs))
    want = []
    for i, j in pairs:
        narrow = min(len(rows[i]), len(rows[j]))
        x, y = (np.bitwise_xor.reduce(rows[k].reshape(-1, narrow), axis=0) for k in (i, j))
        want.append(int(np.bitwise_count(x ^ y).sum()))
    assert ngram_join.Bitmaps([r.tobytes() for r in rows]).differing(a, b).tolist() == want


def test_keep_first_with_clashing_columns(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words), 1, 2, 3, 4), (1, " ".join(words), 1, 2, 3, 4), (2, " ".join(words[1:]), 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _at int, at int, _key int, _stays int")
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == rows[:1]


def test_copies_of_one_text_get_one_component(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(d, " ".join(words)) for d in range(5, 205)] + [(None, " ".join(words)), (300, " ".join(words[:58]))]
    rows += [(2, " ".join(words[1:])), (7, " ".join(words)), (None, "no other text is like this one"), (400, "")]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(d, 56, 2) for d in range(5, 205)] + [(7, 56, 2), (300, 54, 2), (2, 55, 2), (400, 0, 400)]
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == sorted(want)
    assert sorted((r.n_shingles, r.component_id or -1) for r in got if r.doc_id is None) == [(3, -1), (56, 2)]


def test_stages_judge_rows_not_ids(spark):
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    near = " ".join(b[1:])
    a, b = " ".join(a), " ".join(b)
    rows = [(7, a, "x"), (7, b, "x"), (5, near, "x"), (5, near, "y"), (None, b, "x"), (8, b, "x"), (None, "only this one", "x")]
    rows += [(None, "no id here at all now", "x"), (None, "no id here at all now", "x"), (9, "", "x"), (9, "", "x"), (6, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    want = [(7, a), (5, near), (None, "only this one"), (None, "no id here at all now"), (9, ""), (9, ""), (6, None)]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)
    words = a.split()
    rows = [(7, a), (7, b), (None, a), (None, b), (3, " ".join(words[:22])), (3, " ".join(words[18:40])), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words[:40]))], "item_id long, text string")
    left = Counter((r.doc_id, r.text) for r in decontaminate.clean(docs, items).collect())
    assert left == Counter(r for r in rows if r[1] != a)


def test_repeated_rows_are_one_row_of_their_class(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words))] * 50 + [(2, " ".join(words[1:]))] * 50 + [(2, "a text of its own entirely")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    met = []
    first = ngram_join.first_partners
    monkeypatch.setattr(ngram_join, "first_partners", lambda reps: first(met.append(reps.count()) or reps))
    found = ngram_join.jaccard_components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == {(1, 56, 1): 50, (2, 55, 1): 50, (2, 2, 1): 1}
    assert met == [2]
    none = np.zeros(1 << 10, np.uint64)
    sets = ngram_join.sets_of(docs, spark.createDataFrame([(1,), (2,)], "cls long"), none)
    assert Counter((r.cls, len(r["keys"])) for r in sets.collect()) == {(1, 8 * 56): 1, (2, 8 * 55): 1, (2, 8 * 2): 1}


def test_repeated_rows_give_their_spans_once(spark, monkeypatch):
    given = "".join(chr(97 + i * i % 23) + str(i) for i in range(300))
    docs = spark.createDataFrame([(1, given)] * 20 + [(2, "short")], "doc_id long, text string")
    most = []

    def kept(df, name, keep=repeats.saved):
        out = keep(df, name)
        if name == "spans":
            most.extend(r.spans for r in out.collect())
        return out

    monkeypatch.setattr(repeats, "saved", kept)
    got = repeats.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == {(1, len(given)): 20, (2, 0): 1}
    assert len(most) == 1 and len(most[0]) == len(set(most[0]))


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100}
    assert components.components(links.where("a < 0")).count() == 0


def test_quality_counts_and_verdict(docs, texts, empty):
    def counts(text):
        w, seen, dup = words_of(text), set(), 0
        for line in (text or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        found = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if found[tuple(w[i : i + 5])] > 1 for k in range(5)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)

    for r in quality_rules.judge(docs, None).collect():
        want = counts(texts[r.doc_id])
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed)
    kept = quality_rules.quality_filter(docs, None)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.judge(docs, None).where("kept").count()
    assert quality_rules.judge(empty, None).count() == 0


def test_trees_are_monotone_and_separate():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=2000) < 0).astype(float)
    y[:60] = 1 - y[:60]
    trees = quality_rules.grow(x, y, [-1, 0])
    grid = np.column_stack([np.linspace(-3, 3, 200), np.zeros(200)])
    assert np.all(np.diff(trees.margin(grid)) <= 1e-12)
    assert ((trees.good(x) > 0.5) == y).mean() > 0.85


def test_line_dedup(spark, docs, empty):
    docs = docs.dropDuplicates(["doc_id"])
    got = line_dedup.dedup_lines(docs, count="n_removed")
    assert got.columns == [*docs.columns, "n_removed"]
    rows = {r.doc_id: (r.n_removed, r.md5) for r in got.withColumn("md5", F.md5(F.encode("text", "UTF-8"))).collect()}
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841 (read by the query)
    want = {r[0]: (r[1], r[2]) for r in con.execute(line_dedup.LINE_DEDUP_SQL).fetchall()}
    assert rows == want and sum(v[0] for v in want.values()) > 20
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_near_the_threshold(spark):
    line = "a shared line of six words"
    for sites in (4, 5, 6, 40):
        rows = [(i, f"own text {i}\n  {line}", f"site{i % sites}") for i in range(3 * sites)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        left = {r.doc_id for r in line_dedup.dedup_lines(docs).where(F.contains("text", F.lit(line))).collect()}
        assert left == (set(range(3 * sites)) if sites < 5 else {0})


def test_line_dedup_short_lines_need_more_sites(spark):
    lines = {5: "a line of five words", 4: "All rights are reserved", 3: "All rights reserved.", 2: "Read more", 1: "Menu"}
    for words, need in ((5, 5), (4, 10), (3, 15), (2, 20), (1, 25)):
        for sites in (need - 1, need, 60):
            rows = [(i, f"own text {i}\n{lines[words]} \n \n|", f"site{i % sites}") for i in range(2 * sites)]
            rows.append((999, "| | | |", None))
            docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(2)
            wide = line_dedup.widespread_lines(docs)
            gone = wide.where(F.col("key") == F.xxhash64(F.lit(lines[words])))
            assert gone.count() == (sites >= need), (words, sites)
    left = line_dedup.dedup_lines(docs).where(F.contains("text", F.lit("Menu"))).collect()
    assert [r.doc_id for r in left] == [0]
    assert line_dedup.dedup_lines(docs, short=False).where(F.contains("text", F.lit("Menu"))).count() == 120


def test_line_count_replaces_a_column(spark):
    rows = [(i, "a shared line of six words", f"s{i}", 9) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, N_Removed int")
    got = line_dedup.dedup_lines(docs, count="n_removed")
    assert got.columns == ["doc_id", "text", "source", "n_removed"]
    assert sorted(r.n_removed for r in got.collect()) == [0, 1, 1, 1, 1, 1]


def test_only_candidates_are_verified(spark):
    words = [f"w{k}" for k in range(2000)]
    items = [(k, " ".join(words[100 * k : 100 * k + n])) for k, n in enumerate((20, 36, 37, 90, 260, 400, 1000))]
    texts = {d: " ".join(words[40 * d : 40 * d + 700]) for d in range(30)} | {99: " ".join(words[::2]), 100: " ".join(words)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {tuple(r) for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for item, text in items:
        own = shingle_set(text, whole=False)
        for d, t in texts.items():
            both = len(own & shingle_set(t, whole=False))
            if 100 * both >= 80 * len(own):
                want.add((d, item, len(own), both))
    assert got == want and {w[1] for w in want} == set(range(7))  # items of all three partitions


def test_decontamination(spark, docs, texts, empty):
    given = texts[3].split()
    items = [(1, " ".join(given[3:30])), (2, " ".join(given[3:20]).upper()), (3, "too few words"), (4, None), (5, "")]
    items += [(6, " ".join(texts[2011].split()[100:900])), (7, "never seen " * 10), (None, " ".join(given[:9]))]
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for item, text in items:
        own = shingle_set(text, whole=False)
        for d, t in texts.items():
            both = len(own & shingle_set(t, whole=False))
            if item and own and 100 * both >= 80 * len(own):
                want.add((d, item, len(own), both))
    got = decontaminate.contaminated(docs, frame).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) >= 4
    left = {r.doc_id for r in decontaminate.clean(docs, frame).collect()}
    assert left == set(texts) - {w[0] for w in want}
    assert decontaminate.clean(docs, frame.limit(0)).count() == docs.count()
    assert decontaminate.contaminated(empty, frame).count() == 0


def test_sentencepiece_equals_the_library(spark, docs, texts, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.model_path())
    rng = random.Random(2)
    pieces = [sp.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    extra = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    extra += [" " * 3000 + "x", "a" * 2000, "\x00\t\n", "<s></s><unk><0x0A>", "日本語😀é́\u3000", "▁▁ ▁x", "=-" * 400]
    rows = [(9000 + i, t) for i, t in enumerate(extra)] + list(texts.items())
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(rows)
    encoded = sentencepiece_bpe.encode_documents(frame, sentencepiece_bpe.model_path())
    for r in encoded.collect():
        assert list(r.ids) == sp.encode(want[r.doc_id] or "", add_bos=True, add_eos=True)
    for r in sentencepiece_bpe.decode_documents(encoded, sentencepiece_bpe.model_path()).collect():
        assert r.text == sp.decode(sp.encode(want[r.doc_id] or ""))
    for r in sentencepiece_bpe.token_digests(docs, sentencepiece_bpe.model_path()).collect():
        ids = sp.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert sentencepiece_bpe.token_digests(empty, sentencepiece_bpe.model_path()).count() == 0


def test_repeated_strings(docs, texts, empty):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    want = Counter()
    for d, b in rows:
        gone, last = bytearray(len(b)), 0
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                start = max(i, last)
                gone[start : i + 200] = b"\1" * (i + 200 - start)
                last = i + 200
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        want[d, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)] += 1
    got = repeats.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 4097])
def test_permutation(n):
    slots = token_shards.permute(np.arange(n), n)
    assert sorted(slots) == list(range(n))
    assert n < 1000 or np.abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.2


def test_token_shards(spark, docs, texts, empty, tmp_path):
    import sentencepiece

    model = sentencepiece_bpe.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    path = str(tmp_path / "shards")
    rows = token_shards.write_shards(docs, model, path, per_shard=100).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    read = {r.slot: bytes(r.record) for r in token_shards.read_slots(spark, path, 0, len(rows), 100).collect()}
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.sequence):
        got[r.doc_id] += np.frombuffer(read[r.slot], "<u2")[: r.n_tokens].tolist()
    want = {d: sp.encode(t or "", add_bos=True, add_eos=True) for d, t in texts.items()}
    repeated = {r.doc_id for r in docs.groupBy("doc_id").count().where("count > 1").collect()}
    assert all(got[d] == want[d] for d in want if d not in repeated)
    assert all(sorted(got[d]) == sorted(want[d] * (len(got[d]) // len(want[d]))) for d in repeated)
    part = token_shards.read_slots(spark, path, 150, 120, 100).collect()
    assert sorted(r.slot for r in part) == list(range(150, 270))
    assert token_shards.write_shards(empty, model, str(tmp_path / "none")).count() == 0


def test_shards_are_ranges_written_by_one_task_each(spark, docs, tmp_path):
    path = tmp_path / "shards"
    n = token_shards.write_shards(docs, sentencepiece_bpe.model_path(), str(path), per_shard=20).count()
    shards = sorted(path.glob("shard=*"), key=lambda p: int(p.name.split("=")[1]))
    assert [p.name for p in shards] == [f"shard={k}" for k in range(-(-n // 20))] and len(shards) > 9
    files = [list(p.glob("part-*")) for p in shards]
    assert [len(f) for f in files] == [1] * len(shards)
    assert [f[0].name[5:10] for f in files] == [f"{k:05}" for k in range(len(shards))]  # the task is the range
    assert [f[0].stat().st_size // token_shards.STRIDE for f in files] == [20] * (len(shards) - 1) + [n - 20 * (len(shards) - 1)]


def test_shards_of_rows_in_another_order_are_refused(spark, tmp_path):
    path, codec = str(tmp_path / "t"), spark.sparkContext.broadcast(sentencepiece_bpe.load(sentencepiece_bpe.model_path()))
    spark.createDataFrame([(1, "one two"), (2, "two one"), (3, None)], "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    counted = token_shards.count_sequences(docs, codec).collect()
    bases = {0: (0, len(counted), counted[-1].seen)}
    assert token_shards.records(docs, codec, bases, 3).count() == 3
    for other in (docs.orderBy(F.desc("doc_id")).coalesce(1), docs.withColumn("doc_id", F.lit(7)), docs.where("doc_id < 3")):
        with pytest.raises(Exception, match="did not repeat its rows in order"):
            token_shards.records(other, codec, bases, 3).collect()


def test_url_columns_clash_with_nothing(spark):
    pages = spark.createDataFrame([("http://a.net/x", 1, "k", "h", "v"), (None, 2, None, None, None)], "url string, _key int, __in string, Host string, _block string")
    listed = spark.createDataFrame([("a.net/x",)], "u string")
    got = url_filter.judge_urls(pages, listed)
    assert got.columns == ["url", "_key", "__in", "_block", "host", "path", "rule", "verdict"]
    assert sorted((r._key, r["__in"] or "", r.host, r.verdict) for r in got.collect()) == [(1, "k", "a.net", "block"), (2, "", "", "allow")]


def test_one_url_of_a_host_is_listed(spark):
    pages = spark.createDataFrame([(k, f"http{'s' * (k % 2)}://a.net/p{k // 2}/?utm_x={k}") for k in range(400)], "page_id long, url string")
    listed = pages.where("page_id % 10 = 0").select(url_filter.canonical(F.col("url")))
    got = {r.page_id for r in url_filter.judge_urls(pages, listed).where("verdict = 'block'").collect()}
    assert got == {k for k in range(400) if (k // 2) % 5 == 0}
    assert [url_filter.blocks_for(n) for n in (0, 15, 16, 1600, 1 << 40)] == [1, 1, 2, 128, url_filter.BLOCKS]


def test_url_verdicts(spark):
    urls = ["http://A.Example.ORG/es/x?q#f", "https://example.org/en/12", "https://notexample.org/en/1", "ftp://x.com/fr/1"]
    urls += ["http://x.com/de/", "http://com/de/", "http://net.net", "no scheme", None, "", "http://", "x://Y.net/p/?utm_a=1&b=2"]
    urls += ["http://y.net/p?b=2#z", "http://y.net/p?b=3", "http://x.com/fr/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("y.net/p?b=2",), ("x.com/fr/1",), (None,), ("y.net/p?b=2",)], "host string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, listed).collect()}
    assert len(got) == len(urls)
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [got[i].rule for i in range(1, 7)] == ["example.org/en/1", "org/", "com/fr/", "com/de/", "com/de/", None]
    assert [got[i].verdict for i in range(7, 15)] == ["allow"] * 4 + ["block", "block", "allow", "allow"]
    assert all((got[i].host, got[i].path) == ("", "") for i in range(7, 11))
    assert {r.verdict for r in url_filter.judge_urls(pages, listed.limit(0)).where("rule IS NULL").collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0


def test_bloom_passes_every_listed_url(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("k"))
    pages = keys.select(F.xxhash64("k").alias("page_id"), F.concat(F.lit("http://"), "k").alias("url"))
    assert url_filter.judge_urls(pages, keys).where("verdict = 'block'").count() == 5000
    none = spark.range(5000, 9000).select(F.concat(F.lit("h/"), "id").alias("k"))
    assert url_filter.judge_urls(pages, none).where("verdict = 'block'").count() == 0


@pytest.fixture(scope="module")
def marked(spark):
    """Documents with bad lines and rude words, and their labels; a fifth of the labels is held out."""
    rng = random.Random(4)
    rows, labels = [], []
    for d in range(600):
        bad, rude = d % 4 == 0, d % 3 == 0
        lines = [" ".join(rng.choice(["then", "over", "river", "stone", "walk"]) for _ in range(8)) + "." for _ in range(6)]
        if bad:
            lines = [re.sub(r"(\w+)", r"\1%%%", line) if rng.random() < 0.8 else line for line in lines]
        if rude:
            lines.append(f"you {rng.choice(['grump', 'grumpling', 'grumpster'])} walk")
        rows.append((d, "\n".join(lines), "x", "y"))
        labels.append((d, int(not bad), int(rude), "z"))
    rows += [(-1, None, "x", "y"), (-2, "", "x", "y"), (-3, "\n \n", "x", "y"), rows[0]]
    labels += [(1, None, None, "z"), (None, 1, 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("module, label, folds", [(crf_quality, "quality", 5), (toxicity, "toxic", 3)])
def test_scores_on_held_out_rows(marked, module, label, folds):
    docs, labels = marked
    trained = (module.fit if module is crf_quality else module.train)(docs, labels)
    scored = module.score(docs, trained)
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1 OR isnan(score)").count() == 0
    held = scored.join(labels.select("doc_id", label), "doc_id")
    held = held.where((F.crc32(F.col("doc_id").cast("string")) % folds) == module.HELD).dropna().collect()
    right = sum((r.score >= module.CALLED_AT) == bool(r[label]) for r in held)
    assert len(held) > 50 and right / len(held) > 0.95
    one_class = labels.where(f"{label} = 1")
    blind = (module.fit if module is crf_quality else module.train)(docs, one_class)
    assert blind is None and module.score(docs, blind).count() == docs.count()
    assert module.score(docs.limit(0), trained).count() == 0


def test_toxicity_models_equal_brute_force(spark, docs, texts):
    marked = docs.select("doc_id", "text", (F.col("doc_id") % 3 == 0).cast("int").alias("label"))
    rows = marked.select("doc_id", "text")
    run_counts = toxicity.run_counts(marked.select("text", "label"))

    def runs_of(text):
        for word in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
            padded = b"\x01" * (toxicity.ORDER - 1) + word.lower() + b"\x02"
            yield [padded[i : i + toxicity.ORDER] for i in range(len(word) + 1)]

    counts = [Counter(), Counter()]
    for r in marked.collect():
        counts[r.label].update(run for word in runs_of(r.text) for run in word)
    levels = {toxicity.ORDER: counts}
    for order in range(toxicity.ORDER - 1, toxicity.LOWEST - 1, -1):
        levels[order] = [Counter(run[1:] for run in level) for level in levels[order + 1]]
    shared = Counter(run[1:] for run in set(levels[toxicity.LOWEST][0]) | set(levels[toxicity.LOWEST][1]))
    heads, kinds, sums = Counter(), Counter(), {}
    for run, n in shared.items():
        heads[run[:-1]] += n
        kinds[run[:-1]] += 1
    for order, level in levels.items():
        for c in (0, 1):
            for run, n in level[c].items():
                whole, left = sums.get((order, c, run[:-1]), (0, 0.0))
                sums[order, c, run[:-1]] = whole + n, left + toxicity.DISCOUNT

    @functools.cache
    def chance(c, run):
        order = len(run)
        if order < toxicity.LOWEST:
            whole = heads[run[:-1]]
            own = max(shared[run] - toxicity.DISCOUNT, 0)
            return (own + toxicity.DISCOUNT * kinds[run[:-1]] / 256) / whole if whole else 1 / 256
        whole, left = sums.get((order, c, run[:-1]), (0, 0.0))
        lower = chance(c, run[1:])
        return (max(levels[order][c][run] - toxicity.DISCOUNT, 0) + left * lower) / whole if whole else lower

    expected = {}
    for d, text in texts.items():
        words = [sum(math.log(chance(1, r) / chance(0, r)) for r in w) for w in runs_of(text)]
        strong = sum(max(w - toxicity.STRONG, 0) for w in words)
        expected[d] = (sum(words) / max(len(words), 1), strong / max(len(words), 1), len(words))
    for often, hot in ((toxicity.OFTEN, toxicity.HOT), (0, 0), (300, 40)):  # all looked up, all joined, some of each
        found = toxicity.measured(toxicity.fit(run_counts, often), rows, hot).collect()
        assert len(found) == rows.count()
        assert all(np.allclose((r.ratio, r.strong, r.words), expected[r.doc_id], atol=1e-6) for r in found)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    unary, transition = rng.normal(size=9), rng.normal(size=(2, 2))
    first, n = np.array([2, 0, 6]), np.array([4, 2, 3])
    order = np.argsort(-n, kind="stable")
    good, expected = crf_quality.marginals(unary, transition, first[order], n[order])
    total = np.zeros((2, 2))
    for a, k in zip(first, n, strict=True):
        weights, on, pairs = 0.0, np.zeros(k), np.zeros((2, 2))
        for m in range(2**k):
            y = [(m >> i) & 1 for i in range(k)]
            w = np.exp(sum(unary[a + i] * y[i] for i in range(k)) + sum(transition[y[i], y[i + 1]] for i in range(k - 1)))
            weights += w
            on += w * np.array(y)
            for i in range(k - 1):
                pairs[y[i], y[i + 1]] += w
        assert np.allclose(good[a : a + k], on / weights)
        total += pairs / weights
    assert np.allclose(expected, total)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA).cache()
        if name == "quality rules":
            labels = spark.read.parquet(f"{DATA}/labels.parquet")
            kept = quality_rules.judge(docs, quality_rules.fit(docs, labels)).where("kept")
            want = {r.doc_id for r in kept.collect()}
        elif name == "line dedup":
            want = {r.doc_id for r in docs.collect()}
        elif name == "n-gram Jaccard join":
            con = duckdb.connect()
            documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
            want = {r[2] for r in con.execute(ngram_join.NGRAM_JOIN_SQL).fetchall()}
        elif name == "benchmark decontamination":
            con = duckdb.connect()
            documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
            con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{DATA}/benchmark.parquet'")
            want = {r.doc_id for r in docs.collect()} - {r[0] for r in con.execute(decontaminate.DECONTAMINATE_SQL).fetchall()}
        assert {r.doc_id for r in out.collect()} == want, name
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
            docs = out
    assert {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()} == want
