"""Whitening and periodic runs against brute force, with nulls, odd vectors, repeats and clashing names."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ordertide.llm import periodic_runs, whitening

VECTORS = "vec_id long, embedding array<float>, label int, row string, v int, deviation string"


def _vectors(seed=5, n=300, dims=6):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims))).astype(np.float32)


@pytest.fixture(scope="module")
def vectors(spark):
    base = _vectors().tolist()
    odd = [None, [], [1.0, None, 2.0, 0.0, 0.0, 0.0], [math.nan] * 6, [math.inf] + [0.0] * 5, [1.0, 2.0]]
    rows = [(i, v, 1, "r", 2, "d") for i, v in enumerate(base + odd)]
    rows += [rows[0], (None, base[1], None, None, None, None)]
    good = [v for _, v, *_ in rows if v and len(v) == 6 and None not in v and all(map(math.isfinite, v))]
    return spark.createDataFrame(rows, VECTORS).repartition(4).cache(), good


def _moments(good):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in good]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    centred = [[n * r[d] - sums[d] for d in range(dims)] for r in x]
    cov = np.array([[sum(c[i] * c[j] for c in centred) / n**3 for j in range(dims)] for i in range(dims)])
    return x, n, sums, centred, cov


@pytest.mark.parametrize("scale", [1, 1 << 20, 1 << 44])
def test_cross_products_are_exact(scale, monkeypatch):
    monkeypatch.setattr(whitening, "STEP_BYTES", 1 << 12)
    x = (np.random.default_rng(1).normal(size=(200, 5)) * scale).astype(np.int64)
    x[:, 3] = 7
    sums, products = whitening.cross_products(x)
    exact = x.astype(object)
    assert sums.tolist() == exact.sum(axis=0).tolist()
    assert products.tolist() == (exact.T @ exact).tolist()


def test_whitening(vectors, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 64)
    rows, good = vectors
    model = whitening.fit(rows, "embedding")
    x, n, sums, centred, cov = _moments(good)
    assert (model.n, list(model.sums)) == (n, sums)
    values = np.linalg.eigvalsh(cov)[::-1]
    assert np.allclose(model.values, values, rtol=1e-9)
    assert np.allclose(model.explained, values / np.trace(cov), rtol=1e-9)
    got = whitening.project(rows, "embedding", model).collect()
    assert sorted(r.deviation for r in got) == sorted(sum(c * c for c in r) for r in centred)
    assert set(got[0].asDict()) == {"vec_id", "embedding", "label", "row", "v", "deviation", "whitened"}
    white = np.array([r.whitened for r in got])
    assert np.abs(white.T @ white / n - np.eye(6)).max() < 1e-9 and model.identity_error < 1e-9
    by_id = {r.vec_id: r for r in got}
    for k in (1, 7):
        mean = np.array(centred[k]) / n
        assert np.allclose(np.abs(by_id[k].whitened), np.abs(mean @ model.vectors))


def test_whitening_without_variance(spark, vectors):
    rows, _ = vectors
    none = rows.where("vec_id = -1")
    model = whitening.fit(none, "embedding")
    assert model is None and whitening.project(none, "embedding", None).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    model = whitening.fit(flat, "embedding")
    got = whitening.project(flat, "embedding", model).collect()
    assert model.identity_error < 1e-6
    assert all(r.whitened[1:] == [0, 0] and math.isfinite(r.whitened[0]) for r in got)
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    got = whitening.project(huge, "embedding", whitening.fit(huge, "embedding")).collect()
    assert [r.deviation for r in got] == [None, None]


def test_whitening_query(spark):
    from ordertide.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = QUERIES["op12_whitening"](spark, folder).collect()
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    x, n, sums, centred, cov = _moments([r.embedding for r in given])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 32 * n and {r.n for r in got} == {n}
    where = {r.vec_id: k for k, r in enumerate(given)}
    for r in got[::37]:
        c = centred[where[r.vec_id]]
        assert r.deviation == sum(v * v for v in c)
        want = np.array(c) / n @ vectors[:, r.component - 1] / math.sqrt(values[r.component - 1])
        assert abs(abs(want) - abs(r.whitened)) < 1e-6
        assert abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-4


def _brute_runs(w):
    n, out = len(w), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if length >= max(24, 3 * p):
                s = w[i : i + length]
                if not any(s[q:] == s[:-q] for q in range(1, p)):
                    out.append((i, length, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _periodic_words(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        unit = [str(rng.randrange(rng.choice([1, 2, 3, 40]))) for _ in range(rng.randint(1, 12))]
        words += [unit[k % len(unit)] for k in range(rng.randint(1, 80))]
        words += [str(rng.randrange(50)) for _ in range(rng.randint(0, 5))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    found = 0
    for _ in range(800):
        words = _periodic_words(rng)
        assert periodic_runs.text_runs(words) == (want := _brute_runs(words))
        found += len(want)
    assert found > 500


def test_runs_of_long_texts():
    unit = [str(k) for k in range(7000)]
    words = [unit[k % 7000] for k in range(21_000)]
    assert periodic_runs.text_runs(words) == [(0, 21_000, 7000)]
    assert periodic_runs.text_runs(words[:-1]) == []
    assert periodic_runs.text_runs(["a"] * 100_000) == [(0, 100_000, 1)]


def _expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    runs = _brute_runs(words)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query(spark, tmp_path):
    from ordertide.llm.queries import QUERIES

    rng = random.Random(2)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 4000").collect()
    rows = [(r.doc_id, r.text, "x", 1) for r in given]
    rows += [(10_000 + k, " \n".join(_periodic_words(rng)), "x", 1) for k in range(60)]
    rows += [(20_000 + k, "é b c d " * (6 + k), "x", 1) for k in range(30)]
    rows += [(1, None, "x", 1), (2, "", "x", 1), (3, " \t\n\x0b ", "x", 1), (None, "a " * 30, "x", 1), rows[0], rows[70]]
    schema = "doc_id long, text string, collapsed string, runs int"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr((d, *_expected(d, t))) for d, t, *_ in rows)
    assert sum(r.n_runs for r in got) > 100
    kept = periodic_runs.collapse_repeats(docs)
    assert sorted(kept.columns) == sorted(docs.columns) and kept.count() == len(rows)
    assert {r.collapsed for r in kept.where("text = ''").collect()} == {""}
    assert periodic_runs.document_runs(docs.where("false")).count() == 0


def _brute_near(rows, need=0.93):
    """n_links and component of every row (id, vector, label), by all pairs."""
    n = len(rows)
    fine = [
        bool(v) and label is not None and None not in v and all(map(math.isfinite, v)) and any(v) for _, v, label in rows
    ]
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = [None] * n
    for i in range(n):
        if fine[i]:
            v = np.array(rows[i][1], float)
            v /= np.abs(v).max()
            unit[i] = v / np.linalg.norm(v)
    for i in range(n):
        for j in range(i):
            if fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= need:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], least.get(root(i))) for i in range(n)]


@pytest.fixture(scope="module")
def near_rows():
    rng = np.random.default_rng(4)
    rows = []
    for label in (1, 2):
        for _ in range(40):
            center = rng.normal(size=8)
            for _ in range(rng.integers(1, 6)):
                v = center + rng.normal(size=8) * rng.choice([0.05, 0.2, 0.4])
                rows.append((len(rows) + (1 << 60), v.astype(np.float32).tolist(), label))
    rows += [(rows[0][0] + 9000 + k, rows[0][1], 1) for k in range(20)]  # copies
    chain = [[math.cos(0.3 * k), math.sin(0.3 * k)] + [0.0] * 6 for k in range(12)]  # linked in a chain
    rows += [(9000 - k, v, 1) for k, v in enumerate(chain)] + [(7000 + k, [c * 1e-30 for c in v], 2) for k, v in enumerate(chain)]
    odd = [None, [], [0.0] * 8, [math.nan] * 8, [math.inf] + [0.0] * 7, [1.0, None] + [0.0] * 6, [1.0, 0.0], [2.0, 0.0]]
    rows += [(100 + k, v, 1) for k, v in enumerate(odd)]
    rows += [(200, rows[0][1], None), (None, rows[1][1], 1), (None, [0.0] * 7 + [1.0], 5), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("group", [16, 2048])
def test_near_vectors(spark, near_rows, monkeypatch, group):
    from ordertide.llm import cover_tree

    monkeypatch.setattr(cover_tree, "GROUP", group)
    schema = "vec_id long, embedding array<float>, label int, cls int, part string, k int"
    rows = spark.createDataFrame([(*r, 1, "p", 2) for r in near_rows], schema).repartition(5)
    got = cover_tree.near_vectors(rows).collect()
    want = _brute_near(near_rows)
    assert sorted(repr(tuple(r)[:3]) for r in got) == sorted(map(repr, want))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(r.n_links for r in got) > 500


def test_near_vectors_of_texts_and_nothing(spark, near_rows):
    from ordertide.llm import cover_tree

    rows = [(None if i is None else str(i), v, str(label)) for i, v, label in near_rows[:60]]
    given = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")
    got = cover_tree.near_vectors(given).collect()
    assert sorted(repr(tuple(r)[:3]) for r in got) == sorted(map(repr, _brute_near(rows)))
    assert cover_tree.near_vectors(given.where("false")).count() == 0


def test_cover_tree_invariants():
    from ordertide.llm import cover_tree

    rng = np.random.default_rng(3)
    x = cover_tree.unit(np.concatenate([rng.normal(size=(200, 5)), 3 + 0.2 * rng.normal(size=(100, 5))]))
    d, radii = cover_tree.distances(x, x), cover_tree.RADII
    top, parent, reach = cover_tree.cover_tree(x)
    for level in range(len(radii)):
        nodes = np.flatnonzero(top <= level)  # nested by definition
        apart = d[np.ix_(nodes, nodes)][~np.eye(len(nodes), dtype=bool)]
        assert level == 0 or (apart > radii[level]).all()
        assert (d[:, nodes].min(axis=1) <= radii[level]).all()
        below = np.flatnonzero(top == level + 1)
        assert (d[below, parent[below]] <= radii[level]).all() and (top[parent[below]] <= level).all()
        at = np.arange(len(x))
        for up in range(len(radii) - 1, level - 1, -1):
            at = np.where(top[at] <= up, at, parent[at])
        for node in nodes:
            assert np.isclose(reach[node, level], d[node, at == node].max())


def test_near_vectors_query(spark):
    from ordertide.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    got = QUERIES["op11_embedding_near_dups"](spark, folder).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(_brute_near(list(map(tuple, given))))
