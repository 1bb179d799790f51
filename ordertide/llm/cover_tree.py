"""Exact near-duplicate embeddings of equal label by dual traversal of cover trees.

Two vectors link when labels and lengths are equal and their cosine is at least ``NEED``, which on unit
vectors is a distance of at most ``REACH``.

1. Equal vectors of a label are one class with a weight; everything below works on classes.
2. Classes of a label are dealt into groups of about ``GROUP``: by the nearest of a few pivots, where a label
   has several groups, and then by hash. Pivots only decide how much can be pruned, never what links.
3. Each group becomes a cover tree, stored as rows: nested levels whose radii halve from 2; a class
   enters at its ``top`` level, lies within the radius of the level above from its ``parent``, and knows how
   far its descendants reach at each level (``reach``). Below the last radius all classes are leaves.
4. Groups meet if their roots' covering radii allow a link (level 0 of the dual traversal). A task
   gets two trees and goes down both, level by level: a pair of nodes stays while the distance
   of the two is at most REACH plus both covering radii, and only children of pairs that stay are
   compared. Cosines decide at the leaves.
5. A task returns how many links each class has, weighted, and a spanning forest of its links, so a
   group of near copies costs rows in proportion to its size. Components join the forests.

Defined cases: null labels and vectors that are null, empty, zero or hold null, NaN or infinite entries
link with nothing, and have themselves as component; vectors of other lengths link with nothing of this
length; repeated rows and equal vectors link with each other; a null id names a component only if all ids
of it are null; an empty table gives an empty result; other columns are ignored. Entries are
divided by the vector's largest one first, so no norm over- or underflows.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ordertide.llm.components import components
from ordertide.llm.shared import saved

#: Fixed value of the contract: the cosine at which vectors link.
NEED = 0.93
#: Classes that one tree holds, about.
GROUP = 2048
#: Radii of the levels; under the last one a node cannot be pruned much better than its leaves.
RADII = [2.0 / 2**k for k in range(6)]
#: Pivots of a label at most, and labels (the most frequent ones) that have pivots.
PIVOTS, PIVOT_LABELS = 64, 256
#: Room for rounding in bounds; cosines at the leaves have none.
SLACK = 1e-6

SPACE = ["label", "dims"]
TREE = [*SPACE, "cell", "sub"]


def reach_of(need):
    """The distance of unit vectors at cosine ``need``."""
    return float(np.sqrt(2 - 2 * need))


def unit(vectors):
    """Rows of length one, as a matrix of doubles."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x, y):
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def cover_tree(x):
    """top level, parent (-1 for the root, row 0) and reach by level of every row of a unit matrix."""
    n, levels = len(x), len(RADII)
    d = distances(x, x)
    top, parent = np.full(n, levels), np.full(n, -1)
    top[0] = 0
    near, nearest = d[0].copy(), np.zeros(n, int)
    for level in range(1, levels):
        above = nearest.copy()
        while True:
            far = int(np.argmax(near > RADII[level]))
            if near[far] <= RADII[level]:
                break
            top[far], parent[far] = level, above[far]
            closer = d[far] < near
            near[closer], nearest[closer] = d[far][closer], far
            near[far], nearest[far] = 0, far
    leaves = top == levels
    parent[leaves] = nearest[leaves]
    reach = np.zeros((n, levels))
    at = np.arange(n)
    for level in range(levels - 1, -1, -1):
        at = np.where(top[at] <= level, at, parent[at])
        np.maximum.at(reach[:, level], at, d[np.arange(n), at])
    return top, parent, reach


class Side:
    """One tree of a dual traversal, from the table of its rows."""

    def __init__(self, rows):
        rows = rows.sort_by("pos")
        self.cls, self.id = (rows[c].combine_chunks() for c in ("cls", "id"))
        self.weight, self.top, self.parent = (rows[c].to_numpy() for c in ("k", "top", "parent"))
        self.x, self.reach = unit(rows["vec"].to_pylist()), np.array(rows["reach"].to_pylist())

    def below(self, level, nodes):
        """Nodes of a level under ``nodes`` of the level above, and the place of each one's parent in these."""
        place = np.full(len(self.top), -1)
        place[nodes] = np.arange(len(nodes))
        here = np.flatnonzero(self.top <= level)
        above = place[np.where(self.top[here] < level, here, self.parent[here])]
        return here[above >= 0], above[above >= 0]


def linked(a, b, need=NEED):
    """Which rows of two trees link: (rows of a, rows of b, matrix of links)."""
    reach = reach_of(need) + SLACK
    rows, columns, stay = np.zeros(1, int), np.zeros(1, int), np.ones((1, 1), bool)
    for level in range(len(RADII) + 1):
        if level:
            rows, up = a.below(level, rows)
            columns, across = b.below(level, columns)
            stay = stay[np.ix_(up, across)]
        cosines = a.x[rows] @ b.x[columns].T
        if level == len(RADII):
            return rows, columns, stay & (cosines >= need)
        bound = reach + a.reach[rows, level][:, None] + b.reach[columns, level][None, :]
        stay &= np.sqrt(np.maximum(2 - 2 * cosines, 0)) <= bound
        held, across = stay.any(axis=1), stay.any(axis=0)
        rows, columns, stay = rows[held], columns[across], stay[held][:, across]


def forest(links):
    """Components of the rows and columns of a link matrix: (row that names it, its rows, its columns)."""
    open_rows, open_columns = links.any(axis=1), links.any(axis=0)
    while open_rows.any():
        first = int(np.argmax(open_rows))
        new, rows, columns = np.array([first]), [], []
        open_rows[first] = False
        while len(new):
            rows.append(new)
            hit = np.flatnonzero(links[new].any(axis=0) & open_columns)
            open_columns[hit] = False
            columns.append(hit)
            new = np.flatnonzero(links[:, hit].any(axis=1) & open_rows)
            open_rows[new] = False
        yield first, np.concatenate(rows), np.concatenate(columns)


def tree_links(rows, need=NEED):
    """Counts (a, n) and forest edges (a, b) of the links between two trees, or within the one that is there."""
    kind = rows.schema.field("id").type
    schema = pa.schema([("a", pa.int64()), ("a_id", kind), ("b", pa.int64()), ("b_id", kind), ("n", pa.int64())])
    first, second = (rows.filter(pa.compute.equal(rows["side"], side)) for side in (0, 1))
    same = second.num_rows == 0
    first = Side(first)
    second = first if same else Side(second)
    at, across, links = linked(first, second, need)
    if same:
        links &= at[:, None] != across[None, :]
    out = [schema.empty_table()]

    def add(size, **columns):
        out.append(pa.table([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema))

    def count(side, places, counts):
        hit = counts > 0
        add(int(hit.sum()), a=side.cls.take(pa.array(places[hit])), n=pa.array(counts[hit].astype(np.int64)))

    def name(root, side, places):
        root = pa.array(np.full(len(places), root))
        places = pa.array(places)
        ends = dict(a=first.cls.take(root), a_id=first.id.take(root), b=side.cls.take(places), b_id=side.id.take(places))
        add(len(places), **ends)

    count(first, at, links @ second.weight[across].astype(float))
    if not same:
        count(second, across, links.T @ first.weight[at].astype(float))
    for root, left, right in forest(links):
        name(at[root], second, across[right])
        if not same:
            name(at[root], first, at[left][1:])
    return pa.concat_tables(out)


def _with(df, **kinds):
    """The schema of ``df`` with more columns."""
    more = [StructField(name, kind) for name, kind in kinds.items()]
    return StructType(df.schema.fields + more)


def _usable(vec):
    fine = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(fine & F.exists(vec, lambda c: c != 0), F.lit(False))


def _pivots(classes):
    """(label, dims) -> matrix of pivots, for spaces of more than one group; a bounded sample of classes."""
    sizes = classes.groupBy(*SPACE).agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    sizes = sizes.orderBy(F.desc("n")).limit(PIVOT_LABELS)
    sizes = sizes.withColumn("wanted", F.least(F.lit(PIVOTS), F.ceil(F.col("n") / GROUP).cast("int")))
    drawn = classes.join(F.broadcast(sizes), SPACE)
    lot = F.pmod(F.xxhash64("cls"), F.lit(1 << 30))
    drawn = drawn.where(lot < (1 << 30) * F.least(F.lit(1.0), 4 * F.col("wanted") / F.col("n")))
    best = F.slice(F.sort_array(F.collect_list(F.struct(lot.alias("lot"), "cls", "vec"))), 1, F.first("wanted"))
    drawn = drawn.groupBy(*SPACE).agg(best.alias("best"))
    return {(r.label, r.dims): unit([p.vec for p in r.best]) for r in drawn.collect()}


def grouped(classes):
    """The classes with cell (nearest pivot) and sub (part of the cell), which name their tree."""
    pivots = classes.sparkSession.sparkContext.broadcast(_pivots(classes))

    def run(batches):
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            spaces = zip(batch["label"].to_pylist(), batch["dims"].to_pylist(), strict=True)
            rows = defaultdict(list)
            for k, space in enumerate(spaces):
                if space in pivots.value:
                    rows[space].append(k)
            for space, at in rows.items():
                vectors = unit(batch["vec"].take(pa.array(at)).to_pylist())
                cell[at] = np.argmax(vectors @ pivots.value[space].T, axis=1)
            yield batch.append_column("cell", pa.array(cell))

    celled = saved(classes.mapInArrow(run, _with(classes, cell=IntegerType())), "vector-cells")
    cells = celled.groupBy(*SPACE, "cell").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    celled = celled.join(cells, [*SPACE, "cell"])
    return celled.withColumn("sub", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")).drop("parts")


def trees(classes):
    """One row per class: its tree's name (TREE), pos, top, parent and reach."""
    rows = grouped(classes)

    def build(group):
        group = group.sort_by("cls")
        top, parent, reach = cover_tree(unit(group["vec"].to_pylist()))
        for name, values in (("pos", np.arange(len(top))), ("top", top), ("parent", parent)):
            group = group.append_column(name, pa.array(values.astype(np.int32)))
        return group.append_column("reach", pa.array(list(reach)))

    schema = _with(rows, pos=IntegerType(), top=IntegerType(), parent=IntegerType(), reach=ArrayType(DoubleType()))
    return saved(rows.groupBy(*TREE).applyInArrow(build, schema), "cover-trees")


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def meeting_trees(forest_rows, need=NEED):
    """Pairs of trees of a space whose roots allow a link; a tree meets itself. One row per tree and pair, with its side."""
    vec = F.transform("vec", lambda c: c.cast("double"))
    most = F.array_max(F.transform(vec, F.abs))
    roots = forest_rows.where("pos = 0").select(
        *TREE, F.transform(vec, lambda c: c / most).alias("v"), F.col("reach")[0].alias("r")
    )
    roots = roots.withColumn("v", F.transform("v", lambda c: c / F.sqrt(_dot(F.col("v"), F.col("v")))))
    other = roots.select(*SPACE, *[F.col(c).alias(f"{c}_b") for c in ("cell", "sub", "v", "r")])
    apart = F.sqrt(F.greatest(2 - 2 * _dot(F.col("v"), F.col("v_b")), F.lit(0.0)))
    pairs = roots.join(other, SPACE).where(F.struct("cell", "sub") <= F.struct("cell_b", "sub_b"))
    pairs = pairs.where(apart <= reach_of(need) + SLACK + F.col("r") + F.col("r_b"))
    pairs = pairs.select(*TREE, "cell_b", "sub_b")
    name = F.struct("cell", "sub", "cell_b", "sub_b").alias("pair")
    first = pairs.select(*TREE, name, F.lit(0).alias("side"))
    second = pairs.where("NOT (cell = cell_b AND sub = sub_b)")
    second = second.select(*SPACE, F.col("cell_b").alias("cell"), F.col("sub_b").alias("sub"), name, F.lit(1).alias("side"))
    return first.unionByName(second)


def near_vectors(rows, need=NEED):
    """vec_id, n_links, component_id and kept for every row of ``rows`` (vec_id, embedding, label)."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["vec_id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vec = F.col("embedding")
    given = rows.select("vec_id", "label", "embedding").withColumns(
        {
            "vec": F.when(_usable(vec) & F.col("label").isNotNull(), vec),
            "key1": F.xxhash64("embedding"),
            "key2": F.xxhash64(F.lit(1), "embedding"),
            "part": F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"),
        }
    )
    key = ["label", "key1", "key2"]
    # copies of one vector may be a third of all rows: their results reach them by parts
    pieces = given.where("vec IS NOT NULL").groupBy(*key, "vec", "part")
    pieces = saved(pieces.agg(F.count("*").alias("k"), F.min("vec_id").alias("id")), "vector-pieces")
    classes = pieces.groupBy(*key, "vec").agg(F.sum("k").alias("k"), F.min("id").alias("id"))
    classes = classes.withColumns({"cls": F.monotonically_increasing_id(), "dims": F.size("vec")})
    classes = saved(classes, "vector-classes")

    found = trees(classes.select("cls", "id", "k", "vec", *SPACE))
    met = meeting_trees(found, need).join(found, TREE)
    met = met.select("label", "dims", "pair", "side", "pos", "cls", "id", "k", "vec", "top", "parent", "reach")
    links = met.groupBy("label", "dims", "pair").applyInArrow(
        lambda g: tree_links(g, need), f"a bigint, a_id {kind}, b bigint, b_id {kind}, n bigint"
    )
    links = saved(links, "vector-links")

    def node(name):
        return F.struct(F.col(f"{name}_id").isNull().alias("last"), F.col(f"{name}_id").alias("id"), F.col(name).alias("cls"))

    roots = components(links.where("b IS NOT NULL").select(node("a").alias("a"), node("b").alias("b")))
    roots = roots.select(F.col("node.cls").alias("cls"), F.col("root.id").alias("root_id")).distinct()
    counts = links.where("n IS NOT NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    judged = classes.select("cls", *key, "k", "id").join(roots, "cls", "left").join(counts, "cls", "left")
    judged = judged.select(
        *key, (F.col("k") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root_id", "id").alias("component_id")
    )
    judged = pieces.select(*key, "part").join(judged, key)
    out = given.join(judged, [*key, "part"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def near_vectors_query(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
