"""Near-duplicate vectors by exact comparison of all cells that can hold a partner.

Equal vectors are one class from the start. Every class belongs to the cell of its nearest centroid; neighbouring cells
form a group, and a group too large for one task is split by hash into blocks. A class visits each block with a cell
that can hold a vector within the range: the plane halfway between the two centroids is no farther from the class than
the range is wide, and so is the ring of angles in which the cell's members lie around their centroid. Both bounds are
exact, so no link is lost, whatever the size of the table or of a dense group; vectors without any structure are all
compared with each other. Each pair of blocks meets in one task, by matrix products; what lies within rounding of the
threshold is checked in double precision. Tasks emit counts and one edge per vector to its local root, never all pairs
of a dense group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table, tidy, workers_can_import
from .graph import components

COSINE = 0.9
CELL = 256  # classes aimed at per cell
CELLS, SAMPLE_PER_CELL = 4096, 16  # cells up to which there is one for CELL classes; beyond, they grow with the root of the classes
SAMPLE_BYTES = 256 << 20  # of the vectors that the centroids are fitted on, at most
PART = 8192  # classes aimed at per block; two blocks are compared in one task
PART_BYTES = 16 << 20  # of a block's vectors
STRIP = 1 << 22  # similarities that are held at once
SEED = 7


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means from evenly spread rows of the sample."""
    cells = max(1, min(cells, len(sample)))
    c = sample[np.linspace(0, len(sample) - 1, cells).astype(int)]
    step = max(1, STRIP // cells)
    for _ in range(rounds):
        own = np.concatenate([np.argmax(sample[lo : lo + step] @ c.T, axis=1) for lo in range(0, len(sample), step)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), c)
    return c


def _dense(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column, filled up with zeros, and their lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out, size


def _matrix(lists: list, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim))
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def _homes(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, dim: int) -> Iterator[pa.RecordBatch]:
    """Each class with the cell of its nearest centroid and its cosine to that."""
    step = max(1, STRIP // (4 * len(centroids)))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            sims = _unit(_dense(part.column(1), dim)[0]) @ centroids.T
            home = np.argmax(sims, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), pa.array(sims[np.arange(len(home)), home]), *part.columns], names=["cell", "cosine", "node", "v", "copies"])


def reachable(x: np.ndarray, home: np.ndarray, centroids: np.ndarray, low: np.ndarray, high: np.ndarray, least: float) -> np.ndarray:
    """(rows, cells): whether the cell can hold a vector whose cosine to the row is ``least`` or more.

    ``low`` and ``high`` bound the cosine of the cell's members to its centroid; members are nearer to it than to any
    other centroid.
    """
    slack = 1e-6
    if least <= 0:
        return np.ones((len(x), len(centroids)), bool)
    sims = x @ centroids.T
    own = centroids[home]
    apart = np.sqrt(np.maximum(0, (own**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * own @ centroids.T))
    wide = np.arccos(min(1.0, least))
    plane = sims[np.arange(len(x)), home][:, None] - sims <= np.sin(wide) * apart + slack
    angle = np.arccos(np.clip(sims, -1, 1))
    ring = (angle - wide <= np.arccos(np.clip(low - slack, -1, 1)) + slack) & (angle + wide >= np.arccos(np.clip(high + slack, -1, 1)) - slack)
    found = plane & ring
    found[np.arange(len(x)), home] = True
    return found


def _visits(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, low: np.ndarray, high: np.ndarray, group: np.ndarray, groups: int, dim: int, least: float) -> Iterator[pa.RecordBatch]:
    """Each class with its own group and, as a list, all groups it has to visit."""
    order = np.argsort(group, kind="stable")
    begin = np.searchsorted(group[order], np.arange(groups))  # every group has a cell
    step = max(1, STRIP // (4 * len(centroids)))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            home = part.column(0).to_numpy()
            cells = reachable(_unit(_dense(part.column(2), dim)[0]), home, centroids, low, high, least)
            to = np.logical_or.reduceat(cells[:, order], begin, axis=1)
            ends = np.concatenate([[0], np.cumsum(to.sum(axis=1))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(to)[1], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(group[home], pa.int64()), listed, *part.columns[1:]], names=["own", "to", "node", "v", "copies"])


def _roots(root: np.ndarray) -> np.ndarray:
    while True:
        above = root[root]
        if (above == root).all():
            return root
        root = above


def _joined(root: np.ndarray, rows: np.ndarray, columns: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """``root`` after the places ``rows`` and ``columns`` are joined where ``hit`` says so."""
    while True:
        root = _roots(root)
        open_ = hit & (root[rows][:, None] != root[columns])
        down, across = open_.any(axis=1), open_.any(axis=0)
        if not down.any():
            return root
        pairs = [(rows[down], columns[open_[down].argmax(axis=1)]), (rows[open_[:, across].argmax(axis=0)], columns[across])]
        for a, b in zip(np.concatenate([p[0] for p in pairs]).tolist(), np.concatenate([p[1] for p in pairs]).tolist(), strict=True):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)


def _compared(held: pa.Table, dim: int, least: float) -> pa.Table:
    """All classes of two blocks (or of one) to rows (node, links, root)."""
    x, size = _dense(held["v"], dim)
    x = _unit(x)
    rough, near = x.astype(np.float32), (dim + 8) * 1.2e-7  # rounding of a product in single precision
    own, i, j = (held[c].to_numpy() for c in ("block", "i", "j"))
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    copies, links, root = held["copies"].to_numpy().astype(float), np.zeros(len(x)), np.arange(len(x))
    same, even = i[0] == j[0], len(np.unique(size)) == 1
    step = max(1, STRIP // max(1, len(right)))
    for lo in range(0, len(left) if len(right) else 0, step):
        rows = left[lo : lo + step]
        sims = rough[rows] @ rough[right].T
        hit = sims >= least - near
        if not hit.any():
            continue
        a, b = np.nonzero(hit & (sims < least + near))
        for at in range(0, len(a), 100_000):
            s = slice(at, at + 100_000)
            hit[a[s], b[s]] = np.einsum("ij,ij->i", x[rows[a[s]]], x[right[b[s]]]) >= least
        if same:
            hit[np.arange(len(rows)), lo + np.arange(len(rows))] = False
        if not even:
            hit &= size[rows][:, None] == size[right]
        down = hit.any(axis=1)
        rows, hit = rows[down], hit[down]
        across = hit.any(axis=0)
        columns, hit = right[across], hit[:, across]
        grid = hit.astype(float)
        links[rows] += grid @ copies[columns]
        if not same:
            links[columns] += copies[rows] @ grid
        root = _joined(root, rows, columns, hit)
    some = np.flatnonzero((links > 0) | (root != np.arange(len(x))))
    nodes = held["node"].to_numpy()
    return pa.table({"node": pa.array(nodes[some], pa.int64()), "links": pa.array(links[some].astype(np.int64)), "root": pa.array(nodes[root[some]], pa.int64())})


def _classes(rows: DataFrame) -> DataFrame:
    """Vectors that are equal in every component: node, copies, the least id, v, and whether another vector has the node too."""
    order = F.struct(F.col("vec_id").isNull().alias("none"), F.col("vec_id").alias("vec_id"))
    return cut(rows.filter("ok").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("least"), F.min("v").alias("v"), (F.min("v") != F.max("v")).alias("clash")))


@tidy
def link_vectors(vectors: DataFrame, least: float = COSINE, cell: int = CELL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    A vector that is null, empty, zero, or has null or non-finite components links with nothing; vectors of unequal
    length do not link. Rows of one vec_id are vectors of their own that share a component_id only if they link; a
    null vec_id counts as larger than any. An empty table gives an empty one. Labels and other columns are not looked at.
    """
    spark = vectors.sparkSession
    workers_can_import(spark)
    wide = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = cut(vectors.select("vec_id", wide.alias("v")).withColumn("ok", F.coalesce(F.col("v").isNotNull() & (F.size("v") > 0) & fine, F.lit(False))).withColumn("node", F.when(F.col("ok"), F.xxhash64("v"))))
    classes = _classes(rows)
    while clashes := [r[0] for r in classes.filter("clash").select("node").collect()]:  # n ** 2 / 2 ** 65 of n vectors on average
        rows = cut(rows.withColumn("node", F.when(F.col("node").isin(clashes), F.xxhash64(F.to_json(F.struct("v")))).otherwise(F.col("node"))))
        classes = _classes(rows)
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not facts["n"]:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim = int(facts["dim"])
    room = max(1, SAMPLE_BYTES // (8 * dim))
    cells = int(min(max(CELLS, facts["n"] ** 0.5), max(1, -(-facts["n"] // cell)), max(1, room // 4)))
    most = min(cells * SAMPLE_PER_CELL, room)
    share = min(1.0, most / facts["n"])
    picked = classes.filter(F.xxhash64("node", F.lit(SEED)) / F.lit(2.0**64) + 0.5 < share).orderBy("node").limit(2 * most).select("v").collect()
    sample = _unit(_matrix([r["v"] for r in picked], dim)) if picked else np.eye(1, dim)
    centroids = fit_centroids(sample, cells)
    dealt = cut(classes.select("node", "v", "copies").mapInArrow(lambda it: _homes(it, centroids, dim), "cell long, cosine double, node long, v array<double>, copies long"))
    facts_of = {r["cell"]: r for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("low"), F.max("cosine").alias("high")).collect()}  # one row a cell
    used = sorted(facts_of)
    number = np.zeros(len(centroids), np.int64)
    number[used] = np.arange(len(used))
    centroids, sizes = centroids[used], np.array([facts_of[c]["n"] for c in used])
    low, high = (np.array([facts_of[c][k] for c in used]) for k in ("low", "high"))
    part = max(1, min(PART, PART_BYTES // (8 * dim)))
    group = np.unique(np.argmax(centroids @ fit_centroids(centroids, -(-facts["n"] // part)).T, axis=1), return_inverse=True)[1]
    blocks = -(-np.bincount(group, sizes).astype(np.int64) // part)  # of each group
    first, groups = np.cumsum(blocks) - blocks, len(blocks)
    at = lambda column, values: F.element_at(F.lit(values.tolist()), (F.col(column) + 1).cast("int"))
    visits = dealt.select(at("cell", number).alias("cell"), "node", "v", "copies").mapInArrow(lambda it: _visits(it, centroids, low, high, group, groups, dim, least), "own long, to array<long>, node long, v array<double>, copies long")
    placed = visits.select((at("own", first) + F.pmod(F.xxhash64("node", F.lit(1)), at("own", blocks))).alias("block"), F.explode("to").alias("group"), "node", "v", "copies")
    met = placed.select("block", F.explode(F.sequence(at("group", first), at("group", first + blocks) - 1)).alias("other"), "node", "v", "copies")
    pairs = met.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "v", "copies")
    found = cut(pairs.groupBy("i", "j").applyInArrow(lambda held: _compared(held, dim, least), "node long, links long, root long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = cut(classes.select("node", "copies", "least").join(counts, "node", "left").join(labels, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least", F.coalesce("component", "node").alias("c")))
    best = known.groupBy("c").agg(F.min("least").alias("best"))
    named = known.join(best, "c").select("node", "n_links", F.col("best.vec_id").alias("component_id"))
    out = rows.select("vec_id", "node").join(named, "node", "left")
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (alone | F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"))


def recall(vectors: DataFrame, found: DataFrame, queries: int = 200, least: float = COSINE) -> float:
    """Audit: the share of the links of some rows (lowest hashes of vec_id) that ``found`` counts, against brute force.

    The rows are compared with all vectors, in blocks of one Arrow batch each.
    """
    workers_can_import(vectors.sparkSession)
    sample = vectors.filter("embedding is not null").orderBy(F.xxhash64("vec_id")).limit(queries).select("vec_id", "embedding").collect()
    ids = [r["vec_id"] for r in sample]
    q = _unit(np.array([r["embedding"] for r in sample], dtype=float))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float)
            hits = (q @ _unit(x).T >= least) & (np.array(ids)[:, None] != np.array(batch.column(0).to_pylist())[None, :])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hits.sum(axis=1), pa.int64())], names=["vec_id", "n"])

    true = vectors.filter("embedding is not null").select("vec_id", "embedding").mapInArrow(compare, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    row = true.join(found.select("vec_id", "n_links"), "vec_id").agg(F.sum(F.least("n", "n_links")), F.sum("n")).first()
    return 1.0 if not row[1] else row[0] / row[1]


def op7_embeddings(spark, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
c AS (
  SELECT a AS vec_id, a AS root FROM l
  UNION SELECT l.b, c.root FROM c JOIN l ON c.vec_id = l.a WHERE c.root < l.b),
m AS (SELECT vec_id, min(root) AS root FROM c GROUP BY vec_id)
SELECT t.vec_id, coalesce(n.n, 0) AS n_links, least(t.vec_id, coalesce(m.root, t.vec_id)) AS component_id, t.vec_id <= coalesce(m.root, t.vec_id) AS kept
FROM embeddings t LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) n ON n.a = t.vec_id LEFT JOIN m ON m.vec_id = t.vec_id
"""
