import itertools
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import embeddings, neardup
from corpusmill.llm.graph import components

DIR = "/root/testdata/sf0.001"


def union_find(n, links):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_components(spark, rng):
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(400 + i, 401 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find(500, links)
    assert got == {n: want[n] for n in {x for a, b in links if a != b for x in (a, b)}}


def test_signatures_estimate_weighted_jaccard():
    g = np.random.default_rng(0)
    e = g.integers(0, 2**63, 400, dtype=np.uint64)
    a = g.integers(1, 30, 400) + 0.5
    b = np.where(np.arange(400) < 130, a * 3, a)
    s = neardup.signatures(np.concatenate([e, e]), np.concatenate([a, b]), np.repeat([0, 1], 400), 2, 4000)
    assert not np.isinf(s).any() and (s[0] == s[1]).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)
    alone = neardup.signatures(e, a, np.zeros(400, int), 1, 4000)
    assert (alone[0] == s[0]).all()


def shingle_sets(texts):
    out = []
    for t in texts:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def classes(rows):
    sets = shingle_sets([t for _, t in rows])
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = union_find(len(rows), links)
    least = {}
    for i, r in enumerate(root):
        d = rows[i][0]
        if r not in least or (d is not None and (least[r] is None or d < least[r])):
            least[r] = d
    return [least[r] if sets[i] else rows[i][0] for i, r in enumerate(root)]


def test_near_duplicates_against_brute_force(spark, rng):
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    rows = [(None, "only one row of no id"), (900, ""), (901, None), (902, "..."), (903, "..."), (904, "short text"), (905, "Short, text")]
    for i in range(40):
        w = [rng.choice(words) for _ in range(rng.choice([3, 30, 120, 200]))]
        rows.append((i, " ".join(w)))
        for j in range(rng.randint(0, 4)):
            v = list(w)
            for _ in range(rng.randint(0, 6)):
                v[rng.randrange(len(v))] = rng.choice(words)
            rows.append((1000 + 10 * i + j, " ".join(v).upper() if j % 2 else ", ".join(v)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("tie", F.lit(0))
    got = {(r["doc_id"]): (r["class_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()}
    want = classes(rows)
    assert {d: c for (d, _), c in zip(rows, want, strict=True)} == {d: c for d, (c, _) in got.items()}
    assert all(k == (d == c) for d, (c, k) in got.items())
    left = neardup.deduplicated(df)
    assert left.columns == df.columns and left.count() == sum(k for _, k in got.values())


def test_near_duplicates_edges(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    same = spark.createDataFrame([(7, "a b c d e f g")] * 4 + [(3, "a b c d e f g")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(same).collect()) == [(3, 3)] + [(7, 3)] * 4
    assert [r["doc_id"] for r in neardup.deduplicated(same).collect()] == [3]


def test_deduplicated_keeps_rows_without_words(spark):
    rows = [(1, None, "a"), (1, None, "b"), (1, "", "c"), (None, "...", "d"), (None, "...", "d"), (2, "one two three four five six", "e"), (2, "one two three four five six", "f"), (3, "one two three four five six", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("row", F.lit(1))
    left = neardup.deduplicated(df)
    got = sorted(((r["doc_id"], r["source"]) for r in left.collect()), key=str)
    assert left.columns == df.columns and [g for g in got if g[0] != 2] == [(1, "a"), (1, "b"), (1, "c"), (None, "d"), (None, "d")]
    assert [g[1] in ("e", "f") for g in got if g[0] == 2] == [True]
    assert neardup.deduplicated(df.limit(0)).count() == 0


def test_counted_shingles(spark):
    """A text that says one thing over and over is like another by the multiplicities, not by the set."""
    a, b = "a b c d e " * 40, "a b c d e " * 12
    df = spark.createDataFrame([(1, a), (2, b), (3, "a b c d e " * 38)], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 1}
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df, counted=True).collect()} == {1: 1, 2: 2, 3: 1}


def test_long_texts(spark, rng):
    w = [f"w{rng.randint(0, 50_000)}" for _ in range(200_000)]
    v = list(w)
    for i in rng.sample(range(len(v)), 2000):
        v[i] = "changed"
    df = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(v)), (3, " ".join(reversed(w))), (4, "x" * 1_500_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_clusters_of_many_blocks(spark, rng, monkeypatch):
    """Clusters that hold several components, cut into many blocks and levels of size."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "HUBS", 1)
    rows = []
    for i in range(6):
        w = [f"w{i}_{k}" for k in range(160)]
        for j in range(12):
            v = list(w)
            for k in rng.sample(range(160), rng.choice([0, 1, 3, 5, 7])):
                v[k] = f"x{i}_{j}_{k}"
            rows.append((100 * i + j, " ".join(v[: rng.choice([160, 160, 130, 100])])))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(zip([d for d, _ in rows], classes(rows), strict=True))


def test_crowd_of_copies(spark, rng):
    """A large group whose copies are close to their original, not to each other."""
    w = ["w%d" % i for i in range(300)]
    rows = [(0, " ".join(w))]
    for i in range(1, 150):
        v = list(w)
        for k in rng.sample(range(300), 5):
            v[k] = f"x{i}_{k}"
        rows.append((i, " ".join(v)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = dict(zip([d for d, _ in rows], classes(rows), strict=True))
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_vectors_against_brute_force(spark):
    g = np.random.default_rng(1)
    x = g.normal(size=(700, 16))
    x[100:160] = x[99] + 0.05 * g.normal(size=(60, 16))
    x[300:310] = x[299]
    x[400] = 3 * x[299]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [float("inf")] + [1.0] * 15), (1005, [None] + [1.0] * 15), (1006, [1e300] + [0.0] * 15), (1007, [1.0, 2.0]), (1008, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash"))
    found = embeddings.link_vectors(df, cell=64).cache()
    got = {r["vec_id"]: r for r in found.collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    links = near.sum(axis=1)
    took = np.array([got[i]["n_links"] for i in range(700)])
    assert (took <= links).all() and took.sum() >= 0.98 * links.sum()
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(1000, 1007))
    assert got[1007]["n_links"] == got[1008]["n_links"] == 1 and got[1008]["component_id"] == 1007 and not got[1008]["kept"]
    assert embeddings.recall(df.filter("vec_id < 700"), found, 100) >= 0.95


def test_split_cells(spark, monkeypatch):
    """Cells above PART are dealt to several parts; links across them stay."""
    monkeypatch.setattr(embeddings, "PART", 20)
    g = np.random.default_rng(2)
    x = g.normal(size=16) + 0.01 * g.normal(size=(90, 16))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = embeddings.link_vectors(df).collect()
    assert all(r["n_links"] == 89 and r["component_id"] == 0 for r in got)


def test_vectors_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.link_vectors(empty).count() == 0
    bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted((r["vec_id"], r["component_id"]) for r in embeddings.link_vectors(bad).collect()) == [(1, 1), (2, 2)]


def test_vectors_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DIR}/embeddings.parquet'")
    assert sorted(tuple(r) for r in embeddings.op7_embeddings(spark, DIR).collect()) == sorted(con.execute(embeddings.OP7_SQL).fetchall())


def test_every_link_of_vectors_is_found(spark, monkeypatch):
    """A dense third over many cells, and isolated pairs near the threshold in random directions."""
    monkeypatch.setattr(embeddings, "PART", 300)
    g = np.random.default_rng(5)
    x = g.normal(size=(2400, 64))
    x[:800] = x[0] + 0.2 * g.normal(size=(800, 64))
    x[1600:] = x[800:1600] + 0.47 * g.normal(size=(800, 64))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.link_vectors(df, cell=32).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert [got[i]["n_links"] for i in range(2400)] == near.sum(axis=1).tolist()
    root = union_find(2400, np.argwhere(near).tolist())
    assert len({(root[i], got[i]["component_id"]) for i in range(2400)}) == len(set(root)) == sum(got[i]["kept"] for i in range(2400))


def test_large_cluster_loses_no_pair(spark, monkeypatch):
    """Pairs at exactly 0.8 that no hub link joins, in one cluster of more classes than CLUSTER (if there is such a limit)."""
    monkeypatch.setattr(neardup, "CLUSTER", 100, raising=False)

    def one_cluster(shared):
        nodes = shared.select("node").distinct()
        pairs = nodes.crossJoin(nodes.agg(F.min("node").alias("hub"))).filter("node <> hub")
        return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))

    monkeypatch.setattr(neardup, "_hub_pairs", one_cluster)
    rows = []
    for i in range(1500):
        w = [f"w{i}x{k}" for k in range(94)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:84] + [f"v{i}x{k}" for k in range(10)]))]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["doc_id"] for r in got if r["class_id"] != r["doc_id"] - r["doc_id"] % 2] == []


@pytest.mark.parametrize("counted", [False, True])
def test_levels_of_size(spark, monkeypatch, counted):
    """Sets of unlike sizes, over several levels and blocks, against brute force on the sets."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    g = np.random.default_rng(3)
    sets = []
    for _ in range(12):
        base = np.unique(g.integers(0, 2**62, 400).astype(np.uint64) << np.uint64(1))
        for n in [400, 360, 330, 321, 320, 300, 260, 240, 120]:
            e = np.sort(g.permutation(base)[:n]) if n % 2 else base[:n]
            sets.append((e, g.integers(1, 3, len(e)).astype(float) if counted else np.ones(len(e))))
    nodes = [bytes([i]) for i in range(len(sets))]
    contents = spark.createDataFrame([(v, bytearray(neardup.pack_set(e, w, counted)), float(w.sum())) for v, (e, w) in zip(nodes, sets, strict=True)], "node binary, content binary, mass double")
    open_ = spark.createDataFrame([(v, v, nodes[0], len(nodes)) for v in nodes], "node binary, c binary, cluster binary, n long")
    found = neardup._within(open_, contents, 0.8, counted).collect()
    short = [neardup.unpack_set(neardup.pack_set(e, w, counted)) for e, w in sets]
    want = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if neardup.similarity(short[i], short[j]) >= 0.8]
    assert union_find(len(sets), [(r["a"][0], r["b"][0]) for r in found]) == union_find(len(sets), want)


def test_overlapping_groups_of_vectors(spark):
    """Noisy groups that run into each other, in many cells: every link is counted at both of its ends."""
    g = np.random.default_rng(5)
    x = np.repeat(g.normal(size=(120, 24)), 25, axis=0) + 0.33 * g.normal(size=(3000, 24))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    found = embeddings.link_vectors(df, cell=32).cache()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in found.collect()}
    assert [got[i] for i in range(len(x))] == near.sum(axis=1).tolist() and near.sum() > 5000
    assert embeddings.recall(df, found) == 1.0


def test_vectors_that_share_a_key(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], 9, True), (2, [0.0, 1.0], 9, True), (3, [2.0], 8, True)], "vec_id long, v array<double>, node long, ok boolean")
    assert {r["node"]: r["clash"] for r in embeddings._classes(rows).collect()} == {9: True, 8: False}
