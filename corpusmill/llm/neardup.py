"""Near-duplicates by DartMinHash signatures and banding.

For every element of a weighted set the plane of weight and rank is cut into regions (dyadic in both directions); a
region's number of darts is Poisson, drawn from the hash of element and region, and every dart has a place and a
coordinate by hash. A set keeps, for each coordinate, the dart of lowest rank that lies below its element's weight.
Two sets agree in a coordinate with the probability of their weighted Jaccard similarity, and a set throws about
``k ln k`` darts whatever its size.

Equal sets are one class from the start. Classes that share a band are candidates: each is compared with a few hubs
of its bucket. Candidates that hang together form a cluster; where a cluster then still holds several components, its
classes are compared block by block, all pairs inside a task, which only gives back the links that join components.
Only sets of sizes too unlike to reach the threshold are not brought together. This is so for clusters of any number of
classes; no link within a cluster is missed. All comparisons are of whole shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, fresh, hot_keys, salted_join, slices, table, texts_of, tidy, workers_can_import
from .decontaminate import keyed_texts
from .graph import components

SHINGLE, SIMILAR = 5, 0.8
ROWS, BANDS = 5, 25  # a pair at 0.8 shares no band with probability (1 - 0.8 ** 5) ** 25 = 5e-5
HUBS = 4
CROWD = 32  # a bucket of more classes has one hub, the one that shares most
BLOCK, BLOCK_BYTES = 400, 1 << 20  # classes, and bytes of their sets, that are compared with as many others in one task
FIRST_BAND = 0.125  # height of the lowest rank region
SLACK = 3.0  # darts: k * (ln k + SLACK); coordinates that stay empty get a further rank region

_A = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_U = 2.0**-53


def _mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * _U


def _salt(*numbers: int) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(repr(numbers).encode(), digest_size=8).digest(), "<u8")[0]


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all texts, in order, and their number per text.

    Words are runs of letters, digits and non-ASCII characters of the lower-cased text; a text of fewer words, but
    not none, has one shingle of all its words.
    """
    key, _, counts = keyed_texts([t.lower().encode("utf-8", "replace") for t in texts])
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.cumsum(counts) - counts
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
    left = np.repeat(begin + counts, n)
    padded = np.append(key, np.zeros(size, np.uint64))
    h = np.zeros(len(at), np.uint64)
    for j in range(size):
        word = np.where(at + j < left, padded[np.minimum(at + j, len(padded) - 1)], np.uint64(0))
        h = _mix(h * np.uint64(_A[j % 5]) + word + np.uint64(j + 1))
    return h, n


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, k: int, seed: int = 1) -> np.ndarray:
    """(sets, k): the lowest rank per coordinate of each set; a rank is one dart's own. inf where a set is empty."""
    out = np.full(sets * k, np.inf)
    total = np.bincount(owner, weights, minlength=sets)
    alive = total > 0
    with np.errstate(divide="ignore"):
        height = k * (np.log(k) + SLACK) / np.where(alive, total, 1)
    upto = np.maximum(0, np.ceil(np.log2(height / FIRST_BAND))).astype(int)
    band = 0
    while alive.any():
        open_sets = alive & ((upto >= band) | np.isinf(out.reshape(sets, k)).any(axis=1))
        if not open_sets.any():
            break
        alive = open_sets  # rank regions are thrown in order, each for all elements of a set
        mine = np.flatnonzero(open_sets[owner])
        low, tall = (0.0, FIRST_BAND) if band == 0 else (FIRST_BAND * 2.0 ** (band - 1), FIRST_BAND * 2.0 ** (band - 1))
        layer = 0
        while len(mine):
            floor, wide = 2.0**layer - 1, 2.0**layer
            _throw(elements[mine], weights[mine], owner[mine], out, k, low, tall, floor, wide, _salt(seed, band, layer))
            layer += 1
            mine = mine[weights[mine] > 2.0**layer - 1]
        band += 1
    return out.reshape(sets, k)


def _throw(e: np.ndarray, w: np.ndarray, owner: np.ndarray, out: np.ndarray, k: int, low: float, tall: float, floor: float, wide: float, salt: np.uint64) -> None:
    """Throws the darts of one region of each element and lowers ``out`` where they hit."""
    mean = tall * wide
    region = _mix(e ^ salt)
    if mean <= 64:
        term, cdf, i = np.exp(-mean), [], 0
        while term > 1e-18 or i < mean:
            cdf.append((cdf[-1] if cdf else 0.0) + term)
            i += 1
            term *= mean / i
        count = np.searchsorted(np.array(cdf[:-1]), _uniform(region), side="right")
    else:  # cut a large region into equal parts, each with its own count
        parts = int(np.ceil(mean / 32))
        for p in range(parts):
            _throw(e, w, owner, out, k, low + tall * p / parts, tall / parts, floor, wide, _mix(np.array([salt + np.uint64(p + 1)]))[0])
        return
    hit = np.repeat(np.flatnonzero(count), count[count > 0])
    if not len(hit):
        return
    number = np.arange(len(hit)) - np.repeat(np.cumsum(count[count > 0]) - count[count > 0], count[count > 0])
    dart = _mix(region[hit] + (number + 1).astype(np.uint64) * np.uint64(_A[0]))
    rank = low + tall * _uniform(dart)
    more = _mix(dart + np.uint64(_A[1]))
    if wide > 1 or (w[hit] < 1).any():
        below = floor + wide * _uniform(_mix(more + np.uint64(_A[2]))) < w[hit]
        hit, rank, more = hit[below], rank[below], more[below]
    coordinate = ((more >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(out, owner[hit].astype(np.int64) * k + coordinate, rank)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands) as signed 64-bit keys; the band's number is part of the key."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), -1, rows)
    h = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64) * np.uint64(_A[3]), bits.shape[:2]).copy()
    for j in range(rows):
        h = _mix(h * np.uint64(_A[4]) + bits[:, :, j])
    return h.view(np.int64)


def sets_of(texts: list[str], size: int, counted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts (sorted within each), their weights, and their number per text."""
    h, n = shingles(texts, size)
    parts, weights, sizes, at = [], [], [], 0
    for c in n.tolist():
        u, m = np.unique(h[at : at + c], return_counts=True)
        parts.append(u)
        weights.append(m if counted else np.ones(len(u)))
        sizes.append(len(u))
        at += c
    return (np.concatenate(parts), np.concatenate(weights).astype(float), np.array(sizes)) if parts else (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, int))


def _names(e: np.ndarray, w: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A name of 128 bits for each set, the same for equal ones; None for the empty set."""
    out, at = [], 0
    for n in sizes.tolist():
        out.append(hashlib.blake2b(e[at : at + n].tobytes() + w[at : at + n].tobytes(), digest_size=16).digest() if n else None)
        at += n
    return out


def _signed(batches: Iterator[pa.RecordBatch], size: int, rows: int, bands: int, counted: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1, 2 << 20):
        e, w, sizes = sets_of(texts_of(batch.column(1)), size, counted)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        keys = band_keys(signatures(e, w, owner, len(sizes), rows * bands), rows)
        names = _names(e, w, sizes)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands), pa.array(keys.ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.binary()), listed], names=["doc_id", "tie", "node", "bands"])


def pack_set(e: np.ndarray, w: np.ndarray, counted: bool) -> bytes:
    gaps = np.diff(e, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    body = np.ascontiguousarray(gaps).tobytes() + (w.astype("<f8").tobytes() if counted else b"")
    return len(e).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpack_set(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(content[:4], "little")
    body = zstandard.ZstdDecompressor().decompress(content[4:])
    gaps = np.ascontiguousarray(np.frombuffer(body[: 8 * n], np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.frombuffer(body[8 * n :], "<f8") if len(body) > 8 * n else np.ones(n)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    return both / (float(a[1].sum()) + float(b[1].sum()) - both)


def _packed(batches: Iterator[pa.RecordBatch], size: int, counted: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1, 2 << 20):
        e, w, sizes = sets_of(texts_of(batch.column(1)), size, counted)
        ends = np.cumsum(sizes)
        blobs = [pack_set(e[z - n : z], w[z - n : z], counted) for z, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        mass = [float(w[z - n : z].sum()) for z, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary()), pa.array(mass, pa.float64())], names=["node", "content", "mass"])


def _verified(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[bytes, tuple] = {}
        good = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if len(held) > 2000:
                held.clear()
            for c in (x, y):
                if c not in held:
                    held[c] = unpack_set(c)
            a, b = held[x], held[y]
            small, large = sorted((float(a[1].sum()), float(b[1].sum())))
            good.append(small >= least * large and similarity(a, b) >= least)
        mask = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(mask)


@tidy
def near_duplicates(docs: DataFrame, least: float = SIMILAR, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS, counted: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, tie, class_id, kept, worded (whether the text has words).

    Documents link if the Jaccard similarity of their sets of word shingles (with ``counted``: of their multisets) is
    at least ``least``; a class is a component of links, its class_id the smallest doc_id. ``kept`` marks the rows of
    that id (and, among different texts of one id, of the smallest ``tie``, the hash of the text). Texts without words
    (null, empty, only signs) link with nothing and keep their own id. A null doc_id counts as larger than any.
    Columns other than these two are not looked at.
    """
    spark = docs.sparkSession
    workers_can_import(spark)
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    signed = cut(own.mapInArrow(lambda it: _signed(it, size, rows, bands, counted), "doc_id long, tie long, node binary, bands array<long>"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("tie").alias("tie"))
    nodes = cut(signed.filter("node is not null").groupBy("node").agg(F.min(F.struct(rank.alias("r"), F.col("bands").alias("bands"))).alias("m")).select("node", F.col("m.r").alias("r"), F.col("m.bands").alias("bands")))
    placed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(placed.join(buckets.hint("merge"), "key").select("key", "node", "n"))
    pairs = cut(_hub_pairs(shared))
    contents = _contents(own, nodes, shared.select("node").distinct(), size, counted)
    links = cut(_linked(pairs, contents, least))
    labels = cut(components(links))
    clusters = cut(components(pairs))
    open_, hot = _open(clusters, labels)
    open_ = cut(open_)
    if open_.limit(1).count():
        more = cut(_within(open_, contents, least, counted, hot))
        if more.limit(1).count():
            labels = cut(components(links.unionByName(more)))
    drop(shared, pairs, contents, clusters, open_)
    return _classes(signed, nodes, labels)


def _hub_pairs(shared: DataFrame) -> DataFrame:
    """Each class with the hubs of its buckets: the class that shares most, by the sizes of its buckets, and (unless crowded) some by hash.

    What a group of near copies was copied from shares more bands than the copies do with each other.
    """
    mass = shared.groupBy("node").agg(F.sum("n").alias("mass"))
    h = lambda i: F.xxhash64("node", F.lit(i))
    hubs = [F.max(F.struct("mass", h(HUBS).alias("h"), F.col("node").alias("node"))).alias("h0")]
    hubs += [F.min(F.struct(h(i).alias("h"), F.col("node").alias("node"))).alias(f"h{i}") for i in range(1, HUBS)]
    every, first = F.array(*[F.col(f"h{i}")["node"] for i in range(HUBS)]), F.array(F.col("h0")["node"])
    found = shared.join(mass, "node").groupBy("key").agg(F.max("n").alias("n"), *hubs).select("key", F.array_distinct(F.when(F.col("n") <= CROWD, every).otherwise(first)).alias("hubs"))
    pairs = shared.join(found, "key").select("node", F.explode("hubs").alias("hub")).filter("node <> hub")
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _contents(own: DataFrame, nodes: DataFrame, needed: DataFrame, size: int, counted: bool) -> DataFrame:
    """The sets of the needed classes, made again from one text of each."""
    want = cut(nodes.select("node", F.col("r.doc_id").alias("rep"), F.col("r.tie").alias("rtie")).join(needed, "node", "left_semi"))
    texts = own.join(want.hint("merge"), (F.coalesce("doc_id", F.lit(0)) == F.coalesce("rep", F.lit(0))) & own["doc_id"].eqNullSafe(want["rep"]) & (F.col("tie") == F.col("rtie"))).select("node", "text")
    out = cut(texts.mapInArrow(lambda it: _packed(it, size, counted), "node binary, content binary, mass double").groupBy("node").agg(F.min("content").alias("content"), F.min("mass").alias("mass")), "uncompressed")
    drop(want)
    return out


def _linked(pairs: DataFrame, contents: DataFrame, least: float) -> DataFrame:
    first = pairs.join(contents.select(F.col("node").alias("a"), F.col("content").alias("x")), "a")
    both = first.join(contents.select(F.col("node").alias("b"), F.col("content").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(lambda it: _verified(it, least), "a binary, b binary")


def _open(clusters: DataFrame, labels: DataFrame) -> tuple[DataFrame, list]:
    """node, c (component), cluster, n: the classes of clusters of candidates that hold several components, and their number;
    and the clusters that hold a sizeable share of them."""
    at = clusters.select("node", F.col("component").alias("cluster")).join(labels, "node", "left").select("node", "cluster", F.coalesce("component", "node").alias("c"))
    several = cut(at.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("cluster", "n"))
    hot = hot_keys(several, "cluster", "n")
    return salted_join(at, several, ["cluster"], F.xxhash64("node"), hot).select("node", "c", "cluster", "n"), hot


def _within(open_: DataFrame, contents: DataFrame, least: float, counted: bool, hot: list | tuple = ()) -> DataFrame:
    """Links between components of one cluster: its classes are dealt to blocks, and each pair of blocks is compared in one task.

    Blocks hold sets of one level of size; a set 1 / ``least`` times as large is one level up at most, so levels farther
    apart have no links. A task holds two blocks and gives back no more links than it takes to join what belongs together.
    """
    level = F.floor(F.log(F.col("mass")) / (1.0001 * np.log(1 / least) + 1e-9)).cast("long") if least > 0 else F.lit(0).cast("long")  # a little wider, for rounding
    held = cut(open_.join(contents, "node").withColumn("level", level), "uncompressed")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.octet_length("content")) / BLOCK_BYTES)).cast("int")
    sizes = cut(held.groupBy("cluster", "level").agg(blocks.alias("blocks"), F.min("c").alias("c0"), F.max("c").alias("c1")))
    near = sizes.select("cluster", F.col("level").alias("low"), F.col("blocks").alias("below"), "c0", "c1").join(sizes.select("cluster", (F.col("level") - 1).alias("low"), F.col("blocks").alias("above"), F.col("c0").alias("d0"), F.col("c1").alias("d1")), ["cluster", "low"])
    near = near.filter((F.least("c0", "d0") != F.greatest("c1", "d1"))).select("cluster", "low", "below", "above")
    alone = sizes.filter("c0 <> c1").select("cluster", F.col("level").alias("low"), F.col("blocks").alias("below"), F.lit(None).cast("int").alias("above"))
    h = F.xxhash64("node")
    own = lambda n: F.pmod(h, F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["node", "c", "content"]
    met = lambda rows, few: salted_join(rows, few, ["cluster", "low"], F.xxhash64("node", F.lit(1)), hot)
    same = met(held.withColumnRenamed("level", "low"), alone).select("cluster", "low", own("below").alias("own"), upto("below").alias("other"), *kept)
    same = same.select("cluster", "low", F.lit(False).alias("two"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *kept)
    under = met(held.withColumnRenamed("level", "low"), near).select("cluster", "low", F.lit(True).alias("two"), own("below").alias("i"), upto("above").alias("j"), *kept)
    over = met(held.withColumn("low", F.col("level") - 1), near).select("cluster", "low", F.lit(True).alias("two"), upto("below").alias("i"), own("above").alias("j"), *kept)
    keyed = same.unionByName(under).unionByName(over)
    return keyed.groupBy("cluster", "low", "two", "i", "j").applyInPandas(lambda f: _compared(f, least, counted), "a binary, b binary")


def _compared(frame: pd.DataFrame, least: float, counted: bool) -> pd.DataFrame:
    c = frame["c"].tolist()
    if len(set(c)) < 2:
        return pd.DataFrame([], columns=["a", "b"])
    sets = [unpack_set(x) for x in frame["content"]]
    n = len(sets)
    sizes = np.array([w.sum() for _, w in sets])
    both = np.zeros((n, n))
    if counted:
        for i in range(n):
            for j in range(i):
                if c[i] != c[j]:
                    both[i, j] = both[j, i] = similarity(sets[i], sets[j]) * (sizes[i] + sizes[j]) / (1 + similarity(sets[i], sets[j]))
    else:
        who = np.repeat(np.arange(n), [len(x) for x, _ in sets])
        _, which, times = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True, return_counts=True)
        shared = times[which] > 1  # shingles of one set alone add nothing
        who, which = who[shared], np.unique(which[shared], return_inverse=True)[1]
        order = np.argsort(which, kind="stable")
        who, which = who[order], which[order]
        for lo in range(0, int(which[-1]) + 1 if len(which) else 0, 4096):
            a, z = np.searchsorted(which, [lo, lo + 4096])
            grid = np.zeros((n, 4096), np.float32)
            grid[who[a:z], which[a:z] - lo] = 1
            both += grid @ grid.T
    alike = np.argwhere(np.triu(both >= least * (sizes[:, None] + sizes[None, :] - both) - 1e-9, 1) & (both > 0))
    root = {x: x for x in c}

    def find(x: bytes) -> bytes:
        while root[x] != x:
            x = root[x]
        return x

    out = []
    for i, j in alike.tolist():
        x, y = find(c[i]), find(c[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((frame["node"].iloc[i], frame["node"].iloc[j]))
    return pd.DataFrame(out, columns=["a", "b"])


def _classes(signed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    grouped = cut(nodes.select("node", "r").join(labels, "node", "left").select("node", "r", F.coalesce("component", "node").alias("c")))
    best = grouped.groupBy("c").agg(F.min("r").alias("best"))
    named = grouped.join(best, "c").select("node", "best")
    rows = signed.select("doc_id", "tie", "node").join(named, "node", "left")
    alone = F.col("best").isNull()
    kept = alone | (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tie") == F.col("best.tie")))
    return rows.select("doc_id", "tie", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"), kept.alias("kept"), F.col("node").isNotNull().alias("worded"))


def deduplicated(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` with one of each class kept, all columns.

    Rows without words are no one's duplicates: all of them stay, whatever ids and texts they share. Of several rows
    with the kept id and text one stays, by the smallest hash of its other columns.
    """
    found = near_duplicates(docs, **kw)
    own, other, stays = fresh(docs, "_own"), fresh(docs, "_tie"), fresh(docs, "_kept")
    # rows of one id and text: how many there are decides what goes: all of them, or all but one
    marked = found.groupBy(F.col("doc_id").alias(own), F.col("tie").alias(other)).agg(F.max("kept").alias(stays), F.max("worded").alias("worded"), F.count(F.lit(1)).alias("n"))
    marked = cut(marked.filter(F.col("worded") & (~F.col(stays) | (F.col("n") > 1))).select(own, other, stays))
    drop(found)
    marked = marked.hint("merge")  # at any size the same plan
    same = docs["doc_id"].eqNullSafe(marked[own]) & (F.xxhash64(docs["text"]) == marked[other])
    joined = docs.join(marked, (F.coalesce(docs["doc_id"], F.lit(0)) == F.coalesce(marked[own], F.lit(0))) & same, "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    left = joined.filter(F.col(other).isNull()).select(*columns)
    if not marked.filter(stays).limit(1).count():
        return left
    held = joined.filter(stays).select(F.struct(own, other).alias("key"), F.struct(*columns).alias("row"), F.xxhash64(*columns).alias("h"))
    one = held.groupBy("key").agg(F.min_by("row", "h").alias("row"))  # combined before the shuffle, however often a row occurs
    return left.unionByName(one.select(*[F.col("row")[c].alias(c) for c in docs.columns]))


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def column_similar(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of shingles; for small checks in SQL."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT k, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
p AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k <> b.k GROUP BY a.k, b.k),
l AS (SELECT x, y FROM p JOIN n a ON a.k = x JOIN n b ON b.k = y WHERE c >= 0.8e0 * (a.n + b.n - c)),
r AS (SELECT DISTINCT x AS k, x AS root FROM l UNION SELECT l.y, r.root FROM r JOIN l ON r.k = l.x),
m AS (SELECT r.k, min(d.doc_id) AS class_id FROM r JOIN d ON d.k = r.root GROUP BY r.k)
SELECT d.doc_id, coalesce(m.class_id, d.doc_id) AS class_id, d.doc_id = coalesce(m.class_id, d.doc_id) AS kept FROM d LEFT JOIN m USING (k)
"""
