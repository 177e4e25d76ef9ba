"""Exact-substring removal by hash-compared suffix sorting.

1. Every window of ``LENGTH`` bytes has an anchor, the least-hashed gram within it (winnowing); equal windows have
   equal anchors at equal offsets. Grams that occur once in the corpus are dropped.
2. Consecutive windows with one anchor form a run. Runs of one gram with the same 128-bit cryptographic digest of their
   bytes form a class; a class of two or more members is repeated as a whole.
3. Where a gram has several classes, the windows of one member of each are sorted as suffixes: mergesort, where two
   suffixes are compared by prefix polynomial hashes and a binary search for their common extension, so in
   logarithmic time. A window whose own hash occurs once is repeated nowhere and left out of the sort. Neighbours that
   agree for LENGTH bytes are repeats, confirmed byte by byte (if a hash ever failed, the sort runs again with another
   base). A gram with very many classes is not sorted in one task: its windows are counted by two hashes across the
   cluster, and what they say of a run's first and last repeated window is confirmed byte by byte in the same way.
4. Of a run only the first and the last repeated window matter, since any two of its windows overlap.

Texts that occur as a whole more than once only serve as witnesses; all their bytes are removed. Texts are the same if
their SHA-256 is; should two others share the 64-bit key by which they are joined, they get other keys. Grams that hold a
sizeable share of all runs are dealt over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices, table, tidy, workers_can_import
from .neardup import _mix

LENGTH = 200
GRAM = 48
MANY = 4096  # classes of a gram, above which its windows are counted across the cluster instead of sorted in one task
HOT, SALTS = 512, 64  # a gram with this share of all runs is dealt over so many tasks; there are at most HOT such grams
PIECE = 1 << 20  # bytes whose windows are computed at once; longer texts are cut in overlapping pieces
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xDA942042E4DD58B5)
PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n or more."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base]


def prefix_hash(data: np.ndarray, base: int) -> np.ndarray:
    """P[i]: the polynomial hash of the first i bytes (sum of byte * base ** place, modulo 2 ** 64)."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data))[: len(data)], out=out[1:])
    return out


def hashes(p: np.ndarray, at: np.ndarray, size: np.ndarray | int, base: int) -> np.ndarray:
    """Hashes of data[at : at + size], the same wherever the bytes stand."""
    inverse = pow(base, -1, 1 << 64)
    return (p[at + size] - p[at]) * powers(inverse, len(p))[at]


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor over texts that end at ``ends``: first window, last window, hash of the gram."""
    w, n = length - gram + 1, len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none.astype(np.uint64)
    p = prefix_hash(data, BASES[0])
    inverse = powers(pow(BASES[0], -1, 1 << 64), n + 1)
    grams = _mix((p[gram:] - p[:-gram]) * inverse[: n - gram + 1])
    m = len(grams)
    packed = (grams & ~_PLACE) | np.arange(m, dtype=np.uint64)
    padded = np.full(-(-m // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = packed
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - w + 1], ahead[w - 1 : m])
    anchor = (least & _PLACE).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    sizes = np.maximum(0, ends - begins - length + 1)  # windows of each text
    cuts = np.concatenate([np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, begins, begins + sizes])
    cuts = np.append(np.unique(cuts[cuts < len(anchor)]), len(anchor))
    text = np.searchsorted(ends, cuts[:-1], side="right")
    inside = np.flatnonzero(cuts[:-1] < begins[text] + sizes[text])  # a run lies within one text's windows or outside all
    first, last = cuts[inside], cuts[inside + 1] - 1
    return first, last, grams[anchor[first]]


def digests(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """(runs, 2): 128 bits of a cryptographic digest of each run's bytes, as two integers."""
    view, make = memoryview(data.tobytes()), hashlib.blake2b
    held = b"".join([make(view[a : z + length], digest_size=16).digest() for a, z in zip(first.tolist(), last.tolist(), strict=True)])
    return np.frombuffer(held, "<i8").reshape(-1, 2)


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """Texts in groups of about PIECE bytes: their numbers, their offsets in the text, the bytes, the ends."""
    who, offset, parts, held = [], [], [], 0

    def group():
        return who, offset, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(x) for x in parts])

    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            piece = t[at : at + PIECE + length - 1]
            if held and held + len(piece) > 2 * PIECE:
                yield group()
                who, offset, parts, held = [], [], [], 0
            who.append(i)
            offset.append(at)
            parts.append(piece)
            held += len(piece)
    if parts:
        yield group()


def _runs(batches: Iterator[pa.RecordBatch], length: int, gram: int, slim: bool) -> Iterator[pa.RecordBatch]:
    """Rows (tie, text) to runs: (gram, x) for counting, or (gram, body, more, tie, place), place being first * 256 + last - first.

    Of equal texts in a task only the first gives its runs; others would give the same rows.
    """
    seen: set[int] = set()
    for batch in slices(batches, 1, PIECE):
        new = [t not in seen and not seen.add(t) for t in batch.column(0).to_pylist()]
        batch = batch.filter(pa.array(new, pa.bool_()))
        ties = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        texts = [b"" if x is None else x for x in batch.column(1).to_pylist()]
        for who, offset, data, ends in _pieces(texts, length):
            first, last, name = anchor_runs(data, ends, length, gram)
            at = np.searchsorted(ends, first, side="right")
            tie = ties[np.array(who)[at]] if len(at) else np.zeros(0, np.uint64)
            begin = np.concatenate([[0], ends[:-1]])
            place = (first - begin[at] + np.array(offset, dtype=np.int64)[at]) * 256 + (last - first)
            if slim:
                x = _mix(tie + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(BASES[1]))
                columns, names = [name.view(np.int64), x.view(np.int64)], ["gram", "x"]
            else:
                body = digests(data, first, last, length)
                columns, names = [name.view(np.int64), body[:, 0], body[:, 1], tie.view(np.int64), place], ["gram", "body", "more", "tie", "place"]
            for lo in range(0, len(first), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 100_000]) for c in columns], names=names)


class Suffixes:
    """Sorts places of a text as suffixes of at most ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int, base: int):
        self.data, self.length, self.p, self.pw = data, length, prefix_hash(data, base), powers(base, len(data) + 1)

    def shared(self, places: np.ndarray) -> np.ndarray:
        """Whether the hash of the ``length`` bytes from each place is that of another place too; equal bytes have equal hashes."""
        h = (self.p[places + self.length] - self.p[places]) * self.pw[len(self.data) - places]
        order = np.argsort(h)
        same = h[order[1:]] == h[order[:-1]]
        out = np.zeros(len(places), bool)
        out[order[1:][same]] = out[order[:-1][same]] = True
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, by binary search on prefix hashes."""
        p, pw, length = self.p, self.pw, self.length
        whole = (p[a + length] - p[a]) * pw[b] == (p[b + length] - p[b]) * pw[a]
        out = np.full(len(a), length, np.int64)
        rest = np.flatnonzero(~whole)
        a, b = a[rest], b[rest]
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), length - 1, np.int64)
        from_a, from_b, wa, wb = p[a], p[b], pw[a], pw[b]
        for _ in range(int(length - 1).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = (p[a + mid] - from_a) * wb == (p[b + mid] - from_b) * wa
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        out[rest] = lo
        return out

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        n = self.common(a, b)
        over = n >= self.length
        n = np.minimum(n, self.length - 1)
        return np.where(over, or_equal, self.data[a + n] < self.data[b + n])

    def sort(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in suffix order, and whether each shares its first eight bytes with the one before.

        Places are dealt out by their first eight bytes; what ties is mergesorted, runs of one, two, four ... in all
        tied stretches at once, an element's new place being its own plus its rank in the neighbouring run.
        """
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (len(self.data), 8), (1, 1))[places]).view(">u8").ravel().astype(np.uint64)
        order = np.argsort(eight, kind="stable")
        places, eight = places[order].copy(), eight[order]
        tied = np.concatenate([[False], eight[1:] == eight[:-1]]) if len(eight) else np.zeros(0, bool)
        heads = np.flatnonzero(~tied)
        sizes = np.diff(np.append(heads, len(places)))
        keep = sizes > 1
        heads, sizes = heads[keep], sizes[keep]
        run = 1
        while len(heads):
            at = np.repeat(heads, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
            local, head, size = at - np.repeat(heads, sizes), np.repeat(heads, sizes), np.repeat(sizes, sizes)
            block = local // (2 * run) * (2 * run)
            left = local - block < run
            other = head + block + np.where(left, run, 0)  # where the neighbouring run begins
            count = np.clip(np.where(left, size - block - run, run), 0, run)
            lo, hi = np.zeros(len(at), np.int64), count.copy()
            while len(open_ := np.flatnonzero(lo < hi)):
                mid = (lo[open_] + hi[open_]) >> 1
                mine, theirs = places[at[open_]], places[other[open_] + mid]
                before = np.where(left[open_], self.less(theirs, mine, False), self.less(theirs, mine, True))
                lo[open_], hi[open_] = np.where(before, mid + 1, lo[open_]), np.where(before, hi[open_], mid)
            own = np.where(left, local - block, local - block - run)
            moved = np.empty_like(places)
            moved[head + block + own + lo] = places[at]
            target = np.sort(head + block + own + lo)
            places[target] = moved[target]
            run *= 2
            keep = sizes > run
            heads, sizes = heads[keep], sizes[keep]
        return places, tied


def repeated_windows(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The places whose ``length`` bytes also stand at another of the places; sorted, certain."""
    rows = np.lib.stride_tricks.as_strided(data, (max(0, len(data) - length + 1), length), (1, 1))
    for base in BASES:
        s = Suffixes(data, length, base)
        order, tied = s.sort(places[s.shared(places)])
        pairs = np.flatnonzero(tied)
        equal = pairs[s.common(order[pairs - 1], order[pairs]) >= length]
        sure = True
        for lo in range(0, len(equal), 50_000):
            i = equal[lo : lo + 50_000]
            sure = sure and bool((rows[order[i - 1]] == rows[order[i]]).all())
        if sure:
            return np.unique(np.concatenate([order[equal - 1], order[equal]]))
    raise ValueError("every hash base collides on this input")


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, 2, PIECE):
        packed = [pack.compress(x or b"") for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "tie", "packed"])


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(packed, runs) to (gram, body, more, many, bytes of the run)."""
    unpack = zstandard.ZstdDecompressor()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    for batch in batches:
        for packed, runs in zip(batch.column(0), batch.column(1), strict=True):
            t = unpack.decompress(packed.as_py())
            rows = [(r["gram"], r["body"], r["more"], r["many"], t[(a := r["place"] >> 8) : a + (r["place"] & 255) + length]) for r in runs.as_py()]
            for lo in range(0, len(rows), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo : lo + 5000], strict=True), kinds, strict=True)], names=["gram", "body", "more", "many", "bytes"])


def _sorted_repeats(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram, (gram, body, more, bytes): the first and last repeated window of each run that has one."""
    names: list[tuple[int, int, int]] = []
    parts: list[bytes] = []

    def settled() -> pa.RecordBatch:
        sizes = np.array([len(x) for x in parts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        places = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begin, windows)
        found = repeated_windows(np.frombuffer(b"".join(parts), np.uint8), places, length)
        who = np.searchsorted(begin, found, side="right") - 1
        runs, at = np.unique(who, return_index=True)
        till = np.append(at[1:], len(who)) - 1
        named = np.array(names, np.int64).reshape(-1, 3)[runs]
        out = [*named.T, found[at] - begin[runs], found[till] - begin[runs]] if len(runs) else [np.zeros(0, np.int64)] * 5
        names.clear()
        parts.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["gram", "body", "more", "a", "z"])

    for batch in batches:
        for *name, x in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if len(names) >= 4000 and name[0] != names[-1][0]:
                yield settled()
            names.append(tuple(name))
            parts.append(x)
    if names:
        yield settled()


def _counted_windows(batches: Iterator[pa.RecordBatch], length: int, bases: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for g, b, m, x in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            data = np.frombuffer(x, np.uint8)
            at = np.arange(len(data) - length + 1)
            h = [_mix(hashes(prefix_hash(data, base), at, length, base)).view(np.int64) for base in bases]
            n = len(at)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(n, g), np.full(n, b), np.full(n, m), at, *h)], names=["gram", "body", "more", "at", "h", "k"])


def _edges_by_count(contexts: DataFrame, length: int) -> DataFrame:
    """First and last repeated window of runs (gram, body, more, bytes) that no single task can hold.

    Windows are counted by two hashes. A run's first and last window that occurs more than once is then compared, byte
    by byte, with the least window of the same hashes (that one with the greatest); if any differs, other bases are used.
    """
    key = ["gram", "body", "more"]
    at = F.struct(*key, "at")
    window = lambda place: F.substring(F.col("bytes"), F.col(place) + 1, F.lit(length))
    for bases in zip(BASES, BASES[1:] + BASES[:1], strict=True):
        windows = contexts.mapInArrow(lambda it, b=bases: _counted_windows(it, length, b), "gram long, body long, more long, at long, h long, k long")
        twice = cut(windows.groupBy("h", "k").agg(F.min(at).alias("s0"), F.max(at).alias("s1")).filter("s0 <> s1"))
        ends = windows.join(twice.select("h", "k"), ["h", "k"]).groupBy(*key).agg(F.min(F.struct("at", "h", "k")).alias("first"), F.max(F.struct("at", "h", "k")).alias("last"))
        ends = cut(ends)
        asked = ends.select(*key, F.explode(F.array("first", "last")).alias("w")).select(*key, "w.*")
        shown = cut(asked.join(contexts, key).select(*key, "at", "h", "k", window("at").alias("bytes")))
        sides = [twice.select("h", "k", f"{s}.*").join(contexts, key).select("h", "k", F.struct(*key, "at").alias(f"is{s}"), window("at").alias(f"by{s}")) for s in ("s0", "s1")]
        known = sides[0].join(sides[1], ["h", "k"]).join(asked.select("h", "k").distinct(), ["h", "k"], "left_semi")
        partner = F.when(at == F.col("iss0"), F.col("bys1")).otherwise(F.col("bys0"))
        wrong = shown.join(known, ["h", "k"]).filter(F.col("bytes") != partner).limit(1).count()
        if not wrong:
            return ends.select(*key, F.col("first.at").alias("a"), F.col("last.at").alias("z"))
    raise ValueError("every pair of hash bases collides on this input")


def _outcome(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, tie, packed, spans in zip(*[batch.column(i) for i in range(4)], strict=True):
            t, kept, at, merged = unpack.decompress(packed.as_py()), [], 0, []
            for s in sorted((s["a"], s["z"]) for s in spans.as_py()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            for a, z in merged:
                kept.append(t[at:a])
                at = z
            rest = b"".join([*kept, t[at:]])
            rows.append((doc.as_py(), tie.as_py(), len(t) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), [x for m in merged for x in m]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "tie", "n_removed", "n_spans", "kept_sha256", "spans"])


@tidy
def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``spans`` holds begin and end of each removed stretch in turn (null: nothing, or, if the whole text is repeated,
    all of it). A null text is empty. Equal texts of at least ``length`` bytes lose all their bytes, whichever ids they
    have; shorter texts lose nothing. Other columns are not looked at.
    """
    spark = docs.sparkSession
    workers_can_import(spark)
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text")).select("doc_id", "tie", F.col("text").cast("binary").alias("raw"))
    slim, texts = _identified(own)
    while clashes := [r[0] for r in texts.filter("sha0 <> sha1").select("tie").collect()]:  # n ** 2 / 2 ** 65 of n texts on average
        own = own.withColumn("tie", F.when(F.col("tie").isin(clashes), F.xxhash64(F.sha2("raw", 256))).otherwise(F.col("tie")))
        slim, texts = _identified(own)
    key = ["gram", "body", "more"]
    long_ = own.filter(F.octet_length("raw") >= length).select("tie", "raw")
    counted = long_.mapInArrow(lambda it: _runs(it, length, gram, True), "gram long, x long")
    shared = cut(counted.groupBy("gram").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.count(F.lit(1)).alias("n")).filter("x0 <> x1").select("gram", "n"))
    every = shared.agg(F.sum("n")).first()[0] or 0
    hot = F.col("gram").isin([r[0] for r in shared.filter(F.col("n") > every / HOT).select("gram").collect()])  # fewer than HOT
    dealt = lambda df, by: df.withColumn("salt", F.when(hot, F.pmod(by, F.lit(SALTS))).otherwise(0).cast("int"))
    spread = lambda df: df.withColumn("salt", F.explode(F.when(hot, F.lit(list(range(SALTS)))).otherwise(F.lit([0]))))
    runs = long_.mapInArrow(lambda it: _runs(it, length, gram, False), "gram long, body long, more long, tie long, place long")
    members = cut(dealt(runs, F.xxhash64("tie", "place")).join(spread(shared.select("gram")), ["gram", "salt"]).groupBy("gram", "salt", "body", "more", "tie", "place").agg(F.lit(1).alias("one")).drop("one", "salt"))
    classes = cut(members.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("tie", "place")).alias("m")))
    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    open_ = dealt(classes, F.col("body")).join(spread(mixed), ["gram", "salt"]).select(*key, (F.col("n") > MANY).alias("many"), F.col("m.tie").alias("tie"), F.col("m.place").alias("place"))
    asked = open_.groupBy("tie").agg(F.collect_list(F.struct(*key, "many", "place")).alias("runs"))
    asked = cut(asked.join(texts, "tie").select("tie", "rep", "runs"))  # a list holds runs of one text
    packed = own.mapInArrow(_compressed, "doc_id long, tie long, packed binary")
    here = packed.join(asked.select(F.col("tie").alias("atie"), "rep", "runs"), (F.col("tie") == F.col("atie")) & (F.coalesce("doc_id", F.lit(0)) == F.coalesce("rep", F.lit(0))))
    contexts = cut(here.select("packed", "runs").mapInArrow(lambda it: _contexts(it, length), "gram long, body long, more long, many boolean, bytes binary"))
    few = contexts.filter("not many").select(*key, "bytes").repartition("gram").sortWithinPartitions(*key)
    edges = few.mapInArrow(lambda it: _sorted_repeats(it, length), "gram long, body long, more long, a long, z long")
    many = contexts.filter("many").select(*key, "bytes")
    if many.limit(1).count():
        edges = edges.unionByName(_edges_by_count(many, length))
    whole = classes.filter("c > 1").select(*key, F.lit(True).alias("all"))
    edges = edges.groupBy(*key).agg(F.min("a").alias("a"), F.max("z").alias("z"))
    known = cut(edges.join(whole, key, "full_outer").select(*key, "a", "z", "all"))
    single = texts.filter("copies = 1").select("tie", "rep")
    marks = members.join(known, key)
    first = F.shiftright("place", 8)
    begin = first + F.when(F.col("all"), 0).otherwise(F.col("a"))
    end = first + F.when(F.col("all"), F.col("place").bitwiseAND(255)).otherwise(F.col("z")) + length
    spans = marks.select("tie", begin.alias("a"), end.alias("z")).groupBy("tie").agg(F.collect_set(F.struct("a", "z")).alias("spans"))
    affected = cut(spans.join(single, "tie").select(F.col("tie").alias("atie"), F.col("rep").alias("rep"), "spans"))
    there = packed.join(affected, (F.col("tie") == F.col("atie")) & (F.coalesce("doc_id", F.lit(0)) == F.coalesce("rep", F.lit(0))))
    done = cut(there.select("doc_id", "tie", "packed", "spans").mapInArrow(_outcome, "doc_id long, tie long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"))
    done = done.select(F.col("doc_id").alias("did"), F.col("tie").alias("dtie"), "n_removed", "n_spans", "kept_sha256", "spans")
    copied = texts.filter("copies > 1").select("tie", F.lit(True).alias("copied"))
    rows = slim.join(copied, "tie", "left").join(done, (F.col("tie") == F.col("dtie")) & (F.coalesce("doc_id", F.lit(0)) == F.coalesce("did", F.lit(0))), "left")
    all_gone = F.coalesce("copied", F.lit(False)) & (F.col("n") >= length)
    pick = lambda gone, some, none: F.when(all_gone, gone).otherwise(F.coalesce(some, none))
    return rows.select("doc_id", F.col("n").alias("n_bytes"), pick(F.col("n"), F.col("n_removed"), F.lit(0)).alias("n_removed"), pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"), pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"), F.when(~all_gone, F.col("spans")).alias("spans"))


def _identified(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Slim rows (doc_id, tie, n, sha), and per tie its copies, one of its ids, and the least and greatest sha."""
    slim = cut(own.select("doc_id", "tie", F.octet_length("raw").cast("long").alias("n"), F.sha2("raw", 256).alias("sha")))
    return slim, cut(slim.groupBy("tie").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.min("sha").alias("sha0"), F.max("sha").alias("sha1")))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def brute(docs: list[tuple], length: int = LENGTH) -> list[tuple]:
    """What op5 returns, from a table of all windows; for tests."""
    seen: dict[bytes, int] = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for _, t in raw:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for d, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
