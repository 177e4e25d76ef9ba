"""Benchmark decontamination with a positional inverted index.

The index is partitioned by documents: each segment holds, for every term of its documents, the sorted list of its
positions. Positions run through a segment with a gap after each document, so a phrase never crosses one. Test
phrases are looked up by intersecting the offset-adjusted lists of their terms, the rarest first, all phrases of a block
at once; terms near each other are found from the rarest in the same way. Any task can hold any segment, so neither a
frequent term nor a frequent passage meets in one task. The benchmark is read in blocks of bounded size; the text of one
block is what tasks are sent, and they make its windows, as flat arrays, themselves.

Words of up to 7 bytes are their own keys; longer ones have two independent hashes of 63 and 64 bits, in which every byte
moves every bit, and a term is the pair of both: words that share the first are told apart by the second.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, own_cache, slices, table, tidy, workers_can_import

WINDOW = 8
SEGMENT_BYTES = 4 << 20  # text bytes of a segment
BLOCK_BYTES = 4 << 20  # text bytes of a benchmark block (a longer item is a block of its own): the bound of what is sent to every task
AT_ONCE = 1 << 20  # candidate places, and words of windows, that a task looks up at once
INDEX = "segment long, n_docs long, content binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a word: digits, letters, and all bytes of characters beyond ASCII.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)
_TOP = np.uint64(1 << 63)


def _stirred(x: np.ndarray, by: np.uint64, then: np.uint64) -> np.ndarray:
    """A bijection of 64 bits in which each bit moves all."""
    x = (x ^ x >> np.uint64(32)) * by
    x = (x ^ x >> np.uint64(29)) * then
    return x ^ x >> np.uint64(32)


def word_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the words in lower-cased UTF-8 bytes (any other byte separates) and their two keys."""
    low = _LOWER[data]
    inside = _IN_WORD[low]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = ends - starts
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    chunks = np.lib.stride_tricks.as_strided(padded, shape=(len(low) + 1, 8), strides=(1, 1))

    def chunk(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        eight = np.ascontiguousarray(chunks[at]).view("<u8").ravel()
        return eight & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - np.minimum(size, 8)) * 8).astype(np.uint64))

    first = chunk(starts, sizes)
    second = (first ^ sizes.astype(np.uint64)) * _M2
    key = first | sizes.astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(sizes > 7)
    h1, h2 = _stirred(first[long] + sizes[long].astype(np.uint64) * _M2, _M1, _M3), _stirred(second[long], _M3, _M2)
    at = np.arange(len(long))
    j = 8
    while len(at := at[sizes[long[at]] > j]):
        c = chunk(starts[long[at]] + j, sizes[long[at]] - j)
        h1[at] = _stirred(h1[at] ^ c, _M1, _M3)
        h2[at] = _stirred(h2[at] + c, _M3, _M2)
        j += 8
    key[long] = h1 | _TOP
    second[long] = h2
    return starts, key, second


def _by_term(key: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words by their pairs of keys, equal ones as they come, and where in it each term begins."""
    order = np.argsort(key, kind="stable")
    k, s = key[order], second[order]
    if ((k[1:] == k[:-1]) & (s[1:] != s[:-1])).any():  # words that share the first key
        order = np.lexsort((second, key))
        k, s = key[order], second[order]
    new = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    return order, np.flatnonzero(np.concatenate([[True], new])) if len(key) else np.zeros(0, np.int64)


def keyed_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts in order: their two keys, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts, key, second = word_keys(data)
    edges = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    return key, second, np.diff(np.searchsorted(starts, edges), prepend=0)


def _stretches(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts a row of sizes into stretches of about ``most`` in all; a larger single one is a stretch of its own."""
    upto, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


class Segment:
    """Postings of some documents."""

    def __init__(self, docs: np.ndarray, null: np.ndarray, counts: np.ndarray, terms: np.ndarray, seconds: np.ndarray, offsets: np.ndarray, places: np.ndarray):
        self.docs, self.null, self.counts, self.terms, self.seconds, self.offsets, self.places = docs, null, counts, terms, seconds, offsets, places
        self.first = np.concatenate([[0], np.cumsum(counts + 1)[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
        self._listed: np.ndarray | None = None

    @classmethod
    def build(cls, docs: list[int | None], texts: list[bytes]) -> Segment:
        key, second, counts = keyed_texts(texts)
        places = np.arange(len(key), dtype=np.int64) + np.repeat(np.arange(len(counts)), counts)
        order, new = _by_term(key, second)
        null = np.array([d is None for d in docs], dtype=bool)
        numbers = np.array([0 if d is None else d for d in docs], dtype=np.int64)
        return cls(numbers, null, counts, key[order[new]], second[order[new]], np.append(new, len(key)), places[order].astype(np.uint32))

    def tobytes(self) -> bytes:
        """Lists as differences, by bytes of equal weight, compressed."""
        gaps = np.diff(self.places.astype(np.int64), prepend=0)
        gaps[self.offsets[:-1]] = self.places[self.offsets[:-1]]
        by_byte = gaps.astype("<u4").view(np.uint8).reshape(-1, 4).T
        arrays = [self.docs.astype("<i8"), self.null.astype(np.uint8), self.counts.astype("<i8"), self.terms.astype("<u8"), self.seconds.astype("<u8"), np.diff(self.offsets).astype("<u4"), np.ascontiguousarray(by_byte)]
        parts = [zstandard.ZstdCompressor(level=1).compress(a.tobytes()) for a in arrays]
        return struct.pack("<7Q", *map(len, parts)) + b"".join(parts)

    @classmethod
    def frombytes(cls, content: bytes) -> Segment:
        parts, at = [], 56
        for n in struct.unpack("<7Q", content[:56]):
            parts.append(zstandard.ZstdDecompressor().decompress(content[at : at + n]))
            at += n
        docs, null, counts = np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8).astype(bool), np.frombuffer(parts[2], "<i8")
        terms, seconds, sizes = np.frombuffer(parts[3], "<u8"), np.frombuffer(parts[4], "<u8"), np.frombuffer(parts[5], "<u4")
        gaps = np.ascontiguousarray(np.frombuffer(parts[6], np.uint8).reshape(4, -1).T).view("<u4").ravel()
        offsets = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        run = np.cumsum(gaps.astype(np.int64))
        base = run[offsets[:-1]] - gaps[offsets[:-1]] if len(sizes) else run
        return cls(docs, null, counts, terms, seconds, offsets, (run - np.repeat(base, sizes)).astype(np.uint32))

    def term(self, key: int, second: int) -> int:
        """Place of a term in the dictionary, or -1."""
        return int(self.terms_of(np.array([key], np.uint64), np.array([second], np.uint64))[0])

    def terms_of(self, keys: np.ndarray, seconds: np.ndarray) -> np.ndarray:
        at, out, open_ = np.searchsorted(self.terms, keys), np.full(len(keys), -1), np.arange(len(keys))
        while len(open_ := open_[at[open_] < len(self.terms)]):
            open_ = open_[self.terms[at[open_]] == keys[open_]]
            same = self.seconds[at[open_]] == seconds[open_]
            out[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1  # the next term of the same first key
        return out

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.offsets[term] : self.offsets[term + 1]]

    @property
    def listed(self) -> np.ndarray:
        """All postings as one sorted array of term and position, in which any list is looked up."""
        if self._listed is None:
            terms = np.repeat(np.arange(len(self.terms), dtype=np.uint64), np.diff(self.offsets))
            self._listed = terms << np.uint64(32) | self.places.astype(np.uint64)
        return self._listed

    def holds(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each place (-1 and below: none) is in its term's list."""
        if not len(self.listed):
            return np.zeros(len(places), bool)
        asked = terms.astype(np.uint64) << np.uint64(32) | np.maximum(places, 0).astype(np.uint64)
        at = np.minimum(np.searchsorted(self.listed, asked), len(self.listed) - 1)
        return (self.listed[at] == asked) & (places >= 0)

    def phrases(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of all occurrences of phrases: rows of places in the dictionary, filled up with -1.

        The rarest term's list gives the candidates; the other lists, shifted by the offset of their term, cut them down.
        """
        sizes = np.append(np.diff(self.offsets), np.iinfo(np.int64).max)[terms]  # nothing is rarer than what is not there
        order = np.argsort(sizes, axis=1, kind="stable")
        rows = np.arange(len(terms))
        least = sizes[rows, order[:, 0]]
        who, start = [], []
        for lo, hi in _stretches(least, AT_ONCE):
            part = rows[lo:hi]
            n = least[part]
            w = np.repeat(part, n)
            head = terms[part, order[part, 0]]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.offsets[head], n)
            s = self.places[at].astype(np.int64) - order[w, 0]
            for j in range(1, terms.shape[1]):
                t = terms[w, order[w, j]]
                keep = (t < 0) | self.holds(np.maximum(t, 0), s + order[w, j])
                w, s = w[keep], s[keep]
            keep = s >= 0
            who.append(w[keep])
            start.append(s[keep])
        return (np.concatenate(who), np.concatenate(start)) if who else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def within(self, terms: np.ndarray, reach: int) -> np.ndarray:
        """Places of any of the distinct terms from which on ``reach`` words hold all of them, in one document."""
        lists = sorted((self.postings(t).astype(np.int64) for t in terms.tolist()), key=len)
        rare, found = lists[0], []
        for own in lists:  # a place that lies at most reach - 1 before one of the rarest term
            next_ = np.searchsorted(rare, own)
            near = rare[np.minimum(next_, len(rare) - 1)] if len(rare) else own
            found.append(own[(next_ < len(rare)) & (near - own < reach)])
        s = np.unique(np.concatenate(found))
        doc = self.doc_of(s)
        end = np.minimum(s + reach, self.first[doc] + self.counts[doc])
        for own in lists:
            has = np.searchsorted(own, end, side="left") > np.searchsorted(own, s, side="left")
            s, end = s[has], end[has]
        return s

    def near(self, a: int, b: int, within: int) -> np.ndarray:
        """Positions of term ``a`` that have term ``b`` at most ``within`` words away in the same document."""
        x, y = self.postings(a).astype(np.int64), self.postings(b).astype(np.int64)
        doc = self.doc_of(x)
        lo, hi = np.maximum(x - within, self.first[doc]), np.minimum(x + within, self.first[doc] + self.counts[doc] - 1)
        count = np.searchsorted(y, hi, side="right") - np.searchsorted(y, lo, side="left")
        return x[count - ((a == b) & (lo <= x)) > 0]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


def _index(batches: Iterator[pa.RecordBatch], segment_bytes: int) -> Iterator[pa.RecordBatch]:
    docs: list = []
    texts: list[bytes] = []
    held = 0

    def closed() -> pa.RecordBatch:
        content = Segment.build(docs, texts).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([len(docs)], pa.int64()), pa.array([content], pa.binary())], names=["segment", "n_docs", "content"])

    for batch in slices(batches, 1, segment_bytes):
        docs += batch.column(0).to_pylist()
        texts += [b"" if x is None else x for x in batch.column(1).to_pylist()]
        held += batch.column(1).nbytes
        if held >= segment_bytes:
            yield closed()
            docs, texts, held = [], [], 0
    if docs:
        yield closed()


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Segments of ``docs`` (doc_id, text), stored in the shared folder; nothing is shuffled."""
    workers_can_import(docs.sparkSession)
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    index = raw.mapInArrow(lambda it: _index(it, segment_bytes), INDEX).withColumn("segment", F.monotonically_increasing_id())
    return cut(index, "uncompressed")


class TestWindows:
    """The distinct windows of some items, as places in the one array of all their words, and the items that have them.

    ``start`` and ``size`` are those of one occurrence; the items of window w are ``name[held[w] : held[w + 1]]``, numbers in ``names``.
    """

    def __init__(self, items: list, texts: list[bytes], window: int = WINDOW):
        key, second, counts = keyed_texts(texts)
        self.names, name = np.unique(np.array([str(i) for i in items], dtype=object), return_inverse=True) if items else (np.zeros(0, object), np.zeros(0, int))
        known = np.array([i is not None for i in items], dtype=bool)
        n = np.where(known & (counts > 0), np.maximum(1, counts - window + 1), 0)
        owner = np.repeat(np.arange(len(n)), n)
        start = (np.cumsum(counts) - counts)[owner] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        size, self.window = np.minimum(counts[owner], window), window
        order, new = _by_term(key, second)
        self.terms, self.second_of, self.back = key[order[new]], second[order[new]], np.zeros(len(key), np.int64)
        self.back[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(key))))
        which = self._alike(start, size)
        _, one = np.unique(which, return_index=True)
        self.start, self.size = start[one], size[one]
        pairs = np.unique(which * max(1, len(self.names)) + name[owner])  # a window and an item, once
        self.name = pairs % max(1, len(self.names))
        self.held = np.searchsorted(pairs // max(1, len(self.names)), np.arange(len(one) + 1))

    def _alike(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the windows, from 0, the same for the same words: two stretches of 2 ** j words, ranked, make a window."""
        ranks, span, out, upto = self.back, 1, np.zeros(len(start), np.int64), 0
        while span <= self.window:
            for n in np.unique(size[(size >= span) & (size < 2 * span)]).tolist():
                at = np.flatnonzero(size == n)
                _, own = np.unique(ranks[start[at]] * len(self.back) + ranks[start[at] + n - span], return_inverse=True)
                out[at] = own + upto
                upto += own.max() + 1
            ranks = np.unique(ranks[:-span] * len(self.back) + ranks[span:], return_inverse=True)[1] if len(ranks) > span else ranks[:0]
            span *= 2
        return out

    def hits(self, segment: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows found in the segment: their numbers, the documents and the words at which they begin.

        Distinct windows of one size begin at a word but once, so there are ``window`` times as many as words at most.
        """
        where = np.append(segment.terms_of(self.terms, self.second_of)[self.back], -1)
        missing = np.concatenate([[0], np.cumsum(where[:-1] < 0)])
        alive = np.flatnonzero(missing[self.start + self.size] == missing[self.start])
        out = []
        for lo in range(0, len(alive), AT_ONCE // self.window):
            w = alive[lo : lo + AT_ONCE // self.window]
            places = self.start[w][:, None] + np.arange(self.window)
            inside = np.arange(self.window) < self.size[w][:, None]
            phrase, at = segment.phrases(where[np.where(inside, places, -1)])
            doc = segment.doc_of(at)
            out.append((w[phrase], doc, at - segment.first[doc]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


FOUND = "segment long, ordinal long, doc_id long, n_words long, spans array<struct<a: long, z: long>>, items array<string>"
_blocks: dict[str, TestWindows] = {}


def _windows(name: str, sent, window: int) -> TestWindows:
    """The windows of the block that was sent under a name, made once in a worker."""
    own_cache("decontaminate", _blocks.clear)
    if name not in _blocks:
        _blocks.clear()
        _blocks[name] = TestWindows(*sent.value, window)
    return _blocks[name]


def _search(batches: Iterator[pa.RecordBatch], block: TestWindows, every: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())])), pa.list_(pa.string())]
    for batch in batches:
        for number, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            segment = Segment.frombytes(content)
            w, doc, a = block.hits(segment)
            spans, items = _united(doc, a, a + block.size[w]), _named(doc, w, block)
            rows = range(len(segment.docs)) if every else sorted(spans)
            if not rows:
                continue
            columns = [[number] * len(rows), list(rows), [None if segment.null[i] else int(segment.docs[i]) for i in rows], [int(segment.counts[i]) for i in rows]]
            columns += [[spans.get(i, []) for i in rows], [items.get(i, []) for i in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["segment", "ordinal", "doc_id", "n_words", "spans", "items"])


def _united(doc: np.ndarray, a: np.ndarray, z: np.ndarray) -> dict[int, list[dict[str, int]]]:
    """Stretches of words of each document that the intervals cover."""
    out: dict[int, list[dict[str, int]]] = {}
    if not len(doc):
        return out
    order = np.lexsort((a, doc))
    doc, a, z = doc[order], a[order], z[order]
    far = doc * (z.max() + 2)  # documents one after the other, with a gap
    upto = np.maximum.accumulate(z + far)
    begins = np.flatnonzero(np.concatenate([[True], (a + far)[1:] > upto[:-1]]))
    ends = np.append(begins[1:], len(doc)) - 1
    for d, x, y in zip(doc[begins].tolist(), a[begins].tolist(), (upto - far)[ends].tolist(), strict=True):
        out.setdefault(d, []).append({"a": x, "z": y})
    return out


def _named(doc: np.ndarray, w: np.ndarray, block: TestWindows) -> dict[int, list[str]]:
    """Names of the items whose windows were found in each document, in order."""
    out: dict[int, list[str]] = {}
    order = np.argsort(doc, kind="stable")
    docs, begins = np.unique(doc[order], return_index=True)
    for d, found in zip(docs.tolist(), np.split(w[order], begins[1:]), strict=len(docs) > 0):
        found = np.unique(found)
        n = block.held[found + 1] - block.held[found]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.held[found], n)
        out[d] = block.names[np.unique(block.name[at])].tolist()
    return out


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """The benchmark (item_id, text), block by block: ids and texts; only one is on the driver at a time."""
    items: list = []
    texts: list[bytes] = []
    held = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = (row[1] or "").encode()
        if items and held + len(text) > block_bytes:
            yield items, texts
            items, texts, held = [], [], 0
        items.append(row[0])
        texts.append(text)
        held += len(text) + 16
    yield items, texts


@tidy
def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_items: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (sorted as strings), spans (hit words), contaminated.

    A word is hit if it is in any occurrence of a window of an item. Null and empty texts have no words; an item
    without words, or with a null item_id, has no windows. Rows that share a doc_id stay apart, equal rows get equal
    results, and an empty table gives an empty one. A text of any length is one document of one segment. Other columns
    of either table are not looked at.
    """
    index = build_index(docs)
    found = None
    for k, block in enumerate(blocks_of(benchmark)):
        sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex
        part = index.select("segment", "content").mapInArrow(lambda it, n=name, b=sent, every=k == 0: _search(it, _windows(n, b, window), every), FOUND)
        part = cut(part)
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    drop(index)
    if k:
        found = found.groupBy("segment", "ordinal").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    length = F.aggregate("spans", zero, lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["z"] - F.greatest(s["upto"], x["a"]))).cast("long").alias("n"), F.greatest(s["upto"], x["z"]).alias("upto")))["n"]
    return found.select("doc_id", "n_words", length.alias("n_hit"), "items", "spans", (F.size("items") >= least_items).alias("contaminated"))


NEAR = "doc_id long, item_id string, n_words long, places array<long>"


def _near(batches: Iterator[pa.RecordBatch], items: list, texts: list[bytes], reach: int) -> Iterator[pa.RecordBatch]:
    key, second, counts = keyed_texts(texts)
    ends = np.cumsum(counts)
    for batch in batches:
        for content in batch.column(0).to_pylist():
            segment = Segment.frombytes(content)
            terms = segment.terms_of(key, second)
            rows: list[list] = [[], [], [], []]
            for item, a, z in zip(items, (ends - counts).tolist(), ends.tolist(), strict=True):
                own = np.unique(terms[a:z])
                if item is None or a == z or own[0] < 0:
                    continue
                places = segment.within(own, reach)
                doc = segment.doc_of(places)
                begins = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else []
                for lo, hi in zip(begins, [*begins[1:], len(doc)], strict=True):
                    d = int(doc[lo])
                    for column, x in zip(rows, (None if segment.null[d] else int(segment.docs[d]), str(item), int(segment.counts[d]), (places[lo:hi] - segment.first[d]).tolist()), strict=True):
                        column.append(x)
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["doc_id", "item_id", "n_words", "places"])


@tidy
def find_near(docs: DataFrame, queries: DataFrame, reach: int = 20) -> DataFrame:
    """Proximity matches: doc_id, item_id, n_words, places for each document and query (item_id, text) that meet.

    ``places`` are the numbers of those words of the document that are words of the query and from which on ``reach``
    words hold all distinct words of the query, in any order. Queries without words or with a null id match nothing;
    null texts have no words. The index is searched once a block of queries.
    """
    index = build_index(docs)
    found = None
    for items, texts in blocks_of(queries):
        sent = docs.sparkSession.sparkContext.broadcast((items, texts))
        part = cut(index.select("content").mapInArrow(lambda it, b=sent: _near(it, *b.value, reach), NEAR))
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    drop(index)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` whose own text is not contaminated (by its 64-bit hash, whatever the doc_id); all columns stay."""
    own = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = cut(find_benchmark(own, benchmark, **kw).filter("contaminated").select(F.col("doc_id").alias("_bad")).distinct())
    return docs.join(bad, F.xxhash64(docs["text"]) == bad["_bad"], "left_anti")


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


def brute(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """What op3 returns, by comparing every window with every place; for tests."""
    import re

    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = [(str(i), tuple(w[j : j + window])) for i, t in items if (w := words(t)) for j in range(max(1, len(w) - window + 1))]
    out = []
    for d, t in docs:
        w = words(t)
        hit, got = set(), set()
        for i, x in windows:
            for a in range(len(w) - len(x) + 1):
                if tuple(w[a : a + len(x)]) == x:
                    hit.update(range(a, a + len(x)))
                    got.add(i)
        out.append((d, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), len(got) >= 2))
    return out


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, k, generate_subscripts(ws, 1) AS p, unnest(ws) AS word, len(ws) AS n
  FROM (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT item_id, ws[j:j + 7] AS win FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 7, 1) + 1)) AS j FROM i WHERE len(ws) > 0)),
s AS (SELECT DISTINCT win, len(win) AS m FROM g),
f AS (SELECT DISTINCT win[1] AS word FROM s),
c AS (
  SELECT w.k, w.p, s.m, s.win FROM w JOIN f USING (word) JOIN s ON s.win[1] = w.word
  JOIN (SELECT k, list(word ORDER BY p) AS ws FROM w GROUP BY k) l ON l.k = w.k AND l.ws[w.p:w.p + s.m - 1] = s.win),
h AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + m)) AS q FROM c) GROUP BY k),
t AS (SELECT c.k, list_sort(list(DISTINCT CAST(g.item_id AS VARCHAR))) AS items FROM c JOIN g USING (win) GROUP BY c.k),
n AS (SELECT k, doc_id, ANY_VALUE(n) AS n_words FROM w GROUP BY k, doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(len(items), 0) >= 2 AS contaminated
FROM (SELECT doc_id, row_number() OVER () AS k FROM documents) d LEFT JOIN n USING (k) LEFT JOIN h USING (k) LEFT JOIN t USING (k)
"""
