"""Token ids as one wavelet matrix per shard, in ascending document order.

A shard file holds, for every bit of the ids, one bit-plane (each plane orders the ids by the bits above it) and the
number of set bits before each block. Planes are compressed in chunks of their own, so a reader gets any token (access),
the occurrences before a place (rank), all occurrences of an id (select) and counts from the one compressed file by
reading its head and the chunks that hold the asked bits, one or two a plane; nothing else is read or unpacked.

Shards are cut by exact running sums of text bytes in document order, so they do not depend on the partitions of a
run. Tasks write plain files under temporary names and rename them; the manifest (JSON lines), which Spark commits after
all tasks, says which files there are.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, file_system, get_file, own_cache, put_file, ranked, reused_memory, scratch, slices, table, tidy, tidying, workers_can_import

MAGIC = b"WVM2"
BLOCK = 512  # bytes of a plane between two stored ranks
CHUNK = 16 << 10  # bytes of a plane that are compressed together
SHARD_BYTES = 2 << 20  # text bytes of a shard
MOST_SHARDS = 1 << 20  # a shard takes the larger of SHARD_BYTES and this share of all bytes; so many bounds (8 bytes each) go to each task
MANIFEST = "shard long, part long, name string, n_docs long, n_tokens long, bytes long"
SIGNS = ".,;:!?%$#&*()+=/@~"  # as the end of a word; no letter, digit, apostrophe or angle bracket
BATCH_BYTES = 4 << 20  # text bytes that are encoded at once
CACHE = 750_000  # encoded words that a worker remembers
ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class Plane:
    """A bit-plane as an array of bytes, or as chunks of a file that are fetched when asked for."""

    def __init__(self, size: int, held: np.ndarray | None = None, chunk=None):
        self.size, self.held, self.chunk = size, held, chunk
        self.known: dict[int, np.ndarray] = {}

    def cut(self, a: int, z: int) -> np.ndarray:
        if self.held is not None:
            return self.held[a:z]
        z = min(z, self.size)
        if a >= z:
            return np.zeros(0, np.uint8)
        parts = []
        for c in range(a // CHUNK, (z - 1) // CHUNK + 1):
            if c not in self.known:
                if len(self.known) >= 64:
                    self.known.clear()
                self.known[c] = self.chunk(c)
            parts.append(self.known[c][max(0, a - c * CHUNK) : z - c * CHUNK])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class WaveletMatrix:
    """Planes and ranks of a sequence of ids below ``2 ** width``."""

    def __init__(self, n: int, width: int, zeros: list[int], planes: list[Plane], ranks: list[np.ndarray], docs: np.ndarray, lengths: np.ndarray):
        self.n, self.width, self.zeros, self.planes, self.ranks, self.docs, self.lengths = n, width, zeros, planes, ranks, docs, lengths

    @classmethod
    def build(cls, ids: np.ndarray, width: int, docs: np.ndarray | None = None, lengths: np.ndarray | None = None) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        level = ids
        for b in range(width - 1, -1, -1):
            bits = (level & level.dtype.type(1 << b)) != 0
            plane = np.packbits(bits)
            low, high = level.take(np.flatnonzero(~bits)), level.take(np.flatnonzero(bits))  # much faster than by mask
            zeros.append(len(low))
            planes.append(Plane(len(plane), plane))
            ranks.append(cls._ranks(plane))
            level = np.concatenate([low, high])
        none = np.zeros(0, dtype=np.int64)
        return cls(len(ids), width, zeros, planes, ranks, none if docs is None else docs, none if lengths is None else lengths)

    @staticmethod
    def _ranks(plane: np.ndarray) -> np.ndarray:
        eight = np.zeros(-(-len(plane) // BLOCK) * BLOCK // 8, dtype=np.uint64)
        eight.view(np.uint8)[: len(plane)] = plane
        per = np.bitwise_count(eight).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint64)
        return np.concatenate([[0], np.cumsum(per)]).astype("<u8")

    def _rank1(self, k: int, i: int) -> int:
        """Set bits of plane k before place i."""
        byte, bit = divmod(i, 8)
        block = byte // BLOCK
        held = self.planes[k].cut(block * BLOCK, byte + (bit > 0))
        count = int(self.ranks[k][block]) + int(ONES[held[: byte - block * BLOCK]].sum())
        return count + (int(ONES[held[byte - block * BLOCK] >> (8 - bit)]) if bit else 0)

    def _select(self, k: int, one: bool, j: int) -> int:
        """Place of the j-th (from 0) set or unset bit of plane k."""
        r = self.ranks[k].astype(np.int64)
        before = r if one else np.minimum(np.arange(len(r), dtype=np.int64) * BLOCK * 8, self.n) - r
        block = int(np.searchsorted(before, j, side="right")) - 1
        bits = np.unpackbits(self.planes[k].cut(block * BLOCK, (block + 1) * BLOCK))
        return block * BLOCK * 8 + int(np.flatnonzero(bits == one)[j - int(before[block])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(self.width):
            bit = int(self.planes[k].cut(i >> 3, (i >> 3) + 1)[0]) >> (7 - (i & 7)) & 1
            ones = self._rank1(k, i)
            i, value = (self.zeros[k] + ones if bit else i - ones), value << 1 | bit
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before place ``i``."""
        lo, hi = self._range(token, 0, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token < 0 or token >> self.width:
            return 0, 0
        for k in range(self.width):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.width - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def select(self, token: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of ``token``."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        i = lo + j
        for k in range(self.width - 1, -1, -1):
            one = token >> (self.width - 1 - k) & 1
            i = self._select(k, bool(one), i - self.zeros[k] if one else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids, in order."""
        values = np.zeros(self.n, dtype=np.uint16 if self.width <= 16 else np.uint32)
        for k in range(self.width - 1, -1, -1):
            bits = np.unpackbits(self.planes[k].cut(0, self.planes[k].size), count=self.n).view(bool)
            upper = np.empty_like(values)
            upper[np.flatnonzero(~bits)] = values[: self.zeros[k]]
            upper[np.flatnonzero(bits)] = values[self.zeros[k] :] | values.dtype.type(1 << (self.width - 1 - k))
            values = upper
        return values

    def tobytes(self) -> bytes:
        """Magic, lengths, head (JSON), tables (ends and checksums of all chunks, ranks, documents), chunks."""
        pack = zstandard.ZstdCompressor(level=1).compress
        chunks = []
        for plane in self.planes:
            held = plane.cut(0, plane.size).tobytes()
            for a in range(0, len(held), CHUNK):
                raw = held[a : a + CHUNK]
                packed = pack(raw)
                chunks.append(packed if len(packed) < len(raw) else raw)
        ends = np.cumsum([len(c) for c in chunks], dtype=np.int64)
        sums = np.array([zlib.crc32(c) for c in chunks], dtype="<u4")
        ranks = np.concatenate(self.ranks) if self.ranks else np.zeros(0, "<u8")
        tables = [pack(x.tobytes()) for x in (ends.astype("<i8"), sums, ranks, self.docs.astype("<i8"), self.lengths.astype("<i8"))]
        head = json.dumps({"n": self.n, "width": self.width, "zeros": self.zeros, "tables": [len(t) for t in tables], "chunks": int(ends[-1]) if len(ends) else 0}).encode() + b"".join(tables)
        lead = len(head) - sum(map(len, tables))
        return b"".join([MAGIC, struct.pack("<III", lead, len(head), zlib.crc32(head)), head, *chunks])

    @classmethod
    def open(cls, read, size: int) -> WaveletMatrix:
        """From a file of ``size`` bytes, of which ``read(at, n)`` gives any part: only the head is read now."""
        begin = read(0, 16)
        if len(begin) < 16 or begin[:4] != MAGIC:
            raise ValueError("not a wavelet file")
        lead, long, crc = struct.unpack("<III", begin[4:])
        content = read(16, long)
        if len(content) != long or zlib.crc32(content) != crc:
            raise ValueError("damaged head of a wavelet file")
        head, at, tables = json.loads(content[:lead]), lead, []
        if size != 16 + long + head["chunks"]:
            raise ValueError("not a whole wavelet file")
        for n in head["tables"]:
            tables.append(zstandard.ZstdDecompressor().decompress(content[at : at + n]))
            at += n
        ends, sums, ranks, docs, lengths = (np.frombuffer(t, k) for t, k in zip(tables, ("<i8", "<u4", "<u8", "<i8", "<i8"), strict=True))
        plane_bytes, unpack = -(-head["n"] // 8), zstandard.ZstdDecompressor()
        per = -(-plane_bytes // CHUNK)

        def chunk(i: int) -> np.ndarray:
            a = int(ends[i - 1]) if i else 0
            packed = read(16 + long + a, int(ends[i]) - a)
            if zlib.crc32(packed) != sums[i]:
                raise ValueError("damaged chunk of a wavelet file")
            raw = min(CHUNK, plane_bytes - i % per * CHUNK)
            return np.frombuffer(packed if len(packed) == raw else unpack.decompress(packed), np.uint8)

        planes = [Plane(plane_bytes, chunk=lambda c, k=k: chunk(k * per + c)) for k in range(head["width"])]
        blocks = -(-plane_bytes // BLOCK) + 1
        return cls(head["n"], head["width"], head["zeros"], planes, [ranks[k * blocks : (k + 1) * blocks] for k in range(head["width"])], docs, lengths)

    @classmethod
    def frombytes(cls, content: bytes) -> WaveletMatrix:
        view = memoryview(content)
        return cls.open(lambda at, n: bytes(view[at : at + n]), len(content))


def open_shard(folder: str, name: str) -> WaveletMatrix:
    """A shard file, for access, rank, select and counts; what is asked for is read, not the file."""
    system, path = file_system(folder)
    held = system.open_input_file(f"{path}/{name}")
    return WaveletMatrix.open(lambda at, n: held.read_at(n, at), held.size())


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def spaces_separate(path: str) -> bool:
    """Whether the tokenizer lower-cases, drops white space and encodes letters, digits and signs apart."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    split = ((content.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    steps = [x.get("type") for x in (content.get("normalizer") or {}).get("normalizers", [])]
    return "Lowercase" in steps and split.get("type") == "Split" and split.get("behavior") == "Removed" and bool(split.get("invert")) and split["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


@lru_cache(maxsize=2)
def _word_ends(path: str) -> np.ndarray:
    """Whether a piece ends a word, by id."""
    vocab = _tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values()) + 1, dtype=bool)
    out[[i for p, i in vocab.items() if p.endswith("</w>")]] = True
    return out


_known: dict[tuple, dict[str, bytes]] = {}  # per tokenizer, kept by a worker between tasks


def encoder(path: str, end: int, dtype: type):
    """A function from texts to the bytes of their ids, with the end id.

    Where white space only separates, words are encoded once and remembered; the outcome is that of the whole text.
    """
    own_cache("tokens", _known.clear)
    tk, apart, known = _tokenizer(path), spaces_separate(path), _known.setdefault((path, dtype), {"": b""})
    last = dtype(end).tobytes()
    ends = _word_ends(path)

    def learn(new: list[str]) -> None:
        """Encodes many words as one text and deals the ids out by their places."""
        for at in range(0, len(new), 500):
            part = new[at : at + 500]
            begins = np.cumsum([0] + [len(w) + 1 for w in part])
            got = tk.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(got.ids, dtype=dtype)
            places = np.array([a for a, _ in got.offsets], dtype=np.int64)
            cuts = (np.searchsorted(places, begins) * ids.itemsize).tolist()
            held = ids.tobytes()
            known.update(zip(part, [held[a:z] for a, z in zip(cuts, cuts[1:], strict=False)], strict=True))

    def learn_letters(new: list[str]) -> None:
        """As ``learn`` for words of letters only: each is one unit of the tokenizer and ends where its last piece does."""
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            groups = [part[i : i + 200] for i in range(0, len(part), 200)]
            for words, got in zip(groups, tk.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
                ids = np.array(got.ids, dtype=dtype)
                stops = ((np.flatnonzero(ends[ids]) + 1) * ids.itemsize).tolist()
                if len(stops) != len(words):
                    learn(words)
                    continue
                held = ids.tobytes()
                known.update(zip(words, [held[a:z] for a, z in zip([0, *stops], stops, strict=False)], strict=True))

    def pieces_of(words: list[str]) -> list[bytes]:
        if len(known) > CACHE:
            known.clear()
            known[""] = b""
        new = set(words).difference(known)
        plain = {w for w in new if w.isalpha() and (w.isascii() or max(w) < "Ā")}  # beyond, a letter may become a letter and a mark
        others = new.difference(plain)
        ended = [(w, s, w[len(s) :]) for w in others if (s := w.rstrip(SIGNS)) and s is not w and s.isalpha() and (s.isascii() or max(s) < "Ā")]  # letters and signs are encoded apart
        learn_letters(list(plain.union([s for _, s, _ in ended]).difference(known)))
        learn(list(others.difference([w for w, _, _ in ended]).union([e for _, _, e in ended]).difference(known)))
        known.update([(w, known[s] + known[e]) for w, s, e in ended])
        return list(map(known.__getitem__, words))

    def encode(texts: pa.Array) -> pa.Array:
        texts = texts.fill_null("")
        if not apart:
            return pa.array([np.array(e.ids, dtype=dtype).tobytes() + last for e in tk.encode_batch(texts.to_pylist(), add_special_tokens=False)], pa.binary())
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # capitals could else become a special token
            texts = pc.ascii_lower(texts)
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        pieces = pieces_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        pool = np.frombuffer(b"".join(pieces), dtype=dtype)
        sizes = np.fromiter(map(len, pieces), dtype=np.int32, count=len(pieces)) // dtype().itemsize
        which = coded.indices.to_numpy()
        n = sizes[which]
        upto = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        at = np.repeat((np.cumsum(sizes, dtype=np.int64) - sizes)[which] - upto[:-1], n)
        at += np.arange(upto[-1])
        ids = pool[at]
        edges = words.offsets.to_numpy()
        ends_ = upto[edges[1:] - edges[0]]
        ids = np.insert(ids, ends_, end)
        offsets = np.concatenate([[0], ends_ + np.arange(1, len(ends_) + 1)]) * ids.itemsize
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])

    return encode


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end: int, wide: bool, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    encode = encoder(path, end, np.uint32 if wide else np.uint16)
    for batch in slices(batches, 1, BATCH_BYTES):
        ids = batch.column(0)
        shard = np.searchsorted(bounds, ids.fill_null(2**63 - 1).to_numpy(zero_copy_only=False), side="right")
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), ids, encode(batch.column(1))], names=["shard", "doc_id", "ids"])


def _packed(batches: Iterator[pa.RecordBatch], folder: str, width: int, roll: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard to files and their lines of the manifest; one file is in memory.

    A shard is one file unless one id (or none) has so many rows that it exceeds ``roll`` bytes of ids; then it is several.
    """
    dtype = np.uint32 if width > 16 else np.uint16
    shard, part, held, docs, parts = None, 0, 0, [], []

    def closed() -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(parts), dtype=dtype)
        lengths = np.array([len(p) for p in parts], dtype=np.int64) // ids.itemsize
        none = np.array([d is None for d in docs])
        numbers = np.array([0 if d is None else d for d in docs], dtype=np.int64)
        content = WaveletMatrix.build(ids, width, np.concatenate([numbers, none.astype(np.int64)]), lengths).tobytes()
        name = f"shard-{shard:07d}-{part:03d}.wvm"
        put_file(folder, name, content)
        return pa.RecordBatch.from_pydict({"shard": [shard], "part": [part], "name": [name], "n_docs": [len(docs)], "n_tokens": [len(ids)], "bytes": [len(content)]})

    for batch in batches:
        for s, d, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if docs and (s != shard or held >= roll):
                yield closed()
                docs, parts, held, part = [], [], 0, (part + 1 if s == shard else 0)
            shard = s
            docs.append(d)
            parts.append(p)
            held += len(p)
    if docs:
        yield closed()


def _unpacked(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            matrix = WaveletMatrix.frombytes(get_file(folder, name))
            ids, n = matrix.decode().astype("<u4"), len(matrix.lengths)
            ends = np.cumsum(matrix.lengths)
            begins = ends - matrix.lengths
            view = memoryview(ids.tobytes())
            crcs = [zlib.crc32(view[4 * a : 4 * z]) for a, z in zip(begins.tolist(), ends.tolist(), strict=True)]
            docs = pa.array(matrix.docs[:n], pa.int64(), mask=matrix.docs[n:].astype(bool))
            yield pa.RecordBatch.from_arrays([docs, pa.array(begins + start, pa.int64()), pa.array(matrix.lengths, pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _thrifty(work: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with reused_memory():
        yield from work


def _written(docs: DataFrame, path: str, to: str, end: int, shard_bytes: int) -> None:
    slim = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n"))
    slim = cut(slim.groupBy("doc_id").agg(F.sum("n").alias("n")))
    placed = ranked(slim.filter("doc_id is not null"), [F.col("doc_id")], "place", {"before": "n"})
    per = max(shard_bytes, -(-(slim.agg(F.sum("n")).first()[0] or 0) // MOST_SHARDS))
    starts = placed.groupBy((F.col("before") / per).cast("long").alias("part")).agg(F.min("doc_id").alias("at"))
    bounds = np.array(sorted(r["at"] for r in starts.collect())[1:], dtype=np.int64)  # at most MOST_SHARDS + 1
    tk = _tokenizer(path)
    width = max(1, max(tk.get_vocab_size(with_added_tokens=True) - 1, end).bit_length())
    width = 16 if width <= 16 else 32
    encoded = docs.select("doc_id", "text").mapInArrow(lambda it: _thrifty(_encoded(it, path, end, width > 16, bounds)), "shard long, doc_id long, ids binary")
    dealt = encoded.repartitionById(-(-(len(bounds) + 1) // 8), F.col("shard").cast("int")).sortWithinPartitions("shard", F.col("doc_id").isNull(), "doc_id", "ids")  # eight shards a task
    dealt.mapInArrow(lambda it: _thrifty(_packed(it, to, width, 2 * per)), MANIFEST).write.json(f"{to}/manifest")


def write_tokens(docs: DataFrame, path: str, to: str | None = None, end: int = 1, shard_bytes: int = SHARD_BYTES) -> str:
    """Encodes every row of ``docs`` (doc_id, text; more columns are not looked at) and writes the shards; returns the folder.

    A null or empty text is the end id alone, a text of any length is encoded whole. Null doc_ids come last; rows of one
    doc_id follow each other, ordered by their ids' bytes. An empty table gives a folder without shards.
    """
    spark = docs.sparkSession
    workers_can_import(spark)
    to = to or scratch(spark, "tokens")
    with tidying():
        _written(docs, path, to, end, shard_bytes)
    return to


def manifest_of(spark, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


@tidy
def _starts(files: DataFrame) -> DataFrame:
    """name, start: the ids of all files before each."""
    return ranked(files, [F.col("shard"), F.col("part")], "place", {"start": "n_tokens"}).select("name", "start")


def read_tokens(spark, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    workers_can_import(spark)
    placed = _starts(manifest_of(spark, folder))
    tasks = max(1, min(-(-placed.count() // 8), 50_000))
    return placed.repartition(tasks).mapInArrow(lambda it: _thrifty(_unpacked(it, folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(spark, folder: str, token: int) -> DataFrame:
    """doc_id and the places in the document of every occurrence of one id, by select on each shard."""
    workers_can_import(spark)

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name in frame["name"]:
                m = open_shard(folder, name)
                ends, n = np.cumsum(m.lengths), len(m.lengths)
                at = np.array([m.select(token, j) for j in range(m.count(token))], dtype=np.int64)
                k = np.searchsorted(ends, at, side="right")
                docs = pd.array(m.docs[k], dtype="Int64")
                docs[m.docs[n:][k].astype(bool)] = pd.NA
                yield pd.DataFrame({"doc_id": docs, "place": at - (ends - m.lengths)[k]})

    return manifest_of(spark, folder).select("name").mapInPandas(find, "doc_id long, place long")


def op2_tokens(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    folder = write_tokens(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder)
