"""Language ID by unigram pieces, marginalised over segmentations.

The vocabulary is that of a public tokenizer; each language has a probability for every piece, estimated by
expectation-maximisation. A word's probability is the sum over all ways to cut it into pieces (forward algorithm), a
text's the product over all its words, and the prediction the language with the largest posterior. Pieces never cross
words, so words are scored once and remembered.

What is learned from is a sample of bounded size per language, whatever the number of languages: at most ``ROWS`` rows
of ``ROW_CHARS`` code points each, of which the ``TYPES`` most frequent words count. Each language is learned in a task
of its own; the driver holds one probability per piece and language.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh, own_cache, slices, table, texts_of, workers_can_import

#: The sample that is learned from, at most: rows a language, code points a row, word types a language.
ROWS, ROW_CHARS, TYPES = 200, 20_000, 4000
ROUNDS = 4
SMOOTH = 0.05  # added to the expected count of every piece
UNKNOWN = 1e-7  # probability of a character that no piece has, in every language
SHORT = 40  # code points of a word up to which all words of one length are scored at once; longer ones are rescaled as they grow
REMEMBER = 300_000  # scored words that a worker keeps
UND = "und"
WORDS = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, int]:
    """Pieces of a sentencepiece model as they stand in lower-cased words; the word mark begins a word."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    kept = sorted({q for p in pieces if (q := p.lower()).strip("▁").isalpha() and "▁" not in q[1:]})
    return {p: i for i, p in enumerate(kept)}


_longest: dict[int, tuple[dict, int]] = {}


def longest(vocab: dict[str, int]) -> int:
    """Code points of the longest piece."""
    known = _longest.get(id(vocab))
    if known is None or known[0] is not vocab:
        known = _longest[id(vocab)] = (vocab, max(map(len, vocab), default=1))
    return known[1]


def marked(word: str) -> str:
    return "▁" + word


def _cuts(words: list[str], vocab: dict[str, int]) -> np.ndarray:
    """For words of one length: piece of (word, start, length - 1), or the last index (no piece)."""
    n, none, most = len(words[0]), len(vocab), longest(vocab)
    get = vocab.get
    flat = [get(w[i : i + k], none) for w in words for i in range(n) for k in range(1, min(most, n - i) + 1)]
    out = np.full((len(words), n, min(most, n)), none, dtype=np.int32)
    shape = np.array([k <= n - i for i in range(n) for k in range(1, min(most, n) + 1)]).reshape(n, -1)
    out[:, shape] = np.array(flat, dtype=np.int32).reshape(len(words), -1)
    return out


def _with_unknown(p: np.ndarray, cuts: np.ndarray, i: int, k: int) -> np.ndarray:
    """Probabilities of the pieces at (i, k) for all words; a single character that is no piece has UNKNOWN."""
    got = p[cuts[:, i, k - 1]]
    return np.maximum(got, UNKNOWN) if k == 1 else got


def forward(p: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums over segmentations of each prefix: (words, n + 1, languages). ``p``: (pieces + 1, languages), the last row 0."""
    w, n, most = cuts.shape
    a = np.zeros((w, n + 1, p.shape[1]))
    a[:, 0] = 1
    for j in range(1, n + 1):
        for k in range(1, min(most, j) + 1):
            a[:, j] += a[:, j - k] * _with_unknown(p, cuts, j - k, k)
    return a


def _long_word(word: str, vocab: dict[str, int], p: np.ndarray) -> np.ndarray:
    """Log probabilities of a word of any length, rescaled at each step."""
    none, most, a, scale = len(vocab), longest(vocab), [np.ones(p.shape[1])], np.zeros(p.shape[1])
    for j in range(1, len(word) + 1):
        got = np.zeros(p.shape[1])
        for k in range(1, min(most, j) + 1):
            q = p[vocab.get(word[j - k : j], none)]
            got += a[-k] * (np.maximum(q, UNKNOWN) if k == 1 else q)
        a, scale = [x / got for x in a[max(0, len(a) - most + 1) :]] + [np.ones(p.shape[1])], scale + np.log(got)
    return scale


def word_logs(words: list[str], vocab: dict[str, int], p: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.zeros((len(words), p.shape[1]))
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w) + 1, []).append(i)
    for n, at in by.items():
        if n > SHORT:
            for i in at:
                out[i] = _long_word(marked(words[i]), vocab, p)
            continue
        for lo in range(0, len(at), 2000):
            part = at[lo : lo + 2000]
            out[part] = np.log(np.maximum(forward(p, _cuts([marked(words[i]) for i in part], vocab))[:, -1], 1e-300))
    return out


def learn_pieces(counts: Counter, vocab: dict[str, int]) -> np.ndarray:
    """Piece probabilities of one language from word counts, by EM over all segmentations.

    A word longer than SHORT (as in scripts without spaces) is learned from as several, each of at most that length.
    """
    v = len(vocab)
    groups = []
    by: dict[int, Counter] = {}
    for word, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:TYPES]:
        w = marked(word)
        for at in range(0, len(w), SHORT):
            by.setdefault(len(w[at : at + SHORT]), Counter())[w[at : at + SHORT]] += n
    for found in by.values():
        words = sorted(found)
        for lo in range(0, len(words), 2000):
            part = words[lo : lo + 2000]
            groups.append((_cuts(part, vocab), np.array([found[w] for w in part], dtype=float)))
    p = np.append(np.full(v, 1.0 / max(1, v)), 0.0)
    for _ in range(ROUNDS):
        expected = np.full(v + 1, SMOOTH)
        for cuts, weight in groups:
            w, n, most = cuts.shape
            a = forward(p[:, None], cuts)[:, :, 0]
            b = np.zeros((w, n + 1))
            b[:, n] = 1
            for i in range(n - 1, -1, -1):
                for k in range(1, min(most, n - i) + 1):
                    b[:, i] += b[:, i + k] * _with_unknown(p, cuts, i, k)
            scale = weight / np.maximum(a[:, n], 1e-300)
            for i in range(n):
                for k in range(1, min(most, n - i) + 1):
                    np.add.at(expected, cuts[:, i, k - 1], scale * a[:, i] * b[:, i + k] * p[cuts[:, i, k - 1]])
        expected[v] = 0
        p = expected / max(expected.sum(), 1e-300)
    return p


@dataclass
class Model:
    """Languages in order, log priors, piece probabilities, and the vocabulary's place."""

    languages: list[str]
    priors: np.ndarray
    pieces: np.ndarray
    path: str
    _known: dict = field(default_factory=dict, repr=False)
    _logs: list = field(default_factory=list, repr=False)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        vocab, known = vocabulary(self.path), self._known
        if not self.languages:
            return [UND] * len(texts), [0.0] * len(texts)
        words = [WORDS.findall(t.lower()) for t in texts]
        if len(known) > REMEMBER:
            known.clear()
            self._logs.clear()
        new = list({w for ws in words for w in ws if w not in known})
        if new:
            base = len(known)
            known.update(zip(new, range(base, base + len(new)), strict=True))
            self._logs.append(word_logs(new, vocab, self.pieces).astype(np.float32))
        if len(self._logs) > 1:
            self._logs[:] = [np.concatenate(self._logs)]
        langs, scores = [], []
        for t, ws in zip(texts, words, strict=True):
            if not ws or not any(map(str.isalpha, t)):
                langs.append(UND)
                scores.append(0.0)
                continue
            at = np.fromiter(map(known.__getitem__, ws), dtype=np.int64, count=len(ws))
            total = self._logs[0][at].sum(axis=0, dtype=np.float64) + self.priors
            best = int(np.argmax(total))
            langs.append(self.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return langs, scores


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of over ROW_CHARS code points become some of their words, drawn by hash, and texts without words go."""
    for batch in slices(batches, 2, 4 << 20):
        texts = texts_of(batch.column(2))
        for i, t in enumerate(texts):
            if len(t) > ROW_CHARS:
                words = WORDS.findall(t)
                drawn, room = [], ROW_CHARS
                for k in sorted(range(len(words)), key=lambda k: zlib.crc32(k.to_bytes(8, "little"))):
                    if room <= 0:
                        break
                    drawn.append(words[k][:room])
                    room -= len(words[k]) + 1
                texts[i] = " ".join(drawn)
        some = pa.array([WORDS.search(t) is not None for t in texts], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["lang", "h", "text"]).filter(some)


def _learned(frame: pd.DataFrame, path: str) -> pd.DataFrame:
    """The sampled texts of one language to its piece probabilities."""
    counts: Counter = Counter()
    for t in frame["text"]:
        counts.update(WORDS.findall(t.lower()))
    return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "pieces": [learn_pieces(counts, vocabulary(path)).tobytes()]})


def train(docs: DataFrame, path: str) -> Model:
    """Learns from a bounded sample of the rows that are not held out and have text and lang.

    A row is in the sample by a hash of its id and text, so reruns agree; all rows are read to find it, and counts of
    the languages (the priors) cover all rows. A text longer than ROW_CHARS gives that many characters of its words.
    Every language with a text that has a letter is learned; an empty table gives a model that knows none.
    """
    workers_can_import(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros(0), np.zeros((1, 0)), path)
    share = F.element_at(F.create_map(*[x for k, n in sorted(sizes.items()) for x in (F.lit(k), F.lit(min(1.0, 3.0 * ROWS / n)))]), F.col("lang"))
    near = rows.withColumn("h", F.xxhash64("doc_id", "text")).filter((F.col("h") / F.lit(2.0**64) + 0.5 < share))
    near = near.select("lang", "h", "text").mapInArrow(_bounded, near.select("lang", "h", "text").schema)
    first = Window.partitionBy("lang").orderBy("h", "text")
    sample = near.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= ROWS).select("lang", "text")
    learned = {r["lang"]: np.frombuffer(r["pieces"]) for r in sample.groupBy("lang").applyInPandas(lambda f: _learned(f, path), "lang string, pieces binary").collect()}
    languages = sorted(learned)
    pieces = np.stack([learned[k] for k in languages], axis=1) if languages else np.zeros((1, 0))
    priors = np.log(np.array([sizes[k] for k in languages], dtype=float) / max(1, sum(sizes[k] for k in languages)))
    return Model(languages, priors, pieces, path)


_models: dict[int, Model] = {}


def _shared(model: Model) -> Model:
    """One copy of a model in a worker, so that scored words are remembered between tasks."""
    own_cache("langid", _models.clear)
    key = zlib.crc32(model.pieces.tobytes())
    if key not in _models:
        _models.clear()
        _models[key] = model
    return _models[key]


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score", text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus, as the last two, the predicted language and its posterior (0 to 1).

    Where ``docs`` has a column of such a name, the new one gets underscores in front. A null or empty text and a text
    without a letter are ``und`` with score 0; so is every text if nothing was learned. All words of a text count, however
    many. Only the text is looked at, so equal rows get equal results. Equal posteriors go to the first language in order.
    """
    spark = docs.sparkSession
    lang, score = fresh(docs, lang), fresh(docs, score)
    workers_can_import(spark)
    shared = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _shared(shared.value)
        for batch in slices(batches, place, 4 << 20):
            langs, scores = own.predict(texts_of(batch.column(place)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, lang, score])

    return docs.mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_langid(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, path or default_vocabulary())
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
