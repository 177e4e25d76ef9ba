import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import decontaminate as dec
from corpusmill.llm import langid, secrets, suffixdedup, tokens

DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", "<|endoftext|>", "<|ENDOFTEXT|>", "text|>", " ", "\n", "\t", "\x1c", "\x85", " ", "'s", "'", "S", "é", "́", "Σ", "İ", "1", "23", "...", "😀", "日本", "ﬁ", "\r\n", "%%%", "abc", "~", "_"]


def test_encoder_equals_whole_texts(rng):
    import pyarrow as pa

    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + ["", None, "x" * 5000]
    tk = Tokenizer.from_file(PATH)
    got = tokens.encoder(PATH, 1, np.uint16)(pa.array(texts, pa.string())).to_pylist()
    for t, g in zip(texts, got, strict=True):
        assert np.frombuffer(g, np.uint16).tolist() == [*tk.encode(t or "", add_special_tokens=False).ids, 1]


def test_wavelet_matrix(rng):
    for n in (0, 1, 7, 5000):
        x = np.random.default_rng(n).integers(0, 300, n).astype(np.uint16)
        m = tokens.WaveletMatrix.frombytes(tokens.WaveletMatrix.build(x, 16).tobytes())
        assert (m.decode() == x).all() and m.count(400) == 0 and m.count(70000) == 0
        for i in rng.sample(range(n), min(n, 60)):
            t = int(x[i])
            assert m.access(i) == t and m.rank(t, i) == (x[:i] == t).sum() and m.count(t) == (x == t).sum() and m.select(t, m.rank(t, i)) == i
    with pytest.raises(ValueError):
        tokens.WaveletMatrix.frombytes(tokens.WaveletMatrix.build(x, 16).tobytes()[:-9])


def test_wavelet_file_is_read_in_parts():
    """Access, rank, select and counts read the head and a chunk or two a plane, not the file; damage is found where it is read."""
    g = np.random.default_rng(0)
    x = (g.zipf(1.3, 2_000_000) % 50_000).astype(np.uint16)
    content, asked = tokens.WaveletMatrix.build(x, 16).tobytes(), []

    def read(at, n):
        asked.append(n)
        return content[at : at + n]

    m = tokens.WaveletMatrix.open(read, len(content))
    assert m.access(1_234_567) == x[1_234_567] and sum(asked) < len(content) / 5
    places = np.flatnonzero(x == 77)
    assert m.count(77) == len(places) and m.select(77, 5) == places[5] and (m.decode() == x).all()
    bad = bytearray(content)
    bad[-5] ^= 1
    with pytest.raises(ValueError):
        tokens.WaveletMatrix.frombytes(bytes(bad)).decode()


def test_tokens_of_long_texts_and_many_rows_of_one_id(spark):
    """A text of megabytes, and ids (also none) with more rows than a shard has room for."""
    rows = [(1, "Word and 12 signs, " * 120_000)] + [(2, f"text {i % 3}") for i in range(300)] + [(None, "none")] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = tokens.write_tokens(df, PATH, shard_bytes=100)
    got = sorted((tuple(r) for r in tokens.read_tokens(spark, folder).collect()), key=lambda r: r[1])
    tk = Tokenizer.from_file(PATH)
    known = {t: [*tk.encode(t, add_special_tokens=False).ids, 1] for _, t in rows}
    assert sorted((r[0] or 0, r[2], r[3]) for r in got) == sorted((d or 0, len(known[t]), zlib.crc32(np.array(known[t], "<u4").tobytes())) for d, t in rows)
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()] and [r[0] for r in got] == [1] + [2] * 300 + [None] * 200
    assert tokens.manifest_of(spark, folder).filter("part > 0").count() > 0


def test_token_round_trip(spark):
    rows = [(3, "One two"), (1, None), (1, "again"), (1, "again"), (None, "last"), (2, ""), (-4, "Ünder 12 %%%")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    folder = tokens.write_tokens(df, PATH, shard_bytes=10)
    got = sorted((tuple(r) for r in tokens.read_tokens(spark, folder).collect()), key=lambda r: r[1])
    tk, start = Tokenizer.from_file(PATH), 0
    assert [r[0] for r in got] == [-4, 1, 1, 1, 2, 3, None]
    for doc, at, n, crc in got:
        options = [[*tk.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows if d == doc]
        assert at == start and any(n == len(o) and crc == zlib.crc32(np.array(o, "<u4").tobytes()) for o in options)
        start += n
    places = sorted((tuple(r) for r in tokens.occurrences(spark, folder, 1).collect()), key=str)
    assert len(places) == len(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read_tokens(spark, tokens.write_tokens(empty, PATH)).count() == 0


def test_tokens_of_the_table(spark):
    tk, start = Tokenizer.from_file(PATH), 0
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect())
    got = {r[0]: tuple(r) for r in tokens.op2_tokens(spark, DIR).collect()}
    for d, t in docs:
        ids = [*tk.encode(t, add_special_tokens=False).ids, 1]
        assert got[d] == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def contamination(spark, docs, items):
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    return dec.find_benchmark(a, b)


def digest(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"]) for r in df.collect()), key=str)


def test_decontamination_against_brute_force(spark, rng, monkeypatch):
    words = ["the", "a", "über", "extraordinarily", "supercalifragilistic", "x1", "no", "yes", "É"]
    say = lambda n: " ".join(rng.choice(words) + rng.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 8, 9, 20]))) for i in range(12)] + [(50, None), (None, say(9)), (51, "THE a")]
    docs = [(i, say(rng.randint(0, 60)) + " " + rng.choice(items)[1] + " " + say(3) if i % 3 else rng.choice([None, "", "...", say(400)])) for i in range(60) if True and items[0]] if False else []
    for i in range(60):
        t = rng.choice(items)[1] or ""
        docs.append((i % 55, rng.choice([None, "", "...", say(400), say(rng.randint(0, 60)) + " " + t.upper() + " " + say(3), t])))
    want = sorted(dec.brute(docs, [x for x in items if x[0] is not None]), key=str)
    assert digest(contamination(spark, docs, items)) == want
    monkeypatch.setattr(dec, "BLOCK_BYTES", 60)
    monkeypatch.setattr(dec.blocks_of, "__defaults__", (60,))
    monkeypatch.setattr(dec, "AT_ONCE", 64)
    assert digest(contamination(spark, docs, items)) == want


def test_decontamination_empty(spark):
    assert digest(contamination(spark, [], [(1, "a b c")])) == []
    assert digest(contamination(spark, [(1, "a b")], []))[0][:4] == (1, 2, 0, 0)


def test_clean_keeps_clean_rows_of_a_shared_id(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, f"x {item} y", 1), (None, "clean text of no id", 2), (7, item, 3), (7, "another clean text", 4), (7, None, 5), (8, "", 6)], "doc_id long, text string, n int")
    left = dec.clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), least_items=1)
    assert left.columns == docs.columns and sorted(r["n"] for r in left.collect()) == [2, 4, 5, 6]


def test_proximity_against_brute_force(spark, rng, monkeypatch):
    say = lambda n: " ".join(rng.choice("abcdefghij") for _ in range(n))
    docs = [(i % 35, rng.choice([None, "", say(5), say(80)])) for i in range(40)]
    items = [(i, say(rng.choice([1, 2, 2, 3, 4]))) for i in range(10)] + [(20, None), (None, "a"), (21, "zz a"), (22, "A a")]
    want = []
    for d, t in docs:
        w = (t or "").split()
        for i, q in items:
            terms = set((q or "").lower().split())
            places = [s for s in range(len(w)) if w[s] in terms and terms <= set(w[s : s + 6])]
            if places and i is not None:
                want.append((d, str(i), len(w), places))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("places", F.lit("clash"))
    for size in (1 << 20, 4):
        monkeypatch.setattr(dec.blocks_of, "__defaults__", (size,))
        got = dec.find_near(df, spark.createDataFrame(items, "item_id long, text string"), 6)
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str) and len(want) > 50


def test_decontamination_of_long_texts(spark):
    """A passage near the end of a text of several MB, and a benchmark of many windows, which are not copied a window."""
    item = "alpha beta gamma delta epsilon zeta eta theta iota"
    text = "lorem ipsum dolor sit amet " * 120_000 + item
    found = contamination(spark, [(1, text), (2, "x"), (3, text[:1000])], [(7, item), (8, item + " kappa"), (9, "lorem ipsum dolor sit amet lorem ipsum dolor sit")])
    got = {r["doc_id"]: (r["items"], r["contaminated"]) for r in found.collect()}
    assert got == {1: (["7", "8", "9"], True), 2: ([], False), 3: (["9"], False)}
    many = dec.TestWindows(list(range(500)), [(f"w{i} " * 300).encode() for i in range(500)])
    assert sum(x.nbytes for x in (many.start, many.size, many.name, many.back)) <= 33 * 150_000


def test_decontamination_of_words_alike_but_for_two_bytes(spark):
    """Words that differ in their 8th and 16th byte only: each is a term of its own, and no segment fails."""
    letters = "0123456789abcdefghijklmnopqrstuvwxyz"
    words = [f"account{x}segment{y}" for x in letters for y in letters]
    docs = [(k, " ".join(words[k * 36 : k * 36 + 36])) for k in range(36)] + [(99, " ".join(words))]
    items = [(k, w) for k, w in enumerate(words)]
    assert digest(contamination(spark, docs, items)) == sorted(dec.brute(docs, items), key=str)


def test_words_that_share_a_key(monkeypatch):
    """The second key tells words apart that share the first, in the index and in the windows."""
    whole = dec.word_keys

    def few(data):
        starts, key, second = whole(data)
        return starts, key % np.uint64(3), second ^ key

    monkeypatch.setattr(dec, "word_keys", few)
    docs = ["a b c d e f g h i j".split(), "j i h a b c z".split(), "b a d c".split()]
    built = dec.Segment.build([1, 2, 3], [" ".join(d).encode() for d in docs])
    s = dec.Segment.frombytes(built.tobytes())
    items = ["a b c", "c", "h i", "d c", "y", "a b d"]
    block = dec.TestWindows(list(range(len(items))), [t.encode() for t in items])
    w, doc, at = block.hits(s)
    got = sorted((d, p, block.names[n]) for k, d, p in zip(w.tolist(), doc.tolist(), at.tolist(), strict=True) for n in block.name[block.held[k] : block.held[k + 1]].tolist())
    want = sorted((d, p, str(n)) for d, x in enumerate(docs) for n, t in enumerate(items) for p in range(len(x)) if x[p : p + len(t.split())] == t.split())
    assert got == want and len(s.terms) == 11


def test_windows_of_one_word():
    """A text and an item of one word over and over, whose windows are alike: each place is found once, not once a window."""
    n = 20_000
    s = dec.Segment.build([1], [b"buy " * n])
    block = dec.TestWindows([3, 4], [b"buy " * n, b"buy " * 9])
    w, doc, at = block.hits(s)
    assert len(at) == n - 7 and dec._united(doc, at, at + block.size[w]) == {0: [{"a": 0, "z": n}]} and dec._named(doc, w, block) == {0: ["3", "4"]}


def test_near_terms():
    s = dec.Segment.build([1, 2], [b"a x x b c", b"b a"])
    key = lambda w: dec.word_keys(np.frombuffer(w, np.uint8))
    a, b = (s.term(int(key(w)[1][0]), int(key(w)[2][0])) for w in (b"a", b"b"))
    assert s.near(a, b, 3).tolist() == [0, 7] and s.near(a, b, 2).tolist() == [7]
    t = dec.Segment.frombytes(s.tobytes())
    assert t.places.tolist() == s.places.tolist() and t.counts.tolist() == [5, 2]


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op4_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 100 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    train = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)] + [(99, None, "en"), (98, "x", None)], "doc_id long, text string, lang string")
    model = langid.train(train, langid.default_vocabulary())
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "123 ²"), (4, "the and"), (5, "und die"), (6, "q" * 3000), (None, "DER HUND")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(rows, model).collect()}
    assert [got[i] for i in (1, 2, 3, 4, 5, None)] == ["und", "und", "und", "en", "de", "de"] and got[6] in ("en", "de")
    nothing = langid.train(train.filter("lang is null"), langid.default_vocabulary())
    assert langid.predict(rows, nothing).filter("lang_pred <> 'und' or score <> 0").count() == 0


def test_language_of_long_texts_is_learned(spark):
    """All labelled texts of a language are longer than ROW_CHARS."""
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, " " * 30_000 + "der hund und die katze " * 1500, "de") for i in range(20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.default_vocabulary())
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame([(1, "the dog"), (2, "die katze und der hund")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(asked, model).collect()} == {1: "en", 2: "de"}


def test_language_many_and_clashing_names(spark):
    """More languages than any list would hold, one in words longer than any that are scored at once; names that clash."""
    rows = [(k * 4 + i, f"{chr(0x4E00 + k) * 3} {chr(0x4E00 + k)}a", f"l{k:03}") for k in range(230) for i in range(2)] + [(5000 + i, "ㄱㄴㄷ" * 40, "long") for i in range(4)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.default_vocabulary())
    assert len(model.languages) == 231
    asked = spark.createDataFrame([(1, chr(0x4E00 + 229) * 3, 0.5, "x")] * 2 + [(2, "ㄱㄴㄷ" * 41, 0.5, "x")], "doc_id long, text string, score double, lang_pred string")
    got = langid.predict(asked, model)
    assert got.columns == ["doc_id", "text", "score", "lang_pred", "_lang_pred", "_score"]
    assert [(r["score"], r["_score"] > 0) for r in got.collect()] == [(0.5, True)] * 3
    assert langid.predict(asked.limit(0), model).count() == 0
    assert langid.train(asked.limit(0).withColumn("lang", F.lit("x")), langid.default_vocabulary()).languages == []


def log_word(word, pieces, unknown):
    """Log of the sum over all segmentations, straight from the definition, piece by piece from the left."""
    a = [0.0]
    for j in range(1, len(word) + 1):
        terms = []
        for i in range(j):
            q = pieces.get(word[i:j], 0.0)
            q = max(q, unknown) if j - i == 1 else q
            if q > 0:
                terms.append(a[i] + math.log(q))
        top = max(terms)
        a.append(top + math.log(sum(math.exp(x - top) for x in terms)))
    return a[-1]


def test_language_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    model = langid.train(docs, langid.default_vocabulary())
    vocab = langid.vocabulary(model.path)
    names = [{p: model.pieces[i, k] for p, i in vocab.items() if model.pieces[i, k] > 0} for k in range(len(model.languages))]
    known: dict = {}
    want = {}
    for r in docs.collect():
        words = langid.WORDS.findall(r["text"].lower())
        total = model.priors.copy()
        for w in words:
            if w not in known:
                known[w] = np.array([log_word("▁" + w, p, langid.UNKNOWN) for p in names])
            total = total + known[w]
        best = int(np.argmax(total))
        want[r["doc_id"]] = (model.languages[best] if words else "und", zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2, 1 / np.exp(total - total[best]).sum() if words else 0.0)
    got = langid.op4_langid(spark, DIR).collect()
    assert len(got) == len(want)
    for r in got:
        lang, held, score = want[r["doc_id"]]
        assert (r["lang_pred"], r["held_out"]) == (lang, held) and r["score"] == pytest.approx(score, abs=1e-4)


def test_forward_sums_all_segmentations():
    vocab = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}
    p = np.append(np.array([0.3, 0.2, 0.1, 0.15, 0.25]), 0)[:, None]
    total = 0.3 * 0.2 * 0.1 + 0.3 * 0.15 + 0.25 * 0.1
    assert np.exp(langid.word_logs(["ab"], vocab, p))[0, 0] == pytest.approx(total)
    assert np.exp(langid._long_word("▁ab", vocab, p))[0] == pytest.approx(total)


def test_secrets_against_definitions(spark, rng):
    parts = ["password", "passwd", "SECRET", "token", "api_key", "apikey", " ", "=", ":", '"', "'", "abcd1234", "x", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef", "ſecret", "toKen", "é", "\n", "+/", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(800)] + ["", None, "key=a+" * 5000, "a" * 300000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("spans", F.lit(1))
    for r in secrets.scan_secrets(df).select("*", F.sha2("base_spans", 256).alias("h")).collect():
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["h"]) == secrets.brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_spans"].split(","))) <= set(filter(None, r["spans"].split(",")))


def test_secret_propagation():
    text = 'x = "Zk39dkL0aQ11zz"\ndb_password = x\nname = "hello world"\n{"auth_key": "Aa1!bcdefgh"}\npassword = "changeme"\n'
    assert [text[a:z] for a, z in secrets.lexed_spans(text)] == ["Zk39dkL0aQ11zz", "Aa1!bcdefgh"]
    assert "Zk39dkL0aQ11zz" not in secrets.redact(text) and secrets.redact(None) is None


def test_secrets_without_limits():
    """Many constants, sums of many parts, long literals and names, and sums that double each time."""
    found = lambda text: {text[a:z] for a, z in secrets.lexed_spans(text)}
    many = "".join(f'c{i} = "plain{i}"\n' for i in range(10_500))
    assert found(many + 'k = "Zk39dkL0aQ11zz"\ndb_pwd = k\n') == {"Zk39dkL0aQ11zz"}
    parts = [f"Aa1!{i:03}" for i in range(120)]
    assert found("db_pwd = " + " + ".join(f'"{x}"' for x in parts)) == set(parts)
    key = "Zk39dkL0aQ" * 30_000
    assert found(f'credential = "{key}"') == found(f"pwd: '{key}'") == {key}
    assert found(f'{"n" * 500} = "Zk39dkL0aQ11zz"\npwd{" " * 50}= {"n" * 500}') == {"Zk39dkL0aQ11zz"}
    assert found('a0 = "Zk39dkL0aQ11zz"\n' + "".join(f"a{i + 1} = a{i} + a{i}\n" for i in range(200)) + "pwd = a200") == {"Zk39dkL0aQ11zz"}
    assert found(f'pwd = "your{"word1A" * 50}"') == found(f'pwd = "{"x" * 5000}"') == set()


def test_secrets_in_other_syntax():
    """Quotes over several lines, blocks, elements, attributes in either order, and names used before they are assigned."""
    found = lambda text: [text[a:z] for a, z in secrets.lexed_spans(text)]
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIEow IBAAKC\nAQEA\n-----END RSA PRIVATE KEY-----"
    assert found(f'private_key = """\n{pem}\n"""') == [f"\n{pem}\n"]
    block = "\n".join("  " + x for x in pem.split("\n"))
    assert found(f"private_key: |\n{block}\nother: 1") == [block.strip()]
    assert found("<db_password> Zk39dkL0aQ11zz </db_password>") == ["Zk39dkL0aQ11zz"]
    assert found('<add key="db_pwd" value="Zk39dkL0aQ11zz"/>') == found('<x value="Zk39dkL0aQ11zz"  name="db_pwd"/>') == ["Zk39dkL0aQ11zz"]
    assert found('<add key="colour" value="Zk39dkL0aQ11zz"/> pwd') == []
    assert found('db_pwd = x\nx = y + "aB3$"\ny = "Zk39dkL0aQ11zz"') == ["aB3$", "Zk39dkL0aQ11zz"]
    assert found("db_pwd = x\nx = z\nz = x") == found('a = """ never closed pwd\nb = ```') == []


def test_secret_programs(spark, rng):
    """Random programs of literals, copies and sums in any order, against a plain evaluation of each name."""
    rows, want = [], []
    for i in range(60):
        names = [f"v{k}" for k in range(8)]
        made: dict[str, list] = {}
        for n in names:
            made[n] = rng.choice([[f'"Lit{rng.randint(0, 10**6)}Xy$z{rng.randint(0, 10**6)}"'], [rng.choice(names)], [rng.choice(names), '"tail#9Zq"']])
        lines = [f"{n} = {' + '.join(v)}" for n, v in made.items()]
        rng.shuffle(lines)
        target = rng.choice(names)
        text = "\n".join(lines) + f"\ndb_pwd = {target}\n"

        def reach(n, seen, made=made):
            if n.startswith('"'):
                return {n[1:-1]}
            if n in seen:
                return None
            each = [reach(x, seen | {n}) for x in made[n]]
            return None if None in each else set().union(*each)

        rows.append((i, text))
        want.append(reach(target, set()) or set())
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    for r in secrets.scan_secrets(df).collect():
        text = rows[r["doc_id"]][1]
        spans = [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("literal")]
        assert {text[a:z] for a, z in spans} == want[r["doc_id"]]
    assert secrets.scan_secrets(df.limit(0)).count() == 0


def test_suffix_sort(rng):
    for size in (8, 12, 20):
        data = np.frombuffer("".join(rng.choice(["abc ", "foo ", "é", "q"]) for _ in range(300)).encode(), np.uint8)
        places = np.arange(len(data) - size + 1)
        order, _ = suffixdedup.Suffixes(data, size, suffixdedup.BASES[0]).sort(places)
        cut = [bytes(data[p : p + size]) for p in order]
        assert cut == sorted(cut)
        seen: dict = {}
        for p in places.tolist():
            seen.setdefault(bytes(data[p : p + size]), []).append(p)
        assert suffixdedup.repeated_windows(data, places, size).tolist() == sorted(p for v in seen.values() if len(v) > 1 for p in v)


@pytest.mark.parametrize("many", [4096, 4])
def test_suffix_dedup_against_brute_force(spark, rng, monkeypatch, many):
    monkeypatch.setattr(suffixdedup, "MANY", many)
    base = [r[0] for r in spark.read.parquet(f"{DIR}/documents.parquet").select("text").limit(12).collect()]
    rows: list = []
    for i in range(120):
        a, b = rng.choice(base), rng.choice(base)
        t = rng.choice([a[: rng.randint(0, len(a))] + b[rng.randint(0, len(b)) :], a.replace(rng.choice("aeit"), "#", 2), a, "x" * rng.randint(0, 700), None, "", base[0][50:400] + str(i) * 30 + base[1][:300]])
        rows.append((rng.choice([i, i, 5, None]), t))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tie", F.lit("clash"))
    got = sorted((tuple(r) for r in suffixdedup.remove_repeats(df).drop("spans").collect()), key=str)
    assert got == sorted(suffixdedup.brute(rows), key=str)


def test_suffix_collisions(spark, rng, monkeypatch):
    """A base whose hashes collide is found out by bytes and another one takes its place; so is a key that two texts share."""
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(400)).encode(), np.uint8)
    places = np.arange(len(data) - 11)
    want = suffixdedup.repeated_windows(data, places, 12).tolist()
    bad = 1 << 32
    monkeypatch.setattr(suffixdedup, "BASES", (bad, *suffixdedup.BASES[:1]))
    assert suffixdedup.repeated_windows(data, places, 12).tolist() == want and 0 < len(want) < len(places)
    monkeypatch.setattr(suffixdedup, "BASES", (bad,))
    with pytest.raises(ValueError):
        suffixdedup.repeated_windows(data, places, 12)
    own = spark.createDataFrame([(1, 5, b"one"), (2, 5, b"two"), (3, 6, b"x"), (4, 6, b"x")], "doc_id long, tie long, raw binary")
    texts = suffixdedup._identified(own)[1]
    assert {r["tie"]: (r["copies"], r["sha0"] != r["sha1"]) for r in texts.collect()} == {5: (2, True), 6: (2, False)}


def test_suffix_dedup_of_long_texts(spark):
    """Passages that repeat across the borders of the pieces in which long texts are worked on."""
    g = np.random.default_rng(3)
    text = bytes(g.integers(97, 123, 2_600_000, dtype=np.uint8)).decode()
    border = suffixdedup.PIECE
    other = text[border - 150 : border + 170] + "#" + text[500:720] + "#" + text[2 * border - 10 : 2 * border + 195]
    df = spark.createDataFrame([(1, text), (2, other), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixdedup.remove_repeats(df).collect()}
    kept = text[:500] + text[720 : border - 150] + text[border + 170 : 2 * border - 10] + text[2 * border + 195 :]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (320 + 220 + 205, 3, sha(kept)), 2: (320 + 220 + 205, 3, sha("##")), 3: (0, 0, sha(""))}


def test_suffix_dedup_empty(spark):
    assert suffixdedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
