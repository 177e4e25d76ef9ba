import gzip
import hashlib
import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import mixing, pii, warc

DIR = "/root/testdata/sf0.001"


def duck(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(f"{name}_frame", frame)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_frame")
    return con.execute(sql).fetchall()


def same(a, b):
    key = lambda rows: sorted(tuple("" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert key(a) == key(b)


def op1(df):
    m = F.col("mix")
    return mixing.mix(df).select("doc_id", m["size"], m["source_size"], m["target"], m["size"] * m["copies"])


def test_mixing_against_sql(spark, rng):
    rows = [(i if i % 50 else None, None if i % 31 == 0 else " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 40))), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(600)]
    rows += [(7, "x y z", "b")] * 5 + [(8, "", "empty"), (9, None, "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in op1(df).collect()]
    same(got, duck(mixing.OP1_SQL, documents=df.toPandas().astype({"doc_id": "Int64"}).astype({"text": object})))
    taken, target = {}, {}
    for (_, size, total, want, took), (_, _, s) in zip(sorted(got, key=str), sorted(rows, key=str), strict=True):
        assert took <= 3 * size
    for r, s in zip(mixing.mix(df).collect(), range(10**6)):
        taken[r["source"]] = taken.get(r["source"], 0) + r["mix"]["size"] * r["mix"]["copies"]
        target[r["source"]] = r["mix"]["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert sum(target.values()) == pytest.approx(sum(r[1] for r in got))
    assert sorted(got, key=str) == sorted((tuple(r) for r in op1(df.repartition(3)).collect()), key=str)


def test_mixing_levels(spark, rng):
    """Targets against water-filling by rounds, with many sources, ties and budgets beyond all caps."""
    for share in (1, 4):
        rows = [(i, " ".join(["w"] * rng.choice([0, 1, 1, 5, 50, 900])), f"s{rng.randint(0, 40)}") for i in range(300)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        size: dict = {}
        for _, t, s in rows:
            size[s] = size.get(s, 0) + len(t.split())
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
        budget, capped = sum(size.values()) * share, set()
        while True:
            open_ = [s for s in size if s not in capped]
            level = (budget - sum(3 * size[s] for s in capped)) / max(1, sum(weight[s] for s in open_)) if open_ else 0
            more = {s for s in open_ if weight[s] * level > 3 * size[s]}
            if not more:
                break
            capped |= more
        want = {s: 3 * size[s] if s in capped else weight[s] * level for s in size}
        got = {r["source"]: r["mix"]["target"] for r in mixing.mix(df, share=share).collect()}
        assert got == pytest.approx(want)


def test_mixing_long_text(spark):
    rows = [(1, "word " * 400_000, "a"), (2, "one two", "b"), (3, "x" * 2_000_000, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r[0]: r for r in op1(df).collect()}
    assert got[1][1] == 400_000 and got[3][1] == 1 and got[2][2] == 3 and got[2][3] == 9


def test_mixing_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string, mix int")
    assert mixing.mix(empty).count() == 0 and mixing.mix(empty).columns == ["doc_id", "text", "source", "mix", "_mix"]
    one = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, source string")
    assert op1(one).collect()[0][4] == 2
    assert mixing.mixed(one).columns == ["doc_id", "text", "source"]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]


def test_pii_against_re(spark, rng):
    parts = ["a", "b@c", "@", ".", "4111 1111 1111 1111", "192.168.0.1", "+", "(0)", "-", " ", "_", "%", "é", "😀", "\n", "0", "99", "256", "+1 555 123 4567", "a@b.c_d@e.f"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(400)] + ["", None, "1 " * 3000, "a." * 20000, "4111111111111111 " * 500]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    for r in pii.find_pii(df).select("doc_id", pii.joined(F.col("_pii"), pii.BASE).alias("b")).collect():
        assert r["b"] == ",".join(base(texts[r["doc_id"]] or ""))


def test_pii_added(spark):
    texts = ["iban DE89370400440532013000", "DE89370400440532013001", "my ssn is 123-45-6789", "order 123-45-6789", "mail a@b.co now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r["doc_id"]: r for r in pii.find_pii(df).select("doc_id", pii.joined(F.col("pii"), pii.ADDED).alias("a"), pii.redacted(F.col("text"), F.col("pii")).alias("t")).collect()}
    assert [rows[i]["a"] for i in range(4)] == ["iban:5:27", "", "ssn:10:21", ""] and rows[4]["t"] == "mail <email> now"


def test_pii_redacts_spans_not_values(spark):
    """Where a value also stands inside a longer run that is no span, or two kinds overlap."""
    texts = ["build 94111 1111 1111 1111000000", "xa@b.coz 4111111111111111 xa@b.coz", "call +378282246310005 now", "😀 a@b.co", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r["doc_id"]: r["t"] for r in pii.find_pii(df).select("doc_id", pii.redacted(F.col("text"), F.col("pii")).alias("t")).collect()}
    assert rows == {0: texts[0], 1: "<email> <card> <email>", 2: "call <phone> now", 3: "😀 <email>", 4: None, 5: ""}


def test_pii_scores(spark):
    texts = ["mail a@b.co", "invoice a@b.co", "a@b.co", "server 10.0.0.1 and version 10.0.0.2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r["doc_id"]: r["s"] for r in pii.find_pii(df).select("doc_id", pii.scores(F.col("pii"), pii.BASE).alias("s")).collect()}
    assert rows == {0: "100", 1: "60", 2: "90", 3: "60,30"}


def test_pii_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(empty).count() == 0
    twice = spark.createDataFrame([(1, "a@b.co")] * 2 + [(None, "a@b.co")], "doc_id long, text string")
    assert [len(r["pii"]["email"]) for r in pii.find_pii(twice).collect()] == [1, 1, 1]


def test_pii_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    same([tuple(r) for r in pii.op10_pii(spark, DIR).collect()], con.execute(pii.OP10_SQL).fetchall())


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 200
    rows = [(5, "http://a", big), (3, "http://b", big), (9, None, big + "é"), (4, "u\r\nv", None), (4, "u", ""), (1, "http://c", "small"), (2, "http://d", "small"), (None, "n", "z"), (3, "http://b", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kind", F.lit("clash"))
    got = sorted((tuple(r) for r in warc.read_warc(spark, warc.write_warc(df), True).drop("url").collect()), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(p, len((h or "").encode()), sha(h)) for p, _, h in rows]
    assert sorted(g[:3] for g in got if g[0]) == sorted(w for w in want if w[0]) and len(got) == len(rows)
    kinds = sorted((g[0], g[3], g[4]) for g in got if g[1] > 100)
    assert kinds == [(3, "response", None), (3, "revisit", 3), (5, "revisit", 3), (9, "response", None)]
    assert all(hashlib.sha256(g[5]).hexdigest() == g[2] for g in got if g[3] == "response")


def test_warc_files_are_plain(spark, tmp_path):
    """Equal input gives equal files; gzip and a plain parser read them without this package; the manifest is the truth."""
    df = spark.read.parquet(f"{DIR}/pages.parquet")
    held = []
    for k, d in enumerate((df, df.repartition(7))):
        archive = warc.write_warc(d, f"{tmp_path}/{k}", shard_bytes=40_000, roll_bytes=8_000)
        files = {p.name: p.read_bytes() for p in (tmp_path / str(k)).glob("*.warc.gz")}
        manifest = [json.loads(x) for p in (tmp_path / str(k) / "manifest").glob("*.json") for x in p.read_text().splitlines()]
        assert {m["name"]: (m["bytes"], m["sha256"]) for m in manifest} == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in files.items()}
        assert not list((tmp_path / str(k)).glob("*.tmp")) and not list((tmp_path / str(k)).glob(".*.tmp"))
        held.append(files)
    assert held[0] == held[1] and len(held[0]) > 2
    pages = {r["page_id"]: r["html"].encode() for r in df.collect()}
    met = set()
    for content in held[0].values():
        plain = gzip.decompress(content)
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            block, plain = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) + 4 :]
            page = int(fields["WARC-Page-ID"])
            met.add(page)
            assert fields["WARC-Type"] == "revisit" or block.partition(b"\r\n\r\n")[2] == pages[page]
    assert met == set(pages)
    (tmp_path / "1" / "stray.warc.gz").write_bytes(b"left by a lost task")
    assert warc.read_warc(spark, f"{tmp_path}/1").count() == len(pages)
    next((tmp_path / "1").glob("part-*.warc.gz")).write_bytes(b"damaged")
    with pytest.raises(Exception, match="manifest"):
        warc.read_warc(spark, f"{tmp_path}/1").collect()


def test_warc_null_ids_and_long_payloads(spark):
    same, long = "n" * 150, "long " * 600_000
    rows = [(None, "a", same), (None, "b", same), (None, "b", same), (None, "c", long), (8, "d", long), (9, "e", None), (9, "e", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, warc.write_warc(df, shard_bytes=100)).collect()), key=str)
    assert got == sorted([(8, 3_000_000, "response", None), (None, 3_000_000, "revisit", 8), (None, 150, "response", None), (None, 150, "revisit", None), (None, 150, "revisit", None), (9, 0, "response", None), (9, 0, "response", None)], key=str)


def test_warc_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(spark, warc.write_warc(df)).count() == 0


def test_warc_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{DIR}/pages.parquet'")
    same([tuple(r) for r in warc.op9_warc(spark, DIR).collect()], con.execute(warc.OP9_SQL).fetchall())
