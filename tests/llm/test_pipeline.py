"""The five stages, each against brute force on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from corpusmill.llm import decontaminate as dec
from corpusmill.llm import langid, mixing

from .test_similarity import classes

DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert [n for n, _ in cp.STAGES][0] == "language ID" and len(cp.STAGES) == 5
    given = docs
    for k, (name, stage) in enumerate(cp.STAGES):
        before = given.collect()
        stage(spark, given, DIR).write.parquet(f"{tmp_path}/{k}")
        given = spark.read.parquet(f"{tmp_path}/{k}")
        after = given.collect()
        if k < 4:
            assert given.columns == docs.columns
        if name == "language ID":
            assert len(after) == len(before)  # all of these are plain prose
        elif name == "MinHash near-dedup":
            want = classes([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r, c in zip(before, want, strict=True) if r["doc_id"] == c}
        elif name == "benchmark decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
            hit = {d for d, _, _, n, _, _ in dec.brute([(r["doc_id"], r["text"]) for r in before], items) if n}
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - hit and hit
        elif name == "mixing sources":
            m = mixing.mix(spark.read.parquet(f"{tmp_path}/{k - 1}")).collect()
            assert len(after) == sum(r["mix"]["copies"] for r in m)
        else:
            assert given.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and len(after) == len(before)


def test_language_stage_rejects(spark):
    rows = [(i, "the cat and the dog were in the house", "en", "s", 1) for i in range(30)] + [(100, None, "en", "s", 0), (101, "123 456", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.identify_language(spark, df, DIR)
    assert {r["doc_id"] for r in kept.collect()} == set(range(30)) and langid.UND == "und"


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows, columns whose names the operators use, and no rows at all."""
    prose = "the cat and the dog were in the house of the old man by the sea {} and slept"
    rows = [(i, prose.format(i % 7) + f" word{i} " * (i % 3), "en", "s1" if i % 2 else None, None) for i in range(30)]
    rows += [(None, None, None, None, None), (None, "", "en", "s1", 0), (3, None, "en", None, 1), (5, "12 34", None, "s2", 1), (None, prose.format("alone"), None, "s1", 5)] + [(40, prose.format("twice"), "en", "s1", 1)] * 3
    names = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, names)
    for c in ("score", "lang_pred", "mix", "node", "tie", "shard", "_bad", "_id"):
        docs = docs.withColumn(c, F.lit(1))
    for k, given in enumerate((docs, docs.limit(0))):
        for j, (_, stage) in enumerate(cp.STAGES):
            stage(spark, given, DIR).write.parquet(f"{tmp_path}/{k}{j}")
            after = spark.read.parquet(f"{tmp_path}/{k}{j}")
            if j < 4:
                assert after.columns == docs.columns and after.count() <= 3 * given.count()
                given = after
            else:
                assert after.count() == given.count() and (k or after.count() > 5)
    kept = spark.read.parquet(f"{tmp_path}/01").filter("doc_id = 40").count()
    assert kept == 1 and spark.read.parquet(f"{tmp_path}/00").filter("text is null or text = ''").count() == 0


def test_run(spark):
    assert cp.run(spark, DIR).count() > 0 and cp.ORACLE_SQL is None
