import math

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import decisions as dc
from corpusmill.operators import metrics as mx
from corpusmill.operators import models as md
from corpusmill.operators import splits as sp
from corpusmill.plans import report
from corpusmill.operators.language import language_of
from corpusmill.plans import training as tr
from corpusmill.plans.curation import Config, run, with_language
from corpusmill.sources import io

KEYS = ["suspicious_tld_count", "shortener_url_count", "cta_keyword_hits", "cta_plus_url_score", "urgency_cta_url_combo", "money_cta_combo", "account_keyword_hits", "security_keyword_hits", "delivery_keyword_hits", "brand_keyword_hits", "url_count_text", "spam_keyword_hits", "urgency_keyword_hits", "money_keyword_hits", "ham_business_hits", "ham_strength_score"]


def decided(spark, score, **counts):
    df = spark.createDataFrame([(score,)], "s double").withColumn("spam", F.struct(*[F.lit(float(counts.get(k, 0))).alias(k) for k in KEYS]))
    return df.select(dc.spam_decision(F.col("spam"), F.col("s")).alias("d")).first()["d"]


def test_spam_rules(spark):
    assert decided(spark, 0.95)["reason"] == "spam_detected"
    kept = decided(spark, 0.80, ham_business_hits=1)
    assert kept["keep"] and kept["uncertain_reason"] == "high_score_but_weak_spam_evidence"
    assert decided(spark, 0.75, account_keyword_hits=1, security_keyword_hits=1)["reason"] == "spam_detected"
    assert not decided(spark, 0.75, brand_keyword_hits=1, url_count_text=1)["strong_evidence"]
    assert decided(spark, None)["pred_label"] == "ham"


def test_quality_boundary(spark):
    df = spark.createDataFrame([(0.65, True), (0.6499, True), (0.9, False)], "s double, c boolean")
    got = [r["d"] for r in df.select(dc.quality_decision(F.col("s"), F.col("c")).alias("d")).collect()]
    assert [(g["label"], g["reason"]) for g in got] == [("good", None), ("bad", "quality_bad"), ("bad", "quality_missing_features")]
    assert got[2]["score"] == 0


def test_heuristic_boundaries(spark):
    texts = ["x" * 119, "x" * 120, "|" * 6 + "x" * 120, "|" * 7 + "x" * 120, "home login" + "x" * 120, "home login privacy" + "x" * 120]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(dc.heuristic_keep(F.col("t"))).collect()] == [False, True, True, False, True, False]


def test_audit(spark):
    df = spark.createDataFrame([("a", " Good ", "x"), ("b", None, "x"), ("c", "bad", "y")], "text string, label string, stage string")
    assert sorted((r["text"], r["file"]) for r in dc.reject_audit(df, "text", "label", "stage").collect()) == [("a", "good"), ("c", "bad")]


def test_inspection_is_not_audited(spark):
    df = spark.createDataFrame([("a", "good", "2_spam"), ("b", "good", "inspection_2_spam")], "text string, label string, stage string")
    assert [r["text"] for r in dc.reject_audit(df, "text", "label", "stage").collect()] == ["a"]


def test_tags_drop_nothing(spark):
    df = spark.createDataFrame([(0.9, True), (0.1, False)], "s double, c boolean").withColumn("q", dc.quality_decision(F.col("s"), F.col("c")))
    assert [(r["quality_label"], r["quality_score"]) for r in dc.tagged(df, quality=F.col("q")).collect()] == [("good", 0.9), ("bad", 0.0)]


def test_language_scorer(spark):
    texts = ["Il gatto è nella casa e non esce", "the cat is in the house", "der Hund und die Katze sind nicht da", "zzz 123", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r["l"]) for r in df.select(language_of(F.col("t")).alias("l")).collect()]
    assert [g[0] for g in got] == ["it", "en", "de", None, None, None] and all(g[1] > 0.7 for g in got[:3]) and got[3][1] == 0
    meta = "language string, language_score double, label string"
    docs = spark.createDataFrame([("Il gatto è nella casa", ("en", 0.9, None)), ("Il gatto è nella casa", (None, None, "good"))], f"text string, meta struct<{meta.replace(' ', ':').replace(',:', ', ')}>")
    assert [tuple(r["meta"])[0] for r in with_language(docs).collect()] == ["en", "it"]


def test_ties(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.2), (1, 0.9)], "y int, s double")
    assert mx.roc_auc(df, "y", "s").first()[0] == pytest.approx(0.875)
    assert mx.average_precision(df, "y", "s").first()[0] == pytest.approx(5 / 6)


def test_splits(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    counts = {(r["split"], r["y"]): r["count"] for r in sp.stratified_split(df, "id", "y", {"train": 0.7, "validation": 0.15, "test": 0.15}).groupBy("split", "y").count().collect()}
    assert sum(counts.values()) == 1000 and abs(counts["train", 1] - 0.7 * 334) <= 1 and abs(counts["test", 0] - 0.15 * 666) <= 1
    folds = [r["count"] for r in sp.stratified_folds(df, "id", "y", 5).groupBy("fold").count().collect()]
    assert len(folds) == 5 and max(folds) - min(folds) <= 2
    with pytest.raises(ValueError):
        sp.stratified_folds(df, "id", "y", 1)
    dealt = sp.shuffled(df, "id", "y", 3, "z").agg(F.sum("z"), F.count("*")).first()
    assert tuple(dealt) == (334, 1000)


def test_models(spark, tmp_path):
    df = spark.range(300).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 + F.rand(1)).alias("a"), F.rand(2).alias("b")).cache()
    model = md.fit("logistic_regression", df, ["a", "b"])
    done = md.scored(model, df)
    assert md.evaluate(done, 0.5)["roc_auc"] > 0.95
    assert mx.roc_auc(md.dummy(df, df), "y", "score").first()[0] == pytest.approx(0.5)
    imp = md.permutation_importance(model, df, ["a", "b"], 0.5, repeats=2).collect()
    assert abs(imp[1]["importance_mean"]) < 0.1 and len(imp) == 2
    assert imp[0]["feature"] == "a" and imp[0]["importance_mean"] > 0.2
    md.save(model, str(tmp_path / "m"), ["a", "b"], 0.5)
    again, about = md.load(spark, str(tmp_path / "m"))
    assert about["threshold"] == 0.5 and md.threshold_of(None, about, 0.9) == 0.5 and md.threshold_of(0.1, about, 0.9) == 0.1
    assert math.isclose(md.scored(again, df).agg(F.sum("score")).first()[0], done.agg(F.sum("score")).first()[0])
    with pytest.raises(ValueError):
        md.fit("logistic_regression", df.filter("y = 1"), ["a"])


def test_sweep_and_correlations(spark):
    df = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 200).alias("s"), (F.col("id") * 3 + 1).alias("t"), F.lit(5).alias("c"))
    sweep = mx.threshold_sweep(df, "y", "s", [0.0, 0.5])
    assert len(sweep.columns) == 29 and sweep.columns[:3] == ["threshold", "accuracy", "balanced_accuracy"] and sweep.columns[-1] == "fn_rate_on_spam"
    row = sweep.collect()[1]
    assert (row["true_negative"], row["predicted_spam"], row["true_ham"]) == (50, 100, 100)
    every = {(r["a"], r["b"]): r["r"] for r in mx.correlations(df, ["s", "t", "y", "c"]).collect()}
    assert every["s", "t"] == pytest.approx(1) and every["s", "c"] is None and len(every) == 6
    assert [(r["a"], r["b"]) for r in mx.correlations(df, ["s", "t", "y", "c"], 0.9).collect()] == [("s", "t")]


def test_label_correlation_of_a_constant(spark):
    """Means of parts of 49 ones are merged as 49 * (1 / 49), a little less than 1; the column is constant all the same."""
    df = spark.range(0, 98, 1, 2).select(F.lit(1.0).alias("one"), (F.col("id") % 2).alias("y"), F.col("id").alias("n"), (F.col("id") * 1e-9).alias("small"))
    got = {r["feature"]: r["r"] for r in mx.label_correlations(df, ["one", "n", "small"], "y").collect()}
    assert got["one"] is None and abs(got["n"]) > 0.01 and abs(got["small"] - got["n"]) < 1e-9
    assert [r["r"] for r in mx.label_correlations(df, ["n", "small"], "one").collect()] == [None, None]


def test_triage_groups_overlap(spark):
    df = spark.createDataFrame([("a", 0.5, 0.1), ("b", 0.0005, 0.0), ("c", -0.2, 0.3), ("d", -0.2, 0.1)], "feature string, importance_mean double, importance_std double")
    got = {r["feature"]: (r["strong"], r["to_review"], r["negative"]) for r in md.triage(df).collect()}
    assert got == {"a": (True, False, False), "b": (False, True, False), "c": (False, True, True), "d": (False, False, True)}


def test_training_and_evaluation(spark, tmp_path):
    """From rows to a saved model, its files, and an evaluation that finds its own test rows."""
    df = spark.range(240).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 + F.rand(1)).alias("a"), F.rand(2).alias("b"), F.lit(1.0).alias("c"))
    folder = str(tmp_path / "m")
    with pytest.raises(ValueError, match="lang_score"):
        tr.train(df.withColumn("lang_score", F.lit(1.0)), ["a", "lang_score"], folder, 0.5)
    made = tr.train(df, ["a", "b", "c"], folder, 0.5, kind="gbdt", trees=3, importance_repeats=2)
    assert made["features"] == ["a", "b"] and made["near_constant"] == ["c"]
    groups = {g: spark.read.option("header", True).csv(f"{folder}/importance/{g}").count() for g in ("all", "strong", "to_review", "negative")}
    assert groups["all"] == 2 and groups["strong"] >= 1
    report_ = tr.evaluate(spark, folder, folds=2, trees=3, kinds=("gbdt", "logistic_regression", "dummy"))
    assert report_["threshold"] == 0.5 and report_["winner"] in ("gbdt", "logistic_regression")
    by = {r["model"]: r for r in report_["comparison"]}
    assert by["gbdt"]["delta_roc_auc"] == 0 and by["dummy"]["delta_roc_auc"] < -0.2 and by["gbdt"]["oof_accuracy"] > 0.8 and by["dummy"]["oof_roc_auc"] is not None
    assert len(report_["saved_folds"]["folds"]) == 2 and set(report_["lift"]["lift"]) == {"roc_auc", "average_precision"} and report_["fresh_leakage"]["roc_auc"] < 0.9
    page = "".join(r[0] for r in spark.read.text(f"{folder}/evaluation_html").collect())
    assert "<polyline" in page and "Comparison" in page and report_["roc"][-1] == (1.0, 1.0)
    scorer = md.ModelScore.saved(spark, folder)
    rows = df.select("id", F.when(F.col("id") > 0, F.struct("a", "b")).alias("f"))
    done = {r["id"]: r["s"] for r in scorer.apply(rows, "f", "s").collect()}
    plain = {r["id"]: r["score"] for r in md.scored(scorer.model, df).collect()}
    assert all(done[i] == pytest.approx(plain[i]) for i in range(1, 240)) and done[0] is not None


def test_near_constant(spark):
    df = spark.range(1000).select(F.lit(1).alias("a"), F.when(F.col("id") < 4, 1).alias("b"), F.col("id").alias("c"))
    got = {r["feature"]: (r["constant"], r["near_constant"]) for r in mx.near_constant(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (True, True), "b": (False, True), "c": (False, False)}


def test_run_conserves_rows(spark, tmp_path):
    rows = [(str(i), t, (lang, s, "good" if i % 2 else None)) for i, (t, lang, s) in enumerate([("Ciao a tutti, questo è un testo.", "it", 0.9), ("hello", "en", 0.99), ("Clicca qui https://bit.ly/x subito", "it", 0.8), ("", "it", 0.9), ("x", "it", 0.75)])]
    docs = spark.createDataFrame(rows, "id string, text string, meta struct<language: string, language_score: double, label: string>")
    funnel = run(docs, Config(output=str(tmp_path)), lambda s: F.when(s["url_count_text"] > 0, 0.9).otherwise(0.1), lambda q: F.when(q["length"] > 5, 0.9).otherwise(0.1))
    assert {r["stage"]: r["count"] for r in funnel.collect()} == {"clean": 1, "language": 2, "spam": 1, "quality": 1}
    assert spark.read.option("header", True).csv(f"{tmp_path}/spam_features").columns[-1] == "ham_business_density"
    assert spark.read.json(f"{tmp_path}/clean").count() == 1


def test_command_line_with_saved_models(spark, tmp_path):
    """A run as from the command line, in which both models and the language scorer are used."""
    from corpusmill.__main__ import main

    df = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 + F.rand(1) / 10).alias("url_count_text"), (F.col("id") % 2 * 100 + F.rand(9)).alias("length"))
    md.save(md.fit("logistic_regression", df, ["url_count_text"]), str(tmp_path / "spam"), ["url_count_text"], 0.75)
    md.save(md.fit("logistic_regression", df, ["length"]), str(tmp_path / "quality"), ["length"], 0.65)
    (tmp_path / "in").mkdir()
    long = "Questo è un testo per la prova della lingua, che non è breve e che dice più di una cosa. " * 3
    (tmp_path / "in/a.jsonl").write_text("\n".join(['{"id": "1", "text": "%s"}' % long, '{"id": "2", "text": "the cat is in the house and on the roof"}', '{"id": "3", "text": "Clicca qui https://bit.ly/x è per te, che non hai più della tua offerta", "metadata": {"language": "it", "language_score": 0.99}}']))
    done = main(["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--lang-threshold", "0.5", "--spam-model", str(tmp_path / "spam"), "--quality-model", str(tmp_path / "quality")])
    assert {r["stage"]: r["count"] for r in done.collect()} == {"clean": 1, "language": 1, "spam": 1}


def test_config(tmp_path):
    (tmp_path / "c").write_text("LANGUAGE=fr\nTHRESHOLD_SPAM=0.5\nLANG_THRESHOLD=0.1\n")
    c = Config.load(["--config", str(tmp_path / "c"), "--language", "de"], {"THRESHOLD_SPAM": "0.6"})
    assert (c.language, c.threshold_spam, c.lang_threshold, c.threshold_quality) == ("de", 0.6, 0.1, 0.65)


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "text": "ciao", "label": "good", "metadata": {"language": "it"}}\n{"id": "2", "text": ""}\n')
    row = io.read_documents(spark, str(tmp_path)).collect()
    assert [(r["id"], r["metadata"]) for r in row] == [("1", {"label": "good", "language": "it"})]
    (tmp_path / "f.csv").write_text("a,label\n1,good\n2,ugly\n")
    with pytest.raises(ValueError, match="ugly"):
        io.read_features(spark, str(tmp_path / "f.csv"), ["a"], "label")
    with pytest.raises(ValueError, match="missing"):
        io.read_features(spark, str(tmp_path / "f.csv"), ["b"], "label")
    (tmp_path / "s.csv").write_text("a,spam_target_label\nx,ham\n2, SPAM \n3,odd\n")
    df, names = io.read_spam_features(spark, str(tmp_path / "s.csv"), ["a", "b"])
    assert names == ["a"] and sorted((r["a"], r["y"]) for r in df.collect()) == [(0.0, 0), (2.0, 1)]
    with pytest.raises(ValueError):
        io.union_parts([df, df.select("a")])


def test_stream(spark, tmp_path):
    from corpusmill.streaming import curation as st

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"id": "1", "text": "ciao a tutti", "meta": {"language": "it", "language_score": 0.9}}\n')
    q = st.start(st.read_stream(spark, str(tmp_path / "in")), Config(output=str(tmp_path / "out")), lambda s: F.lit(0.0), lambda q: F.lit(1.0), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.json(f"{tmp_path}/out/batch=0/clean").count() == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/batch=0/quality_features").count() == 1


def test_html():
    m = {"tn": 1, "fp": 2, "fn": 3, "tp": 4, "roc_auc": 0.5}
    page = report.html({"metrics": m, "classes": [{"class": "0", "f1": 0.25}], "importance": [{"feature": "a<b", "share": 40.0}]})
    assert "0.2500" in page and "a&lt;b" in page and report.console([{"a": 1.0}]) == "a     \n1.0000"
