from __future__ import annotations

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palate import lexicons
from palate.functions.polarity import PolarityRules
from palate.operators import aspects, features, metrics, models, sampling, topics
from palate.operators.features import TermRules
from palate.plans import training

GOOD = ["love this great taste", "excellent fresh coffee", "great value and great taste", "delicious, would buy again"]
BAD = ["stale and awful", "broken box, never again", "terrible taste, awful smell", "late and damaged package"]


@pytest.fixture(scope="module")
def texts(spark):
    chooser = random.Random(3)
    rows = [
        (f"r{i}", f"{chooser.choice(GOOD if i % 2 else BAD)} number{i % 17}", i % 2, chooser.choice(["train", "train", "validation", "test"]))
        for i in range(240)
    ]
    return spark.createDataFrame(rows, "record_id string, clean_text string, label int, dataset_split string").cache()


def brute_tfidf(docs, low_df, high_df, size):
    grams = {}
    for doc, text in docs:
        tokens = [t for t in text.lower().replace(",", " ").split() if len(t) > 1]
        grams[doc] = Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])])
    df = Counter(t for g in grams.values() for t in g)
    cf = sum(grams.values(), Counter())
    kept = [t for t in df if low_df <= df[t] <= high_df * len(docs)]
    vocabulary = set(sorted(kept, key=lambda t: (-cf[t], t))[:size])
    out = {}
    for doc, counts in grams.items():
        w = {t: (1 + math.log(c)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, c in counts.items() if t in vocabulary}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.update({(doc, t): v / norm for t, v in w.items()})
    return out


def test_tfidf_equals_brute_force_and_vectors_equal_weights(texts):
    rules = TermRules(low=1, high=2, min_df=3, max_df=0.5, max_features=40)
    docs = [(r["record_id"], r["clean_text"]) for r in texts.collect()]
    fitted = features.fit_tfidf(texts, "clean_text", rules)
    expected = brute_tfidf(docs, 3, 0.5, 40)
    weights = {(r["doc"], r["term"]): r["weight"] for r in fitted.weights(texts, "record_id", "clean_text").collect()}
    assert weights.keys() == expected.keys()
    assert all(weights[k] == pytest.approx(expected[k]) for k in weights)
    names = {r["id"]: r["term"] for r in fitted.terms.collect()}
    assert [names[i] for i in range(40)] == sorted(names.values())
    for row in fitted.vectors(texts, "clean_text", ["record_id"]).collect():
        found = {(row["record_id"], names[int(i)]): v for i, v in zip(row["features"].indices, row["features"].values)}
        assert found == pytest.approx({k: v for k, v in expected.items() if k[0] == row["record_id"]})


def test_vectors_need_no_shuffle_and_survive_unknown_text(spark, texts, capsys):
    fitted = features.fit_tfidf(texts, "clean_text", TermRules(max_features=10))
    unknown = spark.createDataFrame([("a", "zzz qqq"), ("b", None)], "k string, t string")
    vectors = fitted.vectors(unknown.filter("t is not null"), "t", ["k"])
    assert vectors.first()["features"].numNonzeros() == 0
    vectors.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_vocabulary_is_not_ranked_in_one_task(spark, texts, capsys):
    chosen = features.vocabulary(texts, "clean_text", texts.count(), TermRules(max_features=10))
    assert chosen.count() == 10
    chosen.explain()
    assert "TakeOrdered" not in capsys.readouterr().out
    with pytest.raises(ValueError, match="max_features"):
        features.fit_tfidf(texts, "clean_text", TermRules()).vectors(texts, "clean_text", ["record_id"])


def test_ranks_are_those_of_one_sort(spark):
    from palate.operators.ranks import ranked

    rows = spark.range(500).select((F.col("id") * 7919 % 500).alias("x"), F.col("id"))
    found = ranked(rows, F.desc("x"), F.col("id")).collect()
    assert [r["x"] for r in sorted(found, key=lambda r: r["rank"])] == list(range(499, -1, -1))
    assert sorted(r["rank"] for r in found) == list(range(1, 501))


def test_requests_all_get_an_answer(spark, texts):
    rules = TermRules(max_features=50)
    fitted = features.fit_tfidf(texts, "clean_text", rules)
    model = models.TextModel(fitted, models.logistic_regression(fitted.vectors(texts, "clean_text", ["label"])), "logistic_regression")
    bodies = ['{"texts": ["a", "b"]}', '{"texts": []}', "[]", "not json", '{"texts": null}', '["x", null]', "[1, 2]", '{"other": ["a"]}', None, '["twice"]', '["twice"]']
    rows = spark.createDataFrame([(min(i, 9), b) for i, b in enumerate(bodies)], "id int, body string")
    found = sorted((r["id"], r["answer"]) for r in models.score_json(model, rows, "id").collect())
    sizes = [len(json.loads(a).get("predictions", [])) if "error" not in json.loads(a) else None for _, a in found]
    assert sizes == [2, 0, 0, None, None, None, None, None, None, 1, 1]


def test_fitted_vocabulary_is_stored_whole(spark, texts, tmp_path):
    rules = TermRules(low=1, high=2, min_df=2, max_features=30, accents=False, stop_words=["and"])
    fitted = features.fit_tfidf(texts, "clean_text", rules)
    fitted.save(str(tmp_path / "v"))
    loaded = features.Tfidf.load(spark, str(tmp_path / "v"))
    assert (loaded.rules, loaded.size) == (fitted.rules, fitted.size)
    counted = features.Tfidf(TermRules(min_df=3, max_df=5, max_features=30), fitted.terms, 30)
    counted.save(str(tmp_path / "w"))
    again = features.Tfidf.load(spark, str(tmp_path / "w")).rules
    assert again == counted.rules and isinstance(again.max_df, int) and isinstance(again.min_df, int)
    one = {(r["doc"], r["term"], r["weight"]) for r in fitted.weights(texts, "record_id", "clean_text").collect()}
    assert one == {(r["doc"], r["term"], r["weight"]) for r in loaded.weights(texts, "record_id", "clean_text").collect()}


def test_sequences(spark):
    docs = spark.createDataFrame([(1, "good good bad"), (2, "bad good, zebra good"), (3, "")], "d int, t string")
    terms = features.sequence_vocabulary(docs, "t", 4)
    assert {(r["term"], r["id"]) for r in terms.collect()} == {("good", 2), ("bad", 3)}
    found = {r["doc"]: r["ids"] for r in features.encode_sequences(docs, terms, "d", "t", 4).collect()}
    assert found == {1: [2, 2, 3, 0], 2: [3, 2, 1, 2], 3: [0, 0, 0, 0]}


def scores(spark, n=400, ties=True):
    chooser = random.Random(5)
    rows = [(i, chooser.randint(0, 1), round(chooser.random(), 1 if ties else 9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, label int, score double")


@pytest.mark.parametrize("ties", [True, False])
def test_ranking_measures_equal_brute_force(spark, ties):
    rows, df = scores(spark, ties=ties)
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    ap = 0.0
    for t in {s for _, _, s in rows}:
        caught = sum(s >= t for s in pos)
        ap += sum(s == t for s in pos) / len(pos) * caught / (caught + sum(s >= t for s in neg))
    assert metrics.roc_auc(df).first()[0] == pytest.approx(auc)
    assert metrics.average_precision(df).first()[0] == pytest.approx(ap)


@pytest.mark.parametrize("n", [500, 5000])
def test_missing_scores_rank_lowest_at_any_size(spark, n):
    """A quarter null, an eighth NaN, the rest distinct: the same pattern, below and above 2,000 scores."""
    chooser = random.Random(n)
    rows = [(chooser.randint(0, 1), None if i % 4 == 0 else float("nan") if i % 8 == 1 else chooser.random()) for i in range(n)]
    ranked = sorted((float("-inf") if s is None or s != s else s, y) for y, s in rows)
    below = won = 0.0
    positives = sum(y for _, y in ranked)
    for value in sorted({s for s, _ in ranked}) if n < 1000 else []:
        here = [y for s, y in ranked if s == value]
        won += sum(here) * (below + here.count(0) / 2)
        below += here.count(0)
    found = metrics.ranking_metrics(spark.createDataFrame(rows, "label int, score double")).first()
    if n < 1000:
        assert found["roc_auc"] == pytest.approx(won / (positives * (n - positives)))
    plain = [(y, -1.0 if s is None or s != s else s) for y, s in rows]
    assert found.asDict() == pytest.approx(metrics.ranking_metrics(spark.createDataFrame(plain, "label int, score double")).first().asDict())


def test_ranking_measures_of_billions_of_rows(spark):
    df = spark.createDataFrame([(1, 0.9, 4_000_000_000), (0, 0.1, 4_000_000_000)], "label int, score double, n bigint")
    assert metrics.ranking_metrics(df, weight="n").first().asDict() == {"roc_auc": 1.0, "average_precision": 1.0}


def test_ranking_measures_of_one_score_and_of_one_class(spark):
    flat = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert metrics.ranking_metrics(flat).first().asDict() == {"roc_auc": 0.5, "average_precision": 0.5}
    single = spark.createDataFrame([(0, 0.5), (0, 0.7)], "label int, score double")
    assert metrics.ranking_metrics(single).first().asDict() == {"roc_auc": 0.0, "average_precision": 0.0}


def test_evaluate_equals_the_single_measures(spark):
    _, df = scores(spark)
    df = df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    found = metrics.evaluate(df)
    expected = {**metrics.binary_metrics(df).first().asDict(), **metrics.weighted_metrics(df).first().asDict()}
    assert {k: found[k] for k in expected} == pytest.approx(expected)


def test_zero_division_gives_zero(spark):
    never = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    found = metrics.binary_metrics(never).first()
    assert (found["precision"], found["recall"], found["f1"], found["balanced_accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_class_report_with_a_class_that_is_only_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "label string, prediction string")
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert report["b"]["support"] == 0 and report["b"]["f1"] == 0.0 and report["macro avg"]["support"] == 3
    assert report["weighted avg"]["recall"] == pytest.approx(2 / 3)


def test_sentiment_training_end_to_end(spark, texts):
    run = training.train_sentiment(
        texts.dropDuplicates(["clean_text"]), TermRules(low=1, high=2, min_df=2, max_features=200, accents=False)
    )
    assert {r["model"] for r in run.results.collect()} == {"logistic_regression", "linear_svm", "naive_bayes"}
    final = {r["measure"]: r["value"] for r in run.report.filter("part = 'test'").collect()}
    assert final["f1"] > 0.9 and final["roc_auc"] > 0.9
    requests = spark.createDataFrame(
        [(1, json.dumps({"texts": [GOOD[0], BAD[0]]})), (2, json.dumps([BAD[1]]))], "id int, body string"
    )
    answers = {r["id"]: json.loads(r["answer"]) for r in models.score_json(run.model, requests, "id").collect()}
    assert answers[1]["predictions"] == [1, 0] and answers[2]["predictions"] == [0]
    assert len(answers[1]["positive_probabilities"]) == 2


def test_baseline_survives_storage(texts):
    found = training.train_baseline(texts, TermRules(low=1, high=2, min_df=2, max_features=100))
    rows = found.collect()
    assert rows and sum(r["label"] == r["prediction"] for r in rows) / len(rows) > 0.9


def test_models_work_after_an_observed_write(spark, texts, tmp_path):
    from palate.sources.tables import verified_write

    verified_write(texts, str(tmp_path / "t"))
    parts = {"train": texts.filter("dataset_split = 'train'"), "test": texts.filter("dataset_split = 'test'")}
    pipelines = {"logistic_regression": models.research_pipelines()["logistic_regression"]}
    results, _ = models.compare_models(pipelines, parts["train"], {"balanced": parts["test"]})
    assert results.first()["accuracy"] > 0.9


def test_select_model_breaks_ties_by_average_precision(spark):
    rows = spark.createDataFrame([("a", 0.5, 0.1), ("b", 0.5, 0.2), ("c", 0.4, 0.9)], "model string, f1 double, average_precision double")
    assert models.select_model(rows).first()["model"] == "b"


def test_class_weights(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (1,)], "label int")
    assert {r["label"]: r["weight"] for r in features.class_weights(rows).collect()} == pytest.approx({0: 2.0, 1: 2 / 3})


def test_aspect_layer_and_review_scoring(spark):
    chooser = random.Random(1)
    parts = ["great taste", "awful taste", "box was broken", "nice box", "nothing here", "i like it"]
    rows = [(f"s{i}", f"r{i // 3}", " ".join(chooser.sample(parts, 2)) + f" w{i % 13}") for i in range(600)]
    sentences = spark.createDataFrame(rows, "sentence_id string, record_id string, sentence_text string")
    context = [c for c in training.PREDICTION_CONTEXT if c not in sentences.columns]
    sentences = sentences.withColumns({c: F.lit(1) for c in context})
    lexicon = {"taste": ["taste"], "packaging": ["box"]}
    run = training.aspect_layer(
        sentences, lexicon, PolarityRules(lexicons.SEED_VALENCE, lexicons.SEED_NEGATORS), TermRules(min_df=2, max_features=100, accents=False)
    )
    measures = {(r["part"], r["measure"]): r["value"] for r in run.report.collect()}
    assert measures["test", "micro_f1"] > 0.95 and measures["validation", "hamming_loss"] < 0.05
    assert {r["aspect"] for r in run.summary.collect()} == {"taste", "packaging"}
    reviews = spark.createDataFrame([(1, "Great taste!\nThe box was broken. Nothing here, i like it.")], "id int, text string")
    found = models.score_reviews(run.model, reviews, "id", "text", PolarityRules(lexicons.SEED_VALENCE, lexicons.SEED_NEGATORS))
    by_sentence = {r["sentence_number"]: r for r in found.collect()}
    blank = spark.createDataFrame([(2, None), (3, " \n ")], "id int, text string")
    answers = models.score_reviews(run.model, blank, "id", "text", PolarityRules(lexicons.SEED_VALENCE, lexicons.SEED_NEGATORS)).collect()
    assert sorted((r["id"], r["aspect"], r["sentiment"]) for r in answers) == [(2, models.NO_TEXT, None), (3, models.NO_TEXT, None)]
    assert run.predictions.select("sentence_id").distinct().count() > 400
    assert [by_sentence[n]["aspect"] for n in (1, 2, 3)] == ["taste", "packaging", models.NO_ASPECT]
    assert [by_sentence[n]["sentiment"] for n in (1, 2, 3)] == ["positive", "negative", "negative"]  # "nothing ... like"


def test_topics_find_separate_vocabularies(spark):
    rows = [("apple pear plum " * 3,)] * 30 + [("steel iron zinc " * 3,)] * 30
    found = topics.fit_topics(
        spark.createDataFrame(rows, "t string"), "t", TermRules(min_df=2, max_features=50), topics=2, iterations=20, top=3
    ).collect()
    words = {k: {r["term"] for r in found if r["topic"] == k} for k in (0, 1)}
    assert sorted(map(sorted, words.values())) == [["apple", "pear", "plum"], ["iron", "steel", "zinc"]]


def test_lexicon_hits(spark):
    rows = spark.createDataFrame([("a", "taste taste box"), ("b", "taste")], "sentence_id string, sentence_text string")
    found = {(r["aspect"], r["term"]): (r["hits"], r["rows_hit"]) for r in aspects.lexicon_hits(rows, {"t": ["taste"], "p": ["box"]}).collect()}
    assert found == {("t", "taste"): (3, 2), ("p", "box"): (1, 1)}


def test_hashed_sample_feeds_training(texts):
    assert sampling.balance_train(texts, cap=10).groupBy("label").count().collect()
