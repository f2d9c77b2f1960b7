"""Severity, language model, licences, quality and decontamination."""

import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import decontamination, licences, maxent, quality, toxicity
from rivulet.llm.tables import read


def test_fitting_takes_little_more_memory_than_the_sample():
    """The driver fits, next to a heap that has most of its memory."""
    rng = np.random.default_rng(1)
    lengths, words = rng.integers(100, 300, 2000), np.arange(5000)
    columns, grade = rng.integers(0, len(words), lengths.sum()).astype(np.int32), rng.integers(0, 3, len(lengths))
    tracemalloc.start()
    model = toxicity._fitted(words, grade, np.ones(len(lengths)), lengths, columns)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.thresholds) == 2 and most < 3.7 * columns.nbytes


def test_severity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where("doc_id % 4 <> 0"))
    assert np.all(np.diff(model.thresholds) >= 0)
    told = toxicity.scored(docs, model).withColumnRenamed("toxic", "told").join(labels.where("doc_id % 4 = 0"), "doc_id")
    counts = {(r.toxic, r.told): r["count"] for r in told.groupBy("toxic", "told").count().collect()}
    clean = counts.get((0, False), 0) + counts.get((0, True), 0)
    assert counts.get((0, True), 0) <= 0.01 * clean
    assert counts.get((1, True), 0) > 2 * counts.get((1, False), 0)
    means = told.groupBy("toxic").agg(F.avg("severity").alias("m"))
    means = {r.toxic: r.m for r in means.collect()}
    assert means[1] > 3 * means[0]


def test_severity_of_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, 1), (7, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd_docs, labels)
    assert toxicity.scored(odd_docs, model).count() == odd_docs.count()
    assert toxicity.without_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.scored(no_docs, model).count() == 0
    nothing = toxicity.fit(odd_docs, labels.limit(0))
    assert toxicity.without_toxic(odd_docs, nothing).count() == odd_docs.count()


def test_base_scores(monkeypatch, odd_docs, odd_rows, no_docs):
    monkeypatch.setattr(maxent, "HEAD", 20)
    found = sorted((tuple(r) for r in maxent.scored(odd_docs).collect()), key=lambda r: (str(r[0]), r[2]))
    told = sorted(brute.unigram_scores(odd_rows), key=lambda r: (str(r[0]), r[2]))
    assert [r[:5] for r in found] == [r[:5] for r in told]
    assert np.allclose([r[5] for r in found], [r[5] for r in told], atol=1e-6)
    assert maxent.scored(no_docs).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = maxent.scored(read(spark, "/root/testdata/sf0.01", "documents")).where("held_out")
    base, score = rows.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_every_training_token_is_learned_from(spark):
    # Each text has words of its own, so that each token has feature rows that hardly any other token meets.
    texts = [" ".join(f"w{k}x{j}" for j in range(6)) for k in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = maxent.trained(docs, maxent.counted(docs))
    for t in texts:
        for _, _, rows, found in maxent.tokens(pa.array([t])):
            at = model.class_places(maxent.context_features(rows, found, np.arange(len(found))))
            assert model.class_rows[at].any(axis=2).all()


def test_scores_do_not_depend_on_the_layout(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    one, many = (
        sorted((r.doc_id, r.score) for r in maxent.scored(docs.repartition(n, "doc_id")).collect())
        for n in (1, 8)
    )
    assert [r[0] for r in one] == [r[0] for r in many]
    assert np.allclose([r[1] for r in one], [r[1] for r in many], rtol=1e-4)


def test_scores_against_a_plain_model(spark, monkeypatch, odd_docs, odd_rows):
    monkeypatch.setattr(maxent, "HEAD", 1500)
    found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in maxent.scored(odd_docs).collect())
    told = sorted(brute.maxent_scores(odd_rows, 1500))
    assert [r[:2] for r in found] == [r[:2] for r in told]
    assert np.allclose([r[2] for r in found], [r[2] for r in told], rtol=1e-3, atol=1e-3)


def test_probabilities_add_up(spark, odd_docs):
    docs = odd_docs.select(F.col("text")).where("text IS NOT NULL")
    vocabulary = maxent.counted(docs)
    model = maxent.trained(docs, vocabulary)
    words = vocabulary.toPandas()
    hashes = words["hash"].to_numpy().view(np.uint64)
    total = 0.0
    for h, n in zip(hashes, words["n"]):
        found = np.array([hashes[0], hashes[1], h])
        counts, ids = model.looked_up(found)
        score = maxent._scores(model, np.zeros(3, int), found, counts, ids)[2]
        # A word outside the head has its share of the last class.
        total += 10 ** (score if ids[2] >= 0 else score + model.rest(np.array([n]))[0])
    unseen = 10 ** (maxent._scores(model, np.zeros(3, int), np.array([hashes[0], hashes[1], np.uint64(5)]), np.array([0, 0, -1]), np.array([-1, -1, -1]))[2] + model.rest(np.array([0]))[0])
    assert abs(total + unseen - 1) < 1e-3


def test_licences(spark, no_docs):
    texts = [
        "Some prose.\nReleased under the MIT License.",
        "Copyright 2020 Somebody\nLicensed under the Apache License, Version 2.0.\n\nMore.",
        "we released a licence under no terms",
        None,
        "",
        "RELEASED   under the MIT license",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.licences for r in licences.scanned(docs).collect()}
    assert found == {0: "MIT", 1: "Apache-2.0", 2: "", 3: "", 4: "", 5: "MIT"}
    assert licences.scanned(no_docs).count() == 0


def test_licence_pruning_loses_nothing():
    made = licences.Templates(licences.TEMPLATES, licences.THRESHOLD)
    every = [t for texts in licences.TEMPLATES.values() for t in texts]
    for text in every:
        w = text.split()
        for cut in range(len(w)):
            unit = " ".join(w[:cut] + w[cut + 1 :])
            grams = licences.bigrams(unit)
            best = max(
                (2 * sum((grams & t).values()) / max(1, sum(grams.values()) + n) for n, _, t in made.made), default=0
            )
            assert (made.best(unit) is not None and made.may_match(unit)) or best < licences.THRESHOLD


def test_quality_of_odd_texts(odd_docs, odd_rows, no_docs):
    found = quality.judged(odd_docs).collect()
    assert len(found) == len(odd_rows)
    for r, (i, t) in zip(sorted(found, key=lambda r: (str(r.doc_id), r.n_words)), sorted(odd_rows, key=lambda x: (str(x[0]), len(brute.words(x[1]))))):
        w = brute.WORD.findall(t or "")
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
        assert (r.doc_id, r.n_words, r.word_chars, r.n_repeat_words) == (i, len(w), sum(map(len, w)), len(again))
        assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert quality.judged(no_docs).count() == 0


QUESTION = "Yesterday the farmer Ann sold 12 kg of apples to Ben and then Ann bought 3,5 km of rope for 40 dollars."


@pytest.mark.parametrize(
    "text, changed",
    [
        (QUESTION, 0),
        ("Some words before. " + QUESTION + " And after.", 0),
        ("x. " + QUESTION.replace("Ann", "Zoe").replace("12", "7").replace("40", "9.50"), 4),
        # One Ann of two is someone else: not the same question.
        (QUESTION.replace("Ann", "Zoe", 1), None),
        ("Yesterday the farmer sold apples and bought rope, no question here at all.", None),
        (None, None),
        ("", None),
    ],
)
def test_leaks(spark, text, changed):
    docs = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(9, QUESTION, "x"), (10, "too short", "x"), (11, None, "x")], "item_id long, text string, doc_id string")
    found = decontamination.leaks(docs, items).collect()
    assert [(r.item_id, r.n_changed) for r in found] == ([] if changed is None else [(9, changed)])
    kept = decontamination.without_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == (1 if changed is None else 0)


def test_leaks_with_a_fifth_changed(spark):
    words = "the quick brown fox jumps over a lazy dog while seven small birds sing loudly near that old stone".split()
    texts = [QUESTION]
    for shift in range(4):
        for changed in ([3, 7, 11, 15], [0, 5, 10, 15], [4, 8, 12, 16], [2, 9]):
            said = [w + "zz" if k in changed else w for k, w in enumerate(words)]
            texts.append(" ".join(["so"] * shift + said + ["end"]))
    # Any blank before a name is a blank.
    names = "we saw how Ann and Ben met Carl near Dover to sell Eve a boat"
    texts.append(names.replace(" ", "\n").replace("Carl", "Karl"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words) + " end"), (2, names)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()}
    assert found == {(k, 1) for k in range(1, 17)} | {(17, 2)}


def test_leaks_with_numbers_that_coincide_or_differ(spark):
    item = "A shop sold 12 kg of rice and 3,5 km of rope and then 12 more sacks of rice to us"
    texts = [item.replace("12", "7").replace("3,5", "7"), item.replace("12", "7", 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r.covered for r in decontamination.leaks(docs, items).collect()}
    assert found[0] == 1 and found[1] == 20 / 21


def test_leaks_without_rows(spark, no_docs, odd_docs):
    items = spark.createDataFrame([(9, QUESTION)], "item_id long, text string")
    assert decontamination.leaks(no_docs, items).count() == 0
    assert decontamination.leaks(odd_docs, items.limit(0)).count() == 0
    # The plan without a broadcast finds the same.
    docs = spark.createDataFrame([(1, QUESTION)], "doc_id long, text string")
    assert decontamination.leaks(docs, items).count() == 1


def test_every_planted_item_is_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = read(spark, folder, "documents"), read(spark, folder, "benchmark")
    held = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert held >= {(d, r.item_id) for r in items.collect() for d, t in texts if r.text in t}


def test_rows_of_one_doc_id_leak_each_for_itself(spark):
    rows = [(None, QUESTION), (None, "nothing of that kind here"), (5, "clean words only"), (5, QUESTION), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, QUESTION)], "item_id long, text string")
    kept = decontamination.without_leaks(docs, items).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([rows[1], rows[2], rows[4]], key=str)


def test_labels_of_other_documents_take_no_room(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id long, text string")
    own = [(k, 1, k % 2) for k in range(40)]
    other = [(1000 + k, 1, k % 2) for k in range(4000)]
    grades = toxicity.severity_grades(spark.createDataFrame(own + other, "doc_id long, quality int, toxic int"))
    assert toxicity.labelled_sample(docs, grades, most=60).count() == 40
    assert toxicity.labelled_sample(docs, grades, most=10).count() == 10


def metric_rows(spark, rows):
    kinds = "lang string, source string, symbol_rate long, line_rate long, repeat_rate long, length_rate long"
    return spark.createDataFrame([(lang, source, x, 2 * x, 3 * x, 4000 + x) for lang, source, x in rows], kinds)


def test_thresholds_follow_each_group(spark):
    rng = np.random.default_rng(4)
    habit = {("en", "a"): 10, ("en", "b"): 100, ("de", "a"): 40, (None, None): 70}
    rows = [(*g, int(x)) for g, top in habit.items() for x in rng.integers(0, top, 3000)] + [("en", "tiny", 900)] * 3
    limits = {(r.lang, r.source): r for r in quality.thresholds(metric_rows(spark, rows)).collect()}
    assert set(limits) == {*habit, ("en", "tiny")}
    for group, top in habit.items():
        assert 1.2 * top < limits[group].most_symbol_rate < 2.2 * top + 15
        assert limits[group].most_line_rate > 1.5 * limits[group].most_symbol_rate
    # Three documents hardly move what their language does.
    assert abs(limits["en", "tiny"].most_symbol_rate - 150) < 30
    # A group whose rates are ten times as high has thresholds to match; the others keep theirs.
    scaled = [(lang, source, 10 * x if (lang, source) == ("de", "a") else x) for lang, source, x in rows]
    moved = {(r.lang, r.source): r for r in quality.thresholds(metric_rows(spark, scaled)).collect()}
    assert moved["de", "a"].most_symbol_rate > 8 * limits["de", "a"].most_symbol_rate
    assert abs(moved["en", "b"].most_symbol_rate - limits["en", "b"].most_symbol_rate) <= 40


def test_verdicts_follow_the_group(spark):
    """The same text is kept where such texts are common and held out where they are not."""
    plain = " ".join(f"word{k}" for k in range(40))
    marked = " ".join(f"word{k}##" for k in range(40))
    rows = [(k, f"{plain} {k}", "en", "plain") for k in range(2000)] + [(3000 + k, f"{marked} {k}", "de", "marked") for k in range(2000)]
    rows += [(9000, marked, "en", "plain"), (9001, marked, "de", "marked")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r.kept for r in quality.judged(docs).collect()}
    assert found[9001] and not found[9000]
    assert sum(found.values()) == len(rows) - 1
