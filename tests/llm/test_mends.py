"""Results that do not depend on size, order or missing ids, each against a plain version."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakezones.llm import fingerprints, mixing, near_dedup, quality_classifier, quality_rules
from lakezones.llm.queries import QUERIES
from tests.llm.test_documents import five
from tests.llm.test_near_dedup import edited, groups

SMALL = "/root/testdata/sf0.001"


# -- Near duplicates -----------------------------------------------------------------------------


@pytest.mark.parametrize("similarity", [50, 70, 90])
def test_links_at_other_thresholds(docs, prose, similarity):
    rows = []
    for base in range(25):
        text = prose(base, 150)
        # Just around the threshold.
        share = {50: 0.065, 70: 0.035, 90: 0.01}[similarity]
        rows += [(len(rows), text), (len(rows) + 1, edited(text, share, base)), (len(rows) + 2, edited(text, share / 2, base + 99))]
    found = near_dedup.near_duplicates(docs(rows), 5, similarity).collect()
    assert {row.doc_id: row.component_id for row in found} == groups(rows, 5, similarity)


def test_least_matches():
    assert [near_dedup.least_matches(s) for s in (100, 80, 50)] == [64, 37, 16]
    for similarity in (5, 0, 101):
        with pytest.raises(ValueError):
            near_dedup.least_matches(similarity)


def test_rows_that_repeat_send_one_set(spark, docs, prose):
    text = prose(1, 200)
    rows = [(None, text)] * 400 + [(7, edited(text, 0.01, 5)), (8, text)] + [(9, prose(2, 80))] * 3
    found = near_dedup.near_duplicates(docs(rows, 4), 4, 80).collect()
    assert Counter((row.doc_id, row.component_id) for row in found) == {(None, 7): 400, (7, 7): 1, (8, 7): 1, (9, 9): 3}
    sketched, nodes = near_dedup.classes(docs(rows, 4), 4)
    repeated = near_dedup.repeated_rows(sketched)
    assert sorted(map(str, (row.doc_id for row in repeated.collect()))) == ["9", "None"]
    blocks = nodes.select(F.lit(1).cast("bigint").alias("block"), "node", F.lit(2).alias("part"), F.col("node").alias("component"))
    made = []
    links = near_dedup.confirmed(blocks, docs(rows, 4), nodes, repeated, 4, 80)
    made = links.collect()
    assert len(made) == 1


# -- Fingerprints --------------------------------------------------------------------------------


def test_contained_passages(spark, docs, prose):
    rows, inside = [], {}
    for i in range(120):
        words = prose(i, 300).split()
        start = random.Random(i).randint(0, 280)
        inside[i] = 5 + i % 5
        rows += [(i, " ".join(words)), (1000 + i, " ".join(words[start : start + inside[i]]))]
    worded = docs(rows).select("doc_id", fingerprints.split_words(F.col("text")).alias("words"))
    sketched = worded.select("doc_id", fingerprints.sketch(F.col("words")).alias("s"))
    pairs = sketched.alias("a").join(sketched.alias("b"), F.col("a.doc_id") == F.col("b.doc_id") + 1000)
    found = pairs.select(fingerprints.containment(F.col("a.s"), F.col("b.s")).alias("c"), F.col("a.doc_id")).collect()
    values = Counter(row.c for row in found)
    assert set(values) <= {1.0, None} and values[1.0] > 20
    # The sketch of both texts is that of all their shingles.
    every = {doc_id: text for doc_id, text in rows}
    for number in (0, 1):
        a, b = (fingerprints.sketch(F.col(name)) for name in ("wa", "wb"))
        short = [(i, every[1000 + i], every[1000 + (i + 7) % 120]) for i in range(120)]
        df = spark.createDataFrame(short, "i int, a string, b string").select(
            "i", fingerprints.split_words(F.col("a")).alias("wa"), fingerprints.split_words(F.col("b")).alias("wb")
        )
        hashes = F.array_sort(F.array_distinct(F.concat(fingerprints.shingle_hashes(F.col("wa"), 5), fingerprints.shingle_hashes(F.col("wb"), 5))))
        rows_found = df.select(fingerprints.merged(a, b).alias("m"), hashes.alias("h")).collect()
        limit = fingerprints.LEAST_LONG + (1 << 64) // fingerprints.SCALE
        assert all(row.m == ([h for h in row.h if h < limit] or row.h[:1]) for row in rows_found)


def fingerprints_by_hand(spark, rows):
    """All columns of the fingerprints, rows in order, with sketches of single texts."""
    hashes = spark.createDataFrame(list(enumerate(text or "" for _, text in rows)), "i int, text string").select("i", F.xxhash64("text"))
    hashes = dict(hashes.collect())
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), hashes[i]))
    texts = [rows[i][1] or "" for i in order]
    changed = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, texts[1:] + texts[:1])]
    words = spark.createDataFrame(list(enumerate(texts + changed)), "i int, text string").select("i", fingerprints.split_words(F.col("text")).alias("w"))
    limit = fingerprints.LEAST_LONG + (1 << 64) // fingerprints.SCALE
    kept = {}
    for row in words.select("i", fingerprints.shingle_hashes(F.col("w"), 5).alias("h")).collect():
        kept[row.i] = sorted({h for h in row.h if h < limit}) or sorted(row.h)[:1]
    text = lambda k: "".join(f"{h & (1 << 64) - 1:016x}" for h in kept[k])

    def alike(a, b):
        a, b = set(kept[a]), set(kept[b])
        return len(a & b) / len(a | b) if a | b else 1.0

    n = len(rows)
    return sorted(
        str((rows[i][0], len(texts[k]), text(k), text(n + k), round(alike(k, n + k), 9), round(alike(k, (k + 1) % n), 9)))
        for k, i in enumerate(order)
    )


def shown(df):
    columns = df.select("doc_id", "n_chars", "fingerprint", "edited_fingerprint", F.round("near_edited", 9), F.round("near_next", 9))
    return sorted(str(tuple(row)) for row in columns.collect())


@pytest.mark.parametrize("range_bytes", [300, 5000, 1 << 30])
def test_fingerprints_of_rows_without_id(spark, docs, prose, monkeypatch, range_bytes):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", range_bytes)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, prose(i % 70, 5 + i)) for i in range(120)]
    rows += [(None, prose(3, 40))] * 30 + [(5, prose(4, 30))] * 9 + [(5, None), (5, ""), (None, None), (7, "x")]
    assert shown(fingerprints.fingerprint_documents(docs(rows, 5))) == fingerprints_by_hand(spark, rows)


def test_hot_rows_are_in_many_ranges(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 2000)
    rows = [(None if i % 3 else 11 if i % 2 else i, prose(i, 30)) for i in range(600)]
    placed, _ = fingerprints.with_next(docs(rows, 4).select("doc_id", "text"))
    sizes = [row["count"] for row in placed.filter("doc_id IS NULL AND NOT copy").groupBy("range").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 100


def test_registered_fingerprints(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(QUERIES["op4_document_fingerprints"](spark, SMALL)) == fingerprints_by_hand(spark, rows)
    assert five("a b") == {("a", "b")}


# -- Mixing --------------------------------------------------------------------------------------


def test_documents_without_words_stay_below_the_limit(docs, prose):
    rows = [(i, "" if i % 2 else prose(i, 20), "a") for i in range(40)] + [(100 + i, prose(i, 400), "b") for i in range(40)]
    found = mixing.mix_sources(docs(rows)).collect()
    clamped = [row for row in found if row.target == 3 * row.source_size]
    assert clamped and {row.copies for row in clamped} == {3}
    assert Counter(row.doc_id for row in mixing.mixed_documents(docs(rows)).collect()) == {row.doc_id: row.copies for row in found if row.copies}


def test_rows_without_id_do_not_move_as_one(docs, prose):
    rows = [(None, prose(i, 30), "a") for i in range(300)] + [(i, prose(i, 30), "b") for i in range(300)]
    found = mixing.mix_sources(docs(rows)).collect()
    for target in {row.target for row in found}:
        taken = sum(row.taken for row in found if row.target == target)
        assert abs(taken - target) <= 30
    copies = Counter(row.copies for row in found if row.doc_id is None)
    assert len(copies) == 2
    assert sum(copies_of * n for copies_of, n in copies.items()) == mixing.mixed_documents(docs(rows)).filter("doc_id IS NULL").count()


# -- Classifier ----------------------------------------------------------------------------------


@pytest.fixture
def labelled(docs, prose):
    rows = [(i, prose(i, 40 + i) if i % 2 else f"buy now!!! {i} $$$ " * (3 + i % 7)) for i in range(160)]
    return rows, [(i, i % 2) for i in range(160)]


def test_scores_do_not_depend_on_the_order_of_rows(spark, docs, labelled):
    rows, marks = labelled
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    runs = []
    for partitions in (1, 3, 8):
        found = quality_classifier.score_documents(docs(rows, partitions), labels.repartition(partitions))
        runs.append({row.doc_id: row.score for row in found.collect()})
    assert runs[0] == runs[1] == runs[2]


def test_normal_equations_directly(spark, docs, labelled):
    """The model against a fit of the same features in one place."""
    rows, marks = labelled
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    training = quality_classifier.training_rows(quality_classifier.described(docs(rows)), labels, F.lit(True))
    model = quality_classifier.train(training)
    values = np.array([quality_classifier.statistics(text) for _, text in rows])
    target = np.array([mark for _, mark in marks], float)
    # Standardised by mean and deviation, as the sums say.
    assert np.allclose(model.mean, values.mean(0), atol=1e-5)
    deviation = values.std(0)
    assert np.allclose(model.scale, np.where(deviation > 1e-9, deviation, 1), atol=1e-4)
    features = np.hstack(
        [np.cos(np.clip((values - model.mean) / model.scale, -8, 8) @ model.directions + model.phases) * np.sqrt(2 / len(model.phases)),
         np.ones((len(values), 1))]
    )
    penalty = np.eye(features.shape[1]) * quality_classifier.RIDGE * len(values)
    penalty[-1, -1] = 0
    direct = np.linalg.solve(features.T @ features + penalty, features.T @ target)
    assert np.abs(features @ direct - model.raw(values)).max() < 0.01
    # Calibrated scores rise with the raw ones, and are right on average.
    raw, score = model.raw(values), model.score(values)
    assert (np.diff(score[np.argsort(raw)]) >= -1e-12).all()
    assert abs(score.mean() - target.mean()) < 0.02


# -- Names ---------------------------------------------------------------------------------------


def test_names_with_dots_pass_through_the_stages(spark, docs, labelled):
    rows, marks = labelled
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    named = docs(rows).withColumns({"a.b": F.lit(1), "c d`e": F.lit("x")})
    kept = quality_classifier.accepted_documents(named, labels)
    assert kept.columns == named.columns and 0 < kept.count() < len(rows)
    assert {row["a.b"] for row in kept.collect()} == {1}
    passing = quality_rules.passing_documents(named)
    assert passing.columns == named.columns and passing.count() > 0
    assert {row["c d`e"] for row in passing.collect()} == {"x"}
    assert mixing.mixed_documents(passing).columns == named.columns
    assert near_dedup.one_of_each_group(passing).columns == named.columns
