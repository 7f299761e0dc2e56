"""Fingerprints, quality rules, classifier, mixing and the pipeline on small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakezones.llm import bpe, fingerprints, mixing, near_dedup, quality_classifier, quality_rules
from lakezones.llm.queries import tokenizer
from lakezones.session import stage

WORD = re.compile("[^ \t\n\x0b\x0c\r]+")


def plain(df):
    return sorted(map(str, map(tuple, df.collect())))


# Fingerprints


def five(text):
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_edited_texts_and_likeness(spark, docs, prose, by_id, partitions):
    rows = [(i * 3 - 20, prose(i // 2, 10 + 37 * i)) for i in range(60)]
    rows += [(1000, ""), (1001, "é 😀x y"), (1002, " one\ntwo "), (1003, prose(9, 20_000)), (1004, prose(9, 20_000))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = by_id(fingerprints.fingerprint_documents(docs(rows, 5)))
        again = plain(fingerprints.fingerprint_documents(docs(rows, 2)))
        assert again == sorted(map(str, map(tuple, found.values())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    ordered = sorted(rows, reverse=True)
    errors = []
    for (doc_id, text), (next_id, following) in zip(ordered, ordered[1:] + ordered[:1]):
        row, half = found[doc_id], len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = five(text), five(changed), five(following)
        errors += [row["near_edited"] - len(a & b) / len(a | b), row["near_next"] - len(a & c) / len(a | c)] if a | b and a | c else []
        if changed == text:
            assert row["fingerprint"] == row["edited_fingerprint"] and row["near_edited"] == 1
    assert np.std(errors) < 0.1
    assert found[1003]["fingerprint"] == found[1004]["fingerprint"] and found[1004]["near_next"] == 1
    assert found[1000]["fingerprint"] == "" and found[1002]["fingerprint"] != ""


def test_sketches_merge_and_contain(spark, docs, prose):
    a, b = prose(1, 3000), prose(2, 300)
    rows = docs([(1, a), (2, b), (3, a + " " + b)]).withColumn("words", fingerprints.split_words(F.col("text")))
    sketches = dict(rows.select("doc_id", fingerprints.sketch(F.col("words"))).collect())
    pair = spark.createDataFrame([(sketches[1], sketches[2], sketches[3])], "a array<bigint>, b array<bigint>, c array<bigint>")
    one, two, both = map(F.col, "abc")
    merged, inside, outside = pair.select(
        fingerprints.likeness(fingerprints.merged(one, two), both), fingerprints.containment(two, both), fingerprints.containment(one, two)
    ).first()
    # Only shingles across the seam differ.
    assert merged > 0.99 and inside == 1 and outside < 0.01


def test_fingerprint_edge_rows(docs, prose):
    rows = [(None, "x y"), (None, prose(1)), (3, None), (3, "a b c d e f"), (3, "a b c d e f"), (4, "")]
    named = docs(rows).selectExpr("*", "1 AS copy", "2 AS range", "3 AS words", "'n' AS next_text")
    found = fingerprints.fingerprint_documents(named).collect()
    assert len(found) == len(rows)
    assert {r["fingerprint"] for r in found if r["n_chars"] == 11} != {""}
    assert len({r["fingerprint"] for r in found if r["n_chars"] == 11}) == 1
    assert fingerprints.fingerprint_documents(named.filter("false")).collect() == []
    (alone,) = fingerprints.fingerprint_documents(docs([(5, "a b c d e f g")])).collect()
    assert alone["near_next"] == 1 and alone["edited_sha256"] == hashlib.sha256(b"a b c d" + b"a b c " + b"").hexdigest()


@pytest.mark.parametrize("cuts", [[], [5], list(range(90, 0, -1)), [7, 3], list(range(301, 0, -7))])
def test_range_number(spark, cuts):
    values = spark.range(0, 320).select("id", fingerprints.range_number(F.col("id"), cuts).alias("n")).collect()
    assert all(row["n"] == sum(cut > row["id"] for cut in cuts) for row in values)


# Quality rules


def counts(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    joined = "".join(words)
    return (len(words), len(joined), sum(c in "#*$%&|<>" for c in joined), len(lines) - len(set(lines)), len(covered))


MENU = "Home | News | Sport | Contact | About | Shop\n"


def rule_texts(prose):
    good = "\n".join(prose(i, 40) for i in range(5))
    return {
        "good": (good, True),
        "null": (None, False),
        "empty": ("", False),
        "spaces": (" \n\t\n", False),
        "short": (prose(1, 40), False),
        "repeated": ("one two three " * 60, False),
        "lines": (good + "\nAll rights reserved.\n" + MENU * 2, True),
        "menu": (MENU * 3 + "\n".join(f"Item {i} | Price {i * 7} | Buy {i}" for i in range(40)), False),
        "symbols": ("\n".join(" ".join(f"{w}$$%" for w in prose(i, 30).split()) for i in range(4)), False),
        "frame": ("\n".join(f"{prose(i, 12)} cookie policy {prose(i + 50, 8)}" for i in range(9)), False),
        "open": ("\n".join(f"Menu{i} item{i}" for i in range(60)), False),
        "long": ("\n".join(prose(i, 60) for i in range(500)), True),
        "unicode": ("é😀 ñ。 " * 3 + "\n".join(prose(i, 60) for i in range(3)), True),
    }


def test_quality_rules(docs, prose, by_id):
    texts = rule_texts(prose)
    rows = [(i, text) for i, (text, _) in enumerate(texts.values())]
    named = docs(rows).selectExpr("*", "1 AS counts", "2 AS n_words", "false AS kept")
    found = by_id(quality_rules.apply_quality_rules(named))
    for i, (name, (text, kept)) in enumerate(texts.items()):
        row, expected = found[i], counts(text)
        assert tuple(row[1:6]) == expected, name
        assert row["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0]), name
        assert row["kept"] == kept, name
    passing = quality_rules.passing_documents(named)
    assert passing.columns == named.columns
    assert sorted(row["doc_id"] for row in passing.collect()) == [i for i, (_, kept) in enumerate(texts.values()) if kept]
    assert quality_rules.apply_quality_rules(named.filter("false")).collect() == []


def test_cleaned_text_and_repeated_rows(docs, prose):
    good = prose(1, 80)
    text = MENU + good + "\n\nAll rights reserved.\n" + good
    frame = docs([(1, text), (1, text), (None, text)])
    assert [row[0] for row in frame.select(quality_rules.cleaned_text(F.col("text"))).collect()] == [good + "\n\n" + good] * 3
    assert len(set(map(str, (row[1:] for row in quality_rules.apply_quality_rules(frame).collect())))) == 1


def test_kept_documents_lose_their_failed_lines(spark, docs, prose, by_id):
    good, end = "\n".join(prose(i, 40) for i in range(5)), prose(9, 40)
    rows = [(1, MENU + good + "\n\nAll rights reserved.\n" + end), (2, good), (3, MENU * 3 + prose(1, 10))]
    named = docs(rows).selectExpr("*", "1 AS row", "2 AS cleaned")
    found = by_id(quality_rules.passing_documents(named))
    assert {i: row["text"] for i, row in found.items()} == {1: good + "\n\n" + end, 2: good}
    assert all(row["n_chars"] == len(row["text"]) and (row["row"], row["cleaned"]) == (1, 2) for row in found.values())
    texts = by_id(corpus_pipeline.clean(spark, docs(rows), ""))
    assert {i: row["text"] for i, row in texts.items()} == {i: row["text"] for i, row in found.items()}


def test_texts_are_judged_once(docs):
    plan = quality_rules.passing_documents(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode(") == 1 and "Filter" not in plan


def test_rules_run_no_python(docs):
    plan = quality_rules.passing_documents(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Repartition")[0]


# Classifier


def labelled(prose):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(f"{w}###" for w in prose(i, 30 + i % 50).split()) if bad else prose(i, 30 + i % 50)
        rows.append((i, text))
        labels.append((i, int(not bad)))
    return rows, labels


def test_classifier(spark, docs, prose):
    rows, labels = labelled(prose)
    edge = [(1001, None), (1002, ""), (None, prose(3)), (1003, prose(5, 20_000)), (7, rows[7][1])]
    named = docs(rows + edge).selectExpr("*", "1 AS score", "2 AS quality", "3 AS statistics", "4 AS label")
    marks = spark.createDataFrame(labels + [(7, 1), (8, None), (None, 1)], "doc_id bigint, quality int")
    found = quality_classifier.score_documents(named, marks).collect()
    assert len(found) == len(rows) + len(edge) and all(0 <= row["score"] <= 1 for row in found)
    held = [(row["predicted"], dict(labels)[row["doc_id"]]) for row in found if row["held_out"] and row["doc_id"] in dict(labels)]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    assert len({row["score"] for row in found if row["doc_id"] == 7}) == 1
    kept = quality_classifier.accepted_documents(named, marks)
    assert kept.columns == named.columns
    scores = {row["doc_id"]: row["predicted"] for row in found}
    kept_ids = [row["doc_id"] for row in kept.collect()]
    assert np.mean([(i in kept_ids) == (scores[i] == 1) for i in scores]) > 0.99


def test_held_out_labels_do_not_matter(spark, docs, prose):
    rows, labels = labelled(prose)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    other = spark.createDataFrame(
        [(i, 1 - q if quality_classifier.fold_of(i) == 2 else q) for i, q in labels], "doc_id bigint, quality int"
    )
    frame = stage(docs(rows, 1))
    assert plain(quality_classifier.score_documents(frame, marks)) == plain(quality_classifier.score_documents(frame, other))


@pytest.mark.parametrize("marks, score", [([], 0.5), ([(1, 1), (3, 1)], 1.0), ([(1, 0), (3, 0)], 0.0)])
def test_classifier_without_two_kinds_of_labels(spark, docs, prose, marks, score):
    frame = spark.createDataFrame(marks, "doc_id bigint, quality int")
    found = quality_classifier.score_documents(docs([(1, prose(1)), (3, None)]), frame).collect()
    assert [row["score"] for row in found] == [score, score]
    assert quality_classifier.score_documents(docs([(1, "a")]).filter("false"), frame).collect() == []


def test_isotonic():
    rnd = np.random.default_rng(2)
    means, weights = rnd.random(200) + np.linspace(0, 1, 200), rnd.integers(1, 9, 200).astype(float)
    found = quality_classifier.isotonic(means, weights)
    assert (np.diff(found) >= 0).all() and np.isclose((found * weights).sum(), (means * weights).sum())
    # No other monotone values are nearer: moving any pool up or down is no gain.
    for pool in np.unique(found):
        rows = found == pool
        assert np.isclose(np.average(means[rows], weights=weights[rows]), pool)


# Mixing


def water_filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by the definition: clamp, reshare, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: weights[i % 3] for i, name in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in capped]
        left = total - sum(most * sizes[n] for n in capped)
        targets = {n: most * sizes[n] if n in capped else left * weight[n] / sum(weight[m] for m in free) for n in names}
        over = {n for n in free if targets[n] > most * sizes[n]}
        if not over:
            return targets
        capped |= over


def mix_rows(prose):
    rows = [(i, "w " * (1 + i % 40), "big") for i in range(600)]
    rows += [(1000 + i, "w " * 20, "tiny") for i in range(10)] + [(2000 + i, "w " * 9, None) for i in range(50)]
    rows += [(3000 + i, "w " * 30, "Zeta") for i in range(80)] + [(4000 + i, "w " * 3, "é") for i in range(30)]
    return rows + [(5000, None, "none"), (5001, "", "none"), (None, "a b c", "big"), (1, "w " * 2, "big")]


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_mixing(docs, prose, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    rows = mix_rows(prose)
    named = docs(rows).selectExpr("*", "1 AS size", "2 AS key", "3 AS target", "4 AS weight", "5 AS rank", "6 AS copies")
    found = mixing.mix_sources(named).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets = water_filled(dict(sizes))
    by_source = {}
    sources = {(i, len(WORD.findall(t or ""))): s for i, t, s in rows}
    for row in found:
        source = sources[row["doc_id"], row["size"]]
        assert row["source_size"] == sizes[source] and abs(row["target"] - targets[source]) < 1e-6
        assert row["taken"] == row["size"] * row["copies"] <= 3 * row["size"]
        by_source[source] = by_source.get(source, 0) + row["taken"]
    for source, target in targets.items():
        largest = max(len(WORD.findall(t or "")) for _, t, s in rows if s == source)
        assert abs(by_source[source] - target) <= largest
    assert plain(mixing.mix_sources(named)) == sorted(map(str, map(tuple, found)))
    repeated = mixing.mixed_documents(named)
    assert repeated.columns == named.columns
    ids = Counter(row["doc_id"] for row in repeated.collect())
    expected = Counter()
    for row in found:
        expected[row["doc_id"]] += row["copies"]
    assert ids == Counter({i: n for i, n in expected.items() if n})


def test_mixing_nothing(docs):
    empty = docs([(1, "a")]).filter("false")
    assert mixing.mix_sources(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    (row,) = mixing.mix_sources(docs([(1, None)])).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0, 0)
    (row,) = mixing.mix_sources(docs([(1, "a b c", None)])).collect()
    assert (row["target"], row["taken"]) == (3, 3)


# Pipeline


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    results, rows = {}, documents
    for name in names:
        rows = results[name] = stage(stages[name](spark, rows, folder), name)
        if name != names[-1]:
            assert rows.columns == documents.columns and rows.schema == documents.schema
    first = {row["doc_id"] for row in results[names[0]].collect()}
    scored = quality_classifier.score_documents(documents, labels).collect()
    assert np.mean([(row["doc_id"] in first) == bool(row["predicted"]) for row in scored]) > 0.99
    second = {row["doc_id"] for row in results[names[1]].collect()}
    assert second == {r["doc_id"] for r in quality_rules.apply_quality_rules(results[names[0]]).collect() if r["kept"]}
    third = {row["doc_id"] for row in results[names[2]].collect()}
    assert third == {r["doc_id"] for r in near_dedup.near_duplicates(results[names[1]]).collect() if r["kept"]}
    mixed = Counter(row["doc_id"] for row in results[names[3]].collect())
    assert mixed == Counter({r["doc_id"]: r["copies"] for r in mixing.mix_sources(results[names[2]]).collect() if r["copies"]})
    expected = bpe.round_trip_digests(results[names[3]], tokenizer("byte_bpe_50k.json"))
    assert plain(results[names[4]]) == plain(expected)
    assert plain(corpus_pipeline.run(spark, folder)) == plain(expected)


def test_pipeline_on_no_documents(spark, docs):
    rows = docs([(1, "a")]).filter("false")
    for name, function in corpus_pipeline.STAGES:
        rows = stage(function(spark, rows, "/root/testdata/sf0.001"), name)
        assert rows.count() == 0
