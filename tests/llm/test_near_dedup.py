import random
import re

import numpy as np
import pytest

import corpus_pipeline
from lakezones.llm import near_dedup
from lakezones.llm.components import connected_components


def shingles(text, width):
    words = re.findall("[^ \t\n\x0b\x0c\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def groups(rows, width, similarity):
    """Least id of the group of each row, by comparing all pairs."""
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return {doc_id: least[root(i)] for i, (doc_id, _) in enumerate(rows)}


def edited(text, share, seed):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.random()}" if rnd.random() < share else word for word in text.split())


@pytest.mark.parametrize("width", [4, 5])
def test_against_all_pairs(docs, prose, width):
    rows, passage = [], prose("passage", 60)
    for base in range(12):
        text = prose(base, 30 + 25 * base)
        rows.append((len(rows), text))
        rows += [(len(rows) + k, edited(text, share, base * 10 + k)) for k, share in enumerate((0.005, 0.02, 0.03, 0.1))]
        rows.append((len(rows), passage + " " + text[:200]))
    rows += [(len(rows) + k, text) for k, text in enumerate(("", " \n", "One two", "one TWO", "one two three", rows[0][1]))]
    random.Random(3).shuffle(rows)
    found = {row["doc_id"]: row for row in near_dedup.near_duplicates(docs(rows), width, 80).collect()}
    expected = groups(rows, width, 80)
    assert {i: row["component_id"] for i, row in found.items()} == expected
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in found.values())
    assert {i: row["n_shingles"] for i, row in found.items()} == {i: len(shingles(t, width)) for i, t in rows}


def test_large_group_of_near_copies_around_the_threshold(docs, prose):
    base = prose("hub", 150)
    rows = [(i, edited(base, 0.018, i)) for i in range(240)] + [(1000 + i, edited(base, 0.05, 5000 + i)) for i in range(60)]
    found = {row["doc_id"]: row["component_id"] for row in near_dedup.near_duplicates(docs(rows, 8), 5, 80).collect()}
    assert found == groups(rows, 5, 80)


def test_edge_rows(spark, docs, prose):
    text, other = prose(1), prose(2)
    rows = [(1, text), (1, text), (1, other), (2, text), (None, text), (None, prose(3)), (5, None), (6, ""), (7, prose(4, 30_000))]
    found = near_dedup.near_duplicates(docs(rows), 5, 80).collect()
    assert len(found) == len(rows)
    assert sorted(str((r["doc_id"], r["component_id"], r["kept"])) for r in found) == sorted(
        map(str, [(1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True),
                  (5, 5, True), (6, 6, True), (7, 7, True)])
    )
    kept = near_dedup.distinct_documents(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(str(row["doc_id"]) for row in kept.collect()) == sorted(map(str, [1, 1, 1, None, None, 5, 6, 7]))
    empty = docs(rows).filter("false")
    assert near_dedup.near_duplicates(empty).collect() == [] and near_dedup.distinct_documents(empty).count() == 0


def test_rows_that_share_an_id_or_have_none_are_told_apart_by_their_texts(docs, prose):
    base = prose("shared", 120)
    rows = [(9, edited(base, 0.01, i)) for i in range(30)] + [(None, edited(base, 0.01, 100 + i)) for i in range(30)]
    rows += [(1, base), (9, prose("apart"))]
    frame = docs(rows)
    sketches, nodes = near_dedup.classes(frame, 5)
    # Each node is one text, found again in one row.
    texts = near_dedup.named_texts(frame).join(
        nodes.select(nodes["doc_id"].alias("of"), "text_hash", "node"), "text_hash"
    )
    assert texts.filter("doc_id <=> of").count() == nodes.count() == sketches.select("digest").distinct().count()
    found = near_dedup.near_duplicates(frame, 5, 80).collect()
    # The same texts under ids of their own, and the least given id of each group.
    members = groups([(place, text) for place, (_, text) in enumerate(rows)], 5, 80)
    heads = {}
    for place, group in members.items():
        heads[group] = min(heads.get(group, 99), rows[place][0] or 99)
    expected = [(rows[place][0], heads[group] if heads[group] < 99 else None) for place, group in members.items()]
    assert sorted(map(str, ((r["doc_id"], r["component_id"]) for r in found))) == sorted(map(str, expected))


def test_no_text_goes_with_another_one_of_its_id(docs, prose):
    a, b = prose("a"), prose("b")
    rows = [(5, a), (5, b), (3, b)]
    for reduced in (near_dedup.distinct_documents, near_dedup.one_of_each_group):
        assert sorted((r["doc_id"], r["text"]) for r in reduced(docs(rows)).collect()) == sorted([(5, a), (3, b)])


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_one_row_of_each_group(docs, prose, monkeypatch, broadcast):
    monkeypatch.setattr(near_dedup, "BROADCAST_NODES", broadcast)
    a, b, c, d = (prose(name) for name in "abcd")
    rows = [(5, a), (5, b), (3, b), (3, b), (None, b)]
    rows += [(None, c)] * 20 + [(None, edited(c, 0.005, i)) for i in range(4)]
    rows += [(8, d), (8, edited(d, 0.005, 1)), (8, d), (9, d), (6, ""), (7, None), (None, "")]
    named = docs(rows).selectExpr("*", "1 AS row", "2 AS of", "3 AS id", "4 AS hash", "5 AS stands", "6 AS rows")
    kept = near_dedup.one_of_each_group(named)
    assert kept.columns == named.columns and dict(kept.dtypes) == dict(named.dtypes)
    found = kept.collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(map(str, [5, 3, None, 8, 6, 7, None]))
    texts = {r["doc_id"]: r["text"] for r in found if r["doc_id"]}
    assert (texts[5], texts[3], texts[6], texts[7]) == (a, b, "", None)
    again = near_dedup.one_of_each_group(named.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert near_dedup.one_of_each_group(named.filter("false")).count() == 0


def test_the_pipeline_keeps_one_row_of_each_group(spark, docs, prose):
    rows = [(5, prose("a")), (5, prose("b")), (3, prose("b"))] + [(None, prose("c"))] * 5
    found = corpus_pipeline.deduplicate(spark, docs(rows), "").collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["3", "5", "None"]


def test_other_columns_do_not_clash(docs, prose):
    named = docs([(1, prose(1)), (2, prose(1))]).selectExpr("*", "1 AS node", "2 AS digest", "3 AS gone", "4 AS component")
    assert near_dedup.near_duplicates(named).count() == 2
    kept = near_dedup.distinct_documents(named)
    assert kept.columns == named.columns and [row["doc_id"] for row in kept.collect()] == [1]


def test_broadcast_and_shuffle_agree(docs, prose, monkeypatch):
    rows = [(i, edited(prose(i % 5), 0.01, i)) for i in range(20)]
    before = sorted(near_dedup.near_duplicates(docs(rows)).collect())
    monkeypatch.setattr(near_dedup, "BROADCAST_NODES", 0)
    assert sorted(near_dedup.near_duplicates(docs(rows)).collect()) == before


def test_signatures_estimate_the_common_share():
    rnd = np.random.default_rng(0)
    both = rnd.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = near_dedup.signatures([np.unique(both[:3600]), np.unique(both[400:])])
    assert abs((a == b).mean() - 0.8) < 0.2
    assert (near_dedup.signature(np.unique(both[:3600])) == a).all()


def test_common_sizes_equal_intersections():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 9000, size, dtype=np.uint64)) for size in (0, 1, 50, 900, 8000, 8000)]
    found = near_dedup.common_sizes(sets)
    for i in range(len(sets)):
        for j in range(len(sets)):
            if i != j:
                assert found[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (200, 201)]
    edges += [(300, 300), (None, 5), (7, None)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = dict(connected_components(frame).collect())
    expected = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200, 202: 200}
    assert found == expected
    assert connected_components(frame.filter("false")).count() == 0
