"""The manifest against a tree that is built in one place."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from lakezones.llm import manifest as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def leaf(row):
    return sha("".join("-" if value is None else f"{len(str(value).encode())}:{value}" for value in row))


def climb(nodes, fanout):
    """The root, and for each node the siblings before and behind on each level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for k in range(len(run)):
                for owner in owners[at + k]:
                    paths[owner].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            above_owners.append([o for own in owners[at : at + fanout] for o in own])
        nodes, owners = above, above_owners
    return nodes[0], paths


def plain(rows, fanout=8):
    """(lang, doc_id, position, leaf, subroot, root, proof, folded, verified) of each row."""
    made = []
    for doc_id, source, lang, n_chars, text in rows:
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        made.append(
            (lang, doc_id, leaf((doc_id, source, lang, n_chars, text)),
             leaf((doc_id, source, lang, n_chars, lowered(text) if tampered else text)))
        )
    made.sort(key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    groups = [list(group) for _, group in groupby(made, key=lambda r: r[0])]
    if not groups:
        return []
    climbed = [climb([r[2] for r in group], fanout) for group in groups]
    root, above = climb([subroot for subroot, _ in climbed], fanout)
    result = []
    for group, (subroot, paths), top in zip(groups, climbed, above):
        for place, (row, path) in enumerate(zip(group, paths)):
            folded = row[3]
            for before, behind in path + top:
                folded = sha(before + folded + behind)
            proof = sha("".join(a + b for a, b in path + top))
            result.append((row[0], row[1], place, row[2], subroot, root, proof, folded, folded == root))
    return sorted(result, key=str)


def table(spark, rows, partitions=4):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def found(df, **options):
    result = M.manifest(df, M.lower_cased(df), **options)
    return sorted(map(tuple, result.collect()), key=str)


def documents(counts, seed=1):
    rnd = random.Random(seed)
    rows = []
    for lang, count in counts.items():
        for _ in range(count):
            number = rnd.randint(-5, 10**9)
            rows.append((number, rnd.choice(["web", None, "Ä:x"]), lang, rnd.choice([None, 7]), f"Text {number} É"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "fanout, levels, counts",
    [
        # The last subtree of a run is short in many ways.
        (2, 1, {"a": 1, "b": 2, "c": 3, "d": 5, "e": 23, None: 39, "Z": 64, "ä": 65}),
        (3, 1, {"a": 100, "b": 28, "c": 82, "d": 4}),
        (3, 2, {"a": 244, None: 10, "b": 1}),
        (8, 1, {"a": 521, "b": 8, "c": 9, "d": 64, "e": 65, "f": 7, "g": 1, "h": 2, "i": 3, "j": 513}),
        (8, 4, {"a": 300, "b": 17}),
    ],
)
def test_against_one_tree(spark, fanout, levels, counts):
    rows = documents(counts)
    result = found(table(spark, rows), fanout=fanout, levels=levels)
    assert result == plain(rows, fanout)
    assert {row[-1] for row in result} == {True, False}


def test_edge_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, "a", "x", 1, "T"), (None, "a", "x", 1, "S"),
        (5, "a", "x", 1, "T"), (5, "a", "x", 1, "T"), (5, "a", "x", 1, "U"), (7, "", "", 0, ""), (9, "b", "x", 2, "Ünï" * 5000),
        (-3, "b", "", None, None),
    ]
    assert found(table(spark, rows)) == plain(rows)
    assert found(table(spark, rows), fanout=2, levels=1) == plain(rows, 2)


def test_one_row_and_none(spark):
    assert found(table(spark, [])) == []
    (row,) = found(table(spark, [(1, "a", "x", 1, "T")]))
    assert row[3] == row[4] == row[5] and row[6] == sha("")


def test_clashing_names(spark):
    rows = documents({"a": 30, "b": 3})
    names = ["place", "position", "size", "block", "node", "tree", "leaf", "root", "a.b", "tampered", "run_group", "path"]
    clashing = table(spark, rows).withColumns({name: F.lit(1) for name in names})
    assert found(clashing, fanout=2, levels=1) == plain(rows, 2)


def test_groups_of_many(spark):
    rows = [(i, "s", f"g{i % 150}", 1, "T") for i in range(400)]
    assert found(table(spark, rows), fanout=4, levels=1) == plain(rows, 4)


def test_a_change_is_found_where_it_is(spark):
    rows = documents({"a": 70, "b": 20})
    df = table(spark, rows)
    changed = {"source": F.when(F.col("doc_id") == rows[0][0], F.lit("other")).otherwise(F.col("source"))}
    bad = M.manifest(df, changed, levels=1).filter("NOT verified").collect()
    assert [row.doc_id for row in bad] == [rows[0][0]]
    assert M.manifest(df).filter("NOT verified").isEmpty()
