"""A Merkle manifest of a table: a leaf for each row, a tree for each group, a tree over the groups.

``H`` is the lower-case hex SHA-256 of its inputs, put together as text. The leaves of a group
(a language) ascend by id; while several nodes remain, each run of ``fanout`` consecutive ones
becomes their ``H``, also a last run of fewer or of one. What remains is the group's root; the
roots of the groups, in their order with null first, give the root of all in the same way. The
proof of a leaf is its siblings from the bottom to the top, left to right, the rest of its run
at each level.

Method: a butterfly exchange. Leaves are numbered in their group and packed into partitions of
``fanout ** BLOCK_LEVELS`` consecutive ones, aligned with the tree, each of which is one row of
digests. A partition hashes its own subtree. Then, round by round, each meets the up to
``fanout - 1`` partitions that differ from it in one digit of their number only, and they swap
the roots of the subtrees that they have got: after round r each knows the root of its run of
``fanout ** r`` partitions and the siblings on the way there. All members of a run compute that
root for themselves, so that nothing has to be sent down the tree again. Where the last
subtree of a run has fewer partitions than the others, these answer for the missing ones as well.
The same rounds, with one group as a partition, lead over the groups to the root.

A round moves one row per partition, not per leaf, and at most as many copies; texts are never
moved. No task holds more than one partition of leaves or one run of roots.

Defined results: a null field is written as ``-``; a null id sorts first, rows that repeat an id
are ordered by their leaf, and equal rows have equal leaves that are all kept; a null group is a
group of its own, the first; an empty table gives no rows; other columns are not read and
change no digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakezones.llm.text import ascii_lower
from lakezones.session import stage
from lakezones.specs import quoted

FANOUT = 8
# Levels of the tree inside one partition: 8 ** 4 leaves, about 300 kB of digests.
BLOCK_LEVELS = 4

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST_BYTES = 32

# monotonically_increasing_id() holds the partition above bit 33 and the row position below it.
POSITION_BITS = 33

RESULT = (
    "lang string, doc_id bigint, position bigint, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field_text(value: Column) -> Column:
    """A field as the leaf has it: ``-`` for null, else its bytes in UTF-8, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(values: Iterable[Column]) -> Column:
    """The leaf of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field_text, values)), 256))


def lower_cased(docs: DataFrame) -> dict[str, Column]:
    """The tampered fields: the text of every document whose id has a checksum that 3 divides."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return {"text": F.when(chosen, ascii_lower(F.col("text").cast("string"))).otherwise(F.col("text"))}


# -- Numbers -------------------------------------------------------------------------------------


def numbered(rows: DataFrame, group: str, order: Sequence[Column], label: str) -> DataFrame:
    """``rows`` with ``position`` (from 0) in their group and ``size``, the rows of the group.

    Range partitions of the sorted rows are written once; the rows of a group before a partition
    are a sum over one number for each partition and group.
    """
    placed = stage(
        rows.orderBy(F.asc_nulls_first(group), *order).withColumn("place", F.monotonically_increasing_id()), label
    )
    part = F.shiftright("place", POSITION_BITS)
    runs = placed.groupBy(F.col(group), part.alias("part")).agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    # A group has at most one row per sort partition here.
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col(group).alias("run_group"),
        F.col("part").alias("run_part"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy(group)).alias("size"),
    )
    same = (part == F.col("run_part")) & F.col(group).eqNullSafe(F.col("run_group"))
    found = placed.join(runs, same).withColumn("position", F.col("place") + F.col("shift"))
    return found.drop("place", "run_group", "run_part", "shift")


# -- Local subtrees ------------------------------------------------------------------------------


def height(nodes: int, fanout: int) -> int:
    """Levels above ``nodes`` nodes until one remains."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def levels_of(leaves: list[str], count: int, fanout: int) -> list[list[str]]:
    """The nodes of a subtree level by level, ``count`` levels above the leaves."""
    levels = [leaves]
    for _ in range(count):
        nodes = levels[-1]
        levels.append([digest("".join(nodes[at : at + fanout])) for at in range(0, len(nodes), fanout)])
    return levels


BLOCKS = "lang string, block bigint, size bigint, doc_ids array<bigint>, leaves binary, tampered binary, root string"


def packer(fanout: int, levels: int) -> Callable[[pa.Table], pa.Table]:
    """Makes one row of the leaves of a partition, with the root of its subtree."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        leaves = b"".join(rows.column("leaf").to_pylist())
        size = rows.column("size")[0].as_py()
        nodes = levels_of(_unpacked(leaves), min(levels, height(size, fanout)), fanout)[-1]
        packed = {
            "lang": pa.array([rows.column("lang")[0].as_py()], pa.string()),
            "block": pa.array([rows.column("block")[0].as_py()], pa.int64()),
            "size": pa.array([size], pa.int64()),
            "doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "leaves": pa.array([leaves], pa.binary()),
            "tampered": pa.array([b"".join(rows.column("tampered").to_pylist())], pa.binary()),
            "root": pa.array(nodes, pa.string()),
        }
        return pa.table(packed)

    return pack


# -- Rounds --------------------------------------------------------------------------------------


def exchange(nodes: DataFrame, most: int, fanout: int, label: str) -> DataFrame:
    """The root above ``node`` in each tree, and the siblings of each node on the way there.

    ``nodes`` has tree, node (its number from 0 in the tree), nodes (their number in the tree) and
    root (the digest of the node); ``most`` is the greatest number of nodes in a tree. The result
    keeps these columns, with ``root`` that of the tree, and ``path``, for each level the digests
    before and behind.
    """
    state = nodes.select("tree", "node", "nodes", "root").withColumn(
        "path", F.array().cast("array<struct<before: string, behind: string>>")
    )
    for level in range(height(most, fanout)):
        state = stage(_round(state, fanout**level, fanout), f"{label}-round")
    return state


def _round(state: DataFrame, width: int, fanout: int) -> DataFrame:
    """Swap roots between the partitions of a run, each of which has the root of ``width`` nodes."""
    subtrees = F.ceil(F.col("nodes") / F.lit(width)).cast("bigint")
    subtree = F.floor(F.col("node") / F.lit(width)).cast("bigint")
    placed = state.withColumns({"subtrees": subtrees, "subtree": subtree, "lane": F.col("node") % width})
    placed = placed.withColumn("run", F.floor(F.col("subtree") / F.lit(fanout)).cast("bigint"))
    # The last subtree may be short of partitions: its own take the lanes of the missing ones too.
    last = F.col("nodes") - (F.col("subtrees") - 1) * width
    short = (
        (F.col("subtree") == F.col("subtrees") - 1) & (last < width) & (F.col("subtree") % fanout > 0)
    )
    lanes = F.when(short, F.sequence("lane", F.lit(width - 1).cast("bigint"), last)).otherwise(F.array("lane"))
    sent = placed.withColumn("own_lane", F.col("lane")).withColumn("lane", F.explode(lanes))
    lane = Window.partitionBy("tree", "run", "lane")
    met = sent.withColumn("met", F.array_sort(F.collect_list(F.struct("subtree", "root")).over(lane)))
    own = met.filter(F.col("lane") == F.col("own_lane"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("met", keep), lambda one: one["root"]), "")

    step = F.struct(
        joined(lambda one: one["subtree"] < F.col("subtree")).alias("before"),
        joined(lambda one: one["subtree"] > F.col("subtree")).alias("behind"),
    )
    # A tree that has come down to one node is done.
    more = F.col("subtrees") > 1
    return own.select(
        "tree",
        "node",
        "nodes",
        F.when(more, F.sha2(joined(lambda one: F.lit(True)), 256)).otherwise(F.col("root")).alias("root"),
        F.when(more, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
    )


# -- Proofs --------------------------------------------------------------------------------------


def _unpacked(digests: bytes) -> list[str]:
    text = digests.hex()
    return [text[at : at + 2 * DIGEST_BYTES] for at in range(0, len(text), 2 * DIGEST_BYTES)]


@dataclass(frozen=True)
class Prove:
    """A row for each leaf of a partition: its proof, and the root that its present row folds to."""

    fanout: int
    levels: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RESULT.split(", ")]
        types = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
        schema = pa.schema([(part.split()[0], types[part.split()[1]]) for part in RESULT.split(", ")])
        for batch in batches:
            for block in batch.to_pylist():
                columns = list(zip(*self._rows(block)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, schema.field(name).type) for name, column in zip(names, columns)], schema=schema
                )

    def _rows(self, block: dict) -> Iterator[tuple]:
        fanout = self.fanout
        leaves, tampered = _unpacked(block["leaves"]), _unpacked(block["tampered"])
        local = min(self.levels, height(block["size"], fanout))
        levels = levels_of(leaves, local, fanout)
        above = [(step["before"], step["behind"]) for step in [*block["path"], *block["top_path"]]]
        siblings_above = "".join(before + behind for before, behind in above)
        first = block["block"] * fanout**self.levels
        for at, leaf in enumerate(leaves):
            path = []
            for level in range(local):
                node = at // fanout**level
                run = node - node % fanout
                nodes = levels[level]
                path.append(("".join(nodes[run:node]), "".join(nodes[node + 1 : run + fanout])))
            proof = digest("".join(before + behind for before, behind in path) + siblings_above)
            folded = tampered[at]
            for before, behind in path + above:
                folded = digest(before + folded + behind)
            yield (
                block["lang"], block["doc_ids"][at], first + at, leaf, block["root"], block["top_root"], proof, folded,
                folded == block["top_root"],
            )


def manifest(
    docs: DataFrame,
    tampered: dict[str, Column] | None = None,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    fanout: int = FANOUT,
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """For each row: its leaf, the roots, the digest of its proof, and whether it still verifies.

    ``tampered`` gives fields as they are found now; a row verifies if the leaf of the present
    fields, folded with the siblings of the original ones, gives the original root.
    """
    if fanout < 2 or levels < 1:
        raise ValueError("a tree needs a fanout of 2 and a level in a partition at least")
    present = {name: F.col(quoted(name)) for name in fields} | (tampered or {})
    leaves = docs.select(
        F.col(quoted(group)).cast("string").alias("lang"),
        F.col(quoted(key)).cast("bigint").alias("doc_id"),
        leaf_digest(F.col(quoted(name)) for name in fields).alias("leaf"),
        leaf_digest(present[name] for name in fields).alias("tampered"),
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("tampered")]
    block = F.floor(F.col("position") / F.lit(fanout**levels)).cast("bigint")
    # Digests are written first, as a sort by range reads its input twice.
    rows = numbered(stage(leaves, "manifest-digests"), "lang", order, "manifest-leaves").withColumn("block", block)
    blocks = stage(rows.groupBy("lang", "block").applyInArrow(packer(fanout, levels), BLOCKS), "manifest-blocks")
    inner = blocks.select(
        F.col("lang").alias("tree"), F.col("block").alias("node"), "root",
        F.ceil(F.col("size") / F.lit(fanout**levels)).cast("bigint").alias("nodes"),
    )
    inner = exchange(inner, inner.agg(F.max("nodes")).first()[0] or 0, fanout, "manifest-blocks")

    first = inner.filter("node = 0").select(F.col("tree").alias("lang"), "root", F.lit(0).alias("tree"))
    roots = numbered(first, "tree", [F.asc_nulls_first("lang")], "manifest-groups").select(
        "lang", "tree", F.col("position").alias("node"), F.col("size").alias("nodes"), "root"
    )
    roots = stage(roots, "manifest-groups")
    top = exchange(roots, roots.agg(F.max("nodes")).first()[0] or 0, fanout, "manifest-groups")
    top = top.select("node", F.col("root").alias("top_root"), F.col("path").alias("top_path"))
    top = roots.select("node", F.col("lang").alias("top_lang")).join(top, "node").drop("node")

    paths = inner.join(top, F.col("tree").eqNullSafe(F.col("top_lang"))).select(
        "tree", "node", "path", "top_root", "top_path", F.col("root").alias("subroot")
    )
    same = (F.col("block") == F.col("node")) & F.col("lang").eqNullSafe(F.col("tree"))
    whole = blocks.drop("root").join(paths, same).select(
        "lang", "block", "size", "doc_ids", "leaves", "tampered", F.col("subroot").alias("root"), "path", "top_root", "top_path"
    )
    return whole.mapInArrow(Prove(fanout, levels), RESULT)
