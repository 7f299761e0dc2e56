"""Near-duplicate groups by an inverted join on MinHash signature coordinates.

Two documents are linked if the common share of their word shingles is at least ``similarity``.
Groups are the connected components of all links.

1. A task turns each text into its set of shingle hashes, and that into a signature: for each of
   ``COORDINATES`` hash functions the least value over the set. Equal sets become one node.
2. A node is posted under each pair of coordinate and value. Postings of one node alone are
   dropped. A link has at least ``least_matches`` common postings but for the chance ``MISS`` at
   the threshold, whatever the threshold is, so nodes with fewer shared postings are dropped too, and of the
   others only a prefix is looked at: with the postings ordered by how common they are, rare
   ones first, two nodes with so many in common share one among the first ``n - least_matches + 1``.
3. In each posting list, every node is paired with the least one. Of these pairs, those of
   compatible size with enough matching coordinates are confirmed on the full sets, and joined to
   first components. In a group of copies that is nearly all the work, and it is linear.
4. What can still matter are pairs in a list from different components. Lists that lie in one
   component are skipped. In the others, block by block, collisions are counted between
   components that are not known to meet, which gives families of components: any two nodes
   that may still have a link are in one family. Families are cut into parts of bounded size, and
   for each two parts the full sets are compared, which yields a link wherever two components
   have one. No task holds more than two parts, and no pair is ever written that is no link.

Full sets are not kept: they are made again from the texts of the nodes in question.

Defined results: a text without words has an empty set and is linked to nothing; a text with
fewer words than a shingle has one shingle, the whole sequence; null texts count as empty; rows
with a null id belong to groups, but never stand for one (their group's id is null if it has no
other); rows that repeat an id share a group with equal texts only, and are kept or not like any
other (``one_of_each_group`` keeps a single row of each group instead); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakezones.llm.components import connected_components
from lakezones.session import stage

WIDTH = 5
SIMILARITY = 80  # per cent

COORDINATES = 64
# The chance that a pair exactly at the threshold has fewer matches than asked for.
MISS = 2e-5
SEED = 11

# Nodes in one part of a posting list, and of a hub with many candidates.
BLOCK = 1024
STAR = 256

# Nodes and shingles in one part of a family, shingles in one matrix, and sets below which none is made.
PART_NODES = 400
PART_SHINGLES = 300_000
SLAB = 4096
FEW_SETS = 12

# Rows that name a text to be read again are broadcast up to this number (at most about 100 bytes each).
BROADCAST_NODES = 300_000

REMEMBERED_WORDS = 150_000
WORDS_AT_ONCE = 500_000

def least_matches(similarity: int) -> int:
    """The number of matching coordinates that a pair of this similarity (per cent) reaches but for ``MISS``.

    Coordinates match independently with the similarity as their chance; 37 of 64 for 80 per cent.
    """
    if not 1 <= similarity <= 100:
        raise ValueError("the similarity is a percentage from 1 to 100")
    share, missed = similarity / 100, 0.0
    for matches in range(COORDINATES + 1):
        missed += math.comb(COORDINATES, matches) * share**matches * (1 - share) ** (COORDINATES - matches)
        if missed > MISS:
            if matches == 0:
                break
            return matches
    if similarity == 100:
        return COORDINATES
    raise ValueError(f"{COORDINATES} coordinates do not tell pairs of similarity {similarity} apart")


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_known_words = _WordHashes()


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _odd_numbers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The hashes of a text's shingles, ascending, each once."""
    # Bytes are split at ASCII white space, and only A-Z are lower-cased.
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_known_words) > REMEMBERED_WORDS:
        _known_words.clear()
    hashes = np.array(list(map(_known_words.__getitem__, words)), np.uint64)
    used = min(width, len(hashes))
    factors = _odd_numbers(width, SEED)
    shingles = np.full(len(hashes) - used + 1, used, np.uint64)
    for place in range(used):
        shingles += _mixed(hashes[place : place + len(shingles)] * factors[place])
    return np.unique(_mixed(shingles))


def signature(shingles: np.ndarray) -> np.ndarray:
    """For each coordinate the least value of its hash function over the set."""
    factors, shifts = _odd_numbers(COORDINATES, SEED + 1), _odd_numbers(COORDINATES, SEED + 2)
    return np.array([((shingles ^ shift) * factor).min() for factor, shift in zip(factors, shifts)], np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The signatures of several sets that are not empty."""
    factors, shifts = _odd_numbers(COORDINATES, SEED + 1), _odd_numbers(COORDINATES, SEED + 2)
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    columns = [np.minimum.reduceat((joined ^ shift) * factor, starts) for factor, shift in zip(factors, shifts)]
    return np.stack(columns, axis=1)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


SKETCHES = "doc_id bigint, text_hash bigint, digest binary, n_shingles bigint, signature binary"


@dataclass(frozen=True)
class Sketch:
    """doc_id, text_hash, the digest and size of the shingle set, and its signature (null if it is empty)."""

    width: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, texts, at = batch.select(["doc_id", "text_hash"]), batch.column("text").to_pylist(), 0
            sets: list[np.ndarray] = []
            size = 0
            for number, text in enumerate(texts, 1):
                sets.append(shingle_set(text, self.width))
                size += len(sets[-1])
                if size >= WORDS_AT_ONCE or number == len(texts):
                    yield self._rows(named.slice(at, len(sets)), sets)
                    at, sets, size = number, [], 0

    def _rows(self, named: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        filled = [s for s in sets if len(s)]
        rows = iter(signatures(filled)) if filled else iter(())
        columns = [
            *named.columns,
            pa.array([set_digest(s) for s in sets], pa.binary()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, [*named.schema.names, "digest", "n_shingles", "signature"])


@dataclass(frozen=True)
class Post:
    """A row for each coordinate of a node's signature."""

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = _odd_numbers(COORDINATES, SEED + 3)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                values = _signature_matrix(part.column("signature").to_pylist())
                postings = _mixed(values ^ salts).view(np.int64).ravel()
                nodes = np.repeat(part.column("node").to_numpy(), COORDINATES)
                coordinates = np.tile(np.arange(COORDINATES, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(postings), pa.array(nodes), pa.array(coordinates)], ["posting", "node", "coordinate"]
                )


def _signature_matrix(packed: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint64).reshape(-1, COORDINATES)


def named_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows apart that share an id or have none."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.withColumn("text_hash", F.xxhash64("text"))


def classes(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Every row with the digest of its set, and one node for each distinct set. Both staged."""
    rows = stage(named_texts(docs).mapInArrow(Sketch(width), SKETCHES), "sketches")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "text_hash"))
    nodes = (
        rows.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(
            least.alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .select("digest", "least.doc_id", "least.text_hash", "n_shingles", "signature")
        .withColumn("node", F.monotonically_increasing_id())
    )
    return rows, stage(nodes, "dedup-nodes")


def prefixes(nodes: DataFrame, similarity: int) -> DataFrame:
    """posting, node, coordinate of the prefix of every node that can have a link. Staged."""
    postings = nodes.select("node", "signature").mapInArrow(Post(), "posting bigint, node bigint, coordinate int")
    common = postings.groupBy("posting").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    shared = postings.join(common, "posting")
    entry = F.struct("nodes", "posting", "coordinate")
    # At most COORDINATES entries of a node.
    ordered = shared.groupBy("node").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    length = F.size("entries") - (least_matches(similarity) - 1)
    kept = ordered.filter(length > 0).select("node", F.explode(F.slice("entries", 1, length)).alias("entry"))
    return stage(kept.select("entry.posting", "node", "entry.coordinate"), "prefixes")


def compatible(a: Column, b: Column, similarity: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * similarity


def star_pairs(postings: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Each node with the least one of its posting lists: ``a``, ``b``, if size and matches allow."""
    least = postings.groupBy("posting").agg(F.min("node").alias("b"))
    pairs = postings.join(least, "posting").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    return with_matches(pairs, nodes, similarity).filter(F.col("matches") >= least_matches(similarity)).select("a", "b")


def with_matches(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """The pairs of compatible size, with the number of coordinates in which they collide."""
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("a_size"), F.col("signature").alias("a_sign"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("b_size"), F.col("signature").alias("b_sign"))
    joined = pairs.join(left, "a").join(right, "b").filter(compatible(F.col("a_size"), F.col("b_size"), similarity))
    counted = joined.select("a", "b", "a_sign", "b_sign").mapInArrow(count_matches, "a bigint, b bigint, matches int")
    return counted


def count_matches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left = _signature_matrix(batch.column("a_sign").to_pylist())
        right = _signature_matrix(batch.column("b_sign").to_pylist())
        matches = pa.array((left == right).sum(1).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), matches], ["a", "b", "matches"])


def star_blocks(pairs: DataFrame) -> DataFrame:
    """block, node, component, n_shingles and part for the pairs of each ``b`` with many ``a``.

    The ``a`` of a hub are cut into parts, so that its set travels once for each part. Part 0 is
    compared with part 1; a node is its own component, as nothing is known of it yet.
    """
    sizes = pairs.groupBy(F.col("b").alias("hub")).agg(F.count("*").alias("nodes"))
    cut = pairs.join(sizes, F.col("b") == F.col("hub"))
    block = F.xxhash64("b", F.pmod(F.xxhash64("a"), F.ceil(F.col("nodes") / STAR)))
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("part")), F.struct(F.col("b").alias("node"), F.lit(1).alias("part"))))
    rows = cut.select(block.alias("block"), ends.alias("end")).select("block", "end.node", "end.part")
    return rows.distinct().withColumn("component", F.col("node"))


def family_blocks(members: DataFrame) -> DataFrame:
    """block, node, component and part for all pairs of nodes in each family.

    ``members``: node, component, n_shingles, family. A family is cut into parts of bounded
    number and size of sets; each two parts meet in a block, and each part meets itself.
    """
    sizes = members.groupBy(F.col("family").alias("of_family")).agg(
        F.count("*").alias("nodes"), F.sum("n_shingles").alias("shingles")
    )
    parts = F.greatest(F.ceil(F.col("nodes") / PART_NODES), F.ceil(F.col("shingles") / PART_SHINGLES))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    cut = members.join(sizes, F.col("family") == F.col("of_family")).withColumn("parts", parts)
    meeting = cut.withColumn("own", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    block = F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") < F.col("other"), 0).when(F.col("own") > F.col("other"), 1).otherwise(2)
    return meeting.select(block.alias("block"), "node", side.alias("part"), "component")


def confirmed(
    blocks: DataFrame, docs: DataFrame, nodes: DataFrame, repeated: DataFrame, width: int, similarity: int
) -> DataFrame:
    """Links ``a``, ``b`` that join all nodes of different components with similar full sets in each block.

    ``blocks``: block, node, part (0 and 1 meet, 2 meets all), component; staged. ``repeated``: the
    doc_id and text_hash that several rows share; staged.
    """
    named_nodes = nodes.select("node", "digest", F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"))
    wanted = blocks.join(named_nodes, "node")
    small = blocks.count() <= BROADCAST_NODES
    if not small:
        wanted = wanted.repartition("of_hash")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    # Of rows that share id and text one is enough. Each task first cuts them to one.
    often = repeated.withColumns({"of": F.col("doc_id"), "of_hash": F.col("text_hash")}).select("of", "of_hash")
    texts = named_texts(docs)
    if not often.isEmpty():
        single = texts.join(often, same, "left_anti")
        once = texts.join(often, same, "left_semi").groupBy("doc_id", "text_hash", F.sha2("text", 256)).agg(F.first("text").alias("text"))
        texts = single.unionByName(once.select("doc_id", "text", "text_hash"))
    named = texts.join(F.broadcast(wanted) if small else wanted, same)
    sets = named.select("block", "node", "part", "component", "digest", "text").mapInArrow(MakeSets(width), MEMBERS)
    confirm = Confirm(similarity)
    return sets.groupBy("block").applyInPandas(lambda block: confirm(block), "a bigint, b bigint")


MEMBERS = "block bigint, node bigint, part int, component bigint, shingles binary"


@dataclass(frozen=True)
class MakeSets:
    """The full set of each node, from the texts that may be its own."""

    width: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None, None)
        for batch in batches:
            digests, texts = batch.column("digest").to_pylist(), batch.column("text").to_pylist()
            rows, sets = [], []
            for row, (digest, text) in enumerate(zip(digests, texts)):
                if last[0] != text:
                    shingles = shingle_set(text, self.width)
                    last = (text, set_digest(shingles), shingles.tobytes())
                # Another text with the same id and hash is not the node's.
                if last[1] == digest:
                    rows.append(row)
                    sets.append(last[2])
            kept = batch.select(["block", "node", "part", "component"]).take(pa.array(rows, pa.int64()))
            yield kept.append_column("shingles", pa.array(sets, pa.binary()))


@dataclass(frozen=True)
class Confirm:
    """The links of a block that join its components."""

    similarity: int

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        # Rows that repeat an id and its text give their node twice.
        rows = rows.drop_duplicates(["node", "part"])
        node, part = rows["node"].to_numpy(), rows["part"].to_numpy()
        joined = Joined(rows["component"])
        sets = [np.frombuffer(packed, np.uint64) for packed in rows["shingles"]]
        sizes = np.array([len(s) for s in sets])
        common = common_sizes(sets) if len(sets) > FEW_SETS else None
        found = []
        for i in np.flatnonzero(part != 1):
            others = np.flatnonzero((part == 1) | ((part == 2) & (node > node[i])))
            others = others[np.minimum(sizes[others], sizes[i]) * 100 >= np.maximum(sizes[others], sizes[i]) * self.similarity]
            if common is not None:
                both = common[i, others]
                others = others[100 * both >= self.similarity * (sizes[others] + sizes[i] - both)]
            for j in others:
                if joined.apart(i, j) and (common is not None or similar(sets[i], sets[j], self.similarity)):
                    joined.join(i, j)
                    found.append((node[i], node[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


class Joined:
    """Which rows of a block are in one component, as links are found."""

    def __init__(self, components: pd.Series):
        self.of_row = pd.factorize(components)[0].tolist()
        self.parent = list(range(len(self.of_row)))

    def root(self, row: int) -> int:
        at = self.of_row[row]
        while self.parent[at] != at:
            self.parent[at] = self.parent[self.parent[at]]
            at = self.parent[at]
        return at

    def apart(self, a: int, b: int) -> bool:
        return self.root(a) != self.root(b)

    def join(self, a: int, b: int) -> None:
        self.parent[self.root(a)] = self.root(b)


def common_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of each two sets, as products of membership matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, element, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[element] > 1
    owner, element = owner[shared], element[shared]
    # Shared elements numbered anew, then a bounded number of them at a time.
    _, element = np.unique(element, return_inverse=True)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    total = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, int(element[-1]) + 1 if len(element) else 0, SLAB):
        low, high = np.searchsorted(element, [first, first + SLAB])
        members = np.zeros((len(sets), SLAB), np.float32)
        members[owner[low:high], element[low:high] - first] = 1
        # A slab counts at most SLAB, which is exact.
        total += (members @ members.T).astype(np.int64)
    return total


def similar(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= similarity * (len(a) + len(b) - common)


@dataclass(frozen=True)
class CompareBlock:
    """Pairs of components that may have a link in a block of a posting list, enough to connect them all.

    Rows: node, component, size, signature, the least node of the list, and whether the node is
    on the left side (0), the right side (1), or both (2: the same part twice).
    """

    similarity: int

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        node, component, leader = rows["node"].to_numpy(), rows["component"].to_numpy(), rows["leader"].iloc[0]
        size, side, least = rows["n_shingles"].to_numpy(), rows["side"].to_numpy(), least_matches(self.similarity)
        sign = _signature_matrix(rows["signature"])
        group = pd.factorize(component)[0]
        found = []
        for i in np.flatnonzero(side != 1):
            # Pairs with the least node have been confirmed or refused; components that are
            # connected already need no further pair.
            others = np.flatnonzero(((side == 1) | ((side == 2) & (node > node[i]))) & (group != group[i]) & (node != leader))
            others = others[np.minimum(size[others], size[i]) * 100 >= np.maximum(size[others], size[i]) * self.similarity]
            if node[i] == leader or not len(others):
                continue
            others = others[(sign[others] == sign[i]).sum(1) >= least]
            if len(others):
                _, firsts = np.unique(group[others], return_index=True)
                found.extend((component[i], component[others[k]]) for k in firsts)
                group[np.isin(group, group[others])] = group[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def open_families(postings: DataFrame, nodes: DataFrame, groups: DataFrame, similarity: int) -> DataFrame:
    """node, component, n_shingles and family of the nodes that may have links between components. Staged.

    Any two nodes of different components that may have a link are in the same family.
    """
    placed = postings.join(groups, "node", "left")
    placed = placed.select("posting", "node", F.coalesce("component", "node").alias("component"))
    lists = placed.groupBy("posting").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("node").alias("leader"), F.count("*").alias("nodes"),
    ).filter("low <> high AND nodes > 2").select(F.col("posting").alias("of_list"), "leader", "nodes")
    mixed = placed.join(lists, F.col("posting") == F.col("of_list"))
    parts = F.ceil(F.col("nodes") / BLOCK)
    meeting = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("other")
    cut = mixed.select("*", F.pmod(F.xxhash64("node"), parts).alias("part"), meeting)
    # Part p of a list meets every part q: as the left side of (p, q) for p < q, as the right side for p > q.
    blocks = cut.select(
        "node", "component", "leader", "posting",
        F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"),
        F.when(F.col("part") < F.col("other"), 0).when(F.col("part") > F.col("other"), 1).otherwise(2).alias("side"),
    ).join(nodes.select("node", "n_shingles", "signature"), "node")
    compare = CompareBlock(similarity)
    meetings = blocks.groupBy("posting", "first", "second").applyInPandas(lambda block: compare(block), "a bigint, b bigint")
    families = connected_components(stage(meetings.distinct(), "meetings"))
    families = families.select(F.col("node").alias("component"), F.col("component").alias("family"))
    members = placed.select("node", "component").distinct().join(families, "component")
    return stage(members.join(nodes.select("node", "n_shingles"), "node"), "families")


def repeated_rows(rows: DataFrame) -> DataFrame:
    """The doc_id and text_hash of nodes' rows that several rows share. Staged."""
    counted = rows.filter("n_shingles > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    return stage(counted.filter("rows > 1").select("doc_id", "text_hash"), "repeated-rows")


def components_of(docs: DataFrame, rows: DataFrame, nodes: DataFrame, width: int, similarity: int) -> DataFrame:
    """node and component of every node that has a link. Staged."""
    postings, repeated = prefixes(nodes, similarity), repeated_rows(rows)

    def confirm(blocks: DataFrame) -> DataFrame:
        return stage(confirmed(stage(blocks, "dedup-blocks"), docs, nodes, repeated, width, similarity), "links")

    links = confirm(star_blocks(stage(star_pairs(postings, nodes, similarity), "star-pairs")))
    groups = stage(connected_components(links), "groups")
    families = open_families(postings, nodes, groups, similarity)
    if families.isEmpty():
        return groups
    more = confirm(family_blocks(families))
    return groups if more.isEmpty() else stage(connected_components(links.unionByName(more)), "groups")


def judged(docs: DataFrame, width: int, similarity: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of every document, and whether its text stands for the group.

    Of a group, ``stands`` is true for the rows of its least id (none comes last) and text hash.
    """
    rows, nodes = classes(docs, width)
    groups = components_of(docs, rows, nodes, width, similarity)
    grouped = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "text_hash")).alias("least")
    heads = grouped.groupBy("component").agg(least)
    named = grouped.join(heads, "component").select(F.col("digest").alias("of"), "least")
    joined = rows.select("doc_id", "text_hash", "digest", "n_shingles").join(named, F.col("digest") == F.col("of"), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least.doc_id"))
    kept = F.col("doc_id").eqNullSafe(component)
    stands = (F.col("n_shingles") == 0) | (kept & (F.col("text_hash") == F.col("least.text_hash")))
    return joined.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), kept.alias("kept"), stands.alias("stands")
    )


def near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (least id of the group) and kept of every document."""
    return judged(docs, width, similarity).select("doc_id", "n_shingles", "component_id", "kept")


def rows_named(docs: DataFrame, keys: DataFrame, kind: str) -> DataFrame:
    """The rows of ``docs`` whose id and text are among ``keys`` (doc_id, text_hash; staged), or are not: a semi or anti join."""
    keys = keys.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"))
    same_id = docs["doc_id"].cast("bigint").eqNullSafe(keys["of"])
    same_text = F.xxhash64(docs["text"].cast("string")) == keys["of_hash"]
    small = keys.count() <= BROADCAST_NODES
    return docs.join(F.broadcast(keys) if small else keys, same_id & same_text, kind)


def distinct_documents(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that have the least id of their group, unchanged; rows without an id stay."""
    found = judged(docs, width, similarity).filter("NOT kept AND doc_id IS NOT NULL")
    return rows_named(docs, stage(found.select("doc_id", "text_hash").distinct(), "duplicates"), "left_anti")


def one_of_each_group(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each group, unchanged, also of rows that share an id or have none.

    It is the one of the least id (none comes last) and text hash; of rows that repeat both, one
    of the least hash over all columns. Rows without words are linked to nothing, and all stay.
    """
    found = judged(docs, width, similarity).filter("n_shingles > 0")
    keys = found.groupBy("doc_id", "text_hash").agg(F.bool_and("stands").alias("stands"), F.count("*").alias("rows"))
    listed = stage(keys.filter("NOT stands OR rows > 1"), "duplicates")
    single = rows_named(docs, listed, "left_anti")
    repeated = listed.filter("stands")
    if repeated.isEmpty():
        return single
    # Each task first cuts the rows of a key to one, so that a key of many rows is no group in one task.
    rows = rows_named(docs, repeated, "left_semi").select(F.struct("*").alias("row"))
    key = [F.col("row.doc_id").alias("id"), F.xxhash64(F.col("row.text").cast("string")).alias("hash")]
    firsts = rows.groupBy(*key).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return single.unionByName(firsts.select("row.*"))
