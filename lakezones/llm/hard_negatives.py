"""Hard negatives: rows of another label that score a little less than an anchor's positives.

A vector's components become ``floor(SCALE * x)``, and the score of two rows is the inner product
of these integers. An anchor's positives are its best other rows of the same label. A negative of an
anchor and a positive is a row of another label whose score is ``low`` to ``high`` percent of the
positive's; the best of them are returned.

Method: angular triangle filtering. Each row is stored with its norm and its angles to a few
reference directions. If an anchor and a row have the angles a and b to a reference, the angle
between them lies from |a - b| to a + b, so that their cosine lies in an interval, and its score in
that interval times both norms, widened by more than rounding can take off. Only rows whose interval
meets a window (the score to beat among positives, the scores between ``low`` and ``high`` percent
among negatives) are scored, in exact integers. References only decide how much is skipped: they
are spread over at most ``SAMPLE_ROWS`` vectors.

Anchors meet all rows in blocks. Rows are sorted by label, nearest reference and angle,
and consecutive ones are packed, so that a block has few labels and narrow angles and is often
skipped whole. Blocks form slabs, at most ``MOST_SLABS`` of ``SLAB_ROWS`` or more rows; anchors,
packed the same way, are sent to each slab that they need. A task streams pairs of packed
blocks, keeps the best rows of the anchors at hand, which raises the score to beat, and yields a few
rows for each anchor and slab. Slabs are cut by number of rows, so that one label with a third
of all rows, or one vector that very many rows share, is spread over many of them.

Defined results: rows with a null label, a null vector or a component that is null or not finite
take no part, nor do rows whose integer vector has a squared norm beyond ``MOST_SQUARED``, as scores
would not fit into 64 bits. Rows that repeat id, label and vector count once. Rows that share an
id but not the rest are rows of their own. A null id is no anchor, unless the caller says so, and
comes after all others in a tie. Vectors of different lengths are compared as if the shorter one
went on with zeros. A vector of zeros scores 0 with all. An anchor without positives, and a positive
without negatives, give no rows; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakezones.session import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# Percent of a positive's score between which a negative lies.
LOW, HIGH = 80, 100

REFERENCES = 16
# Vectors from which the references are chosen.
SAMPLE_ROWS = 1024

# Rows of a block and of a packed set of anchors, and bytes of either.
BLOCK_ROWS = 2048
ANCHOR_ROWS = 256
PACKED_BYTES = 4 << 20
SLAB_ROWS = 4096
MOST_SLABS = 2000
# Packed anchors whose best rows a task remembers at once.
KEPT_ANCHORS = 64

# Five times this still fits into 64 bits.
MOST_SQUARED = 1 << 60
# Integers up to this are exact as floating point numbers.
EXACT = 1 << 53
# More than the rounding of an angle, its cosine and the norms can come to, relative to both norms.
SLACK = 1e-5

CODED = "vec_id bigint, label bigint, vector binary, key bigint, squared double, angles binary, nearest int, angle float"
PACKED = (
    "slab int, number int, labels array<bigint>, ids array<bigint>, keys array<bigint>, row_labels array<bigint>,"
    " width int, vectors binary, norms binary, angles binary"
)
FOUND = "number bigint, row int, anchor_id bigint, id bigint, key bigint, score bigint"
MINED = (
    "number bigint, row int, positive int, anchor_id bigint, positive_id bigint, positive_score bigint,"
    " id bigint, key bigint, score bigint"
)


def _schema(text: str) -> pa.Schema:
    types = {
        "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "float": pa.float32(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, types[kind]) for name, kind in (part.split() for part in text.split(","))])


# -- Rows ----------------------------------------------------------------------------------------


def usable(items: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """The rows that take part, their vectors as 64-bit floating point numbers."""
    rows = items.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    infinite = F.lit(float("inf"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)


def spread(vectors: list[np.ndarray], count: int) -> np.ndarray:
    """Up to ``count`` directions among the vectors, each far from those before it; rows of length 1."""
    width = max((len(vector) for vector in vectors), default=0)
    padded = np.zeros((len(vectors), width))
    for row, vector in zip(padded, vectors):
        row[: len(vector)] = vector
    norms = np.linalg.norm(padded, axis=1)
    units = padded[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.zeros((0, width))
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < count:
        next_one = int(np.argmin(nearest))
        if nearest[next_one] > 1 - 1e-9:
            break
        chosen.append(next_one)
        nearest = np.maximum(nearest, units @ units[next_one])
    return units[chosen]


def references(rows: DataFrame, scale: int, count: int, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Directions to measure angles against, from ``sample_rows`` vectors with the least hashes."""
    sample = rows.orderBy(F.xxhash64("embedding")).limit(sample_rows).select("embedding").collect()
    return spread([_integers(np.array(row[0], float), scale) for row in sample], count)


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    """The components as whole numbers, cut where they could not take part anyway."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -(2.0**40), 2.0**40)


@dataclass(frozen=True)
class Code:
    """Integer vectors with their norms, and their angles to the references."""

    references: np.ndarray
    scale: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(CODED)
        for batch in batches:
            lists = batch.column("embedding")
            flat = _integers(lists.flatten().to_numpy(zero_copy_only=False), self.scale)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            coded = [self._one(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            kept = np.array([one is not None for one in coded], bool)
            if not kept.any():
                continue
            columns = zip(*[one for one in coded if one is not None])
            ids = [batch.column(name).filter(pa.array(kept)) for name in ("vec_id", "label")]
            arrays = [*ids, *(pa.array(column, kind) for column, kind in zip(columns, schema.types[2:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def _one(self, vector: np.ndarray) -> tuple | None:
        squared = float(vector @ vector)
        if squared > MOST_SQUARED:
            return None
        angles = np.full(len(self.references), np.pi / 2)
        width = min(len(vector), self.references.shape[1])
        if squared > 0:
            angles = np.arccos(np.clip(self.references[:, :width] @ vector[:width] / np.sqrt(squared), -1, 1))
        nearest = int(np.argmin(angles)) if len(angles) else 0
        packed = vector.astype("<i4").tobytes()
        # Zeros at the end change no score.
        key = int.from_bytes(hashlib.blake2b(packed.rstrip(b"\0"), digest_size=8).digest(), "little", signed=True)
        return packed, key, squared, angles.astype("<f4").tobytes(), nearest, float(angles[nearest]) if len(angles) else 0.0


# -- Blocks --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pack:
    """Packs consecutive rows of a sorted partition; rows that repeat are next to each other."""

    most: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, number = TaskContext.get().partitionId(), 0
        rows, size, last = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                same = (row["label"], row["key"], row["vec_id"])
                if same == last:
                    continue
                last = same
                rows.append(row)
                size += len(row["vector"])
                if len(rows) >= self.most or size >= PACKED_BYTES:
                    yield self._packed(slab, number, rows)
                    rows, size, number = [], 0, number + 1
        if rows:
            yield self._packed(slab, number, rows)

    def _packed(self, slab: int, number: int, rows: list[dict]) -> pa.RecordBatch:
        # The order of ties: by id, null last, then by key.
        rows = sorted(rows, key=lambda row: (row["vec_id"] is None, row["vec_id"] or 0, row["key"], row["label"]))
        width = max(len(row["vector"]) for row in rows)
        packed = {
            "slab": slab, "number": number, "labels": sorted({row["label"] for row in rows}),
            "ids": [row["vec_id"] for row in rows], "keys": [row["key"] for row in rows],
            "row_labels": [row["label"] for row in rows], "width": width // 4,
            "vectors": b"".join(row["vector"].ljust(width, b"\0") for row in rows),
            "norms": np.sqrt([row["squared"] for row in rows]).astype("<f8").tobytes(),
            "angles": b"".join(row["angles"] for row in rows),
        }
        return pa.RecordBatch.from_pylist([packed], _schema(PACKED))


def _packed_rows(rows: DataFrame, code: Code, parts: int, most: int, label: str) -> DataFrame:
    """The rows in packed blocks, ``parts`` slabs of consecutive ones; staged."""
    coded = rows.mapInArrow(code, CODED)
    order = ["label", "nearest", "angle", "key", F.asc_nulls_last("vec_id")]
    ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stage(ordered.mapInArrow(Pack(most), PACKED), label)


class Block:
    """A packed block in memory."""

    def __init__(self, row: dict, prefix: str = ""):
        self.ids, self.keys = row[prefix + "ids"], np.array(row[prefix + "keys"], np.int64)
        self.labels = np.array(row[prefix + "row_labels"], np.int64)
        count = len(self.ids)
        self.vectors = np.frombuffer(row[prefix + "vectors"], "<i4").reshape(count, row[prefix + "width"])
        self.norms = np.frombuffer(row[prefix + "norms"], "<f8")
        angles = np.frombuffer(row[prefix + "angles"], "<f4").reshape(count, -1)
        self.least, self.most = angles.min(axis=0), angles.max(axis=0)
        self.angles = angles
        self.cosines, self.sines = np.cos(angles).T.copy(), np.sin(angles).T.copy()
        self._known: np.ndarray | None = None

    def exact(self, kind: type) -> np.ndarray:
        if self._known is None or self._known.dtype != kind:
            self._known = self.vectors.astype(kind)
        return self._known


def block_bounds(anchors: Block, block: Block) -> np.ndarray:
    """For each anchor a bound that no score in the block exceeds."""
    apart = np.maximum(np.maximum(block.least - anchors.angles, anchors.angles - block.most), 0)
    cosine = np.cos(apart.max(axis=1, initial=0).astype(float)) + SLACK
    norm = np.where(cosine > 0, block.norms.max(), block.norms.min())
    return anchors.norms * norm * cosine + 1


def row_bounds(anchors: Block, block: Block, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that each chosen anchor and each row of the block can have."""
    shape = (len(chosen), len(block.ids))
    low, high = np.full(shape, -1, np.float32), np.full(shape, 1, np.float32)
    for reference in range(len(block.cosines)):
        cosines = np.outer(anchors.cosines[reference, chosen], block.cosines[reference])
        sines = np.outer(anchors.sines[reference, chosen], block.sines[reference])
        np.maximum(low, cosines - sines, out=low)
        np.minimum(high, cosines + sines, out=high)
    norms = np.outer(anchors.norms[chosen], block.norms)
    return norms * (low - SLACK) - 1, norms * (high + SLACK) + 1


def scores(anchors: Block, block: Block, chosen: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer scores of the chosen anchors and rows."""
    width = min(anchors.vectors.shape[1], block.vectors.shape[1])
    largest = anchors.norms[chosen].max() * block.norms[rows].max()
    # Partial sums stay below the product of the norms, so that nothing is lost in either type.
    kind = np.float64 if largest < EXACT / 2 else np.int64
    left, right = anchors.exact(kind)[chosen, :width], block.exact(kind)[rows, :width]
    return (left @ right.T).astype(np.int64)


# -- Positives and negatives ----------------------------------------------------------------------


class Best:
    """The best rows of a few windows: score descending, then id with null last, then key."""

    def __init__(self, most: int):
        self.most, self.rows = most, []

    def add(self, rows: list[tuple]) -> None:
        self.rows = sorted(self.rows + rows, key=_rank)[: self.most]

    @property
    def to_beat(self) -> int | None:
        return self.rows[-1][0] if len(self.rows) == self.most else None


def _rank(row: tuple) -> tuple:
    score, vec_id, key = row
    return -score, vec_id is None, vec_id or 0, key


def _top(values: np.ndarray, low: int, high: int, most: int) -> np.ndarray:
    """The places of the ``most`` greatest values from ``low`` to ``high``; of equal ones the first."""
    inside = np.flatnonzero((values >= low) & (values <= high))
    return inside[np.argsort(-values[inside], kind="stable")[:most]]


LEAST, GREATEST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class FindPositives:
    """The best rows of an anchor's label in each block that it meets."""

    most: int

    def state(self, anchors: dict, block: Block) -> list[Best]:
        return [Best(self.most) for _ in block.ids]

    def meet(self, anchors: Block, block: Block, best: list[Best]) -> None:
        beat = np.array([LEAST if one.to_beat is None else one.to_beat for one in best], float)
        shared = np.isin(anchors.labels, block.labels)
        chosen = np.flatnonzero(shared & (block_bounds(anchors, block) >= beat))
        if not len(chosen):
            return
        low, high = row_bounds(anchors, block, chosen)
        same = anchors.labels[chosen][:, None] == block.labels
        itself = np.zeros_like(same)
        for at, anchor in enumerate(chosen):
            itself[at] = same[at] & (block.keys == anchors.keys[anchor])
            if itself[at].any():
                itself[at] &= np.array([one == anchors.ids[anchor] for one in block.ids])
        open_rows = same & ~itself
        # The rows that surely are among the best tell which others cannot be.
        sure = np.where(open_rows, low, -np.inf)
        if sure.shape[1] > self.most:
            sure = np.partition(sure, -self.most, axis=1)[:, -self.most]
            beat = np.maximum(beat[chosen], sure)
        else:
            beat = beat[chosen]
        open_rows &= high >= beat[:, None]
        rows = np.flatnonzero(open_rows.any(axis=0))
        if not len(rows):
            return
        found = scores(anchors, block, chosen, rows)
        for at, anchor in enumerate(chosen):
            values = np.where(open_rows[at, rows], found[at], LEAST - 1)
            places = _top(values, LEAST, GREATEST, self.most)
            best[anchor].add([(int(values[p]), block.ids[rows[p]], int(block.keys[rows[p]])) for p in places])

    def rows(self, number: int, anchors: dict, best: list[Best]) -> list[dict]:
        return [
            {"number": number, "row": row, "anchor_id": anchors["ids"][row], "id": vec_id, "key": key, "score": score}
            for row, one in enumerate(best)
            for score, vec_id, key in one.rows
        ]


@dataclass(frozen=True)
class FindNegatives:
    """The best rows of other labels in the window of each anchor and positive."""

    most: int
    low: int
    high: int

    def state(self, anchors: dict, block: Block) -> list[list[list]]:
        """For each anchor: [number of the positive, least score, greatest score, the best rows]."""
        windows: list[list[list]] = [[] for _ in block.ids]
        for one in anchors["positives"]:
            least, greatest = window(one["score"], self.low, self.high)
            if least <= greatest:
                windows[one["row"]].append([one, least, greatest, Best(self.most)])
        return windows

    def meet(self, anchors: Block, block: Block, windows: list[list[list]]) -> None:
        least, greatest = np.full(len(windows), np.inf), np.full(len(windows), -np.inf)
        for row, own in enumerate(windows):
            for one in own:
                beat = one[3].to_beat
                least[row] = min(least[row], one[1] if beat is None else max(one[1], beat))
                greatest[row] = max(greatest[row], one[2])
        chosen = np.flatnonzero(block_bounds(anchors, block) >= least)
        if not len(chosen):
            return
        low, high = row_bounds(anchors, block, chosen)
        open_rows = anchors.labels[chosen][:, None] != block.labels
        open_rows &= (high >= least[chosen, None]) & (low <= greatest[chosen, None])
        rows = np.flatnonzero(open_rows.any(axis=0))
        if not len(rows):
            return
        found = scores(anchors, block, chosen, rows)
        for at, anchor in enumerate(chosen):
            values = np.where(open_rows[at, rows], found[at], LEAST - 1)
            inside = np.flatnonzero((values >= least[anchor]) & (values <= greatest[anchor]))
            inside = inside[np.argsort(-values[inside], kind="stable")]
            ordered = values[inside]
            for one in windows[anchor]:
                first = np.searchsorted(-ordered, -one[2], side="left")
                places = [p for p, value in zip(inside[first:], ordered[first : first + self.most]) if value >= one[1]]
                if places:
                    one[3].add([(int(values[p]), block.ids[rows[p]], int(block.keys[rows[p]])) for p in places])

    def rows(self, number: int, anchors: dict, windows: list[list[list]]) -> list[dict]:
        return [
            {
                "number": number, "row": row, "positive": one["positive"], "anchor_id": anchors["ids"][row],
                "positive_id": one["id"], "positive_score": one["score"], "id": vec_id, "key": key, "score": score,
            }
            for row, own in enumerate(windows)
            for one, _, _, best in own
            for score, vec_id, key in best.rows
        ]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


@dataclass(frozen=True)
class Meet:
    """Runs pairs of packed anchors and blocks, in whatever order they come."""

    find: FindPositives | FindNegatives
    schema: str

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}
        name, block = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                pair = {column: batch.column(column)[at] for column in batch.schema.names}
                number, here = pair["number"].as_py(), (pair["slab"].as_py(), pair["block_number"].as_py())
                if number not in kept:
                    if len(kept) >= KEPT_ANCHORS:
                        oldest = next(iter(kept))
                        yield from self._given(oldest, kept.pop(oldest))
                    row = {column: value.as_py() for column, value in pair.items() if not column.startswith("block_")}
                    anchors = Block(row)
                    kept[number] = row, anchors, self.find.state(row, anchors)
                if here != name:
                    name, block = here, Block({column: value.as_py() for column, value in pair.items()}, "block_")
                _, anchors, state = kept[number]
                self.find.meet(anchors, block, state)
        for number, one in kept.items():
            yield from self._given(number, one)

    def _given(self, number: int, one: tuple) -> Iterator[pa.RecordBatch]:
        row, _, state = one
        rows = self.find.rows(number, row, state)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _schema(self.schema))


def _met(anchors: DataFrame, blocks: DataFrame, slabs: Column, parts: int) -> DataFrame:
    """Each pair of packed anchors and a block of the slabs that they are sent to."""
    sent = anchors.withColumn("slab", F.explode(slabs)).repartition(parts, "slab")
    held = blocks.select("slab", *[F.col(name).alias(f"block_{name}") for name in blocks.columns if name != "slab"])
    return sent.join(held.repartition(parts, "slab"), "slab")


def _first(found: DataFrame, keys: list[str], most: int, rank: str) -> DataFrame:
    """The first rows of each group: score descending, id with null last, key."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "key")
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= most)


def mine_hard_negatives(
    items: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    count_references: int = REFERENCES,
    slab_rows: int = SLAB_ROWS,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the columns vec_id, label and embedding of the rows that take
    part; every such row is an anchor against all rows.
    """
    if not 0 <= low <= high:
        raise ValueError("the window needs 0 <= low <= high")
    spark, rows = items.sparkSession, usable(items, vec_id, embedding, label)
    code = Code(references(rows, scale, count_references), scale)
    slabs = max(1, min(MOST_SLABS, -(-items.count() // slab_rows)))
    blocks = _packed_rows(rows, code, slabs, block_rows, "negatives-blocks")
    chosen = rows.filter(is_anchor)
    anchors = _packed_rows(chosen, code, max(1, min(MOST_SLABS, slabs // 16)), anchor_rows, "negatives-anchors")
    # A number of its own for each packed set: slab and place in it.
    anchors = anchors.withColumn("number", F.shiftleft(F.col("slab").cast("bigint"), 32) + F.col("number")).drop("slab")

    # One row per slab, at most MOST_SLABS of them.
    ranges = blocks.groupBy("slab").agg(F.min(F.array_min("labels")).alias("least"), F.max(F.array_max("labels")).alias("most"))
    known = [(row.slab, row.least, row.most) for row in ranges.collect()]
    if not known:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    places = F.array(
        *[F.struct(*[F.lit(value).cast("bigint").alias(name) for name, value in zip(("slab", "least", "most"), one)]) for one in known]
    )
    every = F.transform(places, lambda one: one["slab"].cast("int"))
    reached = F.transform(
        F.filter(places, lambda one: (one["least"] <= F.array_max("labels")) & (one["most"] >= F.array_min("labels"))),
        lambda one: one["slab"].cast("int"),
    )
    same = F.arrays_overlap("labels", "block_labels")
    pairs = _met(anchors, blocks, reached, slabs).filter(same)
    found = pairs.mapInArrow(Meet(FindPositives(positives), FOUND), FOUND)
    best = _first(found, ["number", "row"], positives, "positive")
    # At most anchor_rows times positives rows in a group.
    windows = best.groupBy("number").agg(F.collect_list(F.struct("row", "positive", "id", "score")).alias("positives"))
    with_windows = stage(anchors.join(windows, "number"), "negatives-windows")

    other = (F.size("labels") > 1) | (F.size("block_labels") > 1) | ~same
    pairs = _met(with_windows, blocks, every, slabs).filter(other)
    mined = pairs.mapInArrow(Meet(FindNegatives(negatives, low, high), MINED), MINED)
    ranked = _first(mined, ["number", "row", "positive"], negatives, "rank")
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
