"""Count tokens without building their ids.

The tokenizer's merges never cross certain places of a text: no vocabulary piece has a space mark
after another character, or contains a line feed. Between these places lie pre-tokens, and the
pieces of a text are those of its pre-tokens together. So the tokenizer is run once for each
distinct pre-token of all documents, and a document's count is the sum over its pre-tokens.

1. Every task counts the pre-tokens it meets, and the counts are added up.
2. The pieces of each distinct pre-token are counted, and the table of both is staged.
3. Every task counts the pre-tokens of each document. The most frequent pre-tokens, a fixed
   number of short ones, come as a broadcast table and are summed at once; the others are joined
   to the staged table, and the sums of a document added up. No key of that join is frequent.

Defined results: a null or empty text has no tokens; repeated rows are counted one by one; other
columns are not read. Whole texts are counted, of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import sentencepiece
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.llm.text import filesystem
from lakezones.session import stage

SPACE_MARK = "▁"
PRETOKEN = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}\n]*|\n+|[^{SPACE_MARK}\n]+")

# The broadcast table has at most so many pre-tokens of at most so many characters.
COMMON_PRETOKENS = 1 << 18
COMMON_LENGTH = 24
STEPS_PER_DOUBLING = 16

# What a task counts before it passes the counts on, and rows in one batch of results.
COUNTED_PRETOKENS = 300_000
BATCH_ROWS = 65_536

POSITION_BITS = 33


class PieceCounter:
    """Counts the pieces of a SentencePiece model in pre-tokens."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("\n" in piece or re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece) for piece in pieces):
            raise ValueError("this model has pieces that cross pre-tokens")
        # What stands before a text that starts in the middle of a line.
        self.lead = len(self.model.encode("\n"))

    def count(self, pretokens: list[str]) -> list[int]:
        """The number of pieces of each pre-token.

        The model puts a space mark before every text. That stands for the first mark of a
        pre-token; one without a mark is put after a line feed, whose pieces are taken off again.
        """
        texts = [p[1:] if p.startswith(SPACE_MARK) else "\n" + p for p in pretokens]
        found = self.model.encode(texts, num_threads=1)
        counts = [len(ids) if p.startswith(SPACE_MARK) else len(ids) - self.lead for p, ids in zip(pretokens, found)]
        # Nothing is put before an empty text.
        return [1 if p == SPACE_MARK else n for p, n in zip(pretokens, counts)]


@cache
def counter(path: str) -> PieceCounter:
    store, name = filesystem(path)
    with store.open_input_stream(name) as stream:
        return PieceCounter(stream.read())


def pretokens(text: str | None) -> list[str]:
    """The pre-tokens of a whole text."""
    return PRETOKEN.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []


def _counts(found: Counter) -> Iterator[pa.RecordBatch]:
    names, numbers = list(found), list(found.values())
    for at in range(0, len(names), BATCH_ROWS):
        part = slice(at, at + BATCH_ROWS)
        columns = [pa.array(names[part], pa.string()), pa.array(numbers[part], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["pretoken", "times"])


def count_pretokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a task meets each pre-token, in parts of bounded size."""
    found: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found.update(pretokens(text))
            if len(found) >= COUNTED_PRETOKENS:
                yield from _counts(found)
                found.clear()
    yield from _counts(found)


@dataclass(frozen=True)
class CountPieces:
    """Adds the number of pieces to each distinct pre-token."""

    path: str

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(self.path)
        for batch in batches:
            numbers = pa.array(pieces.count(batch.column("pretoken").to_pylist()), pa.int64())
            yield batch.append_column("pieces", numbers)


@dataclass(frozen=True)
class SumCommon:
    """For each document, the sum over its common pre-tokens, and its other ones with their number.

    ``row`` tells the rows apart. The first row of a document has its columns, the rows after it
    have a pre-token each.
    """

    common: Broadcast

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = self.common.value
        row = TaskContext.get().partitionId() << POSITION_BITS
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                total, others = 0, []
                for pretoken, times in Counter(pretokens(text)).items():
                    pieces = known.get(pretoken)
                    if pieces is None:
                        others.append((row, None, None, None, pretoken, times))
                    else:
                        total += pieces * times
                rows.append((row, doc_id, len(text.encode()) if text else 0, total, None, None))
                rows.extend(others)
                row += 1
                if len(rows) >= BATCH_ROWS:
                    yield _part(rows)
                    rows = []
            if rows:
                yield _part(rows)


PARTS = "row bigint, doc_id bigint, n_bytes bigint, n_tokens bigint, pretoken string, times bigint"


def _part(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in PARTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names)


def piece_table(docs: DataFrame, path: str) -> DataFrame:
    """Every distinct pre-token of the documents with its frequency and its pieces. Staged."""
    met = docs.select(F.col("text").cast("string")).mapInArrow(count_pretokens, "pretoken string, times bigint")
    distinct = met.groupBy("pretoken").agg(F.sum("times").alias("times"))
    return stage(distinct.mapInArrow(CountPieces(path), "pretoken string, times bigint, pieces bigint"), "pieces")


def common_pretokens(pieces: DataFrame, most: int) -> DataFrame:
    """The short pre-tokens of the greatest frequencies, at most ``most`` of them.

    They are cut off at a frequency, between steps of a logarithmic scale, so that nothing is sorted.
    """
    step = F.floor(F.log2("times") * STEPS_PER_DOUBLING)
    short = pieces.filter(F.length("pretoken") <= COMMON_LENGTH).withColumn("step", step)
    cut, total = None, 0
    for row in sorted(short.groupBy("step").count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        cut = row["step"]
    kept = short.filter(F.col("step") >= cut) if cut is not None else short.filter("false")
    return kept.select("pretoken", "pieces")


def count_tokens(docs: DataFrame, path: str, limit: int, common: int = COMMON_PRETOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more tokens than ``limit``) of every document."""
    spark = docs.sparkSession
    pieces = piece_table(docs, path)
    rows = common_pretokens(pieces, common).toArrow()
    table = dict(zip(rows.column("pretoken").to_pylist(), rows.column("pieces").to_pylist()))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    parts = texts.mapInArrow(SumCommon(spark.sparkContext.broadcast(table)), PARTS)
    # A first row has a key of its own, so that these do not meet as nulls.
    keyed = parts.withColumn("key", F.coalesce("pretoken", F.concat(F.lit("\n\n "), F.col("row").cast("string"))))
    joined = keyed.join(pieces.select(F.col("pretoken").alias("key"), "pieces"), "key", "left")
    tokens = F.coalesce("n_tokens", F.col("times") * F.col("pieces"))
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens")
    )
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
