"""Token ids in flat binary files with 64-bit document offsets, for memory-mapped reading.

A part of the output consists of three files: the ids as unsigned integers of the smallest
width that holds the vocabulary, one after another (``.ids``); for each document the place of
its first id in the part, and at the end the number of ids (``.offsets``, unsigned 64-bit);
and the ids of the documents (``.docs``, signed 64-bit, with the smallest one for null). All are
little-endian. Documents are in ascending order of doc_id within and across parts.

Each task writes one part and reports its sizes; prefix sums over the reports, one number per
part, give the place of every part in the whole. Parts are read back in pieces, by as many tasks. The files that count are those of the staged
report, so that a second attempt of a task does no harm.

Ids come from the tokenizer library, which is run once for each distinct word of a task: it
drops white space and merges nothing across it.

Defined results: a null or empty text has only the end id; rows with equal ids are all written,
in the order of a hash of their text; a null id comes first; an empty table gives no part;
other columns are not read. Whole texts are encoded, of any length.
"""

from __future__ import annotations

import json
import mmap
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakezones.llm.text import Remembered, filesystem, shared_folder, whole
from lakezones.session import scratch_path, stage

END_ID = 2
# ASCII white space, at which a text can be cut without changing its ids.
WORDS = re.compile("[^ \t\n\x0b\x0c\r]+")

# Marks that may be encoded apart from the letters before them.
MARKS = ".,;:!?#$%*"

# Letters up to this one are single characters in every normal form.
LAST_PLAIN = "ÿ"
# Words on which it is tried what a vocabulary allows: all letters up to there, alone and in words.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
SAMPLES = [*LETTERS, *(LETTERS[i : i + 1 + i % 9] for i in range(len(LETTERS) - 9)), "Reading", "THE", "Straße", "canción", "théâtre"]


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes: printable ones for themselves, the others from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()

# Documents, or ids, that one task reads back.
PIECE_DOCUMENTS = 1 << 16
PIECE_IDS = 1 << 24
# Read tasks at most; beyond, a task reads several pieces.
MOST_TASKS = 100_000

REMEMBERED_WORDS = 500_000
REMEMBERED_LENGTH = 64

PARTS = "part int, path string, documents bigint, ids bigint, width int"
NULL_ID = -(1 << 63)
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
BATCH_ROWS = 16_384


class WordEncoder:
    """Encodes whole texts as the library does, remembering the ids of words.

    What a vocabulary allows is tried on sample words: whether capitals make no difference, whether
    marks behind a word are encoded apart from it, and whether a plain word can be given to the model
    itself, without the steps before it. Words that are not plain always take all steps.
    """

    def __init__(self, description: str):
        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        lower = [word.lower() for word in SAMPLES]
        self.folds = all(self._ids(word) == self._ids(plain) for word, plain in zip(SAMPLES, lower))
        self.splits = all(self._ids(word + mark) == self._ids(word) + self._ids(mark) for word in lower for mark in (*MARKS, MARKS))
        # Of a vocabulary that tells capitals apart the samples say too little: most of them may be unknown to it.
        self.direct = self.folds and all(self._ids(word) == self._model_ids(word) for word in lower)
        self.known = Remembered(REMEMBERED_WORDS, REMEMBERED_LENGTH, self._packed)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _model_ids(self, word: str) -> list[int]:
        """The ids that the model alone gives for the bytes of a word, each as the character that stands for it."""
        return [token.id for token in self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_CHARACTERS))]

    def _packed(self, word: str) -> bytes:
        """Words that differ in capitals or in marks behind them are encoded once."""
        stem = word.rstrip(MARKS) if self.splits else word
        if stem != word and stem.isalpha():
            return b"".join(self.known.all([stem, word[len(stem) :]]))
        if not (word.isalpha() and max(word) <= LAST_PLAIN):
            return np.array(self._ids(word), self.dtype).tobytes()
        lower = word.lower()
        if self.folds and lower != word:
            return b"".join(self.known.all([lower]))
        ids = self._model_ids(word) if self.direct and lower == word else self._ids(word)
        return np.array(ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(self.known.all(WORDS.findall(text)))


@cache
def encoder(path: str) -> WordEncoder:
    store, name = filesystem(path)
    with store.open_input_stream(name) as stream:
        description = stream.read().decode()
    normalizer = json.dumps(json.loads(description).get("normalizer"))
    if r'"\\s+"' not in normalizer:
        raise ValueError("this tokenizer keeps white space, so that words cannot be encoded apart")
    return WordEncoder(description)


@dataclass(frozen=True)
class Writer:
    """Writes the rows of a task, which are in order, as one part below ``folder``."""

    folder: str
    path: str
    end_id: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(self.path)
        end = np.array([self.end_id], words.dtype).tobytes()
        store, folder = filesystem(self.folder)
        store.create_dir(folder, recursive=True)
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}-{uuid.uuid4()}"
        documents = ids = 0

        def opened(kind: str):
            return store.open_output_stream(f"{folder}/{name}.{kind}", compression=None, buffer_size=1 << 20)

        with opened("ids") as ids_file, opened("offsets") as offsets, opened("docs") as docs:
            for batch in batches:
                doc_ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                docs.write(doc_ids.astype("<i8").tobytes())
                starts = []
                for text in batch.column("text").to_pylist():
                    packed = words.encode(text) + end
                    ids_file.write(packed)
                    starts.append(ids)
                    ids += len(packed) // words.dtype.itemsize
                offsets.write(np.array(starts, "<u8").tobytes())
                documents += len(starts)
            offsets.write(np.array([ids], "<u8").tobytes())
        if documents:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()), pa.array([f"{self.folder}/{name}"]), pa.array([documents], pa.int64()),
                    pa.array([ids], pa.int64()), pa.array([words.dtype.itemsize], pa.int32()),
                ],
                ["part", "path", "documents", "ids", "width"],
            )


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents in order of doc_id; the staged list of parts with their bases."""
    texts = docs.select(F.col("doc_id").cast("bigint"), whole(F.col("text")).alias("text"))
    ordered = texts.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    parts = stage(ordered.mapInArrow(Writer(folder, path, end_id), PARTS), "token-parts")
    # One row per part, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class _Mapped:
    """A file as one buffer: memory-mapped where the store is a local or mounted folder."""

    def __init__(self, path: str):
        self.store, self.name = filesystem(path)

    def __enter__(self):
        if isinstance(self.store, pafs.LocalFileSystem):
            self.file = open(self.name, "rb")
            self.size = self.file.seek(0, 2)
            self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ) if self.size else b""
        else:
            self.file = self.store.open_input_file(self.name)
            self.size, self.map = self.file.size(), None
        return self

    def __exit__(self, *_):
        if self.map:
            self.map.close()
        self.file.close()

    def values(self, dtype: np.dtype, start: int, stop: int) -> np.ndarray:
        """A copy of the values from ``start`` to ``stop``."""
        first, last = start * dtype.itemsize, stop * dtype.itemsize
        data = self.map[first:last] if self.map is not None else self.file.read_at(last - first, first)
        return np.frombuffer(data, dtype)


def read_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of the pieces: its id, where its ids start, their number and checksum."""
    number, place = np.dtype("<i8"), np.dtype("<u8")
    names = [part.split()[0] for part in ROWS.split(", ")]
    for batch in batches:
        for part in batch.to_pylist():
            dtype, stop = np.dtype(f"<u{part['width']}"), part["first"] + part["count"]
            with _Mapped(part["path"] + ".ids") as ids, _Mapped(part["path"] + ".offsets") as offsets, _Mapped(
                part["path"] + ".docs"
            ) as docs:
                for at in range(part["first"], stop, BATCH_ROWS):
                    last = min(at + BATCH_ROWS, stop)
                    doc_ids = docs.values(number, at, last)
                    places = offsets.values(place, at, last + 1).astype("i8")
                    sums = [
                        zlib.crc32(ids.values(dtype, a, b).astype("<u4").tobytes())
                        for a, b in zip(places[:-1].tolist(), places[1:].tolist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID), pa.array(places[:-1] + part["base"]),
                            pa.array(np.diff(places)), pa.array(sums, pa.int64()),
                        ],
                        names,
                    )


def pieces_of(parts: DataFrame, documents: int = PIECE_DOCUMENTS, ids: int = PIECE_IDS) -> DataFrame:
    """The parts cut into pieces of about equal numbers of documents: ``first``, ``count`` and the number of the piece."""
    number = F.greatest(
        F.ceil(F.col("documents") / documents), F.least(F.ceil(F.col("ids") / ids), F.col("documents"))
    ).cast("bigint")
    # One row per part, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.withColumn("pieces", number).withColumn("earlier", F.coalesce(F.sum("pieces").over(before), F.lit(0)))
    cut = counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))

    def start(piece: Column) -> Column:
        return F.floor(F.col("documents") * piece / F.col("pieces")).cast("bigint")

    return cut.select(
        "path", "width", "base", (F.col("earlier") + F.col("piece")).alias("number"), start(F.col("piece")).alias("first"),
        (start(F.col("piece") + 1) - start(F.col("piece"))).alias("count"),
    )


def read_token_files(parts: DataFrame, documents: int = PIECE_DOCUMENTS, ids: int = PIECE_IDS) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files.

    Each piece is read by a task of its own: the tasks are numbered, as adaptive execution would merge
    the few small rows that name them.
    """
    pieces = pieces_of(parts, documents, ids)
    tasks = min(pieces.count(), MOST_TASKS)
    if not tasks:
        return parts.sparkSession.createDataFrame([], ROWS)
    dealt = pieces.repartitionById(tasks, (F.col("number") % tasks).cast("int"))
    return dealt.mapInArrow(read_parts, ROWS)


def round_trip(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files in the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, scratch_path(docs.sparkSession, "token-files"))
    return read_token_files(write_token_files(docs, folder, path, end_id))
