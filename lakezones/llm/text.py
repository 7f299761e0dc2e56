"""Words, lines and shingles as column expressions, and the shared folder as seen by tasks.

A word is a longest run of characters that are not ASCII white space (space, tab to carriage
return). A null text counts as an empty one everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The ASCII white space that separates words, as characters and as a pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

LONG_ARRAY = "array<bigint>"


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """The words of ``text`` in order."""
    trimmed = F.btrim(whole(text), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN, -1))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def indices(count: Column) -> Column:
    """0, 1, ..., count - 1, and nothing for a count below 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, width: int) -> Column:
    """The hash of each run of ``width`` words; of all words together where there are fewer.

    ``words`` must be a column, not an expression: it is read once for every element.
    """
    hashes = F.transform(
        indices(F.size(words) - (width - 1)),
        lambda i: F.xxhash64(*[F.get(words, i + offset) for offset in range(width)]),
    )
    short = F.array(F.xxhash64(F.size(words), words))
    empty = F.array().cast(LONG_ARRAY)
    return F.when(F.size(words) == 0, empty).when(F.size(words) < width, short).otherwise(hashes)


class Remembered:
    """A bounded memory of packed ids by string, for one task after another in a worker.

    Two generations: what is met again moves to the young one; when that is full it becomes the
    old one, and what was not met since the last such change is forgotten.
    """

    def __init__(self, most: int, longest: int, pack: Callable[[str], bytes]):
        self.most, self.longest, self.pack = most, longest, pack
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def all(self, keys: list[str]) -> list[bytes]:
        """The packed ids of each string."""
        found = list(map(self.young.get, keys))
        if None in found:
            found = [packed if packed is not None else self._one(key) for packed, key in zip(found, keys)]
        return found

    def _one(self, key: str) -> bytes:
        packed = self.young.get(key)
        if packed is not None:
            return packed
        packed = self.old.get(key)
        if packed is None:
            packed = self.pack(key)
        if len(key) <= self.longest:
            if len(self.young) >= self.most:
                self.young, self.old = {}, self.young
            self.young[key] = packed
        return packed


def shared_folder(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of its store.

    Spark takes a path without scheme to be in its default store, a task that opens files by itself
    takes it to be on its own disk; with the scheme both mean the same place.
    """
    if ":/" in folder:
        return folder
    store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return folder if store.startswith("file:") else store.rstrip("/") + "/" + folder.lstrip("/")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it, for tasks that read and write files of their own format."""
    if ":/" not in uri:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)
