"""Byte-level BPE by dynamic programming over prefixes, with exact decoding.

The encoding of every prefix of a string ends in exactly one token, and cutting that token off
leaves the encoding of a shorter prefix. So one pass suffices: an automaton over the vocabulary
names all tokens that are a suffix of the current prefix, and the one that may follow the last
token of the prefix before it is stored. Two tokens may follow each other if merging their
characters gives the two back. The ids are then read off by following the stored tokens
backwards. The time is linear in the string, whatever it consists of.

The texts are first cut as the tokenizer's pattern does, and special tokens in them are kept
whole, as the tokenizer does by default. The encoding of a pre-token is remembered by the task.

Defined results: a null or empty text has no tokens; rows are encoded one by one, so that
repeated rows agree; other columns are not read. Whole texts are encoded, of any length.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from lakezones.llm.text import Remembered, filesystem

# Fixed value: the pattern that cuts a text before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# What a task remembers: pre-tokens (in each of two generations) and pairs (emptied when full).
REMEMBERED_PRETOKENS = 150_000
REMEMBERED_LENGTH = 64
REMEMBERED_PAIRS = 200_000

DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


@cache
def unassigned() -> tuple[re.Pattern, re.Pattern]:
    """What finds code points without a character in Python's tables, on which pattern engines may differ.

    The first pattern finds anything from the first such code point on, which is faster.
    """
    free = [code for code in range(0x110000) if unicodedata.category(chr(code)) == "Cn"]
    starts = [code for code, before in zip(free, [-2, *free]) if code != before + 1]
    ends = [code for code, after in zip(free, [*free[1:], -2]) if code != after - 1]
    ranges = "".join(rf"\U{first:08X}-\U{last:08X}" for first, last in zip(starts, ends))
    return re.compile(rf"[\U{free[0]:08X}-\U0010FFFF]"), re.compile(f"[{ranges}]")


def byte_characters() -> list[str]:
    """The character by which the vocabulary writes each byte: itself if visible, else from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(byte if byte in visible else next(rest)) for byte in range(256)]


class PrefixEncoder:
    """Encodes and decodes as the tokenizer in a JSON description of a byte-level BPE does."""

    def __init__(self, description: dict):
        model = description["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.never = len(self.ranks)
        made = {"".join(pair): rank for rank, pair in reversed(list(enumerate(pairs)))}
        # A merge always comes after those that make its parts; if not, pairs are merged in full.
        self.ordered = all(made.get(part, -1) < rank for pair, rank in self.ranks.items() for part in pair)
        self.special = {token["content"]: token["id"] for token in description["added_tokens"]}
        self.letters = byte_characters()
        self.table = {byte: letter for byte, letter in enumerate(self.letters)}
        self.automaton = ahocorasick.Automaton()
        for token in self.ids:
            self.automaton.add_word(token, token)
        self.automaton.make_automaton()
        back = {letter: byte for byte, letter in enumerate(self.letters)}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, number in self.ids.items():
            self.bytes[number] = bytes(back[letter] for letter in token)
        for token, number in self.special.items():
            self.bytes[number] = token.encode()
        self.cut = regex.compile(PATTERN)
        self.late, self.unassigned = unassigned()
        self.own_cut = ByteLevel(add_prefix_space=False, use_regex=True, trim_offsets=False)
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known = Remembered(REMEMBERED_PRETOKENS, REMEMBERED_LENGTH, self._packed)
        self.spines: dict[str, tuple[bool, list, list]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, letters: str) -> list[str]:
        """Tokens by applying the merges in order; for the few letters of one or two tokens."""
        parts = list(letters)
        while len(parts) > 1:
            ranked = [self.ranks.get(pair, self.never) for pair in zip(parts, parts[1:])]
            best = min(ranked)
            if best == self.never:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, token: str) -> tuple[bool, list, list]:
        """Whether the merges give the token whole, and what was at its ends over time.

        The first list has each part that was the rightmost one while the token was merged, with
        the ranks of the merges that made and took it; the second has the leftmost ones.
        """
        found = self.spines.get(token)
        if found is None:
            parts, right, left = list(token), [(token[-1], -1)], [(token[0], -1)]
            while len(parts) > 1:
                ranked = [self.ranks.get(pair, self.never) for pair in zip(parts, parts[1:])]
                best = min(ranked)
                if best == self.never:
                    break
                at = ranked.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if at == len(parts) - 1:
                    right.append((parts[-1], best))
                if at == 0:
                    left.append((parts[0], best))
            ends = [
                [(part, made, taken) for (part, made), (_, taken) in zip(side, [*side[1:], ("", self.never)])]
                for side in (right, left)
            ]
            found = self.spines[token] = (len(parts) == 1, *ends)
        return found

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the merges leave the two tokens apart and whole.

        They do not if a pair of parts, one at the end of the left token and one at the start
        of the right, is there at the same time as its own merge is due. Of equal merges the
        one further left comes first.
        """
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            found = self._stay_apart(left, right)
            self.pairs[left, right] = found
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        if not self.ordered:
            return self.merged(left + right) == [left, right]
        for part, made, taken in self.spine(left)[1]:
            for other, other_made, other_taken in self.spine(right)[2]:
                rank = self.ranks.get((part, other))
                if rank is not None and made < rank < taken and other_made < rank <= other_taken:
                    return False
        return self.spine(right)[0]

    def pretoken(self, text: str) -> list[int]:
        """The ids of one pre-token."""
        letters = text.encode().decode("latin-1").translate(self.table)
        last: list[str | None] = [None] * len(letters)
        for end, token in self.automaton.iter(letters):
            if last[end] is None:
                start = end - len(token)
                if start < 0:
                    fits = self.spine(token)[0]
                else:
                    fits = last[start] is not None and self.may_follow(last[start], token)
                if fits:
                    last[end] = token
        ids, end = [], len(letters) - 1
        while end >= 0:
            token = last[end]
            ids.append(self.ids[token])
            end -= len(token)
        return ids[::-1]

    def _packed(self, pretoken: str) -> bytes:
        return np.array(self.pretoken(pretoken), "<u4").tobytes()

    def _cut(self, text: str) -> list[str]:
        """Pre-tokens. Characters newer than the tokenizer's tables are left to its own cutting."""
        if text.isascii() or not self.late.search(text) or not self.unassigned.search(text):
            return self.cut.findall(text)
        return [text[start:end] for _, (start, end) in self.own_cut.pre_tokenize_str(text)]

    def _ordinary(self, text: str) -> list[bytes]:
        return self.known.all(self._cut(text))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.at_special is None:
            return b"".join(self._ordinary(text))
        parts, start = [], 0
        for match in self.at_special.finditer(text):
            parts.extend(self._ordinary(text[start : match.start()]))
            parts.append(self.special[match.group()].to_bytes(4, "little"))
            start = match.end()
        parts.extend(self._ordinary(text[start:] if start else text))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")


@cache
def encoder(path: str) -> PrefixEncoder:
    """The encoder of a description file, built once in each worker."""
    store, name = filesystem(path)
    with store.open_input_stream(name) as stream:
        return PrefixEncoder(json.loads(stream.read()))


@dataclass(frozen=True)
class Encode:
    """Adds the ids (little-endian unsigned 32-bit) of each ``text`` to its ``doc_id``."""

    path: str

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(self.path)
        for batch in batches:
            ids = pa.array((known.encode(text or "") for text in batch.column("text").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])


@dataclass(frozen=True)
class Decode:
    """The text of each row's ``ids``."""

    path: str

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(self.path)
        for batch in batches:
            texts = pa.array((known.decode(ids or b"") for ids in batch.column("ids").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])


@dataclass(frozen=True)
class Digest:
    """Encodes each ``text``, decodes the ids, and yields the digests of both."""

    path: str

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(self.path)
        names = [part.split()[0] for part in DIGESTS.split(", ")]
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for text in batch.column("text").to_pylist():
                ids = known.encode(text or "")
                counts.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(known.decode(ids).encode()).hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every document."""
    return _rows(docs).mapInArrow(Encode(path), "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text from doc_id and ids."""
    return encoded.select("doc_id", "ids").mapInArrow(Decode(path), "doc_id bigint, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    return _rows(docs).mapInArrow(Digest(path), DIGESTS)
