import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakezones.llm import bpe, token_counts, token_files
from lakezones.llm.queries import tokenizer

BYTE, PIECE, WORD = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), tokenizer("word_bpe_49k.json")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECE)
BYTE_LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)

EDGES = [
    "", " ", "  ", "\n", "\n\n a", "a\n b", " a ", "\t\x0b\x0c\r", "▁", "▁▁ x", "\x00\x01", "<s>x</s>", "<unk>", "<0x0A>",
    "a<|endoftext|>b", "<|endoftext|><|startoftext|> <|endoftext|>", "I'll we've 'S 'll", "=" * 300, "a" * 5000,
    "\x1c\x1d a\x85b\xa0c​d　e", "é é ﬁ Å Σ ΑΣ.", "😀😀👩‍👩‍👧", "՘࢏꟎", "x y z", "١٢٣ ½ ²",
]
TEXTS = st.text(st.one_of(st.sampled_from(" \n\t▁aeiou'st<|>"), st.characters(exclude_categories=("Cs",))), max_size=60)


def byte_ids(text):
    return BYTE_LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_prefix_encoding(text):
    encoder = bpe.encoder(BYTE)
    ids = encoder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == byte_ids(text)
    assert encoder.decode(ids) == BYTE_LIBRARY.decode(byte_ids(text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_piece_counts(text):
    counter = token_counts.counter(PIECE)
    assert sum(counter.count(token_counts.pretokens(text))) == len(MODEL.encode(text))


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_encoding(text):
    found = np.frombuffer(token_files.encoder(WORD).encode(text), "<u2").tolist()
    assert found == WORD_LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", EDGES)
def test_edge_texts(text):
    encoder = bpe.encoder(BYTE)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == byte_ids(text)
    assert encoder.decode(encoder.encode(text)) == text
    assert sum(token_counts.counter(PIECE).count(token_counts.pretokens(text))) == len(MODEL.encode(text))
    test_word_encoding.hypothesis.inner_test(text)


def test_every_code_point_is_cut_as_the_library_does():
    encoder = bpe.encoder(BYTE)
    for first in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}1! {chr(c)}" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == byte_ids(text), hex(first)


def test_pairs_by_spine_and_by_merging_agree():
    encoder, rnd = bpe.encoder(BYTE), random.Random(4)
    tokens = rnd.sample(sorted(encoder.ids), 3000)
    assert encoder.ordered
    for left, right in zip(tokens, tokens[1:]):
        assert encoder._stay_apart(left, right) == (encoder.merged(left + right) == [left, right])


def test_memory_forgets_but_stays_right():
    encoder = bpe.PrefixEncoder.__new__(bpe.PrefixEncoder)
    encoder.__dict__ |= bpe.encoder(BYTE).__dict__
    encoder.known = type(encoder.known)(3, 8, encoder._packed)
    text = "one two three four five six seven eight nine ten one two extraordinarily" * 3
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == byte_ids(text)
    assert len(encoder.known.young) <= 3 and len(encoder.known.old) <= 3


def table(docs, prose):
    rows = list(enumerate([None, *EDGES, prose(1), prose(2, 40_000), prose(1)], 10))
    return rows + [(10, "again"), (None, "no id"), (None, None)], docs


def test_documents_encode_and_decode(docs, prose):
    rows, make = table(docs, prose)
    encoded = bpe.encode_documents(make(rows), BYTE)
    texts = bpe.decode_documents(encoded, BYTE)
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(map(tuple, texts.collect()), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert bpe.round_trip_digests(make(rows).filter("false"), BYTE).collect() == []


@pytest.mark.parametrize("common", [0, 5, 1000])
def test_document_counts(docs, prose, common):
    rows, make = table(docs, prose)
    named = make(rows).selectExpr("*", "1 AS n_tokens", "'x' AS pretoken", "2 AS pieces", "3 AS row")
    found = token_counts.count_tokens(named, PIECE, 4096, common).collect()
    expected = [(i, len((t or "").encode()), len(MODEL.encode(t or "")), len(MODEL.encode(t or "")) > 4096) for i, t in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert token_counts.count_tokens(named.filter("false"), PIECE, 4096, common).collect() == []


def test_files(docs, prose):
    rows, make = table(docs, prose)
    found = token_files.round_trip(make(rows).selectExpr("*", "1 AS start", "2 AS part", "3 AS ids"), WORD).collect()
    found = sorted(found, key=lambda row: row["start"])
    ids = [row["doc_id"] for row in found]
    assert ids == [None, None] + sorted(i for i in ids if i is not None)
    texts = {}
    for i, text in rows:
        texts.setdefault(i, []).append(text or "")
    start = 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
        sums = [zlib.crc32(np.array(WORD_LIBRARY.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes()) for t in texts[row["doc_id"]]]
        assert row["ids_crc32"] in sums
    assert token_files.round_trip(make(rows).filter("false"), WORD).collect() == []


def test_file_layout(spark, docs, tmp_path):
    parts = token_files.write_token_files(docs([(2, "b"), (1, "a a"), (3, None)], 1), str(tmp_path / "out"), WORD)
    ids, places, names = [], [], []
    for part in parts.orderBy("part").collect():
        values = np.memmap(part["path"] + ".ids", "<u2")
        offsets = np.fromfile(part["path"] + ".offsets", "<u8").astype(int)
        assert len(values) == part["ids"] == offsets[-1] and len(offsets) == part["documents"] + 1
        assert part["base"] == len(ids)
        places += (offsets[:-1] + part["base"]).tolist()
        ids += values.tolist()
        names += np.fromfile(part["path"] + ".docs", "<i8").tolist()
    word = lambda text: WORD_LIBRARY.encode(text, add_special_tokens=False).ids
    assert names == [1, 2, 3] and ids == word("a a") + [2] + word("b") + [2, 2]
    assert places == [0, len(word("a a")) + 1, len(word("a a")) + len(word("b")) + 2]


def test_only_the_most_common_pretokens_are_broadcast(spark, docs):
    pieces = token_counts.piece_table(docs([(1, "a b a\nc"), (2, "a")]), PIECE)
    assert {row["pretoken"]: row["times"] for row in pieces.collect()} == {"▁a": 3, "▁b": 1, "\n": 1, "c": 1}


def test_token_files_are_read_by_many_tasks(docs, tmp_path):
    rows = [(i, f"Text number {i} " * (i % 7)) for i in range(300)]
    parts = token_files.write_token_files(docs(rows), str(tmp_path / "files"), WORD)
    whole = sorted(map(tuple, token_files.read_token_files(parts).collect()))
    cut = token_files.read_token_files(parts, documents=4)
    assert sorted(map(tuple, cut.collect())) == whole
    assert cut.select(F.spark_partition_id().alias("task")).distinct().count() >= 64
    # A few long documents are cut by their ids.
    assert sorted(map(tuple, token_files.read_token_files(parts, ids=10).collect())) == whole


def test_capitals_count_where_the_vocabulary_says_so():
    from tokenizers import Tokenizer, models, normalizers

    library = Tokenizer(models.WordLevel({"Ab": 0, "ab": 1, "A": 2, "a": 3, "[UNK]": 4}, unk_token="[UNK]"))
    library.normalizer = normalizers.Replace("x", "x")
    words = token_files.WordEncoder(library.to_str())
    assert not words.folds and not words.direct and words.encode("Ab ab") != words.encode("ab ab")
    encoder = token_files.encoder(WORD)
    assert encoder.folds and encoder.splits and encoder.direct


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeinrstxyzAEß'.,;:!?#$%*<|>"), st.characters(max_codepoint=0x24F, exclude_categories=("Cs",))), max_size=24))
def test_plain_words_are_encoded_as_the_library_does(text):
    encoder = token_files.encoder(WORD)
    expected = WORD_LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == expected
