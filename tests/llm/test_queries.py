"""The registered queries against their SQL, and those without SQL against the libraries."""

import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lakezones.llm.queries import ORACLES, QUERIES, TOKEN_LIMIT, tokenizer
from tests.oracle import compare, connect

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("folder", [SMALL, LARGER])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, folder, name):
    found = QUERIES[name](spark, folder).toPandas()
    expected = connect(folder).execute(ORACLES[name]).df()
    assert compare(found, expected) is None
    assert len(found) > 0


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_token_counts(spark):
    found = QUERIES["op2_token_counts"](spark, SMALL).toPandas().sort_values("doc_id")
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas().sort_values("doc_id")["text"].tolist()
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    counts = [len(ids) for ids in model.encode(texts, num_threads=1)]
    assert found["n_tokens"].tolist() == counts
    assert found["n_bytes"].tolist() == [len(text.encode()) for text in texts]
    assert found["over_limit"].tolist() == [count > TOKEN_LIMIT for count in counts]


def test_bpe_round_trip(spark):
    found = QUERIES["op3_bpe_round_trip"](spark, SMALL).toPandas().sort_values("doc_id")
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas().sort_values("doc_id")["text"].tolist()
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    ids = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert found["n_tokens"].tolist() == [len(i) for i in ids]
    assert found["ids_sha256"].tolist() == [hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() for i in ids]
    decoded = [library.decode(i, skip_special_tokens=False) for i in ids]
    assert found["decoded_sha256"].tolist() == [hashlib.sha256(text.encode()).hexdigest() for text in decoded]


def test_token_files(spark):
    found = QUERIES["op9_token_files"](spark, SMALL).toPandas().sort_values("doc_id")
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas().sort_values("doc_id")["text"].tolist()
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    ids = [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]
    counts = np.array([len(i) for i in ids])
    assert found["n_tokens"].tolist() == counts.tolist()
    assert found["start"].tolist() == (np.cumsum(counts) - counts).tolist()
    assert found["ids_crc32"].tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]


def test_classifier_on_held_out_labels(spark):
    found = QUERIES["op7_quality_classifier"](spark, LARGER).toPandas()
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas()
    assert found["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found["doc_id"]]
    assert found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= 0.7)).all()
    held = found[found["held_out"]].merge(labels, on="doc_id")
    good, bad = held[held["quality"] == 1]["score"], held[held["quality"] == 0]["score"]
    better = np.mean([(good > score).mean() + (good == score).mean() / 2 for score in bad])
    assert len(bad) > 5 and better > 0.95
    assert (held["predicted"] == held["quality"]).mean() > 0.9
