"""Encoding and decoding against the library, with and without the scan."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from recall_lens.llm import queries, sentencepieces
from recall_lens.llm.vocabulary import tokenizer_path

FOLDER = "/root/testdata/sf0.01"
ODD = ["", " ", "\n", "  a\n b\tc ", "日本語テスト🙂", "a▁b", "x\xa0y ﬁ é", "\x00\r\n", "\n\n a", "a  b   c    d" + " " * 40 + "e", "<s>hi</s> <0x41>", "a \nb", "a" * 90, "end. ", "▁▁ ▁"]


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces(tokenizer_path("piece_bpe_32k.model"))


def test_max_plus_product_is_associative_and_scans(pieces):
    rng = np.random.default_rng(1)
    ms = [np.where(rng.random((4, 4)) < 0.5, rng.integers(0, 9, (4, 4)), -np.inf) for _ in range(7)]
    whole = ms[0]
    for k, m in enumerate(ms):
        whole = m if k == 0 else sentencepieces.product(whole, m)
        assert np.array_equal(sentencepieces.scan(ms)[k], whole)


@pytest.mark.parametrize("chunk", [40, 64, 151])
def test_scanned_documents_equal_the_library(spark, pieces, chunk):
    rng = random.Random(chunk)
    texts = [*ODD, "thewordwithoutblank" * 40, *["".join(rng.choice("ab ▁\nthe日é🙂ing") for _ in range(300)) for _ in range(40)]]
    texts += [r.text[:2000] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = sentencepieces.encode(docs, chunk=chunk)
    rows = sentencepieces.decode(encoded).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == pieces.library.encode(texts[r.doc_id])
        assert r.text == texts[r.doc_id].replace("▁", " ")


def test_query_equals_the_library_and_round_trips(spark, pieces):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op7_sentencepieces(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == pieces.library.encode(texts[r.doc_id]) and r.n_ids == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1000, sentencepieces.CHUNK])
def test_awkward_documents(awkward, nothing, pieces, chunk):
    got = Counter((r.doc_id, tuple(r.ids)) for r in sentencepieces.encode(awkward, chunk=chunk).collect())
    assert got == Counter((r.doc_id, tuple(pieces.library.encode(r.text or ""))) for r in awkward.collect())
    assert sentencepieces.decode(sentencepieces.encode(nothing, chunk=chunk)).count() == 0


def test_decoding_any_ids(spark, pieces):
    ids = [[], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [259, 264], [1, 2, 264]]
    rows = sentencepieces.decode(spark.createDataFrame([*enumerate(ids), (9, None)], "doc_id long, ids array<int>")).collect()
    assert [r.text for r in sorted(rows, key=lambda r: r.doc_id)] == ["", "�", "é", "  a", "a", ""]
