from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymeter.llm import byte_bpe as B
from waymeter.llm import queries

PATH = public_tokenizers.path(B.TOKENIZER)
ALPHABET = "aabcethsn '!.,\n\t \r  0129éüñ　中文字ẞ𝔘😀\x1c\x85ͅ؀१²'s't'll're՘Ᲊ࢏"
SPECIAL = ["hello<|endoftext|>world<|endoftext|><|endoftext|> ", "<|endoftext|>", "<|endoftext", " <|endoftext|> 's"]
EDGES = ["'s's 's !'s don't we'll\t're 'll'", "'", "''s", "x'", "x's", "'re'r", " \n \n x  ", " ", "\n", "\n\nx\n", "x" * 62, "x" * 63, "x" * 64, "y" * 700, "ab" * 300 + "x"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(known, texts):
    ids, sizes = B.encode_texts(known, pa.array(texts, pa.large_string()).fill_null(""))
    ends = np.append(0, np.cumsum(sizes))
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def plain_merges(v, data):
    """Look through all pairs for the leftmost of the lowest rank, again and again."""
    ids = [int(v.byte_ids[b]) for b in data]
    while True:
        found = [(v.rank_of[a << 32 | b], k) for k, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if a << 32 | b in v.rank_of]
        if not found:
            return ids
        rank, k = min(found)
        ids[k : k + 2] = [int(v.merged[rank])]


def test_ids_and_texts_equal_the_library(library, monkeypatch):
    rng = random.Random(1)
    v = B.vocabulary(PATH)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(4000)] + EDGES + [None, ""]
    for known in (200_000, 50):
        monkeypatch.setattr(B, "KNOWN", known)
        for some in (texts, [*SPECIAL, *texts[:50]]):
            k = B.Known(v)
            for part in (some[: len(some) // 2], some[len(some) // 2 :]):
                for text, ids in zip(part, ids_of(k, part), strict=True):
                    want = library.encode(text or "", add_special_tokens=False).ids
                    assert ids == want, text
                    assert B.decode_ids(v, np.array(ids, np.int64)) == library.decode(want, skip_special_tokens=False)


def test_trees_merge_as_a_search_over_all_pairs():
    v = B.vocabulary(PATH)
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b" thetionandsxy\xc3\xa9") for _ in range(rng.randint(1, 90))) for _ in range(600)] + [b"a" * 200, bytes(range(256))]
    ids, counts = B.encode_pieces(v, pieces)
    ends = np.append(0, np.cumsum(counts))
    for piece, a, b in zip(pieces, ends[:-1], ends[1:], strict=True):
        want = plain_merges(v, piece)
        assert ids[a:b].tolist() == want == B._tree_merges(v, piece)


def test_long_texts_are_cut_where_no_piece_goes_on(library, monkeypatch):
    monkeypatch.setattr(B, "SLICE_BYTES", 500)
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(9000)), "word   \n\n" * 900, "z" * 2500, *SPECIAL]
    for text, ids in zip(texts, ids_of(B.Known(B.vocabulary(PATH)), texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_bytes_that_are_no_text_and_unknown_ids(library, spark):
    v = B.vocabulary(PATH)
    rng = random.Random(4)
    raw = bytes(rng.randrange(256) for _ in range(3000))
    ids = v.byte_ids[np.frombuffer(raw, np.uint8)]
    assert B.decode_ids(v, ids) == library.decode(ids.tolist(), skip_special_tokens=False)
    rows = spark.createDataFrame([(1, [15496, None, 995, -5, 10**6]), (2, None), (3, [])], "i int, ids array<int>")
    assert {r.i: r.decoded for r in B.decode(rows).collect()} == {1: "Hello world", 2: "", 3: ""}


def test_other_files_are_refused(spark):
    with pytest.raises(ValueError, match="byte-level"):
        B.encode(spark.range(1).withColumn("text", F.lit("x")), path=public_tokenizers.path("word_bpe_49k.json"))


def test_given_and_odd_documents(library, given, odd, spark):
    for docs in (given("documents"), odd, odd.limit(0)):
        out = B.encode(docs)
        assert out.columns == [*docs.columns, "ids"]
        rows = out.collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    again = B.encode(odd.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2)), decoded="decoded")
    assert all(r.decoded == (r.text or "") for r in again.collect())
    assert all(r.decoded == (r.text or "") for r in B.decode(B.encode(odd)).collect())


def test_query_returns_a_digest_of_every_document(library, spark, given):
    import hashlib

    got = queries.op13_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in given("documents").collect()}
    assert len(got) == len(texts)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hexed(",".join(map(str, ids))), hexed(library.decode(ids, skip_special_tokens=False)))
