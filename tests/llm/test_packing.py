from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from waymeter.llm import packing as P


@pytest.fixture(scope="module")
def ids_of():
    t = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, P.END_ID]


def check(df, ids_of):
    docs = defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        docs[r.doc_id].append(ids_of(r.text))
    got, sequences = defaultdict(list), defaultdict(list)
    for r in P.pack(df).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length > 0
        got[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert got.keys() == docs.keys()
    for i, want in docs.items():
        pieces = sorted(got[i], key=lambda r: (r.sequence_id, r.offset))
        assert sum((list(r.ids) for r in pieces), []) == sum(want, []) or len(want) > 1
        assert sorted(r.doc_tokens for r in pieces if r.start == 0) == sorted(map(len, want))
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0, *[r.length for r in rows[:-1]]]).tolist()
        assert sum(r.length for r in rows) <= P.SIZE
    return sum(map(len, sum(docs.values(), []))), len(sequences)


def test_given_documents_come_back_whole_with_little_padding(given, ids_of):
    tokens, sequences = check(given("documents").coalesce(1), ids_of)
    assert tokens / (P.SIZE * sequences) > 0.95


def test_odd_rows_and_an_empty_table(spark, odd, ids_of):
    check(odd, ids_of)
    assert P.pack(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text", [
    "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b <|im_end|>", "don't we'll I'D it's ,' 'tis", "x1y2 3.14 a-b_c (d)e!f", "Été, été! été İx ǅz K",
    "Σας Σ 你好。 ——a’s ªºµ", "À Ḃc \U0001f600x",
])
def test_ids_equal_those_of_the_whole_text(text, ids_of):
    import pyarrow as pa

    from waymeter.llm import words as W

    ids, _, _ = P.Encoder(public_tokenizers.path(P.TOKENIZER)).encode(*W.buffers(pa.array([text])))
    assert [*ids.tolist(), P.END_ID] == ids_of(text)


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(5)
    for _ in range(30):
        steps = rng.integers(1, 6, 9)
        at = np.append(0, np.cumsum(steps))
        fee = np.append(rng.choice([0.0, 2.0, 5.0], 9), 0.0)
        fee[0] = 0
        size = 9
        cost = lambda ends: sum(size - (b - a) + fee[list(at).index(b)] for a, b in zip([0, *ends[:-1]], ends, strict=True))  # noqa: E731,B023
        plans = [
            [*map(int, inner), int(at[-1])] for k in range(9) for inner in combinations(at[1:-1], k)
            if all(b - a <= size for a, b in zip([0, *inner], [*inner, at[-1]], strict=True))
        ]
        assert cost(P.cuts(at, fee, size).tolist()) == pytest.approx(min(map(cost, plans)))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from waymeter.llm import words as W

    path = public_tokenizers.path(name)
    assert P._cuts_words(path) == (name == P.TOKENIZER)
    texts = ["Hello World again", "", "It's one. Two!  Three? 3.14 \u00c9t\u00e9.", "no end"]
    ids, row, ends = P.Encoder(path).encode(*W.buffers(pa.array(texts)))
    library = Tokenizer.from_file(path)
    for k, text in enumerate(texts):
        assert ids[row == k].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(ends) >= 3 and (ends <= len(ids)).all()
