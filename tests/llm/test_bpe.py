"""Byte-level BPE against the tiktoken library, and exact round trips."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from minekit.llm import bpe
from minekit.llm.pretokens import split

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH),
                             special_tokens={})


def _texts(n, seed=1):
    rng = random.Random(seed)
    letters = "ab's tredvml  \n\t'1²٣éñ日!?|\x1c\x85\xa0​　\U0001f600S<>"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 16))) for _ in range(n)]


def test_split_equals_the_pattern():
    find = regex.compile(public_tokenizers.PATTERN).findall
    texts = _texts(3000)
    joined, at, _, of = split(texts)
    for text, a, b in zip(texts, of[:-1], of[1:]):
        assert [joined[x:y] for x, y in zip(at[a:b], at[a + 1:b + 1])] == find(text)


def test_encoder_equals_tiktoken(reference):
    texts = _texts(2000, 2) + ["", "a" * 3000, "it's <|endoftext|> I'll we've", "ab" * 20_000]
    enc = bpe.Encoder(bpe.load_ranks(PATH))
    assert enc.encode_batch(texts).to_pylist() == [reference.encode_ordinary(t) for t in texts]


def test_memo_is_emptied(monkeypatch, reference):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 5)
    enc = bpe.Encoder(bpe.load_ranks(PATH))
    for text in _texts(30, 3):
        assert enc.encode_batch([text]).to_pylist() == [reference.encode_ordinary(text)]
        assert len(enc.memo) <= 5 + len(text)


def test_perfect_hash_is_minimal_and_perfect():
    keys = bpe._hashes([str(i).encode() for i in range(5000)])
    table = bpe.PerfectHash(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(5000))


def test_frames(spark, reference):
    rows = [(1, None, "x"), (2, "", "y"), (None, "x y", None), (3, "naïve  café\n", "z"), (3, "naïve  café\n", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")          # ids clashes, and is replaced
    both = bpe.round_trip(df).collect()
    apart = bpe.decode(bpe.encode(df)).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, apart))
    assert sorted((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in both) == sorted(
        (i or 0, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_decoding_null_and_sliced_ids():
    work = bpe._decoder(PATH)
    ids = pa.array([[1], None, [], [300, 301], [5]], pa.list_(pa.int32())).slice(1)
    tokens = bpe.token_bytes(PATH).to_pylist()
    assert work(ids).to_pylist() == [b"", b"", tokens[300] + tokens[301], tokens[5]]
