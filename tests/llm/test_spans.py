"""Word hashes, and words that collide under a polynomial modulo 2^64."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from minekit.llm import bpe, jaccard, packing
from minekit.llm.spans import LONG, distinct_spans, span_hashes, words


def thue_morse(n):
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_pre_tokens_keep_their_own_ids(n):
    one, other = thue_morse(n)
    texts = [one, other, f"x {one} {other}\n{other}, {one}", f"{other} {one}"]
    path = public_tokenizers.path(bpe.VOCABULARY)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert bpe.encoder(path).encode_batch(texts).to_pylist() == [want.encode_ordinary(t) for t in texts]
    path = public_tokenizers.path(packing.TOKENIZER)
    library = Tokenizer.from_file(path)
    got = packing.FileEncoder(path).documents(texts)
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_documents_without_a_common_shingle_stay_apart(spark, n):
    one, other = thue_morse(n)
    rows = [(1, one), (2, other), (3, " ".join([one] * 6)), (4, " ".join([other] * 6)), (5, f"a b c {one} d"),
            (6, f"a b c {other} d"), (7, one)]
    got = {r.id: r.component for r in jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1}


def test_hashes_tell_spans_apart():
    rng = random.Random(1)
    some = {"".join(rng.choice("ab\x00é") for _ in range(rng.randint(1, 40))) for _ in range(3000)}
    some |= {"a" * n for n in range(1, 3 * LONG)} | {"b" + "a" * n for n in range(3 * LONG)} | set(thue_morse(2048))
    some |= {"a" * 7 + "\x00" * k for k in range(1, 12)}
    texts = [*some, *some]
    is_word = np.ones(256, dtype=bool)
    is_word[32] = False
    buf, starts, ends, _ = words(pa.array(texts), is_word)
    h = span_hashes(buf, starts, ends)
    assert len(np.unique(h)) == len(some) and (h[:len(some)] == h[len(some):]).all()
    which, values = distinct_spans(buf, starts, ends)
    assert [values[i].as_py().decode() for i in which.tolist()] == texts
    assert len(span_hashes(buf, starts[:0], ends[:0])) == 0
    assert span_hashes(buf, starts[:2], starts[:2])[0] == span_hashes(buf, starts[:2], starts[:2])[1]
