"""Quality: marginals by enumeration, held-out accuracy, defined cases."""

import itertools
import random

import numpy as np
import pyarrow as pa

from minekit.llm import quality

SCHEMA = "doc_id long, text string, score string"


def _docs(seed, n):
    rng = random.Random(seed)
    words = ["the", "house", "was", "red", "and", "we", "went", "there", "slowly"]

    def good():
        return " ".join(rng.choice(words) for _ in range(rng.randint(4, 14))).capitalize() + "."

    def bad():
        return rng.choice([lambda: good().upper().replace(" ", "!! "), lambda: good().replace(" ", "### "),
                           lambda: " | ".join(good().split())])()

    out = []
    for i in range(n):
        y = int(rng.random() < 0.7)
        lines = [good() for _ in range(rng.randint(1, 8))]
        if not y:
            lines[rng.randrange(len(lines) + 1):0] = [bad() for _ in range(rng.randint(2, 6))]
        out.append((i, "\n".join(lines), "old", y))
    return out


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    offsets = np.array([0, 3, 3, 4, 9])
    good, move = rng.normal(size=9) * 2, rng.normal(size=(2, 2))
    got = quality.forward_backward(good, move, offsets)[0]
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b > a:
            weight, marginal = 0.0, np.zeros(b - a)
            for y in itertools.product((0, 1), repeat=b - a):
                w = np.exp(sum(good[a + i] * s for i, s in enumerate(y)) + sum(move[s, t] for s, t in zip(y, y[1:])))
                weight += w
                marginal += w * np.array(y)
            assert np.allclose(got[a:b], marginal / weight)


def test_lines():
    base, sizes, of = quality.lines_of(pa.array(["Ab c\n\n  \nAb c\n", None, "", "éé 12|"]))
    assert of.tolist() == [0, 2, 2, 2, 3] and sizes.tolist() == [4, 4, 6]
    assert base[:2, -1].tolist() == [0, 1]                # the second line stood earlier


def test_held_out_accuracy(spark):
    train, test = _docs(1, 400), _docs(2, 300)
    docs = spark.createDataFrame([r[:3] for r in train], SCHEMA)
    labels = spark.createDataFrame([(r[0], r[3]) for r in train] + [(0, None), (None, 1), (10 ** 6, 0)],
                                   "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    got = quality.score_quality(spark.createDataFrame([r[:3] for r in test], SCHEMA).repartition(3), model).collect()
    want = {r[0]: r[3] for r in test}
    assert np.mean([(r.score >= 0.7) == want[r.doc_id] for r in got]) > 0.95
    good = [r.score for r in got if want[r.doc_id]]
    bad = [r.score for r in got if not want[r.doc_id]]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    cases = spark.createDataFrame([(1, None, ""), (2, "", ""), (2, "", ""), (None, " \n\n", ""),
                                   (4, "We went there slowly.\n" * 5000, "")], SCHEMA)
    scored = quality.score_quality(cases, model).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id != 4}) == 1


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a b", "")], SCHEMA)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.fit_quality(docs, labels) is None and quality.fit_quality(docs, labels.limit(0)) is None
    assert [r.score for r in quality.score_quality(docs, None).collect()] == [1.0]
    assert quality.score_quality(docs.limit(0), None).count() == 0
