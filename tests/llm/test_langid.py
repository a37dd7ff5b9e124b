"""Language identification: held-out accuracy and defined cases."""

import random

import numpy as np
import pyarrow as pa

from minekit.llm import langid

SYLLABLES = {"aa": ["the", "ing", "and", "th", "er"], "bb": ["eau", "que", "é", "oi", "les"], "cc": ["sch", "ung", "ß", "ein"]}
SCHEMA = "doc_id long, text string, lang string, lang_pred string"


def _texts(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((i, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
                                for _ in range(rng.randint(3, 60))), lang, "old"))
    return out


def test_kernel_is_shared_over_mean_of_distinct_grams():
    (_, x), = langid.presence(pa.array(["abcabc", "ABC", "", None]))
    grams = {t: {t[i:i + n].lower() for n in (2, 3, 4) for i in range(len(t) - n + 1)} for t in ("abcabc", "ABC")}
    assert x.sum(axis=1).tolist() == [len(grams["abcabc"]), len(grams["ABC"]), 0, 0]
    assert x[0] @ x[1] == len(grams["abcabc"] & grams["ABC"])


def test_held_out_accuracy(spark):
    train = spark.createDataFrame(_texts(1, 400), SCHEMA)
    test = spark.createDataFrame(_texts(2, 300), SCHEMA).repartition(4)
    got = langid.identify_languages(test, langid.fit_languages(train)).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_model_does_not_depend_on_partitions_or_copies(spark):
    rows = _texts(3, 200)
    one = langid.fit_languages(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    many = langid.fit_languages(spark.createDataFrame(rows * 2, SCHEMA).repartition(7))
    assert one.languages == many.languages and np.allclose(one.weights, many.weights, atol=1e-4)


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    fit = langid._fit
    monkeypatch.setattr(langid, "_fit", lambda rows, *a: seen.append(len(rows)) or fit(rows, *a))
    langid.fit_languages(spark.createDataFrame(_texts(4, 600), SCHEMA), per_language=20, landmarks=5)
    assert seen[0] <= 3 * 40


def test_copies_do_not_thin_the_sample(spark, monkeypatch):
    seen = []
    fit = langid._fit
    monkeypatch.setattr(langid, "_fit", lambda rows, *a: seen.extend(rows) or fit(rows, *a))
    rows = _texts(5, 600)
    copied = [(1, "the and thing", "aa", "")] * 20_000 + [(2, None, "bb", "")] * 20_000
    model = langid.fit_languages(spark.createDataFrame(rows + copied, SCHEMA), per_language=40, landmarks=10)
    assert model.languages == ["aa", "bb", "cc"]
    assert all(sum(lang == k for lang, _ in seen) >= 40 for k in model.languages)


def test_defined_cases(spark):
    model = langid.fit_languages(spark.createDataFrame(_texts(1, 100), SCHEMA))
    rows = [(1, None, None, ""), (2, "", "aa", ""), (3, "12 !?", "aa", ""), (None, "the and thing", None, ""),
            (5, "the and thing " * 20_000, None, "")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] == got[5][0] == "aa"
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.fit_languages(empty) is None and langid.identify_languages(empty, model).count() == 0
    assert langid.identify_languages(spark.createDataFrame(rows, SCHEMA), None).filter("lang_pred = 'und'").count() == 5
