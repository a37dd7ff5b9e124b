"""The corpus pipeline's stages on planted documents."""

import random

import pytest

import corpus_pipeline
from minekit.llm import quality
from minekit.session import scratch_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string"


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    words = {"en": ["the", "house", "and", "there", "thing"], "de": ["der", "haus", "und", "schön", "lich"]}

    def good(lang):
        return "\n".join(" ".join("".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 3))) for _ in range(
            rng.randint(6, 14))).capitalize() + "." for _ in range(rng.randint(2, 6)))

    rows = [(i, good(lang), lang) for i in range(160) for lang in [rng.choice(["en", "de"])]]
    bad = [(200 + i, good("en") + "\n" + (good("en").upper().replace(" ", "!! ") + "\n") * 4, "en") for i in range(60)]
    none = [(300, None, "en"), (301, "12 34 !!", "en"), (302, "", None)]
    copies = [(400 + i, rows[i][1], rows[i][2]) for i in range(10)] + [(0, rows[0][1], rows[0][2])]
    docs = [(i, t, la, "s", len(t or ""), 0.5, "old") for i, t, la in rows + bad + none + copies]
    path = scratch_path(spark, "planted")
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows] + [(r[0], 0, 0) for r in bad],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, {r[0] for r in rows}, {r[0] for r in bad}, {r[0] for r in none}, {r[0] for r in copies}


def test_stages(spark, planted):
    path, good, bad, none, copies = planted
    docs = corpus_pipeline.table(spark, path, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, path), name)
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        counts.append(len(ids))
        if name != "packing":
            assert docs.columns == columns
        if name == "language_id":
            assert set(ids) == good | bad | copies and len(ids) == counts[0] - 3
        if name == "quality":
            assert len(set(ids) & bad) <= 3 and len(good - set(ids)) <= 3
            scored = set(ids)
        if name == "near_duplicates":
            assert len(ids) == len(set(ids)) and set(ids) == scored - (copies - good)
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == scored - (copies - good)


def test_empty_documents(spark, planted):
    path = planted[0]
    docs = corpus_pipeline.table(spark, path, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


def test_stages_learn_from_what_they_are_given(spark, planted, monkeypatch):
    path, good, bad, none, _ = planted
    docs = corpus_pipeline.table(spark, path, "documents")
    nameless = docs.withColumn("lang", corpus_pipeline.F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, nameless, path)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(none)

    seen, fit = [], quality._fit
    monkeypatch.setattr(quality, "_fit", lambda sample, share: seen.append((len(sample), share)) or fit(sample, share))
    labels = corpus_pipeline.table(spark, path, "labels").select("doc_id", "quality")
    absent = spark.range(10_000, 210_000).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    quality.fit_quality(docs, labels.unionByName(absent))
    assert seen == [(len(good) + len(bad), len(good) / (len(good) + len(bad)))]


def test_near_duplicates_go_by_row(spark):
    def words(name, n=60):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(1, words("a"), "x"), (1, words("b"), "y"),            # one id, two texts: the second is a copy of 0's
            (0, words("b") + " more", "z"), (2, words("c"), "x"), (2, words("c"), "x"),     # a repeated row
            (3, words("d"), "x"), (3, words("d") + " end", "x"),   # one id, near copies
            (None, words("a") + " last", "x"), (None, words("e"), "x"), (None, words("f"), "x"), (None, words("f"), "x"),
            (4, None, "x"), (4, "", "x"), (5, words("g"), "x"), (9, words("g") + " end", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id if r.doc_id is not None else -1), (r.text or "").split(" ")[0]) for r in kept.collect())
    assert got == [(-1, "e0"), (-1, "f0"), (0, "b0"), (1, "a0"), (2, "c0"), (3, "d0"), (4, ""), (4, ""), (5, "g0")]


def test_near_duplicates_of_one_id(spark):
    docs = spark.createDataFrame([(7, " ".join(f"w{k}_{i}" for i in range(40))) for k in range(30) for _ in range(2)],
                                 "doc_id long, text string")
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 30
