"""Licence scan against a direct search."""

import random
import re

import pyarrow as pa

from minekit.llm import frames, licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, score string"


def _direct(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(low)
    places = sorted((i, t.label) for t in licenses.BASE for i in range(len(found))
                    if found[i:i + len(t.text.split())] == t.text.split())
    return len(found), places


def test_base_phrases(spark):
    rng = random.Random(6)
    vocabulary = ["GNU", "general", "public", "license", "Apache", "cc", "by", "MIT", "x", "é", "7", "license,", "cc-by"]
    texts = [None, "", "MIT License", "!!", "mit\x00license", "ümit license"] + [
        " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    for r in licenses.scan_licenses(df).collect():
        n, places = _direct(r.text)
        assert r.n_words == n
        assert sorted((m.first, m.label) for m in r.matches if m.base) == places
        assert 0 <= r.score <= 1 and (r.score == 1 or not places)


def test_a_changed_notice_is_found_and_a_partial_one_is_not(spark):
    notice = licenses.ADDED[0].text
    changed = notice.replace("associated", "related").upper()
    part = " ".join(notice.split()[:6])
    df = spark.createDataFrame([(1, f"x {changed} y", ""), (2, part, ""), (3, notice.replace("hereby", "now"), "")], SCHEMA)
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert [(m.label, m.first, m.base) for m in got[1].matches] == [("mit", 1, False)]
    assert 0.9 < got[1].score < 1 and not got[2].matches and not got[3].matches


def test_long_text_over_many_steps(monkeypatch):
    monkeypatch.setattr(frames, "STEP_BYTES", 1000)
    text = "word " * 50_000 + "apache license" + " word" * 50_000
    index = licenses._Index(licenses.BASE, {})
    n, best, found = index.find(pa.array([text, "x"]))
    assert n.tolist() == [100_002, 1] and [f[:3] for f in found] == [(0, 1, 50_000)] and best.tolist() == [1, 0]


def test_phrases_do_not_span_documents():
    index = licenses._Index(licenses.BASE, {})
    assert not index.find(pa.array(["the mit", "license", None, "apache", "license"]))[2]


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0
