"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order.  Each takes the rows that its
predecessor kept, all but the last return the columns of ``documents``:

1. language_id: documents without a language (``und``) go; where there is no
   language to learn, those that are null or have no letter;
2. quality: documents scored below ``registry.KEEP_SCORE`` go;
3. near_duplicates: of rows that link, directly or through others, at a Jaccard
   similarity of 0.8 or more of their 5-word shingles, the one with the smallest
   id stays, whichever rows share its id;
4. packing: the documents' pieces, with their token ids and places in sequences.

Both models are fitted in their stage, to rows of its own input (the held-out
rows of the queries ``op7`` and ``op8`` stay held out).

Defined cases: rows go or stay one by one, so a clean row stays though another
of its id goes; rows with equal id and text count once; rows that repeat an id,
but for one of each id, are compared like any others and go before rows with an
id of their own, rows without an id before all others; texts that are null or
have no letter go in the first stage; extra columns stay until packing, however
they are named; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.llm import jaccard, langid, packing, quality
from minekit.llm.registry import KEEP_SCORE, held_out, table
from minekit.session import materialize


def _fresh(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit_languages(docs.filter(~held_out(3, 1)))
    if model is None:                                    # nothing to tell languages by
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    name, score = _fresh(docs, "lang_pred"), _fresh(docs, "lang_score")
    found = langid.identify_languages(docs, model, "text", name, score)
    return found.filter(F.col(name) != langid.UNKNOWN).select(docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out(4, 2))
    model = quality.fit_quality(docs, labels)
    score = _fresh(docs, "quality_score")
    return quality.score_quality(docs, model, "text", score).filter(F.col(score) >= KEEP_SCORE).select(docs.columns)


def _rows_by_id(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``key``, which no two rows share: the id, where one row has it.  Rows
    that repeat an id or have none are taken apart: equal texts of one id stay once, a
    row of each id keeps it and the others get numbers above all ids, those without an id
    the highest."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = materialize(ids.filter((F.col("n") > 1) | F.col("doc_id").isNull()).select("doc_id"), "repeated")
    if again.isEmpty():
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    listed = again.alias("r")
    h = _fresh(docs, "h")
    rows = materialize(docs.alias("d").join(listed, same, "left_semi").withColumn(h, F.xxhash64("text"))
                       .dropDuplicates(["doc_id", h, "text"]), "repeated")
    first = rows.groupBy("doc_id").agg(F.min(h).alias(h)).withColumn(key, F.col("doc_id").cast("long"))
    above = docs.agg(F.coalesce(F.max(F.col("doc_id").cast("long")), F.lit(0))).first()[0] + 1
    number = F.monotonically_increasing_id() + F.lit(above) + F.when(F.col("doc_id").isNull(), F.lit(1 << 60)).otherwise(0)
    told = rows.join(first, ["doc_id", h], "left").withColumn(key, F.coalesce(key, number)).select(*docs.columns, key)
    alone = docs.alias("d").join(listed, same, "left_anti").withColumn(key, F.col("doc_id").cast("long"))
    return materialize(alone.select(*docs.columns, key).unionByName(told), "rows")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = _fresh(docs, "row")
    rows = _rows_by_id(docs, key)
    found = jaccard.similar_documents(rows, key=key)
    goes = materialize(found.filter(F.col("id") != F.col("component")).select(F.col("id").alias(key)), "ids")
    return rows.join(goes, key, "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces_of(docs).drop("ids_crc32")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids")


STAGES = [("language_id", language_id), ("quality", quality_filter), ("near_duplicates", near_duplicates),
          ("packing", pack)]

#: SQL cannot express the models and the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
