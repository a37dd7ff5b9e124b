"""Frequent itemsets and association rules (FP-growth).

Baskets are one string column with items separated by single spaces.
Tokenising keeps the reference's rules (``java_split``); a NULL basket
raises, and so does a repeated item in a basket unless ``dedupe=True``.  Mining is
``spark.ml.fpm.FPGrowth``: a distributed item count, then conditional
FP-trees built per item group across ``num_partitions`` tasks (by default
the input's partition count, so it grows with the data; the reference
fixed 10).  Rules have one consequent; confidence = freq(A + c) / freq(A).
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.text import java_list_text, java_split

ITEMS = "items"


def basket_items(c: Column, dedupe: bool = False) -> Column:
    """Split a basket string into its items (no trimming)."""
    tokens = java_split(c, " ")
    missing = F.raise_error(F.lit("NULL basket"))
    if dedupe:
        return F.when(c.isNull(), missing).otherwise(F.array_distinct(tokens))
    return F.when(c.isNull(), missing).when(F.size(F.array_distinct(tokens)) != F.size(tokens),
                  F.raise_error(F.concat(F.lit("Items in a transaction must be unique but got "), c))
                  ).otherwise(tokens)


def baskets(df: DataFrame, basket_col: str, dedupe: bool = False) -> DataFrame:
    return df.select(basket_items(F.col(basket_col), dedupe).alias(ITEMS))


def fit_fpgrowth(baskets_df: DataFrame, min_support: float, min_confidence: float,
                 num_partitions: int | None = None, items_col: str = ITEMS) -> FPGrowthModel:
    if not 0.0 < min_support <= 1.0:
        raise ValueError("min_support must be in (0, 1]")
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp.setNumPartitions(num_partitions)
    return fp.fit(baskets_df)


def freq_itemsets(model: FPGrowthModel) -> DataFrame:
    """``itemset`` (sorted, space separated), ``size``, ``freq``."""
    fi = model.freqItemsets
    return fi.select(F.concat_ws(" ", F.array_sort("items")).alias("itemset"),
                     F.size("items").alias("size"), F.col("freq"))


def association_rules(model: FPGrowthModel) -> DataFrame:
    """``antecedent`` (sorted, space separated), ``consequent``, ``confidence``."""
    r = model.associationRules
    return r.select(F.concat_ws(" ", F.array_sort("antecedent")).alias("antecedent"),
                    F.element_at("consequent", 1).alias("consequent"),
                    F.col("confidence"))


def rule_text(model: FPGrowthModel, rule_col: str = "rule", conf_col: str = "confidence") -> DataFrame:
    """The reference's result rows: ``[a, b] => [c]`` and the confidence."""
    r = model.associationRules
    text = F.concat(java_list_text(F.col("antecedent")), F.lit(" => "), java_list_text(F.col("consequent")))
    return r.select(text.alias(rule_col), F.col("confidence").cast("double").alias(conf_col))
