"""Collaborative filtering by ALS (explicit ratings).

``spark.ml.recommendation.ALS`` with ``coldStartStrategy="drop"``: a pair
whose user or item never appeared in training gets no row, as in the
reference's bulk ``predict``.  ALS reads the ratings once into blocks it
persists (memory and disk) for the iterations, and checkpoints its factor
lineage every ``checkpoint_interval`` rounds into the session's shared
checkpoint folder, so a lost executor costs a recompute from the last
checkpoint, not from the scan.  The number of user / item blocks is an
argument with a fixed default, because the random starting factors depend on
it: the same seed and blocks give the same model on any cluster.  Raise it
with the data (each iteration ships factors between every pair of blocks).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.functions.casting import quoted, strict_double, strict_int
from minekit.operators.numbering import dense_ids
from minekit.session import ensure_checkpoint_dir, materialize

USER, ITEM, RATING = "user", "item", "rating"
NUM_BLOCKS = 10
#: Types that user and item keys may have; ``int`` ids go to ``spark.ml`` as they are.
KEY_TYPES = ("int", "bigint", "string")
#: Distinct users or items that ``spark.ml`` can tell apart.
MAX_KEYS = 2 ** 31 - 1


def _key(df: DataFrame, name: str, alias: str, key_type: str) -> Column:
    """A user or item key: integral and in range, or any text; NULL raises."""
    if key_type not in KEY_TYPES:
        raise ValueError(f"keys are one of {', '.join(KEY_TYPES)}, not {key_type!r}")
    if key_type != "string":
        return strict_int(df, name, alias, key_type)
    c = F.col(quoted(name))
    return F.when(c.isNull(), F.raise_error(F.lit(f"NULL in column {name}"))).otherwise(c.cast("string")).alias(alias)


def ratings_frame(df: DataFrame, user_col: str, item_col: str, rate_col: str, key_type: str = "int") -> DataFrame:
    """``user, item, rating double``; ids must be integral and in range, or with
    ``key_type="string"`` any text."""
    return df.select(_key(df, user_col, USER, key_type), _key(df, item_col, ITEM, key_type),
                     strict_double(df, rate_col, RATING))


def pairs_frame(df: DataFrame, user_col: str, item_col: str, key_type: str = "int") -> DataFrame:
    return df.select(_key(df, user_col, USER, key_type), _key(df, item_col, ITEM, key_type))


def fit_als(ratings: DataFrame, rank: int = 10, max_iter: int = 10, reg_param: float = 0.01,
            seed: int | None = None, num_blocks: int = NUM_BLOCKS,
            checkpoint_interval: int = 10) -> ALSModel:
    """Fit on a ``ratings_frame``."""
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol=USER, itemCol=ITEM,
              ratingCol=RATING, coldStartStrategy="drop", nonnegative=False,
              numUserBlocks=num_blocks, numItemBlocks=num_blocks, checkpointInterval=checkpoint_interval,
              intermediateStorageLevel="MEMORY_AND_DISK", finalStorageLevel="MEMORY_AND_DISK")
    if seed is not None:
        als.setSeed(seed)
    # ALS reads its input once, into rating blocks it persists itself.
    return als.fit(ratings)


@dataclass
class KeyedALS:
    """A model over numbers, and the dictionaries ``user, user_idx`` and ``item, item_idx``."""

    model: ALSModel
    users: DataFrame
    items: DataFrame

    def transform(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; pairs of an unknown user or item are dropped."""
        numbered = _numbered(pairs, self.users, self.items)
        return self.model.transform(numbered).drop(_USER_IDX, _ITEM_IDX)


_USER_IDX, _ITEM_IDX = "_user_idx", "_item_idx"


def _numbered(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Rows with known keys, with their numbers; a hot key's rows are split by AQE."""
    return pairs.join(users, USER).join(items, ITEM)


def fit_keyed_als(ratings: DataFrame, rank: int = 10, max_iter: int = 10, reg_param: float = 0.01,
                  seed: int | None = None, num_blocks: int = NUM_BLOCKS,
                  checkpoint_interval: int = 10) -> KeyedALS:
    """Fit on a ``ratings_frame`` with keys of any type that can be sorted."""
    tables = []
    for key, idx in ((USER, _USER_IDX), (ITEM, _ITEM_IDX)):
        ids = dense_ids(ratings, key, idx, limit=MAX_KEYS)
        tables.append(ids.select(key, F.col(idx).cast("int").alias(idx)))
    numbered = _numbered(ratings, *tables).select(
        F.col(_USER_IDX).alias(USER), F.col(_ITEM_IDX).alias(ITEM), RATING)
    model = fit_als(materialize(numbered, "ratings"), rank, max_iter, reg_param, seed, num_blocks, checkpoint_interval)
    model.setUserCol(_USER_IDX).setItemCol(_ITEM_IDX)
    return KeyedALS(model, *tables)


def predict_pairs(model: ALSModel | KeyedALS, pairs: DataFrame, result_user: str = USER, result_item: str = ITEM,
                  result_rate: str = RATING) -> DataFrame:
    """Score (user, item) pairs; unknown users or items are dropped."""
    scored = model.transform(pairs.select(USER, ITEM))
    return scored.select(F.col(USER).alias(result_user), F.col(ITEM).alias(result_item),
                         F.col("prediction").cast("double").alias(result_rate))


def predict_pair(spark: SparkSession, model: ALSModel | KeyedALS, user, item) -> DataFrame:
    """One row with the rating of a single pair; none for an unknown user or item."""
    users, items = (model.users, model.items) if isinstance(model, KeyedALS) else (None, None)
    kinds = [f.schema[k].dataType.simpleString() if f is not None else "int" for f, k in ((users, USER), (items, ITEM))]
    pair = spark.createDataFrame([(user, item)], f"{USER} {kinds[0]}, {ITEM} {kinds[1]}")
    return predict_pairs(model, pair)


def scorable_pairs(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ALS can score: user and item both seen in training.

    Two left-semi joins against the distinct training keys; Spark picks
    broadcast or shuffle per side from their measured size (AQE).
    """
    users = train.select(USER).distinct()
    items = train.select(ITEM).distinct()
    return pairs.select(USER, ITEM).join(users, USER, "left_semi").join(items, ITEM, "left_semi")


def rates_and_preds(model: ALSModel | KeyedALS, ratings: DataFrame) -> DataFrame:
    """Each training rating next to the model's prediction for its pair.

    One row per rating row.  The reference joined ratings with predictions
    keyed by (user, item), which repeats a pair rated n times n * n times;
    scoring the rating rows directly gives every rating its prediction
    without that all-pairs blow-up on a hot pair.
    """
    scored = model.transform(ratings.select(USER, ITEM, RATING))
    return scored.select(USER, ITEM, RATING, F.col("prediction").cast("double").alias("prediction"))


def rating_mse(both: DataFrame) -> DataFrame:
    """Mean squared error over ``rates_and_preds`` rows, one row."""
    diff = F.col(RATING) - F.col("prediction")
    return both.agg(F.avg(diff * diff).alias("mse"), F.count(F.lit(1)).alias("n"))
