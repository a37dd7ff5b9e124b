"""Label indexing around ``spark.ml`` classifiers.

The reference's MLlib classifiers take any double as a class label and
return it unchanged; ``spark.ml`` wants 0..k-1 (naive Bayes silently maps
other values to 0/1).  ``LabelIndex`` maps the distinct labels of the
training rows, in ascending order, to 0..k-1 before ``fit`` and back after
``transform``.

Only the distinct labels reach the driver: k values, where the fitted model
holds k x d numbers there in any case.  ``max_classes`` is an optional check
for callers that know their data; by default there is none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sorted(df: DataFrame, c: Column, max_values: int | None = None) -> list:
    """Sorted distinct values of a category column (aggregated map-side).

    More than ``max_values``, if given, raise before any is collected."""
    values = df.select(c.alias("_v")).distinct()
    if max_values is not None and values.count() > max_values:
        raise ValueError(f"more than {max_values} distinct values: not a category column")
    found = [r["_v"] for r in values.collect()]
    if any(v is None for v in found):
        raise ValueError("NULL in a label / category column")
    return sorted(found)


@dataclass(frozen=True)
class LabelIndex:
    values: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, label: Column, max_classes: int | None = None) -> "LabelIndex":
        values = distinct_sorted(df, label, max_classes)
        if not values:
            raise ValueError("empty training table")
        return cls(tuple(float(v) for v in values))

    @property
    def num_classes(self) -> int:
        return len(self.values)

    def with_index(self, df: DataFrame, label_col: str, metadata: dict | None = None) -> DataFrame:
        """``df`` with ``label_col`` replaced by its 0-based class (double, as
        ``spark.ml`` wants): a join with the k-row label table, k being the
        number of classes that the model holds on the driver."""
        table = df.sparkSession.createDataFrame(
            [(v, float(i)) for i, v in enumerate(self.values)], "_value double, _class double")
        joined = df.join(F.broadcast(table), F.col(label_col) == F.col("_value"))
        index = F.col("_class").alias(label_col, metadata=metadata) if metadata else F.col("_class").alias(label_col)
        return joined.select(index, *[c for c in df.columns if c != label_col])

    def label(self, index: Column) -> Column:
        """0-based class index -> original label value."""
        return F.element_at(F.array(*[F.lit(v) for v in self.values]), index.cast("int") + 1)

    def ml_metadata(self, name: str) -> dict:
        """Nominal-attribute metadata so trees skip their numClasses scan."""
        return {"ml_attr": {"type": "nominal", "num_vals": self.num_classes, "name": name}}
