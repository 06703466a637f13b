"""Label filters, name<->id maps and class counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's class mapping.
SPAM_LABELS = {"ham": 0, "spam": 1}


def where_label(df: DataFrame, label_col: str, value) -> DataFrame:
    """Rows whose label equals ``value``."""
    return df.where(F.col(label_col) == F.lit(value))


def map_labels(c: Column | str, mapping: Mapping = SPAM_LABELS) -> Column:
    """Category name -> id; a name not in ``mapping`` becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for name, value in mapping.items():
        expr = (F.when(col == F.lit(name), F.lit(value)) if expr is None
                else expr.when(col == F.lit(name), F.lit(value)))
    return expr.otherwise(F.lit(None)) if expr is not None else F.lit(None)


def prediction_name(c: Column | str, positive: str = "spam", negative: str = "ham",
                    positive_id: int = 1) -> Column:
    """``positive`` when the id equals ``positive_id``, anything else ``negative``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == F.lit(positive_id), F.lit(positive)).otherwise(F.lit(negative))


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    """Rows per label (map-side partial count, then one small shuffle)."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_rows"))
