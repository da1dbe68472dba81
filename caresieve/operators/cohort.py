"""Cohort queries over the relational model: chained joins, label filters, nested series, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_filter(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Rows whose label is one of the list; pushed to the scan."""
    return df.where(F.col(column).isin(labels))


def nested_series(df: DataFrame, by: str, fields: list[str], order: list[str], out: str = "series") -> DataFrame:
    """One row per `by` with its rows as an array of structs, sorted by `order` first."""
    rest = [f for f in fields if f not in order]
    item = F.struct(*[F.col(c) for c in (*order, *rest)])
    return df.groupBy(by).agg(F.sort_array(F.collect_list(item)).alias(out))


def select_series(nested: DataFrame, field: str, text: str, suffix: bool = False, column: str = "series") -> DataFrame:
    """The series whose field holds (or ends with) a text; persons without one go."""
    test = (lambda x: x[field].endswith(text)) if suffix else (lambda x: x[field].contains(text))
    return nested.withColumn(column, F.filter(column, test)).where(F.size(column) > 0)


def pivot_first(facts: DataFrame, by: str, concept: str, value: str, order: str, concepts: list) -> DataFrame:
    """Long facts as one row per `by`, the first value of each concept in `order`.

    The concepts are given, so there is no extra pass to find them, and min_by makes
    the choice the same on every run.
    """
    cells = [F.min_by(F.when(F.col(concept) == c, F.col(value)), F.when(F.col(concept) == c, F.col(order))).alias(str(c)) for c in concepts]
    return facts.groupBy(by).agg(*cells)


def union_views(measurements: DataFrame, observations: DataFrame, id_col: str = "id") -> DataFrame:
    """Measurements and, with negated ids, observations; absent columns are null."""
    return measurements.unionByName(observations.withColumn(id_col, -F.col(id_col)), allowMissingColumns=True)


def explode_features(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, feature, value) of a JSON object per row; unreadable objects give no rows."""
    parsed = F.from_json(F.col(column), "map<string,double>")
    return df.select(F.col(key), F.explode(parsed).alias("feature", "value"))
