"""Joins and set operations (J1-J5). Rows are paired by an explicit key, never by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_target(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Features left-joined with the target on the key."""
    return features.join(target, key, "left")


def pair_features_target(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Inner join on the key (the reference relied on row order of two files)."""
    return features.join(target, key, "inner")


def concat_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Column-wise concatenation aligned by key (full outer)."""
    return left.join(right, key, "full_outer")


def remove_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Drop the rows whose key is in ``ids`` (left anti join; no collect of the id list)."""
    return df.join(ids.select(key), key, "left_anti")


def invalid_values(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """Distinct values outside the allowed set (NULL included). The allowed list is configuration, so it is
    an in-list predicate; the distinct values are aggregated map-side first."""
    c = F.col(col)
    return df.select(col).filter(c.isNull() | ~c.isin(list(allowed))).distinct()
