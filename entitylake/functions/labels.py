"""Localized labels: ``<field>.UserLocalizedLabel.Label`` with joint fallback.

Two labels are read as a pair. If the *path* of either is broken (a null
struct on the way), both take their fallback; a null leaf is not a broken path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(field: str) -> Column:
    return F.col(f"{field}.UserLocalizedLabel.Label")


def path_broken(field: str) -> Column:
    return F.col(f"{field}.UserLocalizedLabel").isNull()


def paired(
    left: Column, right: Column, broken: Column, left_fallback: Column, right_fallback: Column
) -> tuple[Column, Column]:
    return (
        F.when(broken, left_fallback).otherwise(left),
        F.when(broken, right_fallback).otherwise(right),
    )


def description_label() -> Column:
    """The description alone; null where there is none, or no path to it."""
    return label("Description")


def display_labels() -> tuple[Column, Column]:
    """Display name and display collection name; both null if one path is broken."""
    null = F.lit(None).cast("string")
    broken = path_broken("DisplayName") | path_broken("DisplayCollectionName")
    return paired(label("DisplayName"), label("DisplayCollectionName"), broken, null, null)


def report_labels(entity: Column) -> tuple[Column, Column]:
    """Name and description for reports: the entity's own name and ``''`` as fallback."""
    broken = path_broken("DisplayName") | path_broken("Description")
    described = F.coalesce(label("Description"), F.lit(""))
    return paired(label("DisplayName"), described, broken, entity, F.lit(""))
