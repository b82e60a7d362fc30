"""Query options on an entity: select, filter, expand, orderby, top, count.

They apply in this order: filter, count, orderby, top, expand, select.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.functions.columns import named, split_names
from entitylake.functions.ordering import OrderBy, SortKey, sort_columns, sort_keys
from entitylake.operators.ranking import ranked
from entitylake.operators.selection import first_rows
from entitylake.schemas import COUNT
from entitylake.session import materialized

# Up to here ``top`` is a top-k, which one task finishes; more rows are cut by rank.
TOP_IN_ONE_TASK = 100_000


@dataclass(frozen=True)
class Navigation:
    """A navigation property: how parent rows find their related rows.

    ``left`` is the key column of the parent, ``right`` that of ``df``. To-many
    (``many``) gives an array of structs, to-one a struct. ``order_by`` orders
    the items by columns of ``df`` (ascending, default: by ``key``, the primary
    key of ``df``); ``count_only`` replaces them by their number.

    To-many comes in one of two forms, which the caller chooses. Without
    ``max_items`` every parent keeps one row with all its items; one row must
    then hold them. With ``max_items`` all parents come in item pages:
    ``<name>@page`` k holds items ``(k - 1) * max_items + 1`` to ``k * max_items``
    of the parent, and a parent without items has an empty page 1.
    """

    name: str
    df: DataFrame
    left: str
    right: str
    many: bool = False
    select: str | Sequence[str] | None = None
    order_by: Sequence[str] = field(default_factory=tuple)
    key: Sequence[str] = field(default_factory=tuple)
    max_items: int | None = None
    count_only: bool = False

    def fields(self) -> list[str]:
        return split_names(self.select) or list(self.df.columns)


def equals(column: str, value: Any) -> Column:
    """``eq``: also true for null against null, and pushed down to the scan."""
    return named(column).eqNullSafe(F.lit(value))


def keyed(key: Mapping[str, Any]) -> Column:
    return reduce(lambda a, b: a & b, [equals(name, value) for name, value in key.items()])


def query(
    df: DataFrame,
    select: str | Sequence[str] | None = None,
    filter: Column | str | None = None,
    expand: Navigation | Sequence[Navigation] | None = None,
    top: int | None = None,
    orderby: OrderBy | None = None,
    count: bool = False,
    one_task: int = TOP_IN_ONE_TASK,
) -> DataFrame:
    """The rows of an entity under query options, as a DataFrame.

    A falsy option does not apply (``top=0`` is no limit). ``count`` adds the
    number of rows that match ``filter``, whatever ``top`` cuts off. Intermediate
    rows are stored when the query is built in two cases: item pages, and ``top``
    together with ``expand``. A ``top`` above ``one_task`` rows is not collected in one
    task: the last key it reaches is found when the query is built, see ``selection``.
    """
    navigations = [expand] if isinstance(expand, Navigation) else list(expand or [])
    chosen = split_names(select)
    matching = df.filter(filter) if filter is not None and not _is_blank(filter) else df
    rows = matching
    if count:
        rows = rows.withColumn(COUNT, matching.agg(F.count("*")).scalar())
    keys = sort_keys(orderby)
    large = (top or 0) > one_task
    if large:
        rows = _first(rows, keys, top)
    elif top:
        rows = rows.orderBy(*sort_columns(keys)).limit(top) if keys else rows.limit(top)
    if navigations:
        rows = _expanded(rows, navigations, bool(top))
    if keys and (navigations or not top or large):
        rows = _sorted(rows, keys, chosen or df.columns)
    if chosen:
        extra = [name for nav in navigations for name in _added(nav)] + ([COUNT] if count else [])
        rows = rows.select(*[named(name) for name in [*chosen, *extra]])
    return rows


def _first(rows: DataFrame, keys: Sequence[SortKey], top: int) -> DataFrame:
    if keys:
        try:
            return first_rows(rows, keys, top)
        except TypeError:  # keys that cannot be written as literals
            pass
    return ranked(rows, keys, "__rank").filter(F.col("__rank") <= top).drop("__rank")


def _sorted(rows: DataFrame, keys: Sequence[SortKey], shown: Sequence[str]) -> DataFrame:
    """Sort all rows. Rows with equal keys are spread by a hash of what is shown of them.

    Spark sorts by ranges, and rows with the same sort value share a range: a
    value that a third of all rows have would be one task's work.
    """
    hashed = [name for name in shown if not isinstance(rows.schema[name].dataType, T.MapType)]
    return rows.orderBy(*sort_columns(keys), F.xxhash64(*[named(name) for name in hashed]))


def _is_blank(text: Column | str) -> bool:
    return isinstance(text, str) and not text.strip()


def _expanded(rows: DataFrame, navigations: Sequence[Navigation], top: bool) -> DataFrame:
    """Expand, after cutting related rows down to those the ``top`` parents need.

    The parents are stored then: a limit may choose other rows when it is
    evaluated again.
    """
    if top:
        rows = materialized(rows, "top")
        navigations = [_restricted(nav, rows) for nav in navigations]
    for nav in navigations:
        rows = expand_many(rows, nav) if nav.many else expand_one(rows, nav)
    return rows


def _restricted(nav: Navigation, parents: DataFrame) -> Navigation:
    wanted = parents.select(named(nav.left).alias(nav.right)).distinct()
    return replace(nav, df=nav.df.join(wanted, nav.right, "left_semi"))


def get_by_key(
    df: DataFrame,
    key: Mapping[str, Any],
    select: str | Sequence[str] | None = None,
    expand: Navigation | Sequence[Navigation] | None = None,
) -> DataFrame:
    """Exactly one record by primary or alternate key; none or several fail the job.

    The check is part of the plan: at most two records are looked at, once.
    """
    navigations = [expand] if isinstance(expand, Navigation) else list(expand or [])
    chosen = split_names(select) or df.columns
    needed = dict.fromkeys([*chosen, *(nav.left for nav in navigations)])
    record = F.struct(*[named(name) for name in needed])
    found = df.filter(keyed(key)).select(record.alias("record")).limit(2).agg(F.collect_list("record").alias("found"))
    wrong = F.when(F.size("found") == 0, F.lit("no record")).otherwise(F.lit("more than one record"))
    message = F.concat(wrong, F.lit(f" with key {dict(key)}"))
    checked = F.when(F.size("found") == 1, F.col("found")).otherwise(F.raise_error(message))
    one = found.select(F.explode(checked).alias("record")).select("record.*")
    return query(one, select=chosen, expand=navigations)


def _added(nav: Navigation) -> list[str]:
    if not nav.many:
        return [nav.name]
    if nav.count_only:
        return [f"{nav.name}{COUNT}"]
    return [nav.name] if nav.max_items is None else [nav.name, f"{nav.name}@page"]


def expand_one(parents: DataFrame, nav: Navigation) -> DataFrame:
    """Add the related row as a struct, null where there is none.

    A key that occurs more than once fails the job: parents are never multiplied.
    A parent key that very many rows share is left to adaptive execution.
    """
    item = F.struct(*[named(name) for name in nav.fields()])
    related = nav.df.filter(named(nav.right).isNotNull()).groupBy(named(nav.right).alias("__key"))
    found = related.agg(F.first(item).alias("__item"), F.count("*").alias("__n"))
    message = F.concat(F.lit(f"{nav.right} of {nav.name} is not unique: "), F.col("__key").cast("string"))
    one = F.when(F.col("__n") == 1, F.col("__item")).otherwise(F.raise_error(message))
    joined = parents.join(found, named(nav.left) == F.col("__key"), "left")
    checked = F.when(F.col("__key").isNotNull(), one).alias(nav.name)
    return joined.select(*[named(name) for name in parents.columns], checked)


def expand_many(parents: DataFrame, nav: Navigation) -> DataFrame:
    """Add the related rows as an array, empty where there are none; see ``Navigation``.

    Item pages are cut by rank: the order runs on from page to page, no page has
    more items than asked for, and no task gets all items of a parent.
    """
    hashed = nav.key or [
        item.name for item in nav.df.schema.fields if not isinstance(item.dataType, T.MapType)
    ]
    names = [f"__o{i}" for i in range(len(nav.order_by or nav.key))]
    related = nav.df.select(
        named(nav.right).alias("__key"),
        *[named(name).alias(out) for name, out in zip(nav.order_by or nav.key, names)],
        F.xxhash64(*[named(name) for name in hashed]).alias("__deal"),
        F.struct(*[named(name) for name in nav.fields()]).alias("__item"),
    ).filter(F.col("__key").isNotNull())

    kept = [named(name) for name in parents.columns]
    match = named(nav.left) == F.col("__key")
    if nav.count_only:
        sizes = related.groupBy("__key").agg(F.count("*").alias("__n"))
        number = F.coalesce(F.col("__n"), F.lit(0)).alias(f"{nav.name}{COUNT}")
        return parents.join(sizes, match, "left").select(*kept, number)
    if nav.max_items is None:
        # Plain fields lead, so that sorting an array hardly ever compares whole items.
        arrays = related.groupBy("__key").agg(_collected(*names, "__deal").alias("__items"))
        items = F.coalesce(F.col("__items"), F.array()).alias(nav.name)
        return parents.join(arrays, match, "left").select(*kept, items)
    if nav.max_items < 1:
        raise ValueError("max_items must be positive")
    order = [SortKey(name) for name in [*names, "__deal"]]
    page = F.floor((F.col("__rank") - 1) / F.lit(nav.max_items)).cast("int") + 1
    pages = (
        ranked(related, order, "__rank", group="__key")
        .groupBy("__key", page.alias("__page"))
        .agg(_collected("__rank").alias("__items"))
    )
    return parents.join(pages, match, "left").select(
        *kept,
        F.coalesce(F.col("__items"), F.array()).alias(nav.name),
        F.coalesce(F.col("__page"), F.lit(1)).alias(f"{nav.name}@page"),
    )


def _collected(*order: str) -> Column:
    items = F.sort_array(F.collect_list(F.struct(*order, "__item")))
    return F.transform(items, lambda one: one["__item"])


def counted(df: DataFrame, filter: Column | str | None = None) -> DataFrame:
    """``$count`` alone: one row with the number of matching rows."""
    return query(df, filter=filter).agg(F.count("*").alias(COUNT))


__all__ = [
    "Navigation",
    "counted",
    "equals",
    "expand_many",
    "expand_one",
    "get_by_key",
    "keyed",
    "query",
]
