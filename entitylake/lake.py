"""One object for users who think in entities rather than in DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from entitylake.functions.columns import split_names
from entitylake.functions.ordering import OrderBy
from entitylake.operators import catalog, paging, query
from entitylake.plans.extract import Collection, extract_all
from entitylake.plans.reports import counts_report
from entitylake.sources.pageindex import followed, save_entity, saved_page_behind, saved_pages
from entitylake.sources.pages import write_records


class Lake:
    """Named entity tables with their paging order, navigations and catalogue.

    ``tables`` maps endpoint names to collections, ``navigations`` an endpoint to
    its navigation properties, which ``expand`` then takes by name.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, Collection],
        definitions: DataFrame | None = None,
        snapshots: DataFrame | None = None,
        navigations: Mapping[str, Iterable[query.Navigation]] | None = None,
    ) -> None:
        self.spark = spark
        self.tables = dict(tables)
        self._definitions = definitions
        self._snapshots = snapshots
        self._navigations = {
            entity: {nav.name: nav for nav in found} for entity, found in (navigations or {}).items()
        }

    @property
    def definitions(self) -> DataFrame:
        if self._definitions is None:
            raise LookupError("this lake has no entity definitions")
        return self._definitions

    @property
    def snapshots(self) -> DataFrame:
        if self._snapshots is None:
            raise LookupError("this lake has no record count snapshots")
        return self._snapshots

    def _table(self, entity: str) -> Collection:
        if entity not in self.tables:
            raise LookupError(f"no such entity: {entity}")
        return self.tables[entity]

    def _options(self, entity: str, options: dict[str, Any]) -> dict[str, Any]:
        expand = options.get("expand")
        if isinstance(expand, str) or (isinstance(expand, Sequence) and all(isinstance(e, str) for e in expand)):
            known = self._navigations.get(entity, {})
            options = {**options, "expand": [known[name] for name in split_names(expand)]}
        return options

    def get_entities(
        self,
        entity: str,
        select: str | Sequence[str] | None = None,
        filter: Column | str | None = None,
        expand: str | Sequence[str] | Sequence[query.Navigation] | None = None,
        top: int | None = None,
        orderby: OrderBy | None = None,
        count: bool = False,
    ) -> DataFrame:
        """Query an entity; ``filter`` is a Spark predicate."""
        options = {
            "select": select, "filter": filter, "expand": expand, "top": top, "orderby": orderby, "count": count
        }
        return query.query(self._table(entity).df, **self._options(entity, options))

    def get_entity(self, entity: str, key: Mapping[str, Any], **options: Any) -> DataFrame:
        """Exactly one record by primary or alternate key."""
        return query.get_by_key(self._table(entity).df, key, **self._options(entity, options))

    def get_all_records(self, entity: str) -> DataFrame:
        return self._table(entity).df

    def get_first_page(self, entity: str, size: int = paging.PAGE_SIZE) -> DataFrame:
        table = self._table(entity)
        return paging.first_page(table.df, table.order_by, size)

    def get_next_page(
        self, entity: str, last: Mapping[str, Any] | None, size: int = paging.PAGE_SIZE
    ) -> DataFrame:
        """The page behind ``last``, the sort key values of the last row seen."""
        table = self._table(entity)
        return paging.next_page(table.df, table.order_by, last, size)

    def get_all_pages(self, entity: str, size: int = paging.PAGE_SIZE) -> DataFrame:
        table = self._table(entity)
        return paging.all_pages(table.df, entity, table.order_by, size)

    def save_pages(self, path: str, entities: Sequence[str] | None = None, size: int = paging.PAGE_SIZE) -> None:
        for name in entities or self.tables:
            table = self._table(name)
            save_entity(table.df, name, table.order_by, path, size)

    def get_saved_pages(self, path: str, entity: str, first: int, last: int | None = None) -> DataFrame:
        """Saved pages by number; only the blocks that hold them are read."""
        return saved_pages(self.spark, path, entity, first, last, self._table(entity).df.schema)

    def follow(self, path: str, link: str) -> DataFrame:
        """The saved page that a page's link names."""
        return followed(self.spark, path, link, self._table(link.rpartition("?page=")[0]).df.schema)

    def get_saved_next_page(
        self, path: str, entity: str, last: Mapping[str, Any] | None, size: int = paging.PAGE_SIZE
    ) -> DataFrame:
        """As ``get_next_page``, from saved pages."""
        table = self._table(entity)
        return saved_page_behind(self.spark, path, entity, table.df.schema, table.order_by, last, size)

    def save_records(self, path: str, entities: Sequence[str] | None = None) -> None:
        write_records({name: self._table(name).df for name in entities or self.tables}, path)

    def get_names(self, short: bool = False) -> DataFrame:
        return catalog.harvest_names(self.definitions, short)

    def get_endpoints(self, rule: str = "longest", short: bool = False) -> DataFrame:
        names = self.spark.createDataFrame([(name,) for name in self.tables], "name string")
        return catalog.resolve_endpoints(self.definitions, names, rule, short)

    def get_record_counts(self) -> DataFrame:
        return catalog.record_counts(self.definitions, self.snapshots)

    def get_attributes(self, entities: Sequence[str] | None = None) -> DataFrame:
        frames = {name: self._table(name).df for name in entities or self.tables}
        return catalog.time_fields(catalog.field_listing(frames))

    def get_profiles(self, size: int = paging.PAGE_SIZE) -> DataFrame:
        counts = catalog.record_counts_or_zero(self.definitions, self.snapshots)
        return catalog.entity_profile(self.definitions, self.get_endpoints(), counts, self.get_attributes(), size)

    def counts_report(self, path: str | None = None) -> DataFrame:
        counts = self.get_record_counts().select("entity", "record_count")
        return counts_report(counts, self.definitions, path)

    def extract_all(self, path: str, size: int = paging.PAGE_SIZE, run: str | None = None) -> list[str]:
        return extract_all(self.definitions, self.snapshots, self.tables, path, size, run=run)
