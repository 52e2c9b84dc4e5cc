"""From a configured location to a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from dqgate.names import (
    BRONZE,
    GOLD,
    LOCATION_CATALOG,
    LOCATION_PATH,
    LOCATION_WAREHOUSE,
    SILVER,
    STAGE_BRONZE,
    STAGE_GOLD,
    STAGE_SILVER,
    STAGE_SYNAPSE,
)
from dqgate.sources.files import read_path, read_table
from dqgate.sources.jdbc import Warehouse, read_warehouse

# Layer a stage checks, and the layer its data comes from.
STAGE_LAYERS = {
    STAGE_BRONZE: (BRONZE, BRONZE),
    STAGE_SILVER: (SILVER, BRONZE),
    STAGE_GOLD: (GOLD, SILVER),
    STAGE_SYNAPSE: (GOLD, SILVER),
}


@dataclass(frozen=True)
class LayerStore:
    """One layer of one environment: a base URI, and the names shown in summaries."""

    base_uri: str
    container: str | None = None
    account: str | None = None


def abfss_store(container: str, account: str) -> LayerStore:
    """A layer kept in a container of an Azure storage account."""
    return LayerStore(f"abfss://{container}@{account}.dfs.core.windows.net", container, account)


@dataclass(frozen=True)
class RegisteredTable:
    primary_keys: tuple[str, ...]
    paths: dict[str, str]


@dataclass(frozen=True)
class Locations:
    """Everything needed to turn (location type, location, layer) into a table."""

    layers: dict[str, LayerStore] = field(default_factory=dict)
    fmt: str = "parquet"
    warehouse: Warehouse | None = None
    registry: dict[str, RegisteredTable] = field(default_factory=dict)
    # Path pattern per layer, for tables that are not registered one by one.
    patterns: dict[str, str] = field(default_factory=dict)
    # Warehouse tables read by several tasks: the column to divide them by, and into how many.
    warehouse_partitions: dict[str, tuple[str, int]] = field(default_factory=dict)

    def store(self, layer: str) -> LayerStore:
        for name, store in self.layers.items():
            if name.lower() == layer.lower():
                return store
        raise ValueError(f"layer {layer!r} is not configured; known: {sorted(self.layers)}")

    def path(self, location: str, layer: str | None) -> str:
        """Base URI of the layer followed by the relative location; an absolute
        location (with a scheme, or where no layer is given) stands alone."""
        if layer is None or "://" in location:
            return location
        return self.store(layer).base_uri + location

    def registered_path(self, table: str, layer: str) -> str:
        """Path of a registered table in a layer."""
        entry = self.registry.get(table)
        if entry is None or layer.lower() not in entry.paths:
            raise ValueError(f"table {table!r} is not registered for layer {layer!r}")
        return self.store(layer).base_uri + entry.paths[layer.lower()]

    def area_path(self, table: str, layer: str, **parts: str) -> str:
        """Where a layer keeps a table that is not registered: its base URI and its pattern.

        A pattern is given by the deployment and may name `{table}`, `{TABLE}` and any of
        `parts`; parts that are not given are left out with the slash before them.
        """
        pattern = next((p for name, p in self.patterns.items() if name.lower() == layer.lower()), None)
        if pattern is None:
            return self.registered_path(table.upper(), layer)
        known = {"table": table, "TABLE": table.upper(), **{k: v for k, v in parts.items() if v}}
        fields = [name for _, name, _, _ in Formatter().parse(pattern) if name]
        for name in fields:
            if name not in known:
                pattern = pattern.replace(f"/{{{name}}}", "")
        return self.store(layer).base_uri + pattern.format(**known)


def load_table(
    spark: SparkSession,
    location_type: str,
    location: str,
    locations: Locations,
    layer: str | None = None,
) -> DataFrame:
    """Load a table by its location type; an unknown type raises."""
    if location_type == LOCATION_PATH:
        return read_path(spark, locations.path(location, layer), locations.fmt)
    if location_type == LOCATION_CATALOG:
        return read_table(spark, location)
    if location_type == LOCATION_WAREHOUSE:
        if locations.warehouse is None:
            raise ValueError("a warehouse location needs a configured warehouse")
        column, n = locations.warehouse_partitions.get(location, (None, 1))
        return read_warehouse(spark, locations.warehouse, location, column, n)
    raise ValueError(f"unknown location type {location_type!r}")
