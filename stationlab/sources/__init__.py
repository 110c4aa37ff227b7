"""Reading, typing, storing and querying tables."""

from .layers import layer_inventory, layer_path, register_layers, sql_query, stored_tables
from .shapes import distinct_values, melt_stations, preview_rows, station_catalog, widen_stations
from .tables import (
    CITY_SCHEMA,
    cast_numeric,
    date_parts,
    load_city_table,
    load_station_table,
    parse_date,
    read_csv_table,
    read_json_table,
    read_layer,
    write_layer,
)

__all__ = [
    "CITY_SCHEMA",
    "cast_numeric",
    "date_parts",
    "distinct_values",
    "layer_inventory",
    "layer_path",
    "load_city_table",
    "load_station_table",
    "melt_stations",
    "parse_date",
    "preview_rows",
    "read_csv_table",
    "read_json_table",
    "read_layer",
    "register_layers",
    "sql_query",
    "station_catalog",
    "stored_tables",
    "widen_stations",
    "write_layer",
]
