from fareline.sources.calendar import date_spine, date_spine_between
from fareline.sources.files import (
    MonthSource,
    read_layer_table,
    read_month,
    read_partitioned_month,
    read_trips,
    read_zones_csv,
    read_zones_optional,
    table_name,
)
from fareline.sources.resolve import read_landed, resolve_trips
from fareline.sources.testdata import raw_trips, raw_trips_from_events, raw_zones, raw_zones_from_nations

__all__ = [
    "MonthSource",
    "date_spine",
    "date_spine_between",
    "raw_trips",
    "raw_trips_from_events",
    "raw_zones",
    "raw_zones_from_nations",
    "read_landed",
    "read_layer_table",
    "read_month",
    "read_partitioned_month",
    "read_trips",
    "read_zones_csv",
    "read_zones_optional",
    "resolve_trips",
    "table_name",
]
