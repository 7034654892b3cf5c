"""Declared schemas of the six source tables."""

from pyspark.sql import types as T

_DENORM = (
    "int_id bigint, venue_key_id bigint, floorplan_int_id bigint, persistent_id string, "
    "interval_minutes int, deleted timestamp_ntz, name string, start_time timestamp_ntz, "
    "end_time timestamp_ntz, effective_start_date date, effective_end_date date, table_size int, "
    "turn_duration int, venue_start_of_day_time_min int, last_updated timestamp_ntz, "
    "custom_pacing_str string, covers_per_seating_interval int, shift_start_time_min int, "
    "shift_end_time_min int, duration_minutes_by_party_size_str string, "
    "duration_dict_ranges_str string"
)

SCHEMA_DDL = {
    "shift_default": (
        "int_id bigint, venue_key_id bigint, persistent_id string, name string, category string, "
        "effective_start_date date, effective_end_date date, day_of_week array<boolean>, "
        "excluded_dates array<date>, archived timestamp_ntz, deleted timestamp_ntz"
    ),
    "shift_override": (
        "date date, int_id bigint, venue_key_id bigint, category string, deleted timestamp_ntz"
    ),
    "shift_default_denorm": _DENORM,
    "shift_override_denorm": _DENORM,
    "reservation": (
        "venue_key_id bigint, shift_persistent_id string, marked_time timestamp_ntz, date date, "
        "created timestamp_ntz, status string, max_guests int"
    ),
    "venue": "__key__ struct<id: bigint>, name string",
}

TABLES = tuple(SCHEMA_DDL)


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMA_DDL[table])

# Descriptive columns that no computation needs; a source may leave them out.
OPTIONAL = {
    "floorplan_int_id", "turn_duration", "venue_start_of_day_time_min", "last_updated",
}
