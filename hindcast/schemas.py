"""Fixed schemas and names: source reports, canonical tables, dispositions (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

SYSTEM_TOTAL = "SYSTEM_TOTAL"
ZONES = ("COAST", "EAST", "FAR_WEST", "NORTH", "NORTH_CENTRAL", "SOUTH_CENTRAL", "SOUTHERN", "WEST")

ACCEPTED = "ACCEPTED"
DUPLICATE_IDENTICAL = "DUPLICATE_IDENTICAL"
QUARANTINED_KEY_CONFLICT = "QUARANTINED_KEY_CONFLICT"
QUARANTINED_PARSE_ERROR = "QUARANTINED_PARSE_ERROR"
QUARANTINED_INVALID_VALUE = "QUARANTINED_INVALID_VALUE"
QUARANTINED_SCHEMA_ERROR = "QUARANTINED_SCHEMA_ERROR"
DISPOSITIONS = (ACCEPTED, DUPLICATE_IDENTICAL, QUARANTINED_KEY_CONFLICT, QUARANTINED_PARSE_ERROR, QUARANTINED_INVALID_VALUE, QUARANTINED_SCHEMA_ERROR)


@dataclass(frozen=True)
class Report:
    """One data product: how its files are named and laid out."""

    key: str
    type_id: str
    marker: str
    header: tuple[str, ...]
    day: str
    zones: tuple[tuple[str, str], ...]  # source column and zone, in source order
    is_forecast: bool
    daily_at: int | None  # the local hour of its one publication a day; None: every hour


LOAD_FORECAST = Report(
    "load_forecast",
    "14837",
    "LFMODWEATHERNP3565",
    ("DeliveryDate", "HourEnding", "Coast", "East", "FarWest", "North", "NorthCentral", "SouthCentral", "Southern", "West", "SystemTotal", "Model", "InUseFlag", "DSTFlag"),
    "DeliveryDate",
    tuple(zip(("Coast", "East", "FarWest", "North", "NorthCentral", "SouthCentral", "Southern", "West", "SystemTotal"), (*ZONES, SYSTEM_TOTAL), strict=True)),
    True,
    None,
)
#: This report has its two southern zones in the other order: columns are always found by name.
ACTUAL_LOAD = Report(
    "actual_load",
    "13101",
    "ACTUALSYSLOADWZNP6345",
    ("OperDay", "HourEnding", "COAST", "EAST", "FAR_WEST", "NORTH", "NORTH_C", "SOUTHERN", "SOUTH_C", "WEST", "TOTAL", "DSTFlag"),
    "OperDay",
    (("COAST", "COAST"), ("EAST", "EAST"), ("FAR_WEST", "FAR_WEST"), ("NORTH", "NORTH"), ("NORTH_C", "NORTH_CENTRAL"), ("SOUTHERN", "SOUTHERN"), ("SOUTH_C", "SOUTH_CENTRAL"), ("WEST", "WEST"), ("TOTAL", SYSTEM_TOTAL)),
    False,
    5,
)
REPORTS = {r.key: r for r in (LOAD_FORECAST, ACTUAL_LOAD)}

_HEAD = "run_id string not null, processing_date date not null, source_file_id string not null, "
_OBSERVED = _HEAD + "source_row_number bigint not null, publication_ts_utc timestamp not null, target_ts_utc timestamp not null, operating_date date not null, hour_ending int not null, dst_flag string not null, weather_zone string not null, "
TABLES = {
    "source_file": _HEAD + "report_key string not null, original_filename string not null, publication_ts_utc timestamp not null, content_sha256 string not null, size_bytes bigint not null, schema_fingerprint string not null, local_path string not null, raw_row_count bigint not null",
    "source_row": _HEAD + "source_filename string not null, report_key string not null, source_row_number bigint not null, raw_line string not null, disposition string not null, reason_code string, reason string",
    "forecast_vintage": _OBSERVED + "model string not null, is_ercot_model_in_use boolean not null, forecast_mw double not null",
    "actual_vintage": _OBSERVED + "actual_mw double not null",
}
EVALUATION_COLUMNS = (
    "weather_zone", "target_ts_utc", "operating_date", "hour_ending", "dst_flag", "cutoff_ts_utc",
    "ercot_publication_ts_utc", "ercot_forecast_mw", "ercot_model", "ercot_value_count", "ercot_model_count", "ercot_vintage_age_hours",
    "actual_publication_ts_utc", "actual_mw", "actual_value_count",
    "naive_source_ts_utc", "naive_source_publication_ts_utc", "naive_forecast_mw", "naive_value_count", "ercot_error_mw", "naive_error_mw",
)
