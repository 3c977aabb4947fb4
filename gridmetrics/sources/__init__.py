"""Sources (baseline grids, landed-table shaping, pages, cache) and sinks."""

from .cache import (attempt_path, latest_cached_path, params_digest, publish, raw_path, read_latest_cached, read_raw, restore,
                    write_raw)
from .fallback import fallback_fill, kind_of, run_kind, run_source, write_filled
from .grid import (baseline_daily, baseline_hourly, baseline_monthly, bounds_frame, calendar_grid, country_bounds,
                   data_range, multi_region_union, profile_rows)
from .ingest import (dropped_rows, flatten_columns, fuel_types, generation_wide_to_long, monthly_raw_to_long,
                     monthly_to_long, price_to_hourly, rule_buckets)
from .pages import page_data_links
from .csvfiles import csv_records, read_csv, read_csv_in_order, write_csv
from .sinks import (dq_latest_document, kpi_latest_document, read_json_document, read_kpi_history, write_json_document,
                    write_kpi_history)
