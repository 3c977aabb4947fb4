"""Relational operators: DataFrame -> DataFrame, lazy."""

from .bucket import (DQConfig, aggregate_timeseries, bucket_coverage, bucket_values,
                     bucketed_view, dq_rollup, fill_interior_gaps, with_coverage)
from .compare import (drop_placeholder_rows, order_by_delta, placeholder_mask, top_movers,
                      ranked_by_delta, year_compare, year_comparison, year_window_filter, yearly_kpis, yoy_change)
from .kpi import (attach_dq, compute_kpis, compute_kpis_with_quality, energy_mix, fill_mwh,
                  kpi_core, net_import, price_stats)
from .reports import (delta_bounds, delta_headline, delta_range_filter, dq_latest_items,
                      dq_summary, drop_empty, energy_mix_series, head_rows, history_tail, kpi_latest_items,
                      latest_per_key, latest_snapshot, price_summary, price_vs_mix,
                      region_country, regional_comparison, table_profile, transition_scatter,
                      variation_guard)
from .scope import (alias_countries, eu27_frame, eu27_keys, eu_scope, export_scope,
                    normalize_ts, range_select)
