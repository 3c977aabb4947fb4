"""End-to-end jobs and test-table adapters."""

from .pipeline import (PipelineResult, compare_years, eu_pipeline, global_pipeline, materialize,
                       run_eu, run_global, run_pipeline)
