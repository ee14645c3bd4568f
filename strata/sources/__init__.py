"""Sources and sinks: raw CSV scans, layer tables, and raw views of the test data."""

from strata.sources.csv import read_raw_csv, read_raw_drop, write_raw_csv
from strata.sources.layers import ANALYTICS, CURATED, PROCESSED, LayerStore
from strata.sources.star_views import raw_view, raw_views

__all__ = ["read_raw_csv", "read_raw_drop", "write_raw_csv", "LayerStore", "PROCESSED", "CURATED",
           "ANALYTICS", "raw_view", "raw_views"]
