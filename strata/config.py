"""Run parameters shared by every layer (replaces the YAML config + argparse)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Lineage literals written by each layer.
RAW_RECORD_SOURCE = "olist"
PROCESSED_PREFIX = "processed_layer"
CURATED_PREFIX = "curated_layer"


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one pipeline run.

    ``load_ts`` / ``as_of`` default to "now" / "today" like the original jobs'
    ``current_timestamp()`` / ``current_date()``; pin them for reproducible runs.
    """

    record_source: str = RAW_RECORD_SOURCE
    load_ts: dt.datetime | None = None
    as_of: dt.date | None = None


# Pinned parameters used by the registered queries and their oracle SQL.
PINNED = RunConfig(
    load_ts=dt.datetime(2024, 1, 1, 0, 0, 0),
    as_of=dt.date(2002, 1, 1),
)
