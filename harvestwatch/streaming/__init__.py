"""Incremental refresh of landed raw files with Structured Streaming."""

from .refresh import (start_refresh, start_keyed_refresh, merge_events, conflict_from_partials,
                      rainfall_from_partials)

__all__ = ["start_refresh", "conflict_from_partials", "rainfall_from_partials"]
