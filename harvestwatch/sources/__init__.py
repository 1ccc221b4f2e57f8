"""Scans, landed-file readers and sinks."""

from .tables import (
    RAINFALL_RAW, PRICES_RAW, EVENTS_RAW, EVENT_FIELDS, EVENT_PAGE, read_table, drop_tag_rows, normalised,
    subset_country, read_event_pages, save_if_absent, write_stage, write_feed,
    write_lines, source_overview,
)
from .driver import table

__all__ = [n for n in dir() if not n.startswith("_")]
