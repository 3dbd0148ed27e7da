"""Source readers, the ``Sources`` bundle and the test stand-ins."""

from featuremart.sources.tables import (
    CleanSources,
    Sources,
    clean_sources,
    load_sources,
    parse_run_date,
    read_table,
)

__all__ = [
    "CleanSources",
    "Sources",
    "clean_sources",
    "load_sources",
    "parse_run_date",
    "read_table",
]
