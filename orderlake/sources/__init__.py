from orderlake.sources.records import Written, commit, last_record, new_run, record, unused_folders
from orderlake.sources.zones import (
    BAD_LINE,
    BAD_LINES,
    COUNTS,
    CURATED,
    CURATED_TABLE,
    PROCESSED,
    RAW_ZONE,
    REJECTED,
    ROLLUP_TABLE,
    bad_lines,
    bad_lines_of,
    current,
    read_raw,
    read_written,
    read_zone,
    register_tables,
    register_views,
    remove_run_folders,
    unsorted_writes,
    write_run,
    write_zone,
    zone_path,
)

__all__ = [
    "BAD_LINE",
    "BAD_LINES",
    "COUNTS",
    "CURATED",
    "CURATED_TABLE",
    "PROCESSED",
    "RAW_ZONE",
    "REJECTED",
    "ROLLUP_TABLE",
    "bad_lines",
    "bad_lines_of",
    "commit",
    "current",
    "last_record",
    "new_run",
    "read_raw",
    "read_written",
    "read_zone",
    "record",
    "register_tables",
    "register_views",
    "remove_run_folders",
    "unsorted_writes",
    "unused_folders",
    "write_run",
    "write_zone",
    "zone_path",
    "Written",
]
