from stratum.sources.incremental import (
    high_water_mark,
    incremental_window,
    ingest,
    load_window,
    page,
    page_numbers,
    read_mark,
    read_page_index,
    write_mark,
    write_page_index,
)
from stratum.sources.landing import flatten_nested, land_jsonl
from stratum.sources.raw import (
    parse_records,
    promote_all_extra,
    promote_extra,
    read_merged,
    read_raw,
    read_seed,
    with_load_columns,
)

__all__ = [
    "high_water_mark", "incremental_window", "ingest", "load_window", "page", "page_numbers",
    "read_mark", "read_page_index", "write_mark", "write_page_index", "flatten_nested", "land_jsonl", "parse_records",
    "promote_all_extra", "promote_extra", "read_merged", "read_raw", "read_seed",
    "with_load_columns",
]
