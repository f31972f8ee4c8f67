"""Scans (CSV variants, Parquet layers) and sinks (Parquet writes)."""

from .csv import (
    PART_TOKEN,
    header_groups,
    list_files,
    read_by_header,
    read_delimited,
    read_positional,
    string_schema,
    with_source,
)
from .ledger import Delivery, compare, deliver, drop_unused, listing, read_delivered, read_ledger, read_rejects
from .parquet import read_layer
from .scratch import drop_scratch, path_exists, scratch_path, shared_root, shuffles_released
from .sinks import LAYER_CODEC, write_counted, write_parquet
from .versions import current, prune, read_replaced, replace_parquet

__all__ = [
    "LAYER_CODEC", "PART_TOKEN", "Delivery", "compare", "current", "deliver", "drop_scratch", "drop_unused", "header_groups", "list_files", "listing",
    "path_exists", "prune", "read_by_header", "read_delimited", "read_delivered", "read_layer", "read_ledger",
    "read_rejects",     "read_positional", "read_replaced", "replace_parquet", "scratch_path", "shared_root", "shuffles_released", "string_schema", "with_source",
    "write_counted", "write_parquet",
]
