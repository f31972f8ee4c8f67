"""DataFrame -> DataFrame operators: conformance, alignment, facts, dims, lookups, spines."""

from .align import align_columns, union_aligned
from .conform import cast_columns, fill_sentinels
from .dims import DimSpec, build_dim, chosen, dim_columns, dim_conflicts, dim_filter, finish_dim
from .facts import FactSpec, Measure, build_fact, finish_fact
from .lookup import collapse_lookup, describe_codes, lookup_dim
from .onepass import OnePass
from .rejects import reject_account, rejected_values
from .spines import day_spine, day_spine_over, int_spine

__all__ = [
    "DimSpec", "FactSpec", "Measure", "OnePass", "align_columns", "build_dim", "build_fact",
    "cast_columns", "chosen", "collapse_lookup", "day_spine", "day_spine_over", "describe_codes", "dim_columns", "dim_conflicts",
    "dim_filter", "fill_sentinels", "finish_dim", "finish_fact", "int_spine", "lookup_dim", "reject_account", "rejected_values", "union_aligned",
]
