"""DataFrame -> DataFrame operators."""

from .batching import assign_batches, batch_ranges, batch_report, exact_batches, group_totals, latest_by_key, order_for_batches
from .decode import book_dimension, decode_by_dictionary, decode_tree_columns, lookup_table, tag_dictionary
from .entities import flatten_struct, project_fields, to_flat_entity, to_item, to_json_row, to_keyed, to_wide_entity
from .explode import explode_chapters, explode_levels, explode_nested, explode_text, split_nested
from .joins import join_small, spread
from .profile import payload_profile
from .sequence import global_ordinal, run_ordinal, run_ordinal_in_order, sequence_within

__all__ = [
    "assign_batches", "batch_ranges", "batch_report", "exact_batches", "group_totals", "latest_by_key", "order_for_batches",
    "book_dimension", "decode_by_dictionary", "decode_tree_columns", "lookup_table", "tag_dictionary",
    "flatten_struct", "project_fields", "to_flat_entity", "to_item", "to_json_row", "to_keyed", "to_wide_entity",
    "explode_chapters", "explode_levels", "explode_nested", "explode_text", "split_nested", "join_small", "spread", "payload_profile",
    "global_ordinal", "run_ordinal", "run_ordinal_in_order", "sequence_within",
]
