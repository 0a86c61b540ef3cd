"""Column-level functions (native Spark expressions only)."""

from .ids import concat_id, padded_id, recode_ref, sequence_id
from .labels import greek_part, label, language
from .positional import decode_positional
from .serialize import is_json, json_columns, record_json, tag_string
from .tree import decode_tree, split_tag, tree_error

__all__ = [
    "concat_id", "padded_id", "recode_ref", "sequence_id",
    "greek_part", "label", "language",
    "decode_positional",
    "is_json", "json_columns", "record_json", "tag_string",
    "decode_tree", "split_tag", "tree_error",
]
