"""File sources."""

from .chapters import NESTED3, read_nested_chapters
from .files import (
    NESTED4,
    ManifestCheck,
    check_manifest,
    key_from_name,
    list_books,
    read_nested_books,
    read_tagged_lines,
    route_lines,
    split_quarantine,
    variant_path,
    with_key_from_name,
)

__all__ = [
    "NESTED3", "NESTED4", "read_nested_chapters", "ManifestCheck", "check_manifest", "key_from_name", "list_books", "read_nested_books",
    "read_tagged_lines", "route_lines", "split_quarantine", "variant_path", "with_key_from_name",
]
