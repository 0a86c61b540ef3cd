"""Structured Streaming entry points."""

from .incremental import stream_corpus_files, stream_files_to_table

__all__ = ["stream_corpus_files", "stream_files_to_table"]
