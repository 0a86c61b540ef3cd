"""Sinks: JSON Lines, JDBC and the kvbatch Python data source."""

from .jdbc import write_jdbc_json
from .jsonl import read_jsonl, write_jsonl
from .kvbatch import KVBatchDataSource, register

__all__ = ["write_jdbc_json", "read_jsonl", "write_jsonl", "KVBatchDataSource", "register"]
