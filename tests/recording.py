"""A key-value client that records calls to JSON-lines files instead of a
store — for tests, dry runs and round-trip checks of the ``kvbatch`` sink.

``record_dir`` may be a local path or a URI that ``pyarrow.fs`` resolves
(e.g. the shared checkpoint folder on a cluster).  Each client writes one
file, closed when the task finishes.  ``reject_last``: in every call with more items
than that, report the last ``reject_last`` items as unprocessed, so each
batch is resent once (the resent tail is accepted)."""

from __future__ import annotations

import json
import os
import uuid


def _open_output(record_dir: str, name: str):
    if record_dir.startswith("file:"):
        record_dir = "/" + record_dir[len("file:"):].lstrip("/")
    if "://" in record_dir:
        from pyarrow import fs

        filesystem, root = fs.FileSystem.from_uri(record_dir)
        filesystem.create_dir(root, recursive=True)
        return filesystem.open_output_stream(f"{root.rstrip('/')}/{name}"), True
    os.makedirs(record_dir, exist_ok=True)
    return open(os.path.join(record_dir, name), "ab"), False


class RecordingClient:
    def __init__(self, record_dir: str, reject_last: str | int = 0):
        self._fh, _ = _open_output(record_dir, f"calls-{os.getpid()}-{uuid.uuid4().hex}.jsonl")
        self.reject_last = int(reject_last)

    def _log(self, **rec) -> None:
        self._fh.write((json.dumps(rec, default=str, sort_keys=True) + "\n").encode("utf-8"))

    def batch_write(self, table: str, items: list[dict]) -> list[dict]:
        reject = self.reject_last if self.reject_last and len(items) > self.reject_last else 0
        accepted, rest = (items[: len(items) - reject], items[len(items) - reject:]) if reject else (items, [])
        self._log(op="batch_write", table=table, n=len(items), accepted=accepted)
        return rest

    def put_multi(self, table: str, keys: list[str], items: list[dict]) -> None:
        self._log(op="put_multi", table=table, n=len(items), keys=keys, accepted=items)

    def put(self, table: str, key: str, item: dict) -> None:
        self._log(op="put", table=table, n=1, keys=[key], accepted=[item])

    def close(self) -> None:
        self._fh.close()


def recording_client(record_dir: str, reject_last: str = "0") -> RecordingClient:
    return RecordingClient(record_dir, reject_last)


def read_calls(record_dir: str) -> list[dict]:
    """All recorded calls of a local record folder (tests)."""
    if record_dir.startswith("file:"):
        record_dir = "/" + record_dir[len("file:"):].lstrip("/")
    calls = []
    for name in sorted(os.listdir(record_dir)):
        with open(os.path.join(record_dir, name), encoding="utf-8") as fh:
            calls += [json.loads(line) for line in fh if line.strip()]
    return calls


class CountingClient:
    """Accepts everything and only counts — measures the writer itself."""

    def __init__(self):
        self.n = 0

    def batch_write(self, table: str, items: list[dict]) -> list[dict]:
        self.n += len(items)
        return []

    def put_multi(self, table: str, keys: list[str], items: list[dict]) -> None:
        self.n += len(items)

    def put(self, table: str, key: str, item: dict) -> None:
        self.n += 1


def counting_client() -> CountingClient:
    return CountingClient()
