"""Putting one finished file into storage, from inside a task."""

from __future__ import annotations

import posixpath
import random
import time
import uuid
from collections.abc import Callable

from pyarrow import fs

# Delays between attempts double from 100 ms up to 5 s, at random below that.
BACKOFF_BASE_MS = 100
BACKOFF_DOUBLINGS = 6
BACKOFF_MAX_MS = 5000


def backoff_ms(attempt: int) -> int:
    """Longest wait before an attempt; the first one (0) does not wait."""
    if attempt == 0:
        return 0
    return min(BACKOFF_BASE_MS * 2 ** min(attempt, BACKOFF_DOUBLINGS), BACKOFF_MAX_MS)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and folder of a path or URI; `s3a://` is read as `s3://`."""
    store, folder = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store, folder.rstrip("/")


def is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def _write(store: fs.FileSystem, target: str, content: bytes, metadata: dict[str, str] | None) -> None:
    parent, name = posixpath.split(target)
    if store.type_name in ("s3", "gcs", "abfs"):
        # An object appears whole when its upload completes.
        with store.open_output_stream(target, compression=None, metadata=metadata) as out:
            out.write(content)
        return
    # A name of this attempt alone, renamed when complete; dot files are not read as data.
    draft = f"{parent}/.{name}.{uuid.uuid4().hex}"
    try:
        try:
            out = store.open_output_stream(draft, compression=None)
        except FileNotFoundError:  # the first file of its folder
            store.create_dir(parent, recursive=True)
            out = store.open_output_stream(draft, compression=None)
        with out:
            out.write(content)
        store.move(draft, target)
    except BaseException:
        if store.get_file_info(draft).type != fs.FileType.NotFound:
            store.delete_file(draft)
        raise


def put(
    store: fs.FileSystem,
    target: str,
    content: bytes,
    max_retries: int,
    sleep: Callable[[float], None] = time.sleep,
    metadata: dict[str, str] | None = None,
) -> int:
    """Stores a file and returns the number of failed attempts before it worked.

    Object stores are handed `metadata` with it; keys that a store does not take are ignored there.
    Raises once the retries are used up, which fails the task; Spark may then rerun it.
    """
    for attempt in range(max_retries + 1):
        sleep(random.uniform(0, backoff_ms(attempt)) / 1000)
        try:
            _write(store, target, content, metadata)
            return attempt
        except OSError as error:
            failure = error
    raise OSError(f"maximum number of retries reached for '{target}'") from failure
