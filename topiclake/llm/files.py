"""Byte files in the cluster's shared folder, written and read inside tasks.

``pyarrow.fs`` resolves the folder's scheme (``file``, ``hdfs``, ``s3``, ``gs``). A task
writes under a name that no other attempt uses, and only names that reached the written
manifest table are ever read, so retried, speculative or lost attempts leave no trace.
"""

from __future__ import annotations

import re
import uuid


def filesystem(uri: str):
    """(file system, path) for a folder or file URI; plain paths are local ones."""
    from pyarrow import fs
    uri = re.sub(r"^file:/+", "/", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def unique_name(partition: int, seq: int, suffix: str) -> str:
    return f"part-{partition:06d}-{seq:05d}-{uuid.uuid4().hex[:12]}{suffix}"
