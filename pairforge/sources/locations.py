"""Files as tasks see them: a filesystem and a path for a location that Spark gives."""

from __future__ import annotations

import posixpath
from functools import lru_cache

from pyarrow import fs


@lru_cache(maxsize=64)
def _root(prefix: str):
    return fs.FileSystem.from_uri(prefix + "/")


def open_location(location: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and path of a plain path, a ``file:`` location or one with another scheme. Nothing in it is decoded."""
    if location.startswith("file:"):
        return fs.LocalFileSystem(), "/" + location[len("file:"):].lstrip("/")
    if "://" not in location:
        return fs.LocalFileSystem(), posixpath.abspath(location)
    scheme, rest = location.split("://", 1)
    host, _, path = rest.partition("/")
    system, top = _root(f"{scheme}://{host}")
    return system, posixpath.join(top, path)
