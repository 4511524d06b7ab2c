"""Paths as (file system, plain path). A path is never parsed as a URI: names may hold ``%``, ``#`` or spaces."""

from __future__ import annotations

import re
from functools import lru_cache

_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]+):(?://([^/]*))?(/.*|)$", re.DOTALL)


@lru_cache(maxsize=64)
def _system(scheme: str, authority: str):
    """File system of an authority and the plain path of its root; one client per task and authority."""
    from pyarrow import fs

    if scheme in ("", "file"):
        return fs.LocalFileSystem(), ""
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, base.rstrip("/")


def locate(path: str):
    """(file system, plain path, function that gives a plain path of it the form of ``path``)."""
    match = _SCHEME.match(path)
    if not match:
        system, _ = _system("", "")
        return system, path, lambda plain: plain
    scheme, authority, inside = match[1], match[2] or "", match[3]
    system, base = _system(scheme, authority)
    prefix = path[: len(path) - len(inside)]
    return system, base + inside, lambda plain: prefix + plain[len(base) :]
