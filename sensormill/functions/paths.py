"""Path and log-id expressions. A *numbered* file has a name of digits plus at most one suffix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensormill.schemas import LOG_ID_PATTERN

_NUMBERED = r"(?:^|/)([0-9]+)(?:\.[^./]+)?\z"


def strip_scheme(path: Column) -> Column:
    """``file:/a/b`` and ``file:///a/b`` become ``/a/b``; other schemes keep their authority."""
    return F.regexp_replace(path, "^file:/+", "/")


def folder_name(path: Column, up: int = 1) -> Column:
    """Name of the folder ``up`` levels above the file (1 is its own folder), NULL if there is none."""
    return F.try_element_at(F.split(path, "/"), F.lit(-(up + 1)))


def relative_to(path: Column, root: Column) -> Column:
    return F.substring(path, F.length(root) + 2, F.length(path))


def is_numbered_file(path: Column) -> Column:
    return path.rlike(_NUMBERED)


def stamp_ns(path: Column) -> Column:
    """Digits of the file name as BIGINT; NULL if there are none or they do not fit."""
    digits = F.regexp_extract(path, _NUMBERED, 1)
    return F.when(is_numbered_file(path), digits.try_cast("bigint"))


def is_log_id(value: Column) -> Column:
    return F.coalesce(value.rlike(LOG_ID_PATTERN), F.lit(False))
