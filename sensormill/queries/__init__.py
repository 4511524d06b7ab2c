"""Every operator as a named query over the given tables, with equivalent SQL where SQL can express it."""

from sensormill.queries import checks, encodings, health, ingested, ledgers, marts, multisets, payloads, releases, retrieval, scene_files, scenes, sli_series, streams, sweep_stat, timelines
from sensormill.queries.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "checks",
    "encodings",
    "health",
    "ingested",
    "ledgers",
    "marts",
    "multisets",
    "payloads",
    "releases",
    "retrieval",
    "scene_files",
    "scenes",
    "sli_series",
    "streams",
    "sweep_stat",
    "timelines",
]
