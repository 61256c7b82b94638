"""Registry of named queries: a Spark builder and, where SQL can express it,
the oracle SQL that an independent engine runs on the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from roadlens.session import limit_methods
from roadlens.sources import tables as T


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    operators: tuple[str, ...]
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: tuple[str, ...] = (), oracle: str | None = None, note: str = ""):
    def deco(fn):
        @wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            limit_methods(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = Query(name, build, oracle, tuple(operators), note)
        return fn
    return deco


_DEVICES = T.oracle_text(T.DEVICES_SQL, lineitem="lineitem", part="part", orders="orders")
_EVENTS = T.oracle_text(T.TRAFFIC_EVENTS_SQL, events="events")
_LEGACY = T.oracle_text(T.LEGACY_SQL, devices="devices")
_ATTACH = T.oracle_text(T.ATTACHMENTS_SQL, documents="documents")
_UPLOAD = T.oracle_text(T.UPLOAD_RESPONSE_SQL, attachments="attachments")

_VIEW_SQL = {
    "devices": _DEVICES,
    "traffic_events": _EVENTS,
    "legacy_records": _LEGACY,
    "attachments": _ATTACH,
    "upload_response": _UPLOAD,
}
_VIEW_DEPS = {
    "legacy_records": ("devices",),
    "upload_response": ("attachments",),
}


def with_views(body: str, *views: str) -> str:
    """Prefix the oracle query with the fixture views it reads, as CTEs."""
    order: list[str] = []

    def add(v):
        for d in _VIEW_DEPS.get(v, ()):
            add(d)
        if v not in order:
            order.append(v)
    for v in views:
        add(v)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{v} AS ({_VIEW_SQL[v]})" for v in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
