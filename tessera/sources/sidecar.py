"""Labels beside documents: strict JSON of a fixed shape, with dates as whole numbers.

Rows as DataFrames go through ``checked``; ``to_json`` and ``from_json`` are the same rules for one label.
"""

from __future__ import annotations

import datetime as dt
import json

import pyarrow as pa
from pyspark.sql import DataFrame

WRAPPER = "metadataAttributes"
TEXTS = ("department_name", "alb", "report_type", "spend_id", "project_name")
FIELDS = ("document_type", *TEXTS, "date", "is_latest")
MAX_BYTES = 10_000


class BadSidecar(ValueError):
    pass


def _date(value) -> dt.date:
    if isinstance(value, bool) or not isinstance(value, int) or not 10000101 <= value <= 99991231:
        raise BadSidecar("date must be a whole number YYYYMMDD")
    try:
        return dt.date(value // 10000, value // 100 % 100, value % 100)
    except ValueError:
        raise BadSidecar(f"{value} is no date") from None


def from_json(text: str, types: tuple[str, ...] | None = None) -> dict:
    """The fields of a label; anything out of shape raises ``BadSidecar``."""
    try:
        whole = json.loads(text)
    except ValueError as error:
        raise BadSidecar(f"no JSON: {error}") from None
    if not isinstance(whole, dict) or set(whole) != {WRAPPER} or not isinstance(whole[WRAPPER], dict):
        raise BadSidecar(f"must hold {WRAPPER} alone")
    found = whole[WRAPPER]
    if unknown := sorted(set(found) - set(FIELDS)):
        raise BadSidecar(f"unknown fields {unknown}")
    if not isinstance(found.get("document_type"), str) or (types is not None and found["document_type"] not in types):
        raise BadSidecar("document_type is missing or unknown")
    out: dict = {"document_type": found["document_type"]}
    for name in TEXTS:
        if name in found:
            if not isinstance(found[name], str) or not found[name]:
                raise BadSidecar(f"{name} must be text")
            out[name] = found[name]
    if "date" in found:
        out["date"] = _date(found["date"])
    if "is_latest" in found:
        if not isinstance(found["is_latest"], bool):
            raise BadSidecar("is_latest must be true or false")
        out["is_latest"] = found["is_latest"]
    return out


def to_json(label: dict) -> str:
    """A label as JSON: without NULLs, beyond ASCII escaped; more than ``MAX_BYTES`` bytes are refused."""
    fields = {k: int(v.strftime("%Y%m%d")) if isinstance(v, dt.date) else v for k, v in label.items() if v is not None}
    out = json.dumps({WRAPPER: fields}, indent=2)
    if len(out) > MAX_BYTES:
        raise BadSidecar(f"{len(out)} bytes, more than {MAX_BYTES}")
    return out


def undeclared(label: dict, declared: tuple[str, ...]) -> list[str]:
    """Fields that the source doesn't declare, sorted."""
    return sorted(set(label) - set(declared))


def _checker(batches):
    for batch in batches:
        errors = []
        for text in batch.column(1).to_pylist():
            try:
                from_json(text or "")
                errors.append(None)
            except BadSidecar as error:
                errors.append(str(error))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(errors, pa.string())], names=["key", "error"])


def checked(rows: DataFrame) -> DataFrame:
    """For each (key, text): key and error, NULL where the label is fine."""
    from ..workers import ship

    ship(rows.sparkSession)
    return rows.select("key", "text").mapInArrow(_checker, "key string, error string")
