"""Table properties."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from tablelog.errors import ReservedProperty, UnknownProperty
from tablelog.functions.intervals import interval_ms

# Fixed value: the prefix of session settings.
DEFAULTS_PREFIX = "spark.databricks.delta.properties.defaults."


def _positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise ValueError(f"must be a positive number: {text}")
    return n


def _duration(text: str) -> int:
    n = interval_ms(text)
    if n < 0:
        raise ValueError(f"must not be negative: {text}")
    return n


def _boolean(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise ValueError(f"must be true or false: {text}")
    return text.lower() == "true"


# The validated table properties, their defaults and types.
PROPERTIES: dict[str, tuple[str, Callable[[str], Any]]] = {
    "delta.logRetentionDuration": ("interval 30 days", _duration),
    "delta.deletedFileRetentionDuration": ("interval 1 week", _duration),
    "delta.checkpointInterval": ("10", _positive),
    "delta.enableExpiredLogCleanup": ("true", _boolean),
    "delta.appendOnly": ("false", _boolean),
}
_LOWER = {k.lower(): k for k in PROPERTIES}


def value(configuration: dict[str, str], name: str) -> Any:
    default, convert = PROPERTIES[name]
    return convert(configuration.get(name, default))


def validated(configuration: dict[str, str]) -> dict[str, str]:
    """Known delta.* keys in their usual case with valid values; constraints and unknown delta.* keys are refused, other
    keys pass."""
    out = {}
    for k, v in configuration.items():
        low = k.lower()
        if low.startswith("delta.constraints."):
            raise ReservedProperty(f"{k} can't be set as a property")
        if low.startswith("delta."):
            if low not in _LOWER:
                raise UnknownProperty(f"unknown property {k}")
            PROPERTIES[_LOWER[low]][1](v)
            out[_LOWER[low]] = v
        else:
            out[k] = v
    return out


def with_session_defaults(spark: SparkSession, configuration: dict[str, str]) -> dict[str, str]:
    """Session settings under DEFAULTS_PREFIX come in where the table says nothing."""
    out = {}
    for name in PROPERTIES:
        found = spark.conf.get(DEFAULTS_PREFIX + name.removeprefix("delta."), None)
        if found is not None:
            out[name] = found
    return validated(out) | configuration
