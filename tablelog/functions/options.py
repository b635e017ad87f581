"""Options of sources and sinks; all problems are told at once."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from tablelog.errors import OptionError
from tablelog.functions.intervals import timestamp_ms

# Option names and defaults.
DEFAULTS: dict[str, Any] = {"updateCheckIntervalMillis": 5000, "updateCheckDelayMillis": 1000, "ignoreDeletes": False, "ignoreChanges": False, "parquetBatchSize": 2048, "maxVersionsPerTrigger": 0, "maxFilesPerTrigger": 0, "strictActions": False}
BOUNDED = ("versionAsOf", "timestampAsOf", "parquetBatchSize", "columns")
CONTINUOUS = ("startingVersion", "startingTimestamp", "updateCheckIntervalMillis", "updateCheckDelayMillis", "ignoreDeletes", "ignoreChanges", "parquetBatchSize", "columns", "maxVersionsPerTrigger", "maxFilesPerTrigger", "progressLocation", "strictActions")
_WHOLE = ("updateCheckIntervalMillis", "updateCheckDelayMillis", "parquetBatchSize", "versionAsOf", "maxVersionsPerTrigger", "maxFilesPerTrigger")
_FLAGS = ("ignoreDeletes", "ignoreChanges", "strictActions")
_FORBIDDEN = ("spark.", "delta.logstore", "io.delta", "parquet.")


def source_options(given: Mapping[str, Any], streaming: bool) -> dict[str, Any]:
    """Options by name (case doesn't matter) with their types and defaults."""
    allowed = CONTINUOUS if streaming else BOUNDED
    names = {n.lower(): n for n in (*BOUNDED, *CONTINUOUS)}
    problems, out = [], {k: v for k, v in DEFAULTS.items() if k in allowed}
    for key, value in given.items():
        name = names.get(key.lower())
        if key.lower() in ("path", "mode"):
            continue
        if name is None:
            problems.append(f"unknown option {key}")
        elif name not in allowed:
            problems.append(f"option {name} doesn't go with a {'continuous' if streaming else 'bounded'} source")
        else:
            try:
                out[name] = _typed(name, value)
            except (ValueError, TypeError) as e:
                problems.append(f"option {name}: {e}")
    for a, b in (("versionAsOf", "timestampAsOf"), ("startingVersion", "startingTimestamp")):
        if a in out and b in out:
            problems.append(f"{a} and {b} exclude each other")
    if streaming and (out["maxVersionsPerTrigger"] or out["maxFilesPerTrigger"]) and "progressLocation" not in out:
        problems.append("maxVersionsPerTrigger and maxFilesPerTrigger need progressLocation, the query's checkpoint folder")
    if problems:
        raise OptionError(problems)
    if out.get("ignoreChanges"):
        out["ignoreDeletes"] = True
    return out


def _typed(name: str, value: Any) -> Any:
    if value is None or isinstance(value, str) and not value.strip():
        raise ValueError("no value")
    if name in _WHOLE:
        n = int(value)
        if n < 0:
            raise ValueError(f"can't be negative: {n}")
        return n
    if name in _FLAGS:
        if str(value).lower() not in ("true", "false"):
            raise ValueError(f"must be true or false: {value}")
        return str(value).lower() == "true"
    if name == "startingVersion":
        if str(value).strip().lower() == "latest":
            return "latest"
        if int(value) < 0:
            raise ValueError(f"can't be negative: {value}")
        return int(value)
    if name in ("startingTimestamp", "timestampAsOf"):
        return timestamp_ms(str(value))
    if name == "columns":
        names = [c.strip() for c in value.split(",")] if isinstance(value, str) else list(value)
        if not names or any(not c for c in names):
            raise ValueError("blank column names")
        return names
    return value


def ddl_options(given: Mapping[str, str]) -> dict[str, str]:
    """Table properties of a DDL statement: job options and settings of engines are refused."""
    jobs = {n.lower() for n in (*BOUNDED, *CONTINUOUS, "mode")}
    problems = [f"{k} is an option of a query, not of a table" for k in given if k.lower() in jobs]
    problems += [f"{k} is a setting of an engine, not of a table" for k in given if k.lower().startswith(_FORBIDDEN)]
    if problems:
        raise OptionError(problems)
    return {k: v for k, v in given.items() if k not in ("connector", "table-path")}


def query_hints(given: Mapping[str, str], reading: bool) -> dict[str, Any]:
    """Hints of a statement: source options when reading (mode says which source), none when writing."""
    if not reading:
        if given:
            raise OptionError([f"{k} can't be given when writing" for k in given])
        return {}
    mode = given.get("mode", "batch").lower()
    if mode not in ("batch", "streaming"):
        raise OptionError([f"mode must be batch or streaming, not {mode}"])
    return {"mode": mode} | source_options(given, mode == "streaming")
