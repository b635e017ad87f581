"""Schema rules: names, duplicates, write compatibility, unenforceable constraints, external schemas."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import types as T

from tablelog.errors import InvalidColumnName, NestedNotNull, NoDataColumn, PartitionColumnsNotFound, SchemaChanged, SchemaError

ILLEGAL = re.compile(r"[ ,;{}()\n\t=]")


def _paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """Every field's path, elements of arrays and maps named so."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            name = f"`{f.name}`" if "." in f.name else f.name
            yield f"{at}{name}"
            yield from _paths(f.dataType, f"{at}{name}.")
    elif isinstance(kind, T.ArrayType):
        yield from _paths(kind.elementType, f"{at}element.")
    elif isinstance(kind, T.MapType):
        yield from _paths(kind.keyType, f"{at}key.")
        yield from _paths(kind.valueType, f"{at}value.")


def check_duplicates(schema: T.StructType, what: str = "in the schema") -> None:
    twice = [k for k, n in Counter(p.lower() for p in _paths(schema)).items() if n > 1]
    if twice:
        raise SchemaError(f"duplicate columns {what}: {', '.join(sorted(twice))}")


def check_names(schema: T.StructType) -> None:
    for p in _paths(schema):
        leaf = p[1:-1] if p.startswith("`") else p
        if ILLEGAL.search(leaf):
            raise InvalidColumnName(f"column name {p!r} holds one of ' ,;{{}}()\\n\\t='")


def check_partition_columns(schema: T.StructType, columns: tuple[str, ...] | list[str]) -> None:
    missing = [c for c in columns if c not in schema.fieldNames()]
    if missing:
        raise PartitionColumnsNotFound(f"partition columns {missing} are not in {schema.fieldNames()}")
    if schema.fields and len(set(columns)) == len(schema.fields):
        raise NoDataColumn("a table needs a column that it isn't partitioned by")


def check_not_null(schema: T.StructType) -> None:
    """NOT NULL fields of structs inside arrays or maps can't be enforced."""

    def walk(kind: T.DataType, inside: bool, at: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                if inside and not f.nullable:
                    raise NestedNotNull(f"NOT NULL of {at}{f.name} inside an array or map can't be enforced")
                walk(f.dataType, inside, f"{at}{f.name}.")
        elif isinstance(kind, T.ArrayType):
            walk(kind.elementType, True, f"{at}element.")
        elif isinstance(kind, T.MapType):
            walk(kind.keyType, True, f"{at}key.")
            walk(kind.valueType, True, f"{at}value.")

    walk(schema, False, "")


def write_compatible(old: T.DataType, new: T.DataType) -> bool:
    """Whether data of schema old can be read under new: nothing dropped, retyped, renamed in case or made required; new
    fields are nullable."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        there = {f.name.lower(): f for f in new.fields}
        known = {f.name.lower() for f in old.fields}
        for f in old.fields:
            g = there.get(f.name.lower())
            if g is None or g.name != f.name or f.nullable and not g.nullable or not write_compatible(f.dataType, g.dataType):
                return False
        return all(f.nullable for f in new.fields if f.name.lower() not in known)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return (not old.containsNull or new.containsNull) and write_compatible(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return (not old.valueContainsNull or new.valueContainsNull) and write_compatible(old.keyType, new.keyType) and write_compatible(old.valueType, new.valueType)
    return old == new


def check_write_compatible(old: T.StructType, new: T.StructType) -> None:
    if not write_compatible(old, new):
        raise SchemaChanged(f"the new schema doesn't fit the table's data.\nTable: {old.simpleString()}\nNew: {new.simpleString()}")


def check_external(table: T.StructType, declared: T.StructType) -> None:
    """Names without case, order and types must agree; nullability doesn't matter. The error lists all differences."""

    def plain(kind: T.DataType) -> str:
        return kind.simpleString().lower()

    said = []
    a, b = [(f.name.lower(), plain(f.dataType)) for f in table.fields], [(f.name.lower(), plain(f.dataType)) for f in declared.fields]
    if a != b:
        names, other = dict(a), dict(b)
        said += [f"column {n} is missing" for n in names if n not in other]
        said += [f"column {n} is not in the table" for n in other if n not in names]
        said += [f"column {n} is {other[n]}, in the table {names[n]}" for n in names if n in other and names[n] != other[n]]
        if not said:
            said.append(f"columns are ordered {[n for n, _ in b]}, in the table {[n for n, _ in a]}")
        raise SchemaError("the declared schema differs from the table's: " + "; ".join(said))
