"""Avro records framed for a schema registry: a zero byte, the schema's id in four bytes, the record.

Frames are split by column functions. Records are read in tasks by the schema their
frame names and resolved to the caller's one schema: fields by name or alias, missing ones
by their default, numbers widened, unknown fields skipped. Spark's own Avro reader knows one
writer's schema a query and isn't among the packages that come with PySpark.

What can't be read (no frame, an id without a schema, a broken record) stays as a row of
nulls whose ``problem`` says why; nothing is dropped, and a null message is one of these.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Reader = Callable[[bytes, int], tuple]
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_NUMBERS = ("int", "long", "float", "double")
_PRIMITIVE = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType()}
_LOGICAL = {"timestamp-millis": T.TimestampType(), "timestamp-micros": T.TimestampType(), "date": T.DateType()}


def split_frames(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages with ``schema_id`` and ``payload``, both null where there is no frame."""
    framed = (F.length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    return messages.withColumns({"schema_id": F.when(framed, number), "payload": F.when(framed, F.substring(F.col(value), F.lit(6), F.length(value)))})


def _named(schema, names: dict):
    """A schema without references: named types are put in place of their names."""
    if isinstance(schema, str):
        return names.get(schema, schema)
    if isinstance(schema, list):
        return [_named(s, names) for s in schema]
    kind = schema["type"]
    if kind in ("record", "enum", "fixed"):
        out = dict(schema)
        names[schema["name"]] = out
        if "namespace" in schema:
            names[f"{schema['namespace']}.{schema['name']}"] = out
        if kind == "record":
            out["fields"] = [{**f, "type": _named(f["type"], names)} for f in schema["fields"]]
        return out
    if kind == "array":
        return {**schema, "items": _named(schema["items"], names)}
    if kind == "map":
        return {**schema, "values": _named(schema["values"], names)}
    return _named(kind, names) if isinstance(kind, (dict, list)) else schema


def parse(text: str):
    return _named(json.loads(text), {})


def _kind(schema) -> str:
    return schema if isinstance(schema, str) else "union" if isinstance(schema, list) else schema["type"]


def spark_type(schema) -> T.DataType:
    """The Spark type of a parsed schema; a union may only add null."""
    kind = _kind(schema)
    if kind == "union":
        other = [s for s in schema if _kind(s) != "null"]
        if len(other) != 1:
            raise ValueError("only unions of null and one type have a column type")
        return spark_type(other[0])
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"])) for f in schema["fields"]])
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"]))
    if kind == "enum":
        return T.StringType()
    if kind == "fixed":
        return T.BinaryType()
    return _LOGICAL.get(schema.get("logicalType") if isinstance(schema, dict) else None, _PRIMITIVE[kind])


def read_long(data: bytes, at: int) -> tuple[int, int]:
    """A variable-length zigzag number and the place after it."""
    out = shift = 0
    while True:
        byte = data[at]
        at += 1
        out |= (byte & 127) << shift
        if byte < 128:
            return (out >> 1) ^ -(out & 1), at
        shift += 7


def _bytes(data: bytes, at: int) -> tuple[bytes, int]:
    n, at = read_long(data, at)
    if n < 0 or at + n > len(data):
        raise ValueError("a length beyond the record's end")
    return data[at : at + n], at + n


def _text(data: bytes, at: int) -> tuple[str, int]:
    raw, at = _bytes(data, at)
    return raw.decode(), at


def _logical(schema, read: Reader) -> Reader:
    unit = {"timestamp-millis": "milliseconds", "timestamp-micros": "microseconds"}.get(schema.get("logicalType") if isinstance(schema, dict) else None)
    if unit:
        return lambda d, at: ((lambda v, p: (_EPOCH + timedelta(**{unit: v}), p))(*read(d, at)))
    if isinstance(schema, dict) and schema.get("logicalType") == "date":
        return lambda d, at: ((lambda v, p: (date(1970, 1, 1) + timedelta(days=v), p))(*read(d, at)))
    return read


def _blocks(item: Reader, put: Callable, new: Callable) -> Reader:
    def read(data: bytes, at: int) -> tuple:
        out = new()
        while True:
            n, at = read_long(data, at)
            if n == 0:
                return out, at
            if n < 0:
                _, at = read_long(data, at)
            for _ in range(abs(n)):
                at = put(out, data, at, item)

    return read


def _put_item(out: list, data: bytes, at: int, item: Reader) -> int:
    value, at = item(data, at)
    out.append(value)
    return at


def _put_entry(out: dict, data: bytes, at: int, item: Reader) -> int:
    key, at = _text(data, at)
    out[key], at = item(data, at)
    return at


def _matches(writer, reader) -> bool:
    a, b = _kind(writer), _kind(reader)
    return a == b or a in _NUMBERS and b in _NUMBERS and _NUMBERS.index(a) <= _NUMBERS.index(b) or {a, b} == {"string", "bytes"}


def resolver(writer, reader) -> Reader:
    """How a value of the writer's schema is read as one of the reader's."""
    kind = _kind(writer)
    if kind == "union":
        branches = [_resolve_or_none(w, reader) for w in writer]

        def union(data: bytes, at: int) -> tuple:
            k, at = read_long(data, at)
            if not 0 <= k < len(branches) or branches[k] is None:
                raise ValueError("a branch that the reader's schema doesn't have")
            return branches[k](data, at)

        return union
    if _kind(reader) == "union":
        fitting = [r for r in reader if _kind(r) == kind] or [r for r in reader if _matches(writer, r)]
        if not fitting:
            raise ValueError(f"{kind} is in no branch of the reader's union")
        return resolver(writer, fitting[0])
    if not _matches(writer, reader):
        raise ValueError(f"{kind} can't be read as {_kind(reader)}")
    if kind == "record":
        return _record(writer, reader)
    if kind == "array":
        return _blocks(resolver(writer["items"], reader["items"]), _put_item, list)
    if kind == "map":
        return _blocks(resolver(writer["values"], reader["values"]), _put_entry, dict)
    if kind == "enum":
        symbols = writer["symbols"]
        return lambda d, at: ((lambda k, p: (symbols[k], p))(*read_long(d, at)))
    if kind == "fixed":
        size = writer["size"]
        return lambda d, at: (d[at : at + size], at + size)
    if kind == "null":
        return lambda d, at: (None, at)
    if kind == "boolean":
        return lambda d, at: (d[at] != 0, at + 1)
    if kind in ("float", "double"):
        form, size = ("<f", 4) if kind == "float" else ("<d", 8)
        return lambda d, at: (struct.unpack_from(form, d, at)[0], at + size)
    if kind in ("bytes", "string"):
        return _text if _kind(reader) == "string" else _bytes
    widened = _kind(reader) in ("float", "double")
    return _logical(reader, (lambda d, at: ((lambda v, p: (float(v), p))(*read_long(d, at)))) if widened else read_long)


def _resolve_or_none(writer, reader) -> Reader | None:
    try:
        return resolver(writer, reader)
    except ValueError:
        return None


def _record(writer: dict, reader: dict) -> Reader:
    by_name = {n: f for f in reader["fields"] for n in (*f.get("aliases", ()), f["name"])}
    steps, given = [], set()
    for f in writer["fields"]:
        target = by_name.get(f["name"])
        given.add(target["name"] if target else None)
        steps.append((target["name"] if target else None, resolver(f["type"], target["type"] if target else f["type"])))
    missing = {}
    for f in reader["fields"]:
        if f["name"] not in given:
            if "default" not in f:
                raise ValueError(f"the writer has no {f['name']}, and it has no default")
            missing[f["name"]] = f["default"]
    order = [f["name"] for f in reader["fields"]]

    def read(data: bytes, at: int) -> tuple:
        out = dict(missing)
        for name, step in steps:
            value, at = step(data, at)
            if name is not None:
                out[name] = value
        return {n: out[n] for n in order}, at

    return read


def decode(messages: DataFrame, schemas: dict[int, str], reader: str, value: str = "value", keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Framed messages as columns of the reader's schema, with ``keep``, ``schema_id`` and ``problem``.

    ``schemas`` are the registry's, by id; they are sent to the tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = parse(reader)
    rows = split_frames(messages.select(*keep, value), value).select(*keep, "schema_id", "payload")
    record = spark_type(target)
    out = T.StructType([*(rows.schema[k] for k in keep), T.StructField("schema_id", T.LongType()), *record.fields, T.StructField("problem", T.StringType())])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Reader] = {}
        for batch in batches:
            records, problems = [], []
            for number, payload in zip(batch.column("schema_id").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                found, problem = None, None
                try:
                    if number is None:
                        raise ValueError("no frame")
                    if number not in known:
                        if number not in schemas:
                            raise ValueError(f"no schema {number}")
                        known[number] = resolver(parse(schemas[number]), target)
                    found, at = known[number](payload, 0)
                    if at != len(payload):
                        found, problem = None, "bytes after the record's end"
                except (ValueError, IndexError, OverflowError, struct.error) as e:
                    problem = str(e) or "a broken record"
                records.append(found or {})
                problems.append(problem)
            columns = [batch.column(k) for k in (*keep, "schema_id")]
            columns += [pa.array([r.get(f.name) for r in records], arrow.field(f.name).type) for f in record.fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(problems, pa.string())], names=out.names)

    return rows.mapInArrow(run, out)


def _long(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def write(schema, value) -> bytes:
    """A value's bytes under a parsed schema."""
    kind = _kind(schema)
    if kind == "union":
        k = next(i for i, s in enumerate(schema) if (_kind(s) == "null") == (value is None))
        return _long(k) + write(schema[k], value)
    if kind == "record":
        return b"".join(write(f["type"], value[f["name"]]) for f in schema["fields"])
    if kind == "array":
        return (_long(len(value)) + b"".join(write(schema["items"], v) for v in value) if value else b"") + b"\0"
    if kind == "map":
        return (_long(len(value)) + b"".join(write("string", k) + write(schema["values"], v) for k, v in value.items()) if value else b"") + b"\0"
    if kind == "enum":
        return _long(schema["symbols"].index(value))
    if kind == "null":
        return b""
    if kind == "boolean":
        return b"\1" if value else b"\0"
    if kind in ("float", "double"):
        return struct.pack("<f" if kind == "float" else "<d", value)
    if kind == "fixed":
        return bytes(value)
    if kind in ("bytes", "string"):
        raw = value.encode() if isinstance(value, str) else bytes(value)
        return _long(len(raw)) + raw
    logical = schema.get("logicalType") if isinstance(schema, dict) else None
    if isinstance(value, datetime):
        value = (value.replace(tzinfo=value.tzinfo or timezone.utc) - _EPOCH) // timedelta(**{"milliseconds" if logical == "timestamp-millis" else "microseconds": 1})
    elif isinstance(value, date):
        value = (value - date(1970, 1, 1)).days
    return _long(value)


def encode(rows: DataFrame, schema: str, schema_id: int, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as framed messages; columns are the schema's fields."""
    parsed = parse(schema)
    names = [f["name"] for f in parsed["fields"]]
    chosen = rows.select(*keep, *(n for n in names if n not in keep))
    head = b"\0" + struct.pack(">I", schema_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [head + write(parsed, r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(values, pa.binary())], names=[*keep, value])

    return chosen.mapInArrow(run, T.StructType([*(chosen.schema[k] for k in keep), T.StructField(value, T.BinaryType())]))
