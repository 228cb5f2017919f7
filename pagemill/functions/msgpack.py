"""MessagePack records as typed columns, and back.

A decoder reads a whole batch of Arrow binary values and fits each record to a Spark schema: nested arrays, maps and structs, binary
values, timestamps (extension type -1) and other extensions, as struct<code, data>. What is broken or does not fit the schema is no failure of the job:
the row keeps a null record and says why, so that it can go to the dead letters.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Fixed values of the format: numbers by their first byte, and how many bytes give the length of what else has one.
NUMBERS = {0xCA: ">f", 0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}
LENGTHS = {0xC4: ("bin", 1), 0xC5: ("bin", 2), 0xC6: ("bin", 4), 0xC7: ("ext", 1), 0xC8: ("ext", 2), 0xC9: ("ext", 4), 0xD9: ("str", 1), 0xDA: ("str", 2), 0xDB: ("str", 4), 0xDC: ("array", 2), 0xDD: ("array", 4), 0xDE: ("map", 2), 0xDF: ("map", 4)}
FIXED_EXT = {0xD4: 1, 0xD5: 2, 0xD6: 4, 0xD7: 8, 0xD8: 16}
SINGLE = {0xC0: None, 0xC2: False, 0xC3: True}
TIMESTAMP = -1
#: The deepest nesting that is read.
DEEPEST = 64
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


class Ext(tuple):
    """An extension value (code, data)."""


class Reader:
    """One record; raises ValueError where it is broken."""

    def __init__(self, data: memoryview):
        self.data, self.at = data, 0

    def take(self, n: int) -> memoryview:
        end = self.at + n
        if end > len(self.data):
            raise ValueError("ends early")
        out = self.data[self.at : end]
        self.at = end
        return out

    def value(self, depth: int = 0):
        if depth > DEEPEST:
            raise ValueError("nested too deeply")
        first = self.take(1)[0]
        if first < 0x80 or first >= 0xE0:
            return first if first < 0x80 else first - 256
        if first in NUMBERS:
            form = NUMBERS[first]
            return struct.unpack(form, self.take(struct.calcsize(form)))[0]
        if first in SINGLE:
            return SINGLE[first]
        if first in FIXED_EXT:
            return self.extension(FIXED_EXT[first])
        if first in LENGTHS:
            kind, size = LENGTHS[first]
            n = int.from_bytes(self.take(size), "big")
        elif first < 0xC0:
            kind, n = ("map", first & 15) if first < 0x90 else ("array", first & 15) if first < 0xA0 else ("str", first & 31)
        else:
            raise ValueError("an unused first byte")
        match kind:
            case "str":
                return str(self.take(n), "utf-8")
            case "bin":
                return bytes(self.take(n))
            case "ext":
                return self.extension(n)
            case "array":
                return [self.value(depth + 1) for _ in range(self.bounded(n))]
        return [(self.value(depth + 1), self.value(depth + 1)) for _ in range(self.bounded(2 * n) // 2)]

    def bounded(self, n: int) -> int:
        """Every value takes a byte at least: a longer list than that is broken."""
        if n > len(self.data) - self.at:
            raise ValueError("ends early")
        return n

    def extension(self, n: int):
        code = struct.unpack(">b", self.take(1))[0]
        data = bytes(self.take(n))
        if code != TIMESTAMP:
            return Ext((code, data))
        if n == 4:
            nanos, seconds = 0, int.from_bytes(data, "big")
        elif n == 8:
            nanos, seconds = divmod(int.from_bytes(data, "big"), 1 << 34)
        elif n == 12:
            nanos, seconds = struct.unpack(">Iq", data)
        else:
            raise ValueError("a timestamp of another length")
        return EPOCH + timedelta(seconds=seconds, microseconds=nanos // 1000)


_INTEGERS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_PLAIN = {T.StringType: str, T.BinaryType: bytes, T.BooleanType: bool, T.TimestampType: datetime}


def fitter(kind: T.DataType) -> Callable:
    """A function that takes a value to a type's, or raises ValueError. Null fits all; a struct is a map whose unknown keys are dropped."""
    if type(kind) in _INTEGERS:
        limit = 1 << (_INTEGERS[type(kind)] - 1)

        def fit(v):
            if not isinstance(v, int) or isinstance(v, bool) or not -limit <= v < limit:
                raise ValueError(f"no {kind.simpleString()}")
            return v

    elif isinstance(kind, (T.DoubleType, T.FloatType)):

        def fit(v):
            if not isinstance(v, (int, float)) or isinstance(v, bool):
                raise ValueError(f"no {kind.simpleString()}")
            return float(v)

    elif isinstance(kind, T.ArrayType):
        each = fitter(kind.elementType)

        def fit(v):
            if not isinstance(v, list) or any(isinstance(x, tuple) and not isinstance(x, Ext) for x in v):
                raise ValueError("no array")
            return [each(x) for x in v]

    elif isinstance(kind, T.MapType):
        key, each = fitter(kind.keyType), fitter(kind.valueType)

        def fit(v):
            out = [(key(k), each(x)) for k, x in pairs(v)]
            if any(k is None for k, _ in out):
                raise ValueError("a null key")
            return list({k: (k, x) for k, x in out}.values())

    elif isinstance(kind, T.StructType) and kind.names == ["code", "data"]:

        def fit(v):
            if not isinstance(v, Ext):
                raise ValueError("no extension")
            return {"code": v[0], "data": v[1]}

    elif isinstance(kind, T.StructType):
        fields = {f.name: fitter(f.dataType) for f in kind}

        def fit(v):
            given = {k: x for k, x in pairs(v) if isinstance(k, str)}
            return {name: own(given.get(name)) for name, own in fields.items()}

    else:

        def fit(v):
            if not isinstance(v, _PLAIN[type(kind)]):
                raise ValueError(f"no {kind.simpleString()}")
            return v

    return lambda v: None if v is None else fit(v)


def pairs(v) -> list[tuple]:
    if not isinstance(v, list) or not all(isinstance(x, tuple) and not isinstance(x, Ext) for x in v):
        raise ValueError("no map")
    return v


def _windows(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``n`` bytes from each place on; ``data`` has as many more at its end."""
    return np.lib.stride_tricks.sliding_window_view(data, n)[at]


def _big(data: np.ndarray, at: np.ndarray, form: str) -> np.ndarray:
    """Big-endian numbers from each place on."""
    return np.ascontiguousarray(_windows(data, at, np.dtype(form).itemsize)).view(form)[:, 0]


def _binary(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> pa.Array:
    """The stretches of bytes as values."""
    ends = np.concatenate(([0], np.cumsum(size)))
    places = np.arange(ends[-1]) + np.repeat(at - ends[:-1], size)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[places])])


#: Longest start of a value that is read at once, and the seconds of the first and the last year.
_AHEAD, _YEARS = 16, (-62135596800, 253402300799)


def _column(data: np.ndarray, at: np.ndarray, ok: np.ndarray, kind: T.DataType) -> tuple[np.ndarray, pa.Array]:
    """Values of a plain type that begin at ``at``, as a column, and where they end; ``ok`` becomes false where another form than the usual stands."""
    first = data[at]
    null, size = first == 0xC0, np.ones(len(at), np.int64)
    if isinstance(kind, T.StringType):
        short, byte = (first & 0xE0) == 0xA0, first == 0xD9
        two = first == 0xDA
        head = np.select([byte, two], [2, 3], 1)
        length = np.select([short, byte, two], [first & 31, data[at + 1], _big(data, at + 1, ">u2")], 0).astype(np.int64)
        good = (null | short | byte | two) & (at + head + length <= len(data))
        values = _binary(data, at + head, np.where(ok & good, length, 0)).cast(pa.string())
        size = head + length
    elif isinstance(kind, T.BooleanType):
        values, good = pa.array(first == 0xC3), null | (first == 0xC2) | (first == 0xC3)
    elif isinstance(kind, T.DoubleType):
        wide = first == 0xCB
        values, good, size = pa.array(_big(data, at + 1, ">f8").astype(float)), null | wide, np.where(wide, 9, 1)
    elif isinstance(kind, T.TimestampType):
        wide = (_windows(data, at, 3) == np.frombuffer(b"\xc7\x0c\xff", np.uint8)).all(axis=1)
        seconds = _big(data, at + 7, ">i8").astype(np.int64)
        good, size = null | (wide & (seconds > _YEARS[0]) & (seconds < _YEARS[1] - 9)), np.where(wide, 15, 1)
        values = pa.array(np.where(good & wide, seconds, 0) * 1_000_000 + _big(data, at + 3, ">u4") // 1000).cast(pa.timestamp("us", "UTC"))
    else:
        wide, small = first == 0xD3, (first < 0x80) | (first >= 0xE0)
        limit = 1 << (_INTEGERS[type(kind)] - 1)
        numbers = np.where(wide, _big(data, at + 1, ">i8").astype(np.int64), first.view(np.int8))
        inside = (numbers >= -limit) & (numbers <= limit - 1)
        good, size = null | ((wide | small) & inside), np.where(wide, 9, 1)
        values = pa.array(np.where(inside, numbers, 0).astype(f"i{_INTEGERS[type(kind)] // 8}"))
    ok &= good
    return np.where(ok, at + size, at), pc.if_else(pa.array(null), pa.scalar(None, values.type), values)


_GUESSED = {str: T.StringType(), bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), datetime: T.TimestampType(), type(None): T.StringType()}


def _alike(column: pa.Array, kind: T.StructType, arrow: pa.DataType) -> tuple[np.ndarray, pa.Array] | None:
    """Which records are laid out like the column's first one, in the usual forms of plain types, and these as structs; None if the first tells no layout.

    A column is read at a time. What this does not read, in whole or in single records, is left to ``Reader``.
    """
    plain = (*_INTEGERS, T.StringType, T.BooleanType, T.DoubleType, T.TimestampType)
    if column.type != pa.binary() or not len(column) or not column[0].is_valid or not all(type(f.dataType) in plain for f in kind):
        return None
    try:
        layout = Reader(memoryview(column[0].as_buffer()).cast("B")).value()
    except (ValueError, OverflowError):
        return None
    if not isinstance(layout, list) or not layout or not all(isinstance(x, tuple) and not isinstance(x, Ext) for x in layout):
        return None
    names = [k for k, _ in layout]
    types = {f.name: f.dataType for f in kind}
    for k, v in layout:
        if not isinstance(k, str) or type(v) not in _GUESSED:
            return None
        types.setdefault(k, _GUESSED[type(v)])
    if len(set(names)) < len(names):
        return None
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.concatenate((np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], np.zeros(_AHEAD + 256, np.uint8)))
    at, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    ok, found = np.asarray(column.is_valid()).copy(), {}
    head = _head(len(names), (0x80, 16), (None, 0xDE, 0xDF))
    for start, name in [(head, None), *((packed(k), k) for k in names)]:
        if len(start) > 256:
            return None
        ok &= (_windows(data, at, len(start)) == np.frombuffer(start, np.uint8)).all(axis=1)
        at = np.where(ok, at + len(start), at)
        if name is not None:
            try:
                at, found[name] = _column(data, at, ok, types[name])
            except pa.ArrowInvalid:  # text that is none
                return None
        ok &= at <= ends
        at = np.minimum(at, ends)
    ok &= at == ends
    children = [found[f.name].cast(f.type) if f.name in found else pa.nulls(len(column), f.type) for f in arrow]
    return ok, pa.StructArray.from_arrays(children, fields=list(arrow))


def decode(messages: DataFrame, column: str, schema: str | T.StructType, record: str = "record", error: str = "error") -> DataFrame:
    """``messages`` with the struct ``record`` and ``error``: null, or why the record of ``column`` can't be read, with a null record.

    A null value is an error too. Bytes after a record are an error. An empty array fits an empty map and the other way round.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = T.StructType([*messages.schema.fields, T.StructField(record, kind), T.StructField(error, T.StringType())])
    place, fit, arrow = messages.columns.index(column), fitter(kind), to_arrow_type(kind, timestamp_utc=True)

    def one(value: pa.Scalar) -> tuple:
        data = value.as_buffer()
        try:
            if data is None:
                raise ValueError("nothing")
            reader = Reader(memoryview(data).cast("B"))
            found = fit(reader.value())
            if found is None or reader.at < len(reader.data):
                raise ValueError("no record" if found is None else "more than a record")
            return found, None
        except (ValueError, OverflowError) as e:
            return None, str(e)

    def read(batches):
        for batch in batches:
            values = batch.column(place)
            ok, records = _alike(values, kind, arrow) or (np.zeros(len(values), bool), pa.nulls(0, arrow))
            other = np.flatnonzero(~ok)
            told = [one(values[int(i)]) for i in other]
            errors = np.full(len(values), None, object)
            errors[other] = [e for _, e in told]
            if len(other):
                from_all = np.arange(len(values))
                from_all[other] = len(records) + np.arange(len(other))
                records = pa.concat_arrays([records, pa.array([r for r, _ in told], arrow)]).take(pa.array(from_all))
            yield pa.RecordBatch.from_arrays([*batch.columns, records, pa.array(errors, pa.string())], out.names)

    return messages.mapInArrow(read, out)


def _head(n: int, short: tuple[int, int] | None, codes: tuple[int | None, int, int]) -> bytes:
    if short and n < short[1]:
        return bytes([short[0] | n])
    for code, size in zip(codes, (1, 2, 4), strict=True):
        if code is not None and n < 1 << (8 * size):
            return bytes([code]) + n.to_bytes(size, "big")
    raise ValueError("too long")


def packed(v) -> bytes:
    """A value as MessagePack; dictionaries and lists of pairs are maps."""
    if v is None or isinstance(v, bool):
        return {None: b"\xc0", False: b"\xc2", True: b"\xc3"}[v]
    if isinstance(v, int):
        return struct.pack("b", v) if -32 <= v < 128 else b"\xd3" + v.to_bytes(8, "big", signed=True)
    if isinstance(v, float):
        return b"\xcb" + struct.pack(">d", v)
    if isinstance(v, str):
        data = v.encode()
        return _head(len(data), (0xA0, 32), (0xD9, 0xDA, 0xDB)) + data
    if isinstance(v, (bytes, bytearray)):
        return _head(len(v), None, (0xC4, 0xC5, 0xC6)) + v
    if isinstance(v, datetime):
        whole = (v if v.tzinfo else v.replace(tzinfo=UTC)) - EPOCH
        return b"\xc7\x0c\xff" + struct.pack(">Iq", whole.microseconds * 1000, whole.days * 86400 + whole.seconds)
    if isinstance(v, dict) or (isinstance(v, list) and v and all(isinstance(x, tuple) for x in v)):
        items = list(v.items()) if isinstance(v, dict) else v
        return _head(len(items), (0x80, 16), (None, 0xDE, 0xDF)) + b"".join(packed(x) for pair in items for x in pair)
    return _head(len(v), (0x90, 16), (None, 0xDC, 0xDD)) + b"".join(map(packed, v))


def _lengths(lengths: pa.Array, short: tuple[int, int] | None, codes: tuple[int | None, int, int]) -> pa.Array:
    """The starts of values of these lengths."""
    known, which = np.unique(np.asarray(lengths.fill_null(0)), return_inverse=True)
    return pa.array([_head(int(n), short, codes) for n in known], pa.binary()).take(pa.array(which))


def _rows(wide: np.ndarray, size: np.ndarray) -> pa.Array:
    """The first ``size`` bytes of each row of bytes."""
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(wide[np.arange(wide.shape[1]) < size[:, None]])])


def packed_column(c: pa.Array) -> pa.Array:
    """``packed`` of each value: plain types as a column, others one by one."""
    n, t = len(c), c.type
    if pa.types.is_signed_integer(t):
        v = np.asarray(c.cast(pa.int64()).fill_null(0))
        small = (v >= -32) & (v < 128)
        wide = np.full((n, 9), 0xD3, np.uint8)
        wide[:, 1:] = v.astype(">i8").view(np.uint8).reshape(n, 8)
        wide[small, 0] = v[small] & 0xFF
        out = _rows(wide, np.where(small, 1, 9))
    elif pa.types.is_float64(t):
        wide = np.full((n, 9), 0xCB, np.uint8)
        wide[:, 1:] = np.asarray(c.fill_null(0.0)).astype(">f8").view(np.uint8).reshape(n, 8)
        out = _rows(wide, np.full(n, 9))
    elif pa.types.is_boolean(t):
        out = pc.if_else(c, pa.scalar(b"\xc3"), pa.scalar(b"\xc2"))
    elif pa.types.is_timestamp(t) and t.unit == "us":
        v = np.asarray(c.cast(pa.int64()).fill_null(0))
        wide = np.tile(np.frombuffer(b"\xc7\x0c\xff" + bytes(12), np.uint8), (n, 1))
        wide[:, 3:7] = (v % 1_000_000 * 1000).astype(">u4").view(np.uint8).reshape(n, 4)
        wide[:, 7:] = (v // 1_000_000).astype(">i8").view(np.uint8).reshape(n, 8)
        out = _rows(wide, np.full(n, 15))
    elif t == pa.string():
        data = c.cast(pa.binary())
        out = pc.binary_join_element_wise(_lengths(pc.binary_length(data), (0xA0, 32), (0xD9, 0xDA, 0xDB)), data, b"")
    elif t == pa.binary():
        out = pc.binary_join_element_wise(_lengths(pc.binary_length(c), None, (0xC4, 0xC5, 0xC6)), c, b"")
    else:
        return pa.array([packed(v) for v in c.to_pylist()], pa.binary())
    return pc.if_else(c.is_valid(), out, pa.scalar(b"\xc0")) if c.null_count else out


def encode(rows: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as records of all their columns, in the binary column ``value`` after the columns to ``keep``."""
    out = T.StructType([*(rows.schema[k] for k in keep), T.StructField(value, T.BinaryType())])

    def write(batches):
        for batch in batches:
            held = [batch.column(k) for k in keep]
            starts = [packed(k) for k in batch.schema.names]
            starts[0] = _head(len(starts), (0x80, 16), (None, 0xDE, 0xDF)) + starts[0]
            parts = [x for start, c in zip(starts, batch.columns, strict=True) for x in (pa.scalar(start), packed_column(c))]
            yield pa.RecordBatch.from_arrays([*held, pc.binary_join_element_wise(*parts, b"")], out.names)

    return rows.mapInArrow(write, out)


def split(messages: DataFrame, record: str = "record", error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Records as columns, and the messages that can't be read."""
    return messages.where(F.col(error).isNull()).select(f"{record}.*"), messages.where(F.col(error).isNotNull()).drop(record)
