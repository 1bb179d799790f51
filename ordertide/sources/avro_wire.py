"""Avro binary records as Spark columns, for clusters without the Avro connector.

Each record is flat, so a whole Arrow batch is read field by field: one vector of
byte positions moves through all payloads together. Used only when the Spark Avro
module is missing; otherwise ``from_avro`` and ``to_avro`` do the work in the JVM.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro

from ordertide.schemas import avro_schema, record_struct, record_symbols


def has_connector(spark):
    """Whether the Spark Avro module is on the class path."""
    try:
        spark.range(1).select(from_avro(F.lit(b""), '"string"')).schema
        return True
    except (PySparkException, TypeError):
        return False


class _Cursor:
    """Positions in a batch of payloads; ``ok`` turns false where a payload is malformed."""

    def __init__(self, payloads):
        payloads = payloads.cast(pa.large_binary())
        offsets = np.frombuffer(payloads.buffers()[1], np.int64)
        offsets = offsets[payloads.offset : payloads.offset + len(payloads) + 1]
        data = payloads.buffers()[2]
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        self.pos = offsets[:-1].copy()
        self.end = offsets[1:]
        self.ok = payloads.is_valid().to_numpy(zero_copy_only=False).copy()

    def varint(self, rows):
        """Zig-zag number of the given rows; 0 elsewhere."""
        value = np.zeros(len(self.pos), np.uint64)
        open_ = rows & self.ok
        for shift in range(0, 70, 7):
            self.ok &= ~(open_ & (self.pos >= self.end))
            open_ &= self.ok
            if not open_.any():
                break
            at = np.flatnonzero(open_)
            byte = self.data[self.pos[at]].astype(np.uint64)
            value[at] |= (byte & np.uint64(0x7F)) << np.uint64(min(shift, 63))
            self.pos[at] += 1
            open_[at] = byte >= 0x80
        self.ok &= ~open_
        return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)

    def boolean(self, rows):
        self.ok &= ~(rows & (self.pos >= self.end))
        rows = rows & self.ok
        value = np.zeros(len(self.pos), np.uint8)
        value[rows] = self.data[self.pos[rows]]
        self.pos[rows] += 1
        self.ok &= value <= 1
        return value == 1

    def text(self, rows):
        """Start and length of a string in each of the given rows."""
        length = self.varint(rows)
        self.ok &= ~rows | ((length >= 0) & (length <= self.end - self.pos))
        length = np.where(rows & self.ok, length, 0)
        start = self.pos.copy()
        self.pos += length
        return start, length


def _gather(data, start, length):
    """Byte ranges of ``data`` as one Arrow binary array."""
    ends = np.cumsum(length)
    index = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    body = np.ascontiguousarray(data[index])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())]
    )


def _utf8(raw, ok):
    """Binary to text; rows that are not UTF-8 are marked as malformed."""
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        texts = []
        for i, item in enumerate(raw.to_pylist()):
            try:
                texts.append(item.decode("utf-8"))
            except UnicodeDecodeError:
                ok[i] = False
                texts.append("")
        return pa.array(texts, pa.string())


def _masked(array, missing):
    return pc.if_else(pa.array(missing), pa.scalar(None, array.type), array)


def decode_batch(payloads, record):
    """Arrow binary array to an Arrow struct array; malformed payloads give null."""
    names = [name for name, _ in record]
    if len(payloads) and payloads.null_count == len(payloads):  # a batch of JSON alone
        kinds = decode_batch(payloads.slice(0, 0), record).type
        return pa.StructArray.from_arrays([pa.nulls(len(payloads), kind.type) for kind in kinds], names=names)
    cursor = _Cursor(payloads)
    everything = np.ones(len(payloads), bool)
    arrays = []
    for _, kind in record:
        rows = everything
        if kind.endswith("?"):
            branch = cursor.varint(everything)
            cursor.ok &= (branch == 0) | (branch == 1)
            rows = branch == 1
        base = kind.rstrip("?")
        if base == "string":
            start, length = cursor.text(rows)
            array = _utf8(_gather(cursor.data, start, length), cursor.ok)
        elif base == "boolean":
            array = pa.array(cursor.boolean(rows))
        elif base == "enum":
            symbols = record_symbols(record)
            index = cursor.varint(rows)
            cursor.ok &= (index >= 0) & (index < len(symbols))
            array = pa.array(symbols).take(pa.array(np.where(cursor.ok, index, 0)))
        else:
            number = cursor.varint(rows)
            if base == "int":
                cursor.ok &= (number >= -(2**31)) & (number < 2**31)
                number = np.where(cursor.ok, number, 0)
            array = pa.array(number, pa.int32() if base == "int" else pa.int64())
        arrays.append(_masked(array, ~rows) if kind.endswith("?") else array)
    cursor.ok &= cursor.pos == cursor.end
    return pa.StructArray.from_arrays([_masked(a, ~cursor.ok) for a in arrays], names=names)


def _varint_bytes(numbers):
    """Zig-zag varint of each number as an Arrow binary array."""
    numbers = np.asarray(numbers, np.int64)
    zigzag = ((numbers << 1) ^ (numbers >> 63)).view(np.uint64)
    cells = np.zeros((len(numbers), 10), np.uint8)
    used = np.ones(len(numbers), np.int64)
    rest = zigzag.copy()
    for i in range(10):
        more = (rest >> np.uint64(7)) > 0
        cells[:, i] = (rest & np.uint64(0x7F)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        rest >>= np.uint64(7)
        used += more
    flat = cells.reshape(-1)
    return _gather(flat, np.arange(len(numbers), dtype=np.int64) * 10, used)


def _encode_values(array, kind, record):
    base = kind.rstrip("?")
    if base == "enum":
        return _varint_bytes(pc.index_in(array, pa.array(record_symbols(record))).to_numpy(zero_copy_only=False))
    if base == "string":
        body = array.cast(pa.large_string()).cast(pa.large_binary())
        sizes = pc.binary_length(body).to_numpy(zero_copy_only=False)
        return pc.binary_join_element_wise(_varint_bytes(sizes), body, pa.scalar(b"", pa.large_binary()))
    if base == "boolean":
        flags = array.to_numpy(zero_copy_only=False).astype(np.uint8)
        return _gather(flags, np.arange(len(flags), dtype=np.int64), np.ones(len(flags), np.int64))
    return _varint_bytes(array.to_numpy(zero_copy_only=False))


_BLANK = {"string": "", "boolean": False, "int": 0, "long": 0}


def encode_batch(rows, record):
    """Arrow struct array to Arrow binary payloads."""
    pieces = []
    for name, kind in record:
        array = rows.field(name)
        base = kind.rstrip("?")
        blank = record_symbols(record)[0] if base == "enum" else _BLANK[base]
        value = _encode_values(array.fill_null(blank), kind, record)
        if kind.endswith("?"):
            present = array.is_valid().to_numpy(zero_copy_only=False)
            branch = _varint_bytes(present.astype(np.int64))
            value = pc.if_else(pa.array(present), value, pa.scalar(b"", pa.large_binary()))
            pieces.append(branch)
        pieces.append(value)
    return pc.binary_join_element_wise(*pieces, pa.scalar(b"", pa.large_binary())).cast(pa.binary())


def decode_avro(spark, value, record):
    """Column of binary payloads to a struct column, null where a payload is malformed."""
    if has_connector(spark):
        return from_avro(value, avro_schema(record), {"mode": "PERMISSIVE"})

    @F.arrow_udf(record_struct(record))
    def decode(payloads: pa.Array) -> pa.Array:
        return decode_batch(payloads, record)

    return decode(value)


def encode_avro(spark, row, record):
    """Struct column in record layout to a column of binary payloads."""
    if has_connector(spark):
        return to_avro(row, avro_schema(record))

    @F.arrow_udf("binary")
    def encode(rows: pa.Array) -> pa.Array:
        return encode_batch(rows, record)

    return encode(row)
