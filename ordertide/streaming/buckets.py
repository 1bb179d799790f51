"""Many keys of a state operator as one: a bucket of keys, whose states are packed into one value.

Each key of ``transformWithState`` costs several calls between Python and the state store in every batch that
has it. With buckets the calls are made once for each bucket. A bucket is read and written whole, so this is the form
for batches with many keys, such as replays; for a few keys at a time a state for each key moves less. The number
of buckets belongs to a checkpoint: with another one a key would be looked for in the wrong bucket.
"""

import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

#: Buckets of the registered queries.
BUCKETS = 1024
#: State of a bucket: packed rows, and the one timer that is set.
PACKED = "packed binary, wake_ms bigint"
_EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
# pandas holds times of these years only
_FIRST, _LAST = (datetime.datetime(year, 1, 1, tzinfo=datetime.timezone.utc) for year in (1678, 2262))


def bucket_of(key, buckets):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def within_pandas(time):
    """A time column that can carry the watermark into pandas: what lies outside its years counts as their ends."""
    low, high = (F.timestamp_micros(F.lit((t - _EPOCH) // datetime.timedelta(microseconds=1))) for t in (_FIRST, _LAST))
    return F.when(time < low, low).when(time > high, high).otherwise(time)


def framed(rows, names):
    """Rows as a frame whose whole numbers stay such beside nulls."""
    return pd.DataFrame(rows, columns=names, dtype=object)


def pack(frame, schema):
    """The rows of a frame as bytes."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.RecordBatch.from_pandas(frame, schema, preserve_index=False))
    return out.getvalue().to_pybytes()


def unpack(data):
    """The rows that were packed, as tuples."""
    frame = pa.ipc.open_stream(data).read_all().to_pandas(integer_object_nulls=True)
    return zip(*(frame[name].tolist() for name in frame.columns))


def states(session, checkpoint, variable, schema):
    """What the buckets of a checkpoint know of single keys, with one row for each key."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                yield from pa.ipc.open_stream(data.as_py())

    kept = session.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    return kept.select("value.packed").filter(F.col("packed").isNotNull()).mapInArrow(run, schema)


class Waker:
    """The one timer of a bucket, at the earliest time of any of its keys."""

    def __init__(self, handle):
        self.handle = handle

    def move(self, old_ms, us, fired=False):
        """Replace the timer of ``old_ms``, unless it has fired, by one for ``us``; None stands for no timer."""
        new_ms = None if us is None else -(-us // 1000)
        if new_ms != old_ms:
            if old_ms is not None and not fired:  # Spark removes a timer that has fired
                self.handle.deleteTimer(old_ms)
            if new_ms is not None:
                self.handle.registerTimer(new_ms)
        return new_ms
