"""Chunks: a table cut once into numbered, compressed slices, and packed exchanges between slices and keys.

The heavy operators need, for every row of a text, an answer that depends on equal keys anywhere in the corpus.  They
do it in three Spark steps that move packed numpy arrays instead of single rows:

1. ``pack`` writes the table as chunks (an Arrow slice of a few MB, compressed) to the shared folder.  The numbering
   is fixed by that write, so a task that is run again sees the same rows.
2. A map over chunks sends, per key bucket, one blob with the chunk's distinct keys (``deal``); a grouped map over
   buckets compares them.  A key that a third of all rows holds costs one entry per chunk, not one per row.
3. The answers go back to their chunk (``cogroup`` by chunk number).

The number of buckets follows the size of the input, so a bucket stays a few MB at every scale.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens as T
from strata.session import scratch_path, small_batches

CHUNK_BYTES = 4 << 20
ROW_BITS = 20                                   # row number = chunk << ROW_BITS | place in the chunk
SEND = "key long, chunk long, blob binary"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder named in spark.checkpoint.dir and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freeze(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def thaw(blob) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_next_batch()


def pack(df: DataFrame, text: str = "text", target: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, n_rows, n_bytes, blob): the rows of ``df``, every column, in slices of about ``target`` text bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq = TaskContext.get().partitionId() << 20, 0
        held, size = [], 0

        def out():
            nonlocal seq, held, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            row = pa.RecordBatch.from_arrays(
                [pa.array([base + seq], pa.int64()), pa.array([whole.num_rows], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([freeze(whole)], pa.binary())],
                names=["chunk", "n_rows", "n_bytes", "blob"])
            seq, held, size = seq + 1, [], 0
            return row

        for batch in batches:
            for part in T.slices(batch, text, target):
                n = int(T.buffers(part.column(text))[1][-1])
                if held and (size + n > target or sum(b.num_rows for b in held) + part.num_rows > 1 << 16):
                    yield out()
                held.append(part)
                size += n
        if held:
            yield out()
        give_back()

    small_batches(df.sparkSession)
    return write_table(df.mapInArrow(run, "chunk long, n_rows long, n_bytes long, blob binary"), "chunks")


def buckets_for(chunks: DataFrame, per_bucket: int = 16 << 20) -> int:
    """How many buckets keep each at about ``per_bucket`` bytes of text; at least the shuffle partitions."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // per_bucket), 1)


def give_back() -> None:
    """Return memory that the last chunk's arrays have left behind; workers live long and allocators keep what was freed."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):                 # glibc
        libc.malloc_trim(0)


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of any one-dimensional dtype as bytes, lightly compressed column by column.

    The bytes of numbers go by place (all first bytes, then all second ones): high bytes vary little.
    """
    parts, z = [], zstandard.ZstdCompressor(level=1)
    for a in arrays:
        raw = np.ascontiguousarray(a)
        if raw.itemsize > 1:
            raw = np.ascontiguousarray(raw.view(np.uint8).reshape(-1, raw.itemsize).T)
        raw = raw.tobytes()
        small = z.compress(raw) if len(raw) > 64 else raw
        small = raw if len(small) >= len(raw) else small
        head = f"{a.dtype.str},{len(raw)},{len(small)}".encode()
        parts += [len(head).to_bytes(2, "little"), head, small]
    return b"".join(parts)


def spread(blob) -> list[np.ndarray]:
    blob, out, i = memoryview(blob), [], 0
    z = zstandard.ZstdDecompressor()
    while i < len(blob):
        n = int.from_bytes(blob[i:i + 2], "little")
        dtype, raw, small = bytes(blob[i + 2:i + 2 + n]).decode().split(",")
        i += 2 + n
        body = blob[i:i + int(small)]
        flat, kind = np.frombuffer(body if raw == small else z.decompress(body), np.uint8), np.dtype(dtype)
        if kind.itemsize > 1:
            flat = np.ascontiguousarray(flat.reshape(kind.itemsize, -1).T)
        out.append(flat.reshape(-1).view(kind))
        i += int(small)
    return out


def send(key: list[int], chunk: list[int], blob: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(chunk, pa.int64()), pa.array(blob, pa.binary())],
        names=["key", "chunk", "blob"])


def deal(chunk: int, n: int, keys: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    """One row per bucket with the keys that fall in it, in their order, and the columns that go with them.

    The bucket is taken from the key's high bits, so a sorted ``keys`` is cut without another sort.
    """
    bucket = bucket_of(keys, n)
    if len(bucket) > 1 and (bucket[1:] < bucket[:-1]).any():
        order = np.argsort(bucket, kind="stable")
        bucket, keys, more = bucket[order], keys[order], [m[order] for m in more]
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    ends = np.r_[cut[1:], len(bucket)]
    return send([int(bucket[a]) for a in cut], [chunk] * len(cut),
                [squeeze(keys[a:b], *[m[a:b] for m in more]) for a, b in zip(cut, ends)])


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def over_chunks(chunks: DataFrame, fn: Callable[[int, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn(chunk number, rows)`` for every chunk."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                give_back()
                yield from fn(batch.column("chunk")[i].as_py(), thaw(batch.column("blob")[i].as_buffer()))
        give_back()                                  # the worker waits for its next task without them

    return chunks.select("chunk", "blob").mapInArrow(run, schema)


def back(chunks: DataFrame, answers: DataFrame, fn: Callable, schema) -> DataFrame:
    """``fn(chunk number, rows, [blobs sent to it])`` yields the record batches of a chunk's result."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        if left.num_rows == 0:
            return pa.Table.from_batches([], schema=target)
        chunk = left.column("chunk")[0].as_py()
        rows = thaw(left.column("blob")[0].as_buffer())
        got = [(right.column("key")[i].as_py(), right.column("blob")[i].as_buffer()) for i in range(right.num_rows)]
        out = list(fn(chunk, rows, got))
        del rows, got
        give_back()
        return pa.Table.from_batches(out, schema=out[0].schema) if out else pa.Table.from_batches([], schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    struct = schema if isinstance(schema, StructType) else chunks.sparkSession.createDataFrame([], schema).schema
    target = to_arrow_schema(struct)
    return (chunks.select("chunk", "blob").groupBy("chunk")
            .cogroup(answers.select("key", "chunk", "blob").groupBy("chunk")).applyInArrow(run, schema))


def by_key(sent: DataFrame, fn: Callable[[list[tuple[int, bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn(key, [(chunk, blob)])`` for every key (bucket) of ``sent``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(sent.sparkSession.createDataFrame([], schema).schema)

    def run(table: pa.Table) -> pa.Table:
        give_back()
        key = table.column("key")[0].as_py()
        got = [(table.column("chunk")[i].as_py(), table.column("blob")[i].as_buffer()) for i in range(table.num_rows)]
        out = list(fn(key, got))
        del got
        give_back()
        return pa.Table.from_batches(out, schema=target) if out else pa.Table.from_batches([], schema=target)

    return sent.groupBy("key").applyInArrow(run, schema)
