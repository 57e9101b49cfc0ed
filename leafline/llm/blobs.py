"""Arrays and rows as compressed bytes, so few and small rows are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from leafline.llm.storage import trim


def pack(*arrays: np.ndarray) -> bytes:
    raw = b"".join([np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, "<i8", len(types), 8)
    starts = 8 + 8 * len(types) + np.r_[0, np.cumsum(sizes)[:-1]]
    return [np.frombuffer(raw, t, int(n) // np.dtype(t).itemsize, int(s)) for t, n, s in zip(types, sizes, starts)]


def planes(numbers: np.ndarray) -> np.ndarray:
    """64-bit numbers byte by byte, all lowest bytes first: upper bytes that are all nought take no room when packed."""
    return np.ascontiguousarray(numbers.astype("<u8").view("u1").reshape(-1, 8).T).ravel()


def from_planes(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(8, -1).T).view("<u8").ravel()


def bundles(rows: DataFrame, most_rows: int) -> DataFrame:
    """(chunk, data): the rows of a chunk that lie together, at most `most_rows`, as one compressed table, which is what is shuffled."""

    def flush(chunk: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as out:
            out.write_table(table)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            batch = batch.drop_columns(["chunk"])
            edges = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(chunks) else np.zeros(0, np.int64)
            for i, j in zip(edges, np.r_[edges[1:], len(chunks)]):
                if parts and (chunks[i] != held or sum(p.num_rows for p in parts) >= most_rows):
                    yield flush(held, parts)
                    parts = []
                held = int(chunks[i])
                parts.append(batch.slice(i, j - i))
        if parts:
            yield flush(held, parts)
        trim()

    return rows.mapInArrow(run, "chunk bigint, data binary")


def unbundled(table: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in table.column("data").to_pylist()])
