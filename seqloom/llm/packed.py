"""Sorted hashes in packed rows, cut by ranges of the hash, for exchanges between blocks and shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit integers, byte planes apart, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def shard_bits(keys: int, shard_keys: int) -> int:
    """Bits of the hash that tell the shards apart, for about `shard_keys` keys in each."""
    return max(3, int(np.ceil(np.log2(max(1, keys / shard_keys)))))


def shard_slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, first, end) for every shard that sorted keys fall in."""
    found, first = np.unique(keys >> np.uint64(64 - bits), return_index=True)
    for shard, a, b in zip(found, first, [*first[1:], len(keys)], strict=True):
        yield int(shard), int(a), int(b)


def as_table(rows: list[dict], schema: StructType) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))
