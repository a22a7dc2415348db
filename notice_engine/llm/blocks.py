"""Documents in blocks, and keys that blocks ask a keyed side about.

Some operators need, for every word run of every document, a fact about the whole
corpus. A row for each would be shuffled twice. Here the different texts are dealt
into blocks of some ten megabytes; a block asks about its different keys, sorted and
packed, one blob for each key shard, and the answer is a blob in the same order. A
key that is in a third of all documents is asked about once by each block.

Texts are collapsed within each Arrow batch of a task before they are dealt, so a
text with many copies comes to its block once for each batch that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_engine.llm.lean import lean_batches
from notice_engine.llm.words import slices
from notice_engine.session import ship

#: Bytes of text in a block and behind a key shard. Both are small enough for a Python worker with some hundred MB.
BLOCK_BYTES, SHARD_BYTES = 12_000_000, 16_000_000
LEAST_BLOCKS = 24
#: Bytes of text that a worker sends at once.
AT_ONCE = 4_000_000
_U = np.uint64


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed."""
    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes() if len(values) else b"")


def unpack(blob: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31) if blob else b""
    planes = np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their differences."""
    return pack(np.diff(keys, prepend=_U(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, _U), dtype=_U)


def shard_starts(shards: int) -> np.ndarray:
    """The first key of each shard but the first: shard s has the s-th part of the range of keys."""
    return np.array([(s << 64) // shards for s in range(1, shards)], _U)


def shard_edges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted keys are cut into shards."""
    return np.concatenate([[0], np.searchsorted(keys, shard_starts(shards)), [len(keys)]]).astype(np.int64)


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Numbers of blocks and of key shards for these texts."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    least = max(LEAST_BLOCKS, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    return max(least, -(-total // BLOCK_BYTES)), max(least, -(-total // SHARD_BYTES))


def digest_column(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def blocked(docs: DataFrame, values: dict[str, Column], merge: Callable[[list, list], list], blocks: int) -> DataFrame:
    """block, digest, text (binary, null as empty) and one long for each of ``values``, merged over the equal texts of each batch; dealt by block."""
    ship(docs.sparkSession)
    names = list(values)

    @lean_batches
    def run(batches):
        for batch in batches:
            kept: dict[bytes, tuple[int, list]] = {}
            texts = batch.column(0)
            for k, (raw, *got) in enumerate(zip(texts, *[c.to_pylist() for c in batch.columns[1:]], strict=True)):
                d = hashlib.md5(raw.as_py() or b"").digest()
                kept[d] = (kept[d][0], merge(kept[d][1], got)) if d in kept else (k, got)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([int.from_bytes(d[:6], "big") % blocks for d in kept], pa.int32()),
                    pa.array(list(kept), pa.binary()),
                    pc.fill_null(texts.take(pa.array([k for k, _ in kept.values()])), b""),
                    *[pa.array([got[k] for _, got in kept.values()], pa.int64()) for k in range(len(names))],
                ],
                names=["block", "digest", "text", *names],
            )
            for a, b in slices(out.column(2), AT_ONCE):
                yield out.slice(a, b - a)

    rows = docs.select(F.col("text").cast("binary"), *[c.cast("long").alias(n) for n, c in values.items()])
    out = rows.mapInArrow(run, "block int, digest binary, text binary, " + ", ".join(f"{n} long" for n in names))
    return out.repartition(blocks, "block")


def block_texts(table: pa.Table, names: list[str], merge: Callable[[list, list], list]) -> list[tuple[bytes, bytes, list]]:
    """(digest, text, values) of a block, each text once, in order of digest."""
    kept: dict[bytes, tuple[bytes, list]] = {}
    for d, raw, *got in zip(*[table[c].to_pylist() for c in ("digest", "text", *names)], strict=True):
        kept[d] = (raw, merge(kept[d][1], got)) if d in kept else (raw, got)
    return [(d, *kept[d]) for d in sorted(kept)]
