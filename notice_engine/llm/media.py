"""Media columns with content-defined chunking.

A payload is kept as a WAV file of 8-bit mono samples. Files are cut where a rolling
gear hash of the last 16 bytes hits a pattern, so equal stretches give equal chunks
wherever they lie. Chunks are known by digest; Spark joins find, for each digest that
occurs more than once, the one row that keeps its bytes. The store has one row per
document: its ordered list of chunks, the bytes of those that occur nowhere else, and
the shared chunks that it keeps for others. Reading joins the shared chunks back,
puts the list in order, checks every digest and the digest of the whole, and only
then gives out the samples.

Only digests and shared chunks are shuffled, not the payloads.

Defined cases: null text is empty; payloads are padded with zero bytes to a positive
multiple of 64, so an empty text has 64; repeated rows and equal texts give equal
values; a null doc_id is kept; an empty table gives no rows; other columns are
ignored. A payload of 4 GB or more does not fit a WAV file and fails.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.session import ship, table, written

UNIT, RATE = 64, 8_000
LEAST, MOST, CUT_BITS = 512, 16_384, 11
#: Rows of duplicate chunks that are broadcast at most (some 40 bytes each); beyond, the documents are shuffled.
BROADCAST_ROWS = 1_000_000


def _gear() -> np.ndarray:
    """256 pseudo-random 16-bit values, from a rule."""
    return np.frombuffer(hashlib.shake_128(b"gear").digest(512), "<u2").copy()


GEAR = _gear()


def padded(raw: bytes) -> bytes:
    return raw + bytes(UNIT * max(1, -(-len(raw) // UNIT)) - len(raw))


def wav(payload: bytes) -> bytes:
    """Unsigned 8-bit PCM, one channel."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload)) + payload


def samples(stored: bytes) -> bytes:
    riff, size, wave, _, _, kind, channels, _, _, _, bits, _, n = struct.unpack_from("<4sI4s4sIHHIIHH4sI", stored)
    if (riff, wave, kind, channels, bits) != (b"RIFF", b"WAVE", 1, 1, 8) or size != 36 + n or len(stored) != 44 + n:
        raise ValueError("not an 8-bit mono file")
    return stored[44:]


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``."""
    b = np.frombuffer(data, np.uint8)
    h = GEAR[b]
    for k in (1, 2, 4, 8):  # hash of the last 2, 4, 8, 16 bytes: each byte shifted once more than the next
        ahead = h.copy()
        ahead[k:] += h[:-k] << np.uint16(k)
        h = ahead
    found = np.flatnonzero((h >> np.uint16(16 - CUT_BITS)) == 0).tolist()
    out, start = [], 0
    for at in [*(x + 1 for x in found), len(data)]:
        while at - start > MOST:
            start += MOST
            out.append(start)
        if at - start >= LEAST and at < len(data) or at == len(data) and at > start:
            out.append(at)
            start = at
    return out


def chunks(stored: bytes) -> list[bytes]:
    ends = cuts(stored)
    return [stored[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def feature(payload: bytes) -> str:
    """Mean, root mean square about 128, zero crossings and a 16-band histogram of the samples."""
    x = np.frombuffer(payload, np.uint8)
    side = x >= 128
    crossings = int((side[1:] != side[:-1]).sum())
    bands = np.bincount(x >> 4, minlength=16)
    centred = x.astype(np.int64) - 128
    power = int((centred * centred).sum())
    return f"mean={x.mean():.6f};rms={(power / len(x)) ** 0.5:.6f};crossings={crossings};bands={','.join(map(str, bands.tolist()))}"


def chunk_list(docs: DataFrame) -> DataFrame:
    """doc_id, text_md5, seq and digest of every chunk."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            doc, md5s, seqs, digests = [], [], [], []
            for k, (raw, m) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                parts = chunks(wav(padded(raw or b"")))
                doc += [k] * len(parts)
                md5s += [m] * len(parts)
                seqs += range(len(parts))
                digests += map(digest, parts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), pa.array(md5s, pa.binary()), pa.array(seqs, pa.int32()), pa.array(digests, pa.binary())], names=["doc_id", "text_md5", "seq", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _keyed(docs).mapInArrow(run, f"doc_id {kind}, text_md5 binary, seq int, digest binary")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.cast("binary").alias("text"), F.unhex(F.md5(text)).alias("text_md5"))


def store(docs: DataFrame) -> DataFrame:
    """The written store: doc_id, text_md5, media_sha256, n_bytes, list (digests in order), own (seqs and bytes) and kept (shared chunks)."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = written(chunk_list(docs), "media-lists")
    where = F.struct("text_md5", "doc_id", "seq")
    keepers = lists.groupBy("digest").agg(F.min(where).alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper")
    shared = lists.join(keepers, "digest").select("doc_id", "text_md5", "seq", F.col("keeper").eqNullSafe(where).alias("keeps"))
    notes = shared.groupBy("doc_id", "text_md5").agg(F.collect_set(F.when(~F.col("keeps"), F.col("seq"))).alias("foreign"), F.collect_set(F.when(F.col("keeps"), F.col("seq"))).alias("keeps"))
    notes = written(notes.select(F.col("doc_id").alias("_doc"), F.col("text_md5").alias("_md5"), "foreign", "keeps"), "media-notes")
    small = notes.agg(F.coalesce(F.sum(1 + F.size("foreign") + F.size("keeps")), F.lit(0))).first()[0] <= BROADCAST_ROWS
    rows = _keyed(docs)
    rows = rows.join(F.broadcast(notes) if small else notes, (F.col("text_md5") == F.col("_md5")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "media_sha256": [], "list": [], "own": [], "own_sizes": [], "kept": [], "foreign": []}
            for raw, foreign, keeps in zip(*[batch.column(k).to_pylist() for k in (1, 3, 4)], strict=True):
                whole = wav(padded(raw))
                parts = chunks(whole)
                foreign, keeps = set(foreign or ()), set(keeps or ())
                single = [p for k, p in enumerate(parts) if k not in foreign and k not in keeps]
                out["n_bytes"].append(len(raw))
                out["media_sha256"].append(hashlib.sha256(whole).hexdigest())
                out["list"].append([digest(p) for p in parts])
                out["own"].append(b"".join(single))
                out["own_sizes"].append([0 if k in foreign or k in keeps else len(p) for k, p in enumerate(parts)])
                out["kept"].append([{"digest": digest(parts[k]), "bytes": parts[k]} for k in sorted(keeps)])
                out["foreign"].append(bool(foreign))
            one = pa.struct([("digest", pa.binary()), ("bytes", pa.binary())])
            kinds = [pa.int64(), pa.string(), pa.list_(pa.binary()), pa.binary(), pa.list_(pa.int32()), pa.list_(one), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)]], names=["doc_id", "text_md5", *out])

    rows = rows.select("doc_id", "text", "text_md5", "foreign", "keeps")
    made = rows.mapInArrow(run, f"doc_id {kind}, text_md5 binary, n_bytes long, media_sha256 string, list array<binary>, own binary, own_sizes array<int>, kept array<struct<digest:binary,bytes:binary>>, foreign boolean")
    return written(made, "media-store")


def read_back(stored: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (the verified file) and media_sha256 of every row of a store."""
    ship(stored.sparkSession)
    kind = stored.schema["doc_id"].dataType.simpleString()
    plain = stored.where("not foreign").withColumn("fetched", F.expr("cast(null as array<struct<digest:binary,bytes:binary>>)"))
    apart = stored.where("foreign")
    kept = stored.where(F.size("kept") > 0).select(F.explode("kept").alias("k")).select("k.digest", "k.bytes").dropDuplicates(["digest"])
    # which shared chunks each text needs, once for each text
    needs = apart.select("text_md5", F.explode(F.array_distinct(F.expr("filter(transform(list, (d, i) -> if(own_sizes[i] = 0, d, null)), d -> d is not null)"))).alias("digest")).distinct()
    fetched = needs.join(kept, "digest").groupBy("text_md5").agg(F.collect_list(F.struct("digest", "bytes")).alias("fetched"))
    rows = plain.unionByName(apart.join(fetched, "text_md5"))

    def run(batches):
        for batch in batches:
            media = []
            for sha, names, own, own_sizes, kept_, fetched_ in zip(*[batch.column(k).to_pylist() for k in range(2, 8)], strict=True):
                known = {x["digest"]: x["bytes"] for x in [*(kept_ or []), *(fetched_ or [])]}
                parts, at = [], 0
                for name, size in zip(names, own_sizes, strict=True):
                    part = own[at : at + size] if size else known[name]
                    at += size
                    if digest(part) != name:
                        raise ValueError("a chunk differs from its digest")
                    parts.append(part)
                whole = b"".join(parts)
                if hashlib.sha256(whole).hexdigest() != sha:
                    raise ValueError("a file differs from its digest")
                media.append(whole)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(media, pa.binary()), batch.column(2)], names=["doc_id", "n_bytes", "media", "media_sha256"])

    return rows.select("doc_id", "n_bytes", "media_sha256", "list", "own", "own_sizes", "kept", "fetched").mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary, media_sha256 string")


def features(media: DataFrame) -> DataFrame:
    """What is computed from the samples of verified files."""
    ship(media.sparkSession)
    kind = media.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"payload_bytes": [], "payload_sha256": [], "tail_crc32": [], "media_bytes": [], "feature": []}
            for whole in batch.column(2).to_pylist():
                payload = samples(whole)
                for name, v in zip(out, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(whole), feature(payload)), strict=True):
                    out[name].append(v)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *[pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)]], names=["doc_id", "n_bytes", "media_sha256", *out])

    rows = media.mapInArrow(run, f"doc_id {kind}, n_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string")
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(read_back(store(table(spark, sf_dir, "documents").select("doc_id", "text"))))
