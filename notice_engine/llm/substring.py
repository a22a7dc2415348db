"""Substring dedup: runs of words that an earlier document has too, found with compressed FM-indexes.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller doc_id; windows are judged
on the input.

1. Every window is known by its minimizer, the run of six words in it with the
   smallest hash. Equal windows have equal minimizers, so a window can only repeat
   if its minimizer occurs in a second text. Blocks ask which of their minimizers do.
2. Windows that remain are routed by minimizer: each stretch of windows with the
   same minimizer goes, with its words, to the shard of that minimizer, so equal
   windows meet whatever document they are from. Equal stretches of a block go once.
   Windows of a minimizer that very many texts share (a stock phrase) are routed one
   by one by a hash of the whole window, so they spread over all shards.
3. A shard builds an FM-index of its different stretches and streams them over it:
   backward search over the wavelet matrix extends the match word by word, shortens it
   where no stretch goes on, and gives the matching statistics of each place. Where
   they reach ``WINDOW`` words, the smallest doc_id in the interval is the answer.
4. Back in its block, a document marks the words of windows that start earlier.

Index and search cover repeated text only and grow with it, not with the number of
documents times the number of shards. Words are told apart by 48 bits of a hash (a
window by 13 times that), windows without regard to how they are routed.

Defined cases: null text has no words; rows with a null doc_id keep all words and do
not count as earlier documents; rows that share a doc_id do not remove each other's
words; documents shorter than a window keep all words; equal texts are judged once
and the answer holds for each of their rows; an empty table gives no rows; other
columns are kept by :func:`without_repeated_substrings` and ignored otherwise.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.llm.blocks import block_texts, blocked, digest_column, pack, pack_sorted, shard_edges, shard_starts, sizes, unpack, unpack_sorted
from notice_engine.llm.fmindex import FMIndex
from notice_engine.llm.lean import lean_groups
from notice_engine.llm.names import apart
from notice_engine.llm.words import grams, mixed, words_of
from notice_engine.session import ship, table

WINDOW, MINIMIZER = 13, 6
#: A minimizer of more texts than this is too many for one shard.
HOT_TEXTS = 4_096
#: Words whose minimizers are looked for at once; temporary arrays take some 60 bytes for each.
WORDS_AT_ONCE = 1 << 17
NONE = 2**63 - 1
_U = np.uint64


def _earliest(a: list, b: list) -> list:
    return [min(a[0], b[0])]


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts one after the other, and where each text begins."""
    words = words_of(texts)
    return words.hashes(), words.first


def minimizer_runs(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that have their minimizer (the leftmost of equal ones) at the same place.

    Text k has the word hashes h[first[k]:first[k + 1]]. For each run: its text, where in
    ``h`` its first window starts and the one behind its last, and the minimizer's key.
    """
    parts, k = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U))], 0
    while k < len(first) - 1:
        stop = max(k + 1, int(np.searchsorted(first, first[k] + WORDS_AT_ONCE, "right")) - 1)
        text, begin, end, key = _runs(h[first[k] : first[stop]], first[k : stop + 1] - first[k])
        parts.append((text + k, begin + first[k], end + first[k], key))
        k = stop
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    windows = np.maximum(np.diff(first) - WINDOW + 1, 0)
    if not windows.sum():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U)
    least = grams(h, MINIMIZER)
    at = np.arange(len(least), dtype=np.int32 if len(least) < 1 << 31 else np.int64)
    wide, span = WINDOW - MINIMIZER + 1, 1
    while span < wide:  # the least of 1, 2, 4, ... runs of words, also across texts
        step = min(span, wide - span)
        smaller = least[step:] < least[:-step]
        at, least = (np.where(smaller, x[step:], x[:-step]) for x in (at, least))
        span += step
    place = np.arange(windows.sum()) + np.repeat(first[:-1] - np.cumsum(windows) + windows, windows)  # windows within a text
    at, least = at[place], least[place]
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    begin = place[new]
    return np.searchsorted(first, begin, "right") - 1, begin, place[np.append(new[1:], len(place)) - 1] + 1, mixed(least[new])


def _asked(table_: pa.Table, shards: int) -> pa.Table:
    """The minimizers of a block, and how many of its texts have them."""
    block = table_["block"][0].as_py()
    text, _, _, key = minimizer_runs(*_hashed([raw for _, raw, first in block_texts(table_, ["first"], _earliest) if first[0] != NONE]))
    order = np.lexsort((text, key))
    text, key = text[order], key[order]
    again = np.concatenate([[False], (text[1:] == text[:-1]) & (key[1:] == key[:-1])])[: len(key)]
    keys, counts = np.unique(key[~again], return_counts=True)
    edges = shard_edges(keys, shards)
    parts = [s for s in range(shards) if edges[s + 1] > edges[s]]
    cut = lambda x, s: x[edges[s] : edges[s + 1]]
    return pa.table(
        {
            "shard": pa.array(parts, pa.int32()),
            "block": pa.array([block] * len(parts), pa.int32()),
            "keys": pa.array([pack_sorted(cut(keys, s)) for s in parts], pa.binary()),
            "texts": pa.array([pack(cut(counts, s).astype("<u4")) for s in parts], pa.binary()),
        }
    )


def _shared(table_: pa.Table) -> pa.Table:
    """For each block that asked: which of its minimizers another text has too, and which very many have."""
    keys = [unpack_sorted(b) for b in table_["keys"].to_pylist()]
    times = [unpack(b, "<u4").astype(np.int64) for b in table_["texts"].to_pylist()]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], every[order][1:] != every[order][:-1]]))
    total = np.empty(len(every), np.int64)
    total[order] = np.repeat(np.add.reduceat(np.concatenate(times)[order], starts), np.diff(np.append(starts, len(every))))
    cuts = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
    bits = lambda least: pa.array([np.packbits(c > least).tobytes() for c in cuts], pa.binary())
    return pa.table({"block": table_["block"], "shard": table_["shard"], "bits": bits(1), "hot": bits(HOT_TEXTS)})


def _stretches(table_: pa.Table, replies: pa.Table, shards: int) -> pa.Table:
    """The stretches of a block's windows with shared minimizers, by shard; equal ones once, with the smallest doc_id and all their places."""
    out: dict[str, list] = {"shard": [], "block": [], "words": [], "lengths": [], "first": [], "which": [], "row": [], "start": []}
    if table_.num_rows and replies.num_rows:
        block = table_["block"][0].as_py()
        texts = [(k, first[0], raw) for k, (_, raw, first) in enumerate(block_texts(table_, ["first"], _earliest)) if first[0] != NONE]
        h, first_word = _hashed([raw for _, _, raw in texts])
        texts = [(k, first) for k, first, _ in texts]
        text, begin, stop, key = minimizer_runs(h, first_word)
        keys, number = np.unique(key, return_inverse=True)
        edges = shard_edges(keys, shards)
        shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for s, *packed in zip(replies["shard"].to_pylist(), replies["bits"].to_pylist(), replies["hot"].to_pylist(), strict=True):
            for bits, raw in zip((shared, hot), packed, strict=True):
                bits[edges[s] : edges[s + 1]] = np.unpackbits(np.frombuffer(raw, np.uint8), count=edges[s + 1] - edges[s])
        ok = shared[number]
        text, begin, stop, number = (x[ok] for x in (text, begin, stop, number))
        shard = np.searchsorted(edges, number, "right") - 1
        alone = hot[number]
        if alone.any():  # each of their windows is a stretch
            times = np.where(alone, stop - begin, 1)
            run = np.repeat(np.arange(len(times)), times)
            inside = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
            begin, alone, text, shard = begin[run] + inside, alone[run], text[run], shard[run]
            stop = np.where(alone, begin + 1, stop[run])
            shard[alone] = np.searchsorted(shard_starts(shards), grams(h, WINDOW)[begin[alone]], "right")
        starts, ends = begin - first_word[text], stop + WINDOW - 1
        h >>= _U(16)
        short = memoryview(h).cast("B")
        by_shard: dict[int, dict] = {}
        for t, b, e, start, s in zip(text.tolist(), begin.tolist(), ends.tolist(), starts.tolist(), shard.tolist(), strict=True):
            row, first = texts[t]
            piece = bytes(short[8 * b : 8 * e])
            known = by_shard.setdefault(s, {})
            got = known.get(piece)
            if got is None:
                known[piece] = got = [first, []]
            elif first < got[0]:
                got[0] = first
            got[1].append((row, start))
        for s, known in sorted(by_shard.items()):
            places = [(k, r, b) for k, (_, spots) in enumerate(known.values()) for r, b in spots]
            which, row, start = (np.array(x, "<u4") for x in zip(*places, strict=True))
            words = np.frombuffer(b"".join(known), "<u8")
            six = np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :6])
            out["shard"].append(s)
            out["block"].append(block)
            out["words"].append(zstandard.ZstdCompressor(level=1).compress(six.tobytes()))
            out["lengths"].append(pack(np.array([len(p) // 8 for p in known], "<u4")))
            out["first"].append(pack(np.array([f for f, _ in known.values()], "<i8")))
            for name, x in (("which", which), ("row", row), ("start", start)):
                out[name].append(pack(x))
    return pa.table({n: pa.array(v, pa.int32() if n in ("shard", "block") else pa.binary()) for n, v in out.items()})


def _earlier(table_: pa.Table) -> pa.Table:
    """Answers of one shard: for every window of every stretch, the smallest doc_id it starts in."""
    words, lengths, firsts = [], [], []
    for w, n, f in zip(*[table_[c].to_pylist() for c in ("words", "lengths", "first")], strict=True):
        six = np.frombuffer(zstandard.ZstdDecompressor().decompress(w, max_output_size=1 << 31), np.uint8).reshape(-1, 6)
        eight = np.zeros((len(six), 8), np.uint8)
        eight[:, :6] = six
        words.append(eight.view("<u8").reshape(-1))
        lengths.append(unpack(n, "<u4").astype(np.int64))
        firsts.append(unpack(f, "<i8"))
    per_block = [len(n) for n in lengths]
    flat, length, first = np.concatenate(words), np.concatenate(lengths), np.concatenate(firsts)
    del words, lengths, firsts
    # equal stretches of different blocks are indexed once
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    known: dict[bytes, int] = {}
    same = np.empty(len(length), np.int64)
    for k, (b, n) in enumerate(zip(begin.tolist(), length.tolist(), strict=True)):
        same[k] = known.setdefault(hashlib.blake2b(flat[b : b + n], digest_size=16).digest(), len(known))
    one = np.full(len(known), -1)
    one[same[::-1]] = np.arange(len(length))[::-1]
    least = np.full(len(known), NONE)
    np.minimum.at(least, same, first)
    # text: each stretch behind a separator
    n_one = length[one]
    at = np.concatenate([[0], np.cumsum(n_one + 1)[:-1]]) + 1
    inner = np.arange(n_one.sum()) - np.repeat(np.cumsum(n_one) - n_one, n_one)
    vocabulary, number = np.unique(flat[np.repeat(begin[one], n_one) + inner], return_inverse=True)
    del flat, known
    place = np.repeat(at, n_one) + inner
    del inner
    text, owner = np.zeros(int(n_one.sum() + len(n_one)), np.int32), np.zeros(int(n_one.sum() + len(n_one)), np.int32)
    text[place] = number + 1
    owner[place] = np.repeat(np.arange(len(one)), n_one)
    del number, place
    index = FMIndex(text, len(vocabulary), WINDOW, owner)
    del owner, vocabulary
    size, lows, highs = index.matching_statistics(text, at, at + n_one)

    windows = n_one - WINDOW + 1
    step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(at, windows) + step
    low, high = lows[starts].astype(np.int64), highs[starts].astype(np.int64)
    docs_in_order = least[index.piece]
    intervals, back = np.unique(low, return_inverse=True)
    ends = np.empty(len(intervals), np.int64)
    ends[back] = high
    cuts = np.stack([intervals, ends], 1).reshape(-1)
    answer = np.minimum.reduceat(np.append(docs_in_order, NONE), cuts)[::2][back] if len(cuts) else np.empty(0, np.int64)
    answer[size[starts] < WINDOW] = NONE  # not reached by any interval

    first_window = np.cumsum(windows) - windows
    replies, k = [], 0
    for n in per_block:
        s = same[k : k + n]
        w = windows[s]
        inside = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        replies.append(pack(answer[np.repeat(first_window[s], w) + inside]))
        k += n
    return pa.table({"block": table_["block"], **{c: table_[c] for c in ("lengths", "which", "row", "start")}, "answer": pa.array(replies, pa.binary())})


RESULT = "digest binary, first long, n_words long, n_removed long, kept binary, kept_sha256 string, whole_sha256 string"


def _kept(table_: pa.Table, replies: pa.Table, with_text: bool) -> pa.Table:
    """What stays of each text of a block."""
    texts = block_texts(table_, ["first"], _earliest) if table_.num_rows else []
    gone: dict[int, list[np.ndarray]] = {}
    for n, which, row, start, answer in zip(*[replies[c].to_pylist() for c in ("lengths", "which", "row", "start", "answer")], strict=True):
        windows = unpack(n, "<u4").astype(np.int64) - WINDOW + 1
        begin = np.cumsum(windows) - windows
        which, row, start, answer = unpack(which, "<u4").astype(np.int64), unpack(row, "<u4"), unpack(start, "<u4").astype(np.int64), unpack(answer, "<i8")
        w = windows[which]
        inside = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        own = np.repeat(np.array([texts[r][2][0] for r in row.tolist()], np.int64), w)
        hit = answer[np.repeat(begin[which], w) + inside] < own
        place, rows = (np.repeat(start, w) + inside)[hit], np.repeat(row, w)[hit]
        order = np.argsort(rows, kind="stable")
        place, rows = place[order], rows[order]
        found, begins = np.unique(rows, return_index=True)
        for r, a, b in zip(found.tolist(), begins.tolist(), np.append(begins[1:], len(rows))[: len(found)].tolist(), strict=True):
            gone.setdefault(r, []).append(place[a:b])
    out: dict[str, list] = {n.split()[0]: [] for n in RESULT.split(", ")}
    for k, (digest, raw, first) in enumerate(texts):
        words = raw.split()
        whole = b" ".join(words)
        n, kept = len(words), whole
        if k in gone:
            edge = np.zeros(n + 1, np.int64)
            for p in gone[k]:
                np.add.at(edge, p, 1)
                np.add.at(edge, p + WINDOW, -1)
            stays = np.cumsum(edge[:-1]) == 0
            words = [words[i] for i in np.flatnonzero(stays).tolist()]
            kept = b" ".join(words)
        sha = hashlib.sha256(whole).hexdigest()
        values = (digest, None if first[0] == NONE else first[0], n, n - len(words), kept if with_text else None, hashlib.sha256(kept).hexdigest() if k in gone else sha, sha)
        for name, v in zip(out, values, strict=True):
            out[name].append(v)
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    return pa.table({n.split()[0]: pa.array(out[n.split()[0]], kinds[n.split()[1]]) for n in RESULT.split(", ")})


def judged_texts(docs: DataFrame, with_text: bool) -> DataFrame:
    """One row for each different text: its first doc_id and what stays of it there."""
    ship(docs.sparkSession)
    n_blocks, n_shards = sizes(docs)
    rows = blocked(docs, {"first": F.coalesce(F.col("doc_id").cast("long"), F.lit(NONE))}, _earliest, n_blocks)
    asked = rows.groupBy("block").applyInArrow(lean_groups(lambda t: _asked(t, n_shards)), "shard int, block int, keys binary, texts binary")
    shared = asked.groupBy("shard").applyInArrow(lean_groups(_shared), "block int, shard int, bits binary, hot binary")
    stretches = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(lean_groups(lambda a, b: _stretches(a, b, n_shards)), "shard int, block int, words binary, lengths binary, first binary, which binary, row binary, start binary")
    answers = stretches.groupBy("shard").applyInArrow(lean_groups(_earlier), "block int, lengths binary, which binary, row binary, start binary, answer binary")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lean_groups(lambda a, b: _kept(a, b, with_text)), RESULT)


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for every row."""
    found = judged_texts(docs.select("doc_id", "text"), False)
    rows = docs.select("doc_id", digest_column(F.col("text")).alias("digest")).join(found, "digest")
    own = F.col("doc_id").isNotNull()
    copy = own & (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW)  # an earlier document has the same text
    removed = F.when(copy, F.col("n_words")).when(own, F.col("n_removed")).otherwise(0)
    sha = F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(own, F.col("kept_sha256")).otherwise(F.col("whole_sha256"))
    return rows.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), sha.alias("kept_sha256"))


def without_repeated_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words cut out of text; texts that lose nothing stay as they are. n_chars follows the text."""
    names = docs.columns
    digest, first, words, kept, new = apart(names, "digest", "first", "words", "kept", "new")
    found = judged_texts(docs.select("doc_id", "text"), True)
    found = found.select(F.col("digest").alias(digest), F.col("first").alias(first), F.col("n_words").alias(words), F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).alias(kept))
    rows = docs.withColumn(digest, digest_column(F.col("text"))).join(found, digest)
    own = F.col("doc_id").isNotNull()
    copy = own & (F.col("doc_id") > F.col(first)) & (F.col(words) >= WINDOW)
    text = F.when(copy, F.lit("")).when(own & F.col(kept).isNotNull(), F.col(kept)).otherwise(F.col("text"))
    rows = rows.withColumn(new, text)
    return rows.select(*[F.col(new).alias(n) if n == "text" else F.length(new).cast(docs.schema[n].dataType).alias(n) if n == "n_chars" else F.col(n) for n in names])


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, doc_id, i, array_to_string(w[i:i+12], ' ') AS k FROM (SELECT rid, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL)),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
h AS (SELECT DISTINCT g.rid, g.i + x AS p FROM g JOIN f ON g.k = f.k AND f.first < g.doc_id, generate_series(0, 12) AS s(x)),
r AS (SELECT rid, list(p) AS gone FROM h GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' '), '') END) AS kept_sha256
FROM d LEFT JOIN r ON d.rid = r.rid
"""
