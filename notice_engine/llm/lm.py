"""LM scoring by deleted interpolation of word bigrams.

The probability of a token after a context is a mixture of the bigram's relative
frequency, the token's relative frequency and a uniform share for the vocabulary
and one unknown word. The weights depend on how often the context was seen (by
powers of two) and are learned by expectation-maximisation: the documents of one
fold of the training set are deleted from the counts, and the mixture that makes
them likeliest is kept. Scores then use the counts of the whole training set.

Counts never leave their shards as rows. Blocks of documents ask key shards about
their different words and bigrams, giving how often each occurs in their training
documents; a shard adds the counts of all blocks and answers each block in its own
order. Every document of every size takes part; what is gathered grows with the
corpus. The mixture is learned from a histogram of the deleted documents' tokens
over a fixed grid (context bucket, and both frequencies in steps of a quarter
octave), so what reaches the driver is bounded by the grid.

Defined cases: null text is empty, whose only token is the end; a null doc_id
hashes as the empty string; equal texts are counted once for each row in the
training set and scored once; an empty table gives no rows; without training
documents every word is unknown (N = V = 0); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.llm.blocks import block_texts, blocked, digest_column, pack, pack_sorted, shard_edges, sizes, unpack, unpack_sorted
from notice_engine.llm.lean import lean_batches, lean_groups
from notice_engine.llm.words import mixed, words_of
from notice_engine.session import ship, table, written

FOLDS, HELD_OUT = 7, 2
#: One of so many folds of the training documents is deleted to learn the mixture.
DELETED = 8
BUCKETS, GRID = 48, 4
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_U = np.uint64


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _sum(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b, strict=True)]


def _streams(texts: list[tuple[bytes, bytes, list]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens (lower-cased words, then the end) and of the bigrams of all texts, and the number of tokens of each."""
    found = words_of([raw for _, raw, _ in texts])
    length = np.diff(found.first) + 1
    words = np.insert(found.hashes(lower=True), found.first[1:], END)
    del found
    pairs = np.empty_like(words)  # first the contexts
    pairs[1:] = words[:-1]
    pairs[np.cumsum(length) - length] = START
    pairs *= _U(0x9E3779B97F4A7C15)
    pairs += words ^ (words >> _U(29))
    return words, mixed(pairs), length


def _summed(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by group, exact beyond 2 ** 53 too."""
    high, low = values >> 24, values & 0xFFFFFF
    out = np.bincount(group, low, n).astype(np.int64)
    return out + (np.bincount(group, high, n).astype(np.int64) << 24) if high.any() else out


def _asked(table_: pa.Table, shards: int) -> pa.Table:
    """The words (kind 0) and bigrams (kind 1) of a block and how often they are in training, and deleted, documents."""
    block = table_["block"][0].as_py()
    texts = block_texts(table_, ["train", "deleted"], _sum)
    words, pairs, length = _streams(texts)
    times = [np.array([v[k] for _, _, v in texts], np.int64) for k in (0, 1)]
    del texts
    out: dict[str, list] = {"kind": [], "shard": [], "block": [], "keys": [], "train": [], "deleted": []}
    streams = [words, pairs]
    del words, pairs
    for kind in (0, 1):
        keys, back = np.unique(streams.pop(0), return_inverse=True)
        counts = [_summed(back, np.repeat(w, length), len(keys)) for w in times]
        del back
        edges = shard_edges(keys, shards)
        for s in range(shards):
            a, b = edges[s], edges[s + 1]
            if b > a:
                for name, v in zip(out, (kind, s, block, pack_sorted(keys[a:b]), pack(counts[0][a:b]), pack(counts[1][a:b])), strict=True):
                    out[name].append(v)
    return pa.table({n: pa.array(v, pa.int32() if n in ("kind", "shard", "block") else pa.binary()) for n, v in out.items()})


def _counted(table_: pa.Table) -> pa.Table:
    """Totals of one shard's keys, for each block in its order. One reply also carries the shard's number of tokens and of different words in training."""
    kind = table_["kind"][0].as_py()
    keys = [unpack_sorted(b) for b in table_["keys"].to_pylist()]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], every[order][1:] != every[order][:-1]]))
    times = np.diff(np.append(starts, len(every)))
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    replies, tokens_, types = {}, 0, 0
    for name in ("train", "deleted"):
        counts = np.concatenate([unpack(b, "<i8") for b in table_[name].to_pylist()])
        total = np.add.reduceat(counts[order], starts)
        if name == "train" and kind == 0:
            tokens_, types = int(total.sum()), int((total > 0).sum())
        spread = np.empty(len(every), "<u8")
        spread[order] = np.repeat(total, times)
        replies[name] = [pack(c) for c in np.split(spread, cuts)]
    blocks = table_["block"].to_pylist()
    teller = int(np.argmin(blocks))
    once = lambda v: pa.array([v if k == teller else 0 for k in range(len(blocks))], pa.int64())
    return pa.table({"block": table_["block"], "kind": table_["kind"], "shard": table_["shard"], "train": pa.array(replies["train"], pa.binary()), "deleted": pa.array(replies["deleted"], pa.binary()), "tokens": once(tokens_), "types": once(types)})


COUNTED = "digest binary, n_tokens long, n_deleted long, words binary, pairs binary, words_deleted binary, pairs_deleted binary, tokens long, types long"


def _with_counts(table_: pa.Table, replies: pa.Table, shards: int) -> pa.Table:
    """For each text of a block the counts of its tokens and bigrams; for those with deleted rows also the deleted counts. A row without digest sums up the shards."""
    out: dict[str, list] = {n.split()[0]: [] for n in COUNTED.split(", ")}
    if table_.num_rows and replies.num_rows:
        texts = block_texts(table_, ["train", "deleted"], _sum)
        words, pairs, length = _streams(texts)
        counts: list[dict[str, np.ndarray]] = []
        streams = [words, pairs]
        del words, pairs
        for kind in (0, 1):
            keys, back = np.unique(streams.pop(0), return_inverse=True)
            edges = shard_edges(keys, shards)
            got = {"train": np.zeros(len(keys), np.int64), "deleted": np.zeros(len(keys), np.int64)}
            for k, s, a, d in zip(*[replies[c].to_pylist() for c in ("kind", "shard", "train", "deleted")], strict=True):
                if k == kind:
                    got["train"][edges[s] : edges[s + 1]] = unpack(a, "<u8")
                    got["deleted"][edges[s] : edges[s + 1]] = unpack(d, "<u8")
            small = {n: v.astype(np.uint32) if v.max(initial=0) < 2**32 else v for n, v in got.items()}
            counts.append({n: v[back] for n, v in small.items()})
        stop = np.cumsum(length)
        for (digest, _, (_, deleted)), a, b in zip(texts, (stop - length).tolist(), stop.tolist(), strict=True):
            cut = lambda kind, n: pack(counts[kind][n][a:b].astype("<i8"))  # noqa: B023, E731
            row = (digest, b - a, deleted, cut(0, "train"), cut(1, "train"), cut(0, "deleted") if deleted else None, cut(1, "deleted") if deleted else None, 0, 0)
            for name, v in zip(out, row, strict=True):
                out[name].append(v)
        sums = (None, 0, 0, None, None, None, None, sum(replies["tokens"].to_pylist()), sum(replies["types"].to_pylist()))
        for name, v in zip(out, sums, strict=True):
            out[name].append(v)
    kinds = {"binary": pa.binary(), "long": pa.int64()}
    return pa.table({n.split()[0]: pa.array(out[n.split()[0]], kinds[n.split()[1]]) for n in COUNTED.split(", ")})


def contexts(words: np.ndarray, starts: int) -> np.ndarray:
    """Counts of the tokens' contexts: the word before, or the start, which is as frequent as the end."""
    return np.concatenate([[starts], words[:-1]])


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + its power of two."""
    return np.where(context > 0, np.minimum(np.frexp(np.maximum(context, 1).astype(float))[1], BUCKETS - 1), 0)


def frequencies(words: np.ndarray, pairs: np.ndarray, context: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return pairs / np.maximum(context, 1), words / max(n, 1)


def learn_mixture(b: np.ndarray, p2: np.ndarray, p1: np.ndarray, n: np.ndarray, unknown: float, rounds: int = 60) -> np.ndarray:
    """Weights (bucket, [uniform, word, bigram]) that make the deleted tokens likeliest. An unseen context has no bigram share; buckets without tokens take the nearest learned ones."""
    w = np.full((BUCKETS, 3), 1 / 3)
    p = np.stack([np.full(len(b), unknown), p1, p2], 1)
    seen = np.bincount(b, n, BUCKETS) > 0
    w[0] = (0.5, 0.5, 0.0)
    for _ in range(rounds):
        part = w[b] * p
        part *= (n / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        total = np.stack([np.bincount(b, part[:, k], BUCKETS) for k in range(3)], 1)
        w[seen] = (total[seen] + 1e-3) / (total[seen] + 1e-3).sum(axis=1, keepdims=True)
        w[0] = (w[0, 0], w[0, 1], 0.0) / w[0, :2].sum()
    for k in np.flatnonzero(~seen):
        others = np.flatnonzero(seen & (np.arange(BUCKETS) > 0))
        if k and len(others):
            w[k] = w[others[np.abs(others - k).argmin()]]
    return w


class Model:
    """Counts beside each different text, and the learned mixture."""

    def __init__(self, docs: DataFrame):
        ship(docs.sparkSession)
        n_blocks, n_shards = sizes(docs)
        train = remainder(F.col("doc_id")) != HELD_OUT
        fold = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(DELETED)) == 0
        rows = blocked(docs, {"train": train.cast("long"), "deleted": (train & fold).cast("long")}, _sum, n_blocks)
        asked = rows.groupBy("block").applyInArrow(lean_groups(lambda t: _asked(t, n_shards)), "kind int, shard int, block int, keys binary, train binary, deleted binary")
        counted = asked.groupBy("kind", "shard").applyInArrow(lean_groups(_counted), "block int, kind int, shard int, train binary, deleted binary, tokens long, types long")
        known = rows.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(lean_groups(lambda a, b: _with_counts(a, b, n_shards)), COUNTED)
        self.texts = written(known, "lm-counts")
        ends = docs.agg(F.count_if(train), F.count_if(train & fold)).first()
        sums = self.texts.agg(F.sum("tokens"), F.sum("types")).first()
        self.tokens, self.types = (int(x or 0) for x in sums)
        self.starts, self.starts_deleted = (int(x or 0) for x in ends)
        self.weights = self._mixture()

    def _mixture(self) -> np.ndarray:
        gone = self.texts.where("n_deleted > 0").agg(F.sum(F.col("n_tokens") * F.col("n_deleted"))).first()[0] or 0
        n, starts, unknown = self.tokens - int(gone), self.starts - self.starts_deleted, 1 / (self.types + 1)

        @lean_batches
        def run(batches):
            for batch in batches:
                sums: dict[int, int] = {}
                for copies, *blobs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    words, pairs, words_gone, pairs_gone = (unpack(b, "<i8") for b in blobs)
                    words, pairs = words - words_gone, pairs - pairs_gone
                    context = contexts(words, starts)
                    p2, p1 = frequencies(words, pairs, context, n)
                    step = [np.where(p > 0, np.clip(np.rint(-GRID * np.log2(np.maximum(p, 1e-30))), 0, 398), 399).astype(np.int64) for p in (p2, p1)]
                    cell, times = np.unique((bucket(context) * 400 + step[0]) * 400 + step[1], return_counts=True)
                    for c, t in zip(cell.tolist(), times.tolist(), strict=True):
                        sums[c] = sums.get(c, 0) + t * copies
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["cell", "n"])

        rows = self.texts.where("n_deleted > 0").select("n_deleted", "words", "pairs", "words_deleted", "pairs_deleted").mapInArrow(run, "cell long, n long")
        grid = rows.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
        cell, times = grid["cell"].to_numpy(np.int64), grid["n"].to_numpy(float)
        back = lambda s: np.where(s == 399, 0.0, 2.0 ** (-s / GRID))
        return learn_mixture(cell // 160_000, back(cell // 400 % 400), back(cell % 400), times, unknown)

    def scores(self) -> DataFrame:
        """digest, n_tokens, n_known, base_score and score of each different text."""
        weights, n, v, starts = self.weights, self.tokens, self.types, self.starts

        @lean_batches
        def run(batches):
            for batch in batches:
                out: dict[str, list] = {"n_known": [], "base_score": [], "score": []}
                for w, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    words, pairs = unpack(w, "<i8"), unpack(p, "<i8")
                    context = contexts(words, starts)
                    p2, p1 = frequencies(words, pairs, context, n)
                    mix = weights[bucket(context)]
                    out["n_known"].append(int((words > 0).sum()))
                    out["base_score"].append(float(np.log10((words + 1) / (n + v + 1)).sum()))
                    out["score"].append(float(np.log10(mix[:, 0] / (v + 1) + mix[:, 1] * p1 + mix[:, 2] * p2).sum()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out["n_known"], pa.int64()), pa.array(out["base_score"], pa.float64()), pa.array(out["score"], pa.float64())], names=["digest", "n_tokens", *out])

        rows = self.texts.where("digest is not null").select("digest", "n_tokens", "words", "pairs")
        return rows.mapInArrow(run, "digest binary, n_tokens long, n_known long, base_score double, score double")


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row."""
    light = docs.select("doc_id", "text")
    model = Model(light)
    rows = light.select("doc_id", digest_column(F.col("text")).alias("digest")).join(model.scores(), "digest")
    return rows.select("doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
