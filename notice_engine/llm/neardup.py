"""Near duplicates by BagMinHash signatures of five-word shingles, bands and exact verification.

Similarity is the weighted Jaccard of two texts' shingle multisets, 0.8 or more.

Signatures. A shingle with count ``c`` owns the weight interval (0, c], cut into
the dyadic intervals (0,1], (1,2], (2,4], (4,8] and so on. Each interval has a
Poisson process seeded by the shingle and the interval: points come in order of
time, each with a signature component and a place in the interval that successive
halvings choose; points beyond ``c`` do not count. A component is the earliest
point that counts, so two signatures agree in a component with a probability equal
to the weighted Jaccard. Points later than the time by which all components are
expected to be filled are not generated; texts with an empty component go on with a
later time.

Candidates. Equal texts are one node from the start (collapsed in each Arrow batch
before any shuffle). Signatures are cut into bands; texts that share a band meet in a
bucket, and every pair of a bucket is a candidate. Signatures drop pairs whose
estimate lies 4.4 standard deviations below 0.8. The rest is verified on the texts:
first the two best candidates of each text, then every candidate whose ends are
still in different classes.

This goes in two passes. The first takes all pairs of buckets of up to 16 texts and
in larger ones pairs each text with three members only, drawn anew for each bucket,
which joins most of a large group at little cost. The second takes the larger
buckets whose texts are still in different classes and compares all their texts of
different classes, block against block. Pairs within a class need no look, since
they cannot change it. A bucket of n texts that stay apart costs n * n / 2
comparisons of signatures, and the pairs that pass are verified where they are
compared: rows are texts and the links that join classes, fewer than texts; never pairs.

Classes are the components of the verified links.

Defined cases: words are maximal runs outside ``\\x20\\x09-\\x0D``, taken as they
are; texts of one to four words have one shingle, the whole; texts without words
(null, empty, blank) are alone in their class, also among each other; a class id is
the smallest doc_id of the class, null only if no member has one; repeated rows and
equal texts under several ids share a class; an empty table gives no rows; other
columns are kept by :func:`without_near_duplicates` and ignored otherwise. Nodes are
60-bit hashes of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from notice_engine.llm.graph import components
from notice_engine.llm.lean import lean_batches, lean_groups
from notice_engine.llm.names import apart
from notice_engine.llm.words import WORD, buffer_of, grams, mixed, slices, words_of
from notice_engine.session import ship, table, written

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 24, 5
PARTS = BANDS * ROWS
SMALL_BUCKET, MEMBERS = 16, 3
#: Texts of a large bucket whose signatures are compared at once, and of those the texts verified at once: of each side, about.
BLOCK, TILE = 2048, 128
#: Bytes of text in such a block, about.
BLOCK_BYTES = 6_000_000
ESTIMATE = 0.64
#: Ids of texts to verify, or of documents to leave out, that are broadcast at most (8 bytes each); beyond, joins shuffle.
BROADCAST_IDS = 2_000_000
#: Pairs that take a text from one place; a text of more pairs is dealt to several.
HOT_PAIRS = 64
#: Bytes of text whose shingles are in memory at once.
AT_ONCE = 2_000_000
_U = np.uint64


def shingle_sets(texts: pa.Array | list[bytes]) -> list[np.ndarray]:
    """Hashes of the shingles of each text, in order and with repeats."""
    words = words_of(texts)
    h, first = words.hashes(), words.first.tolist()
    g = grams(h, SHINGLE)
    return [g[a : b - SHINGLE + 1] if b - a >= SHINGLE else grams(h[a:b], b - a) if b > a else h[:0] for a, b in zip(first, first[1:], strict=False)]


def shingles(raw: bytes | None) -> np.ndarray:
    return shingle_sets([raw or b""])[0]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets, each as sorted values and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low))


def _times(k: int, odd: int) -> np.uint64:
    return _U(k * odd & 0xFFFFFFFFFFFFFFFF)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``PARTS`` 64-bit values for each non-empty array of shingle hashes (with repeats)."""
    values, counts, owner = [], [], []
    for k, s in enumerate(sets):
        v, c = np.unique(s, return_counts=True)
        values.append(v)
        counts.append(c)
        owner.append(np.full(len(v), k, np.int64))
    value, count, owner = np.concatenate(values), np.concatenate(counts).astype(np.int64), np.concatenate(owner)
    weight = np.array([len(s) for s in sets], float)
    # processes: one for each element and dyadic interval below its count
    seeds, owners, lengths, within = [value], [owner], [np.ones(len(value), np.int64)], [np.ones(len(value), np.int64)]
    low, step = 1, 1
    while (more := np.flatnonzero(count > low)).size:
        seeds.append(value[more] + _times(step, 0xA0761D6478BD642F))
        owners.append(owner[more])
        lengths.append(np.full(len(more), low, np.int64))
        within.append(np.minimum(count[more] - low, low))
        low, step = low * 2, step + 1
    seed, owner, length, within = np.concatenate(seeds), np.concatenate(owners), np.concatenate(lengths), np.concatenate(within)

    best = np.full(len(sets) * PARTS, np.inf)
    todo, until = np.arange(len(sets)), (np.log(PARTS) + 3.0) / weight
    while len(todo):
        chosen = np.zeros(len(sets), bool)
        chosen[todo] = True
        live = np.flatnonzero(chosen[owner])
        time, point = np.zeros(len(live)), 0
        while len(live):
            point += 1
            h = mixed(seed[live] + _times(point, 0xE7037ED1A0B428DB))
            time = time - np.log(((h >> _U(11)).astype(float) + 1.0) * 2.0**-53) / (PARTS * length[live])
            early = time <= until[owner[live]]
            live, time, h = live[early], time[early], h[early]
            g = mixed(h ^ _U(0x8EBC6AF09C88C6E3))
            part = ((g >> _U(32)) * _U(PARTS) >> _U(32)).astype(np.int64)
            inside = (g & _U(0xFFFFFFFF)).astype(np.int64) & (length[live] - 1) if length.max() > 1 else 0
            met = inside < within[live]
            np.minimum.at(best, (owner[live] * PARTS + part)[met], time[met])
        unfilled = np.isinf(best.reshape(len(sets), PARTS)).any(axis=1)
        todo = np.flatnonzero(unfilled)
        until[todo] *= 2
        best.reshape(len(sets), PARTS)[todo] = np.inf
    return best.reshape(len(sets), PARTS).view(_U)


def band_keys(sig: np.ndarray) -> np.ndarray:
    out = np.empty((len(sig), BANDS), _U)
    for b in range(BANDS):
        h = np.full(len(sig), b + 1, _U)
        for r in range(ROWS):
            h = mixed(h * _U(0x9E3779B97F4A7C15) + sig[:, b * ROWS + r])
        out[:, b] = h
    return out


def text_id(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _text_id(raw) -> int:
    return int(hashlib.md5(raw).hexdigest()[:15], 16)


def signed_texts(docs: DataFrame) -> DataFrame:
    """tid, first (smallest doc_id), bands, short (16 bits of each signature value) and size (bytes) for each different text with words."""
    kind = docs.schema["doc_id"].dataType
    ship(docs.sparkSession)
    arrow_kind = to_arrow_type(kind)

    @lean_batches
    def run(batches):
        for batch in batches:
            docs_, texts = batch.column(0).to_pylist(), batch.column(1)
            data, offsets = buffer_of(texts)
            firsts: dict[int, object] = {}
            rows: dict[int, int] = {}
            for k, doc in enumerate(docs_):
                tid = _text_id(data[offsets[k] : offsets[k + 1]])
                if tid not in rows:
                    rows[tid], firsts[tid] = k, doc
                elif doc is not None and (firsts[tid] is None or doc < firsts[tid]):
                    firsts[tid] = doc
            kept, size = [], 0
            for tid, k in rows.items():
                kept.append(tid)
                size += offsets[k + 1] - offsets[k]
                if size > AT_ONCE:
                    yield signed(texts, rows, firsts, kept)
                    kept, size = [], 0
            if kept:
                yield signed(texts, rows, firsts, kept)

    def signed(texts, rows, firsts, kept) -> pa.RecordBatch:
        own = texts.take(pa.array([rows[t] for t in kept]))
        sig = signatures(shingle_sets(own))
        short = (mixed(sig) >> _U(48)).astype("<u2")
        return pa.RecordBatch.from_arrays(
            [
                pa.array(kept, pa.int64()),
                pa.array([firsts[t] for t in kept], arrow_kind),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(kept) * BANDS + 1, BANDS), pa.int32()), pa.array(band_keys(sig).view(np.int64).reshape(-1))),
                pa.array([s.tobytes() for s in short], pa.binary()),
                pc.binary_length(own).cast(pa.int64()),
            ],
            names=["tid", "first", "bands", "short", "size"],
        )

    with_words = docs.where(F.col("text").rlike(WORD)).select("doc_id", F.col("text").cast("binary"))
    rows = with_words.mapInArrow(run, f"tid long, first {kind.simpleString()}, bands array<long>, short binary, size long")
    return rows.groupBy("tid").agg(F.min("first").alias("first"), *[F.any_value(c).alias(c) for c in ("bands", "short", "size")])


def shared_buckets(texts: DataFrame) -> DataFrame:
    """key, tid, n (texts of the bucket) and a few members for each bucket of more than one text."""
    rows = texts.select("tid", F.explode("bands").alias("key"))
    drawn = [F.min_by("tid", F.xxhash64("key", "tid", F.lit(k))) for k in range(MEMBERS)]
    buckets = rows.groupBy("key").agg(F.count("*").alias("n"), *[d.alias(f"r{k}") for k, d in enumerate(drawn)]).where("n > 1")
    return rows.join(buckets, "key")


def candidate_pairs(texts: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b, alike), a < b: the first pass; all pairs of small buckets, some of large ones, alike by their signatures."""
    small = met.where(F.col("n") <= SMALL_BUCKET).select("key", "tid")
    near = small.join(small.select("key", F.col("tid").alias("other")), "key").where("tid < other").select(F.col("tid").alias("a"), F.col("other").alias("b"))
    large = met.where(F.col("n") > SMALL_BUCKET).select("tid", F.explode(F.array(*[f"r{k}" for k in range(MEMBERS)])).alias("other"))
    large = large.where("tid <> other").select(F.least("tid", "other").alias("a"), F.greatest("tid", "other").alias("b"))
    pairs = near.union(large).distinct()
    short = lambda name: texts.select(F.col("tid").alias(name), F.col("short").alias(f"short_{name}"))
    ship(texts.sparkSession)

    @lean_batches
    def estimate(batches):
        for batch in batches:
            x, y = (buffer_of(batch.column(k))[0].view("<u2").reshape(-1, PARTS) for k in (2, 3))
            alike = (x == y).mean(axis=1)
            keep = pa.array(alike >= ESTIMATE)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike)], names=["a", "b", "alike"]).filter(keep)

    joined = pairs.join(short("a"), "a").join(short("b"), "b").select("a", "b", "short_a", "short_b")
    return joined.mapInArrow(estimate, "a long, b long, alike double")


def dealt_buckets(texts: DataFrame, met: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, i, j, tid, root, block): the texts of large buckets with different roots, once for each pair i, j of blocks that has their own.

    The texts of a bucket's most frequent root and the others are dealt to blocks
    apart, so that blocks of that root do not meet each other.
    """
    rows = met.where(F.col("n") > SMALL_BUCKET).select("key", "tid").join(roots.withColumnRenamed("node", "tid"), "tid", "left")
    rows = rows.select("key", "tid", F.coalesce("root", "tid").alias("root")).join(texts.select("tid", "size"), "tid")
    rows = written(rows.select("key", "tid", "root", "size"), "bmh-large")
    roots_of = rows.groupBy("key", "root").agg(F.count("*").alias("c"), F.sum("size").alias("size")).groupBy("key")
    open_ = roots_of.agg(F.count("*").alias("roots"), F.sum("c").alias("n"), F.sum("size").alias("size"), F.max(F.struct("c", "root", "size")).alias("top")).where("roots > 1")
    blocks = lambda n, size: F.ceil(F.greatest(n / F.lit(BLOCK), size / F.lit(BLOCK_BYTES)))
    others, tops = blocks(F.col("n") - F.col("top.c"), F.col("size") - F.col("top.size")), blocks(F.col("top.c"), F.col("top.size"))
    rows = rows.join(open_.select("key", F.col("top.root").alias("top"), others.alias("others"), tops.alias("tops")), "key")
    salt, is_top = F.xxhash64("tid"), F.col("root") == F.col("top")
    block = F.when(is_top, F.col("others") + F.pmod(salt, F.col("tops"))).otherwise(F.pmod(salt, F.col("others")))
    partners = F.sequence(F.lit(0).cast("long"), F.when(is_top, F.col("others")).otherwise(F.col("others") + F.col("tops")) - 1)
    rows = rows.withColumn("block", block).withColumn("partner", F.explode(partners))
    return rows.select("key", F.least("block", "partner").alias("i"), F.greatest("block", "partner").alias("j"), "tid", "root", "block")


def _near(group: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A row of a pair of blocks (key, i, j, tid, root, block, bands, short), the rows of other roots that are like it by their signatures, and how much.

    A pair is given by the first bucket that it shares; if that one is small, the first pass had the pair.
    """
    key, i, j = (group.column(k)[0].as_py() for k in range(3))
    root, block = (group.column(k).to_numpy() for k in (4, 5))
    bands = group.column(6).combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    short = np.frombuffer(b"".join(group.column(7).to_pylist()), "<u2").reshape(-1, PARTS)
    x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
    root_y, short_y = root[y], short[y]
    for k, row in enumerate(x.tolist()):
        start = k + 1 if i == j else 0
        alike = np.count_nonzero(short_y[start:] == short[row], axis=1) / PARTS
        near = np.flatnonzero((alike >= ESTIMATE) & (root_y[start:] != root[row]))
        other = y[start:][near]
        shared = bands[other] == bands[row]
        first = bands[row][shared.argmax(axis=1)] == key
        yield row, other[first], alike[near[first]]


def pairs_between(texts: DataFrame, met: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, i, j, a, b, alike), a < b: all pairs of large buckets with different roots, alike by their signatures, as a table. :func:`links_between` does without that table."""
    ship(texts.sparkSession)

    @lean_groups
    def compare(group: pa.Table) -> pa.Table:
        tid = group.column(3).to_numpy()
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        found += [(np.minimum(tid[other], tid[row]), np.maximum(tid[other], tid[row]), alike) for row, other, alike in _near(group)]
        a, b, alike = (np.concatenate(f) for f in zip(*found, strict=True))
        key, i, j = (pa.array(np.full(len(a), group.column(k)[0].as_py(), np.int64)) for k in range(3))
        return pa.table({"key": key, "i": i, "j": j, "a": a, "b": b, "alike": alike})

    rows = dealt_buckets(texts, met, roots).join(texts.select("tid", "bands", "short"), "tid").select("key", "i", "j", "tid", "root", "block", "bands", "short")
    return rows.groupBy("key", "i", "j").applyInArrow(compare, "key long, i long, j long, a long, b long, alike double")


def links_between(texts: DataFrame, met: DataFrame, roots: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b), a < b: the second pass; verified links of large buckets, as many as it takes to join the roots that any verified pair of :func:`pairs_between` joins.

    Pairs are verified within their pair of blocks, those that links found there have joined already are passed over.
    """
    rows = written(dealt_buckets(texts, met, roots), "bmh-dealt")
    ids = written(rows.select("tid").distinct(), "bmh-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    own = docs.select(text_id(F.col("text")).alias("tid"), "text").join(ids, "tid", "left_semi").groupBy("tid").agg(F.any_value("text").cast("binary").alias("text"))
    own = texts.select("tid", "bands", "short").join(own, "tid")
    ship(docs.sparkSession)

    @lean_groups
    def run(group: pa.Table) -> pa.Table:
        found = [f for f in _near(group) if len(f[1])]
        if not found:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        tid, root = (group.column(k).to_numpy() for k in (3, 4))
        used = np.unique(np.concatenate([[row for row, _, _ in found], *[other for _, other, _ in found]]))
        members = group.column(8).combine_chunks().take(pa.array(used))
        sets = [np.unique(s, return_counts=True) for a, b in slices(members, AT_ONCE) for s in shingle_sets(members.slice(a, b - a))]
        _, word = np.unique(np.concatenate([v for v, _ in sets]), return_inverse=True)
        count = np.concatenate([c for _, c in sets])
        ends = np.cumsum([len(v) for v, _ in sets])
        starts = ends - [len(v) for v, _ in sets]
        total = np.add.reduceat(count, starts)
        _, joined = np.unique(root[used], return_inverse=True)
        weight, links = np.zeros(word.max() + 1, count.dtype), []
        for row, other, alike in found:
            k, rest = int(np.searchsorted(used, row)), np.searchsorted(used, other[np.argsort(-alike, kind="stable")])
            rest = rest[joined[rest] != joined[k]]
            if not len(rest):
                continue
            n = ends[rest] - starts[rest]
            begin = np.cumsum(n) - n
            theirs = np.arange(n.sum()) + np.repeat(starts[rest] - begin, n)
            part = slice(starts[k], ends[k])
            weight[word[part]] = count[part]
            low = np.add.reduceat(np.minimum(weight[word[theirs]], count[theirs]), begin)
            weight[word[part]] = 0
            for r in rest[low / (total[k] + total[rest] - low) >= SIMILAR].tolist():
                if joined[r] != joined[k]:
                    joined[joined == joined[r]] = joined[k]
                    links.append((k, r))
        a, b = tid[used[np.array(links, np.int64).reshape(-1, 2)]].T
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    sent = rows.join(own, "tid").select("key", "i", "j", "tid", "root", "block", "bands", "short", "text")
    return sent.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def verified_in_tiles(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """As :func:`verified`, for many pairs (key, i, j, a, b) of few texts: a text is sent once to each tile of pairs, not to each pair."""
    tile = ["key", "i", "j", "u", "v"]
    dealt = lambda c: F.pmod(F.xxhash64(c, F.lit(1)), F.lit(-(-BLOCK // TILE)))
    pairs = pairs.select("key", "i", "j", dealt("a").alias("u"), dealt("b").alias("v"), "a", "b")
    ends = written(pairs.select(*tile, F.explode(F.array("a", "b")).alias("tid")).distinct(), "bmh-ends")
    texts = docs.select(text_id(F.col("text")).alias("tid"), "text").join(ends.select("tid").distinct(), "tid", "left_semi")
    texts = texts.groupBy("tid").agg(F.any_value("text").cast("binary").alias("text"))
    ship(docs.sparkSession)

    @lean_groups
    def run(group: pa.Table, members: pa.Table) -> pa.Table:
        a, b = (group.column(k).to_numpy() for k in ("a", "b"))
        tid = members.column("tid").to_numpy()
        sets = [np.unique(s, return_counts=True) for s in shingle_sets(members.column("text").combine_chunks())]
        at = {t: k for k, t in enumerate(tid.tolist())}
        _, word = np.unique(np.concatenate([v for v, _ in sets]), return_inverse=True)
        count = np.concatenate([c for _, c in sets])
        ends = np.cumsum([len(v) for v, _ in sets])
        starts = ends - [len(v) for v, _ in sets]
        total = np.add.reduceat(count, starts)
        other = np.array([at[t] for t in b.tolist()], np.int64)
        keep, own = np.zeros(len(a), bool), np.zeros(word.max() + 1, count.dtype)
        order = np.argsort(a, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
            k = at[int(a[rows[0]])]
            part = slice(starts[k], ends[k])
            own[word[part]] = count[part]
            low = np.add.reduceat(np.minimum(own[word], count), starts)
            own[word[part]] = 0
            keep[rows] = (low / (total[k] + total - low))[other[rows]] >= SIMILAR
        return pa.table({"a": a[keep], "b": b[keep]})

    sent = ends.join(texts, "tid").select(*tile, "tid", "text")
    return pairs.groupBy(*tile).cogroup(sent.groupBy(*tile)).applyInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those pairs whose texts are at least 0.8 alike.

    A text that is in many pairs is sent to several places, each for some of its pairs.
    """
    ends = pairs.select("a").union(pairs.select("b")).withColumnRenamed("a", "tid")
    ids = written(ends.groupBy("tid").agg(F.ceil(F.count("*") / F.lit(HOT_PAIRS)).alias("places")), "bmh-ids")
    hot = ids.where("places > 1")
    small = lambda t: F.broadcast(t) if t.count() <= BROADCAST_IDS else t
    texts = docs.select(text_id(F.col("text")).alias("tid"), "text").join(small(ids.select("tid")), "tid", "left_semi").groupBy("tid").agg(F.any_value("text").cast("binary").alias("text"))
    texts = texts.join(small(hot), "tid", "left").select("tid", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("places", F.lit(1)) - 1)).alias("place"))
    dealt = pairs.select("a", "b")
    for one, other in (("a", "b"), ("b", "a")):
        dealt = dealt.join(small(hot.select(F.col("tid").alias(one), F.col("places").alias(f"places_{one}"))), one, "left")
        dealt = dealt.withColumn(f"place_{one}", F.when(F.col(f"places_{one}").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(other), f"places_{one}")).cast("long"))
    ship(docs.sparkSession)

    @lean_batches
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column(2), AT_ONCE):
                part = batch.slice(start, stop - start)
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                at = {t: (2, k) for k, t in enumerate(a)} | {t: (3, k) for k, t in enumerate(b)}
                found = [np.unique(s, return_counts=True) for c in (2, 3) for s in shingle_sets(part.column(c).take(pa.array([k for d, k in at.values() if d == c], pa.int64())))]
                known = dict(zip(sorted(at, key=lambda t: at[t][0]), found, strict=True))
                keep = [weighted_jaccard(known[x], known[y]) >= SIMILAR for x, y in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: texts.select(F.col("tid").alias(name), F.col("place").alias(f"place_{name}"), F.col("text").alias(f"text_{name}"))
    dealt = dealt.join(side("a"), ["a", "place_a"]).join(side("b"), ["b", "place_b"])
    return dealt.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def best_two(pairs: DataFrame) -> DataFrame:
    """(a, b): those pairs that are among the two best of one of their texts."""
    ends = pairs.select("a", "b", "alike").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "alike"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.col("alike").desc(), "b"))
    return ends.withColumn("place", place).where("place <= 2").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def open_pairs(pairs: DataFrame, seen: DataFrame, roots: DataFrame) -> DataFrame:
    """Those pairs, without the seen ones, whose ends are in different classes."""
    root = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    rest = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
    return rest.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns).join(seen, ["a", "b"], "left_anti")


def near_duplicate_texts(docs: DataFrame) -> DataFrame:
    """tid, first and class_id (smallest doc_id of the class) for each different text with words."""
    texts = written(signed_texts(docs), "bmh-texts")
    met = written(shared_buckets(texts), "bmh-met")
    pairs = written(candidate_pairs(texts, met), "bmh-pairs")
    best = best_two(pairs)
    links = written(verified(best, docs), "bmh-links")
    roots = written(components(links), "bmh-roots")
    rest = written(open_pairs(pairs.select("a", "b"), best, roots), "bmh-rest")
    if not rest.isEmpty():
        more = written(verified(rest, docs), "bmh-links")
        if not more.isEmpty():
            links = links.union(more)
            roots = written(components(links), "bmh-roots")
    more = written(links_between(texts, met, roots, docs), "bmh-links")
    if not more.isEmpty():
        roots = written(components(links.union(more)), "bmh-roots")
    out = texts.select("tid", "first").join(roots.withColumnRenamed("node", "tid"), "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    ids = out.groupBy("root").agg(F.min("first").alias("class_id"))
    return out.join(ids, "root").select("tid", "first", "class_id")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id for every row."""
    found = near_duplicate_texts(docs.select("doc_id", "text")).select("tid", "class_id")
    rows = docs.select("doc_id", F.when(F.col("text").rlike(WORD), text_id(F.col("text"))).alias("tid"))
    return rows.join(found, "tid", "left").select("doc_id", F.when(F.col("tid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, that of its smallest doc_id; all columns kept. Rows without words stay."""
    found = written(near_duplicate_texts(docs.select("doc_id", "text")), "bmh-classes")
    keeper = found.where(F.col("first").eqNullSafe(F.col("class_id"))).groupBy(F.col("class_id").alias("_class")).agg(F.min("tid").alias("keeper"))
    found = found.join(keeper, F.col("class_id").eqNullSafe(F.col("_class"))).select("tid", "class_id", "keeper")
    rows = docs.select("doc_id", F.when(F.col("text").rlike(WORD), text_id(F.col("text"))).alias("tid")).where("tid is not null")
    rows = rows.groupBy("doc_id", "tid").agg(F.count("*").alias("n")).join(found, "tid")
    stays = (F.col("tid") == F.col("keeper")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    own, tid, doc = apart(docs.columns, "own", "tid", "doc")
    out = written(rows.select(F.col("doc_id").alias(doc), F.col("tid").alias(tid), stays.alias("stays"), "n").where("not stays or n > 1"), "bmh-out")
    gone, twice = out.where("not stays").select(doc, tid), out.where("stays").select(doc, tid)
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    tagged = docs.withColumn(own, F.when(F.col("text").rlike(WORD), text_id(F.col("text"))))
    same = (F.col(own) == F.col(tid)) & F.col("doc_id").eqNullSafe(F.col(doc))
    kept = tagged.join(gone, same, "left_anti")
    if not twice.isEmpty():  # rows that repeat a kept one
        again = tagged.join(twice, same, "left_semi").dropDuplicates(["doc_id", own])
        kept = kept.join(twice, same, "left_anti").unionByName(again)
    return kept.drop(own)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
