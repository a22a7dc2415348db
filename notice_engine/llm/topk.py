"""Exact top-k by inner product with a pivot table.

Every vector keeps its distances to a few dozen pivots. By the triangle
inequality the distance of a query to a candidate is at least the largest
difference of their distances to a pivot, and since
``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2`` that bounds the score from above.
Candidates are evaluated in the order of their bounds until the k-th best score
lies above the bound of the next one, so the result is exact.

Before anything is shuffled, each query is scored against the bounded sample that the
pivots are from, which gives a first k-th best score. Queries are dealt into blocks by
their nearest pivot; a block is known by the ranges of its queries' pivot distances
and its lowest k-th best score. A candidate is sent only to those blocks whose bound
for it reaches that score. Each pair of a query block and a candidate block is one
group and gives at most k rows for each query, of which the best k are kept.

Defined cases: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; vectors of different length are not compared;
repeated candidates count as often as they occur; equal repeated queries are asked
once; ties go to the smaller id; an empty table gives no rows; other columns are
ignored. Components are 256 times the input, rounded down, of any size; scores are
sums of whole numbers of any size, and one among the best that does not fit 64 bits is
an error, as is a component whose 256-fold is beyond a double.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notice_engine.llm.lean import lean_batches, lean_groups
from notice_engine.session import ship, table, written

PIVOTS, PIVOT_SAMPLE = 32, 2_000
QUERY_BLOCK, CANDIDATE_BLOCK = 1_024, 4_096
#: Query blocks whose ranges are sent to all tasks (some 500 bytes each); with more queries blocks grow.
MOST_BLOCKS = 20_000
SCALE, STEP = 256, 256


def usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    return v.isNotNull() & F.forall(v, finite)


def integers(v: Column) -> Column:
    """Whole numbers, kept as doubles, which hold them exactly."""
    return F.transform(v, lambda x: (F.rint(x.cast("double") * SCALE) - (F.rint(x.cast("double") * SCALE) > x.cast("double") * SCALE).cast("double")))


def choose_pivots(x: np.ndarray) -> np.ndarray:
    """Farthest-first points of a bounded sample (the rows with the smallest hashes)."""
    picked, far = [0], _distances(x, x[:1])[:, 0]
    while len(picked) < min(PIVOTS, len(x)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[picked[-1:]])[:, 0])
    return x[picked]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def with_pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """(id, v) -> also p, the distances to the pivots of v's length."""
    ship(vectors.sparkSession)

    @lean_batches
    def run(batches):
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            out: list = [None] * len(lengths)
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                near = _distances(_matrix(batch.column(1).take(pa.array(rows))), pivots[dim]) if dim in pivots else np.empty((len(rows), 0))
                for r, d in zip(rows.tolist(), near, strict=True):
                    out[r] = d
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], names=["id", "v", "p"])

    return vectors.select("id", "v").mapInArrow(run, "id long, v array<double>, p array<double>")


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(pivots)))
    with np.errstate(over="ignore"):
        for j, p in enumerate(pivots):
            out[:, j] = np.sqrt(((x - p) ** 2).sum(axis=1))
    return out


def _squares(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x * x).sum(axis=1)


def _upper(q2, x2, low) -> np.ndarray:
    """No score is above this: squared lengths and a lower bound of the distance, with room for rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        high = (q2 + x2 - low * low) / 2 + 1e-9 * (q2 + x2) + 1e-6
    return np.where(np.isnan(high), np.inf, high)


def _pair(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if all inner products are exact in them, else as Python integers."""
    if not (np.isfinite(q).all() and np.isfinite(x).all()):
        raise OverflowError("256 times a component is beyond a double")
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    if top < 2**53:
        return q, x
    whole = lambda m: np.array([[int(v) for v in row] for row in m.tolist()], object).reshape(m.shape)
    return whole(q), whole(x)


def best_in_block(q_ids, q, q_table, floors, ids, x, x_table, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(query row, id, score) of the best k candidates of one block for each query, but for those below the query's floor; and the number of pairs evaluated."""
    order = np.argsort(ids, kind="stable")
    ids, x, x_table = ids[order], x[order], x_table[order]
    exact_q, exact_x = _pair(q, x)
    x2, q2 = _squares(x), _squares(q)
    out, evaluated = [], 0
    for row in range(len(q)):
        low = np.abs(x_table - q_table[row]).max(axis=1) if x_table.shape[1] else np.zeros(len(x))
        high = _upper(q2[row], x2, np.nan_to_num(low, nan=0.0, posinf=0.0))
        high[(ids == q_ids[row]) | (high < floors[row])] = -np.inf
        by_bound = np.argsort(-high, kind="stable")
        by_bound = by_bound[: int((high > -np.inf).sum())]
        got_s, got_i, seen = np.empty(0, exact_x.dtype), np.empty(0, np.int64), 0
        while seen < len(by_bound):
            if len(got_s) == k and got_s[-1] > high[by_bound[seen]]:
                break
            part = by_bound[seen : seen + STEP]
            seen += len(part)
            s = np.concatenate([got_s, exact_x[part] @ exact_q[row]])
            i = np.concatenate([got_i, ids[part]])
            keep = np.lexsort((i, -s))[:k]
            got_s, got_i = s[keep], i[keep]
        evaluated += seen
        out += [(row, int(i), int(s)) for s, i in zip(got_s, got_i, strict=True)]
    return out, evaluated


def query_floors(asked: DataFrame, sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(id, v, p) of queries -> also home, the nearest pivot, and floor: the k-th best score in the sample, just below it (-inf if the sample has too few)."""
    ship(asked.sparkSession)

    @lean_batches
    def run(batches):
        for batch in batches:
            floors, homes = [], []
            for id_, v, p in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids, x = sample.get(len(v), (np.empty(0, np.int64), np.empty((0, len(v)))))
                homes.append(int(np.argmin(p)) if p else 0)
                with np.errstate(over="ignore", invalid="ignore"):
                    q = np.array(v, float)
                    s = (x @ q)[ids != id_]
                    s = s - 1e-9 * np.sqrt(_squares(x)[ids != id_] * (q @ q)) - 1e-6
                s = s[np.isfinite(s)]
                floors.append(float(np.partition(s, len(s) - k)[len(s) - k]) if len(s) >= k else -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes, pa.int32()), pa.array(floors, pa.float64())], names=["id", "v", "p", "home", "floor"])

    return asked.select("id", "v", "p").mapInArrow(run, "id long, v array<double>, p array<double>, home int, floor double")


def query_blocks(asked: DataFrame, size: int) -> tuple[DataFrame, list]:
    """Queries with ``qb``, their block among those of their length and nearest pivot; and for each block its ranges."""
    counts = {(r["dim"], r["home"]): r["n"] for r in asked.groupBy(F.size("v").alias("dim"), "home").agg(F.count("*").alias("n")).collect()}
    start, at = {}, 0
    for key in sorted(counts):
        start[key] = (at, -(-counts[key] // size))
        at += start[key][1]
    if not counts:
        return asked.withColumn("qb", F.lit(0)), []
    place = F.lit(None).cast("int")
    for (dim, home), (first, n) in start.items():  # as many branches as pivots
        place = F.when((F.size("v") == dim) & (F.col("home") == home), F.lit(first) + F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).otherwise(place)
    dealt = asked.withColumn("qb", place)
    n_pivots = F.size("p")
    ranges = dealt.groupBy("qb").agg(
        F.first(F.size("v")).alias("dim"),
        F.array(*[F.min(F.when(n_pivots > j, F.get("p", F.lit(j)))) for j in range(PIVOTS)]).alias("low"),
        F.array(*[F.max(F.when(n_pivots > j, F.get("p", F.lit(j)))) for j in range(PIVOTS)]).alias("high"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("q2"),
        F.min("floor").alias("floor"),
    )
    return dealt, ranges.orderBy("qb").collect()


def wanted_by(rows: DataFrame, ranges: list) -> DataFrame:
    """(id, v, p) -> one row for each query block whose bound for this candidate reaches the block's floor."""
    ship(rows.sparkSession)
    by_dim: dict[int, tuple] = {}
    for dim in {r["dim"] for r in ranges}:
        own = [r for r in ranges if r["dim"] == dim]
        n = sum(v is not None for v in own[0]["low"])
        by_dim[dim] = (np.array([r["qb"] for r in own], np.int32), np.array([r["low"][:n] for r in own], float), np.array([r["high"][:n] for r in own], float), np.array([r["q2"] for r in own], float), np.array([r["floor"] for r in own], float))

    @lean_batches
    def run(batches):
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                if dim not in by_dim:
                    continue
                qb, low, high, q2, floor = by_dim[dim]
                part = batch.take(pa.array(np.flatnonzero(lengths == dim)))
                x2, p = _squares(_matrix(part.column(1))), _matrix(part.column(2))
                apart = np.zeros((len(p), len(qb)))
                for j in range(p.shape[1]):
                    apart = np.fmax(apart, np.fmax(p[:, j : j + 1] - high[:, j], low[:, j] - p[:, j : j + 1]))
                met = _upper(q2[None, :], x2[:, None], np.nan_to_num(apart, nan=0.0, posinf=0.0)) >= floor[None, :]
                row, block = np.nonzero(met)
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(qb[block], pa.int32())], names=["id", "v", "p", "qb"])

    return rows.select("id", "v", "p").mapInArrow(run, "id long, v array<double>, p array<double>, qb int")


def scored_pairs(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, key (of a query among those of one id), vec_id and score of the best of each pair of blocks; and rows without query_id that tell the pairs ``evaluated``."""
    ship(vectors.sparkSession)
    rows_sampled = vectors.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).collect()
    by_length: dict[int, list] = {}
    for r in rows_sampled:
        by_length.setdefault(len(r["v"]), []).append(r)
    sample = {dim: (np.array([r["id"] for r in own], np.int64), np.array([r["v"] for r in own], float).reshape(len(own), dim)) for dim, own in by_length.items()}
    pivots = {dim: choose_pivots(x) for dim, (_, x) in sample.items()}
    rows = written(with_pivot_table(vectors, pivots), "topk-rows")
    query = is_query
    sides = rows.agg(F.count("*").alias("n"), F.count_if(query).alias("q")).first()
    asked = query_floors(rows.where(query).dropDuplicates(["id", "v"]), sample, k)
    asked, ranges = query_blocks(written(asked, "topk-queries"), max(QUERY_BLOCK, -(-sides["q"] // MOST_BLOCKS)))
    n_c = max(1, -(-sides["n"] // CANDIDATE_BLOCK))
    given = wanted_by(rows, ranges).withColumn("cb", F.pmod(F.xxhash64("id"), F.lit(n_c)).cast("int"))
    asked = asked.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))

    @lean_groups
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found, keys, evaluated = [], [], 0
        if left.num_rows and right.num_rows:
            q_ids, q = left["id"].to_numpy(), _matrix(left["v"])
            found, evaluated = best_in_block(q_ids, q, _matrix(left["p"]), left["floor"].to_numpy(), right["id"].to_numpy(), _matrix(right["v"]), _matrix(right["p"]), k)
            for r, i, s in found:
                if not -(2**63) <= s < 2**63:
                    raise OverflowError(f"the score of {q_ids[r]} and {i} does not fit 64 bits: {s}")
            keys = [xxhash.xxh3_64_intdigest(q[r].tobytes()) >> 1 for r, *_ in found] if len(set(q_ids.tolist())) < len(q_ids) else [0] * len(found)
        n = len(found)
        return pa.table(
            {
                "query_id": pa.array([*[int(q_ids[r]) for r, *_ in found], None], pa.int64()),
                "key": pa.array([*keys, None], pa.int64()),
                "vec_id": pa.array([*[f[1] for f in found], None], pa.int64()),
                "score": pa.array([*[f[2] for f in found], None], pa.int64()),
                "evaluated": pa.array([*[None] * n, evaluated], pa.int64()),
            }
        )

    blocks = asked.select("id", "v", "p", "floor", "qb", "cb").groupBy("qb", "cb").cogroup(given.groupBy("qb", "cb"))
    return blocks.applyInArrow(run, "query_id long, key long, vec_id long, score long, evaluated long")


def best_of(pairs: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id"))
    return pairs.where("query_id is not null").withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(id, v) with whole numbers -> query_id, rank, vec_id, score for each row where ``is_query`` (of id) holds, against all other rows."""
    return best_of(scored_pairs(vectors, is_query, k), k)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").cast("long").alias("id"), integers(F.col("embedding")).alias("v"))
    return top_k(vectors, F.col("id") % 50 == 0, 5)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
