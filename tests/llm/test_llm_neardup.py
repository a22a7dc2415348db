import numpy as np
import pytest
from pyspark.sql import functions as F

from notice_engine.llm import neardup
from notice_engine.llm.graph import components


def brute(rows):
    """Classes of (doc_id, text) by all pairs."""
    sets = [np.unique(neardup.shingles((t or "").encode()), return_counts=True) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a][0]) and len(sets[b][0]) and neardup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    return {frozenset(v) for v in groups.values()}


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 4))
    rows = [(0, None), (1, ""), (2, "  \n "), (3, "one two"), (4, "one two"), (5, "One two"), (6, "x " * 60000), (7, "x " * 60001)]
    for k in range(n):
        base = [word() for _ in range(int(rng.integers(30, 200)))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(int(rng.integers(0, 4))):
            other = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 25))):
                other[rng.integers(len(other))] = word()
            rows.append((len(rows), " ".join(other)))
    base = [word() for _ in range(120)]  # one large group of near copies
    for _ in range(60):
        other = list(base)
        other[rng.integers(120)] = word()
        rows.append((len(rows), " ".join(other)))
    rows += [(len(rows) + k, rows[8][1]) for k in range(30)]  # and one of copies
    rows += [(len(rows), "a b c d e " * 40), (len(rows) + 1, "a b c d e " * 39), (len(rows) + 2, "a b c d e " * 10)]  # counts matter
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "b", 0) for i, t in rows], "doc_id bigint, text string, tid int, class_id string, root int")


@pytest.mark.parametrize("limit", [neardup.BROADCAST_IDS, 0])
def test_classes_are_those_of_all_pairs(spark, limit, monkeypatch):
    monkeypatch.setattr(neardup, "BROADCAST_IDS", limit)
    rows = texts(60)
    got = {}
    for r in neardup.classes(frame(spark, rows)).collect():
        got.setdefault(r["class_id"], []).append(r["doc_id"])
    assert {frozenset(v) for v in got.values()} == brute(rows)
    assert all(k == min(v) for k, v in got.items())


def test_one_of_each_class_stays(spark):
    rows = [*texts(20, 4), (8, texts(20, 4)[8][1]), (None, "null id one two three"), (None, texts(20, 4)[9][1])]
    d = frame(spark, rows)
    out = neardup.without_near_duplicates(d)
    assert out.columns == d.columns
    ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    want = sorted(min(c) for c in brute(texts(20, 4)))
    assert ids == want and sum(r["doc_id"] is None for r in out.collect()) == 1
    assert neardup.classes(d.limit(0)).count() == 0 and neardup.without_near_duplicates(d.limit(0)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(8)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(30):
            a = np.repeat(rng.integers(1, 2**63, 80, dtype=np.uint64), rng.integers(1, 7, 80))
            b = np.where(rng.random(len(a)) < share, a, rng.integers(1, 2**63, len(a), dtype=np.uint64))
            true = neardup.weighted_jaccard(np.unique(a, return_counts=True), np.unique(b, return_counts=True))
            sig = neardup.signatures([a, b])
            errors.append((sig[0] == sig[1]).mean() - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_signature_does_not_depend_on_company():
    rng = np.random.default_rng(9)
    sets = [rng.integers(1, 2**63, n, dtype=np.uint64) for n in (1, 3, 50, 4000)]
    together = neardup.signatures(sets)
    assert all((neardup.signatures([s])[0] == t).all() for s, t in zip(sets, together, strict=True))


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 50)] + [(int(a), int(b)) for a, b in rng.integers(200, 400, (150, 2))]
    parent = {x: x for e in edges for x in e}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {k: find(k) for e in edges if e[0] != e[1] for k in e}
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0 and df.where(F.lit(False)).count() == 0


def star(copies, seed=3):
    """A text and copies of it, edited each on its own: all 0.8 like the first, most less like each other."""
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(copies):
        other = list(base)
        for at in rng.choice(39, 4, replace=False) * 5 + 2:
            other[at] = "".join(rng.choice(list("klmnopqrst"), 6))
        rows.append((k + 1, " ".join(other)))
    return rows


@pytest.mark.parametrize("block", [neardup.BLOCK, 50])
def test_star_of_copies_is_one_class(spark, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "TILE", 20)
    rows = star(400)
    assert brute(rows) == {frozenset(range(401))}
    assert {r["class_id"] for r in neardup.classes(frame(spark, rows)).collect()} == {0}


def test_second_pass_has_every_pair_of_large_buckets(spark):
    rows = star(150) + [(1000 + i, t) for i, t in star(60, 4)]
    texts = neardup.written(neardup.signed_texts(frame(spark, rows).select("doc_id", "text")), "t")
    met = neardup.written(neardup.shared_buckets(texts), "m")
    none = spark.createDataFrame([], "node bigint, root bigint")
    first = {(r["a"], r["b"]) for r in neardup.candidate_pairs(texts, met).collect()}
    between = neardup.pairs_between(texts, met, none)
    second = [(r["a"], r["b"]) for r in between.collect()]
    assert len(second) == len(set(second))
    signed = [(r["tid"], set(r["bands"]), np.frombuffer(r["short"], "<u2")) for r in texts.collect()]
    want = {(min(x, y), max(x, y)) for x, p, s in signed for y, q, t in signed if x < y and p & q and (s == t).mean() >= neardup.ESTIMATE}
    assert first | set(second) == want and first != want
    docs = frame(spark, rows).select("doc_id", "text")
    pairs = lambda df: {(r["a"], r["b"]) for r in df.collect()}
    assert pairs(neardup.verified_in_tiles(between, docs)) == pairs(neardup.verified(between, docs)) != set()


def test_each_bucket_draws_its_own_members(spark):
    met = neardup.shared_buckets(spark.createDataFrame([(t, list(range(24))) for t in range(40)], "tid bigint, bands array<bigint>"))
    assert len({r[f"r{k}"] for r in met.collect() for k in range(neardup.MEMBERS)}) > neardup.MEMBERS


@pytest.mark.parametrize(("block", "size"), [(neardup.BLOCK, neardup.BLOCK_BYTES), (50, neardup.BLOCK_BYTES), (neardup.BLOCK, 100_000)])
def test_second_pass_gives_fewer_links_than_texts_and_joins_what_all_pairs_join(spark, block, size, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", size)
    rows = star(150) + [(1000 + i, t) for i, t in star(60, 4)]
    docs = frame(spark, rows).select("doc_id", "text")
    texts = neardup.written(neardup.signed_texts(docs), "t")
    met = neardup.written(neardup.shared_buckets(texts), "m")
    none = spark.createDataFrame([], "node bigint, root bigint")
    pairs = neardup.written(neardup.pairs_between(texts, met, none), "p")
    every, links = neardup.verified(pairs, docs), neardup.written(neardup.links_between(texts, met, none, docs), "l")
    of = lambda df: {(r["a"], r["b"]) for r in df.collect()}
    assert of(links) <= of(every)
    roots = lambda df: {(r["node"], r["root"]) for r in components(df).collect()}
    assert roots(links) == roots(every) != set()
    dealt = neardup.dealt_buckets(texts, met, none)
    assert links.count() < dealt.count() and pairs.count() > 10 * len(rows)
    assert (dealt.agg(F.max("j")).first()[0] > 1) == (block == 50 or size == 100_000)


def test_classes_make_no_table_of_pairs_of_large_buckets(spark, monkeypatch):
    seen = {}
    real = neardup.written

    def counted(df, label):
        out = real(df, label)
        seen[label] = max(seen.get(label, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "written", counted)
    rows = star(400)
    neardup.classes(frame(spark, rows)).collect()
    first_pass = neardup.BANDS * (neardup.MEMBERS + neardup.SMALL_BUCKET / 2) * len(rows)
    assert max(seen.values()) < first_pass / 4, seen


def test_pipeline_stage_keeps_one_of_a_star_without_a_table_of_pairs(spark, monkeypatch):
    import corpus_pipeline

    most = []
    real = neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, label: (out := real(df, label), most.append(out.count()))[0])
    rows = star(400)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), "").collect()] == [0]
    assert max(most) < neardup.BANDS * (neardup.MEMBERS + neardup.SMALL_BUCKET / 2) * len(rows) / 4
