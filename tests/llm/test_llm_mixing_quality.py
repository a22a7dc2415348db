import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from notice_engine.llm import mixing, quality

KIND = "doc_id bigint, text string, source string, size string, h string, weight int, target string"


def docs(spark, rows):
    """Columns whose names the operators use inside come along."""
    return spark.createDataFrame([(i, t, s, "x", "y", 9, "z") for i, t, s in rows], KIND)


def brute_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * left / total > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * left / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left = sum(sizes.values()) - sum(target.values())
        free -= over
    return target


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), "w " * int(rng.integers(0, 30)), [None, "", "a", "b", "ż", "hot", "hot", "hot"][rng.integers(8)]) for i in range(800)]
    rows += [(None, "null id", "a"), (5, None, "a"), (7, "tie one two", "b"), (7, "tie one two", "b"), (900, "long " * 20000, "c"), (901, "", "empty")]
    got = mixing.mix(docs(spark, rows)).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = brute_targets(sizes)
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= (20000 if s == "c" else 60)
    again = mixing.mix(docs(spark, rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_repeat_rows(spark):
    rows = [(i, f"{'a b c ' * (1 + i % 4)}", "small" if i % 10 == 0 else "large") for i in range(200)]
    d = docs(spark, rows)
    out = mixing.mixed_documents(d)
    assert out.columns == d.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(d).collect() if r["copies"]}
    assert counts == plan
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.mixed_documents(d.limit(0)).count() == 0


def test_more_sources_than_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    rows = [(i, "x y z", f"s{i % 5}") for i in range(100)]
    assert mixing.mix(docs(spark, rows)).agg(F.sum("taken")).first()[0] > 250


def _corpus(spark, n=600):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words[:10] * 4), "s"))
        labels.append((i, int(good), 0))
    rows += [(5000, None, "s"), (5001, "", "s"), (5002, "long " * 30000, "s"), (None, "null id text", "s"), (1, rows[1][1], "s")]
    labels += [(1, None, 0), (None, 1, 0), (2, 1, 0)]
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_classifier(spark):
    d, labels = _corpus(spark)
    model = quality.fit(d, labels)
    rows = quality.scored(d, model).collect()
    assert len(rows) == d.count() and all(0 <= r["_score"] <= 1 for r in rows)
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["_score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in held]) > 0.95
    kept = {r["doc_id"] for r in quality.kept_documents(d, labels).collect()}
    assert kept >= {i for i in range(600) if i % 4} and quality.kept_documents(d, labels).columns == d.columns


def test_compiled_rules_agree_with_the_model(spark):
    d, labels = _corpus(spark, 300)
    x, y = quality.training_rows(d, labels)
    model = quality.RuleEnsemble.fit(x, y)
    stats = quality.statistics(F.col("text"))
    rows = quality.scored(d, model).select("_score", *[stats[n].alias(n) for n in quality.NAMES]).collect()
    found = np.array([[r[n] for n in quality.NAMES] for r in rows])
    assert np.isfinite(found).all() and np.allclose(model.predict(found), [r["_score"] for r in rows])
    assert 0 < len(model.weighted) < 300


def test_classifier_without_labels(spark):
    d, labels = _corpus(spark, 40)
    assert {r["_score"] for r in quality.scored(d, quality.fit(d, labels.limit(0))).collect()} == {0.5}
    assert quality.scored(d.limit(0), quality.fit(d.limit(0), labels)).count() == 0
    only = quality.fit(d, labels.where("quality = 1"))
    assert not only.weighted


def test_lasso_drops_noise():
    rng = np.random.default_rng(0)
    m = (rng.random((2000, 12)) < 0.5).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(3 * m[:, 0] - 2)))).astype(float)
    constant, w = quality.lasso_logistic(m, y, 0.02)
    assert w[0] > 1 and np.count_nonzero(w) <= 4 and constant < 0


def test_too_few_labels_for_a_rule(spark):
    d, labels = _corpus(spark, 40)
    few = labels.where("doc_id in (1, 3, 4)").where("quality is not null")
    model = quality.fit(d, few)
    scores = {round(r["_score"], 6) for r in quality.scored(d, model).collect()}
    assert not model.weighted and len(scores) == 1 and 0 < scores.pop() < 1


def test_statistics_computed_a_second_way(spark):
    import re

    texts = ["", "One two, two.\n\nTHREE 4 four! ü\tÜ", "a" * 50, " \n\n ", "x;y:z " * 9, "\u0660 1 \u00a0b\x0bc"]
    stats = quality.statistics(F.col("text"))
    df = docs(spark, [(k, t, "s") for k, t in enumerate(texts)])
    for r in df.select("text", *[stats[n].alias(n) for n in quality.NAMES]).collect():
        t = r["text"]
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        lines = [x for x in t.split("\n") if x]
        chars, n = max(len(t), 1), max(len(words), 1)
        assert r["log_words"] == pytest.approx(np.log1p(len(words))) and r["word_length"] == pytest.approx(sum(map(len, words)) / n)
        assert r["stops"] == pytest.approx(sum(c in ".,;:" for c in t) / n) and r["distinct_words"] == pytest.approx(len(set(words)) / n)
        assert r["upper"] == pytest.approx(sum(c.isupper() for c in t) / chars) and r["digits"] == pytest.approx(sum(c.isdecimal() for c in t) / chars)
        assert r["lines"] == pytest.approx(max(len(lines), 1) / n) and r["distinct_lines"] == pytest.approx(len(set(lines)) / max(len(lines), 1))


def test_rows_without_ids_are_dealt_by_text(spark):
    rows = [(None, f"word {i}", "a") for i in range(300)] + [(i, "x y", "b") for i in range(100)]
    got = mixing.mix(docs(spark, rows)).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w")).collect()
    assert all(abs(r["t"] - r["w"]) <= 4 for r in got)
