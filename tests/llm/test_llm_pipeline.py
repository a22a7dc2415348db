import hashlib
import math
import re

import corpus_pipeline
import numpy as np
import regex
import test_llm_mixing_quality
import test_llm_neardup
from notice_engine.llm import bpe, quality

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    first, n = docs.columns, docs.count()
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, DIR)
        rows = docs.collect()
        counts.append(len(rows))
        if k < 4:
            assert docs.columns == first
    assert counts[0] < n and counts[1] < counts[0] and counts[2] == counts[1] and 0 < counts[3] and counts[4] == counts[3]
    v = bpe.vocabulary(bpe.default_path())
    for r in rows[:20]:
        assert len(r["ids"]) == r["n_tokens"] and r["round_trip"]
        ids = bytes(b"".join(i.to_bytes(4, "little") for i in r["ids"]))
        assert hashlib.sha256(ids).hexdigest() == r["ids_sha256"] and v.decode(np.array(r["ids"], "<u4"))


def test_empty_documents_pass(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.count() == 0


def test_one_of_a_large_star_of_copies_stays(spark):
    rows = test_llm_neardup.star(200)
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(1)
    stars = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.drop("doc_id", "text").crossJoin(stars).select(docs.columns)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, DIR).collect()] == [0]


def _statistics(t):
    t = t or ""
    words, lines = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w], [x for x in t.split("\n") if x]
    chars, n = max(len(t), 1), max(len(words), 1)
    count = lambda p: len(regex.findall(p, t))
    found = {
        "log_words": math.log1p(len(words)), "word_length": sum(map(len, words)) / n, "upper": count(r"\p{Lu}") / chars, "digits": count(r"\p{Nd}") / chars,
        "symbols": len(re.sub(r"[ \t\n\x0b\f\r.,;:'()\-]", "", regex.sub(r"\p{L}", "", t))) / chars, "stops": count(r"[.,;:]") / n,
        "distinct_words": len(set(words)) / n, "lines": max(len(lines), 1) / n, "distinct_lines": len(set(lines)) / max(len(lines), 1),
    }
    return [found[k] for k in quality.NAMES]


def _without_repeats(rows):
    first, out = {}, []
    words = [(t or "").split() for _, t, _ in rows]
    for (i, _, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    for (i, t, s), w in zip(rows, words, strict=True):
        gone = {k + j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(13)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t, s))
    return out


def _mixed(rows):
    size = [len((t or "").split()) for _, t, _ in rows]
    h = [int(hashlib.md5((("" if i is None else str(i)) + ":" + hashlib.md5((t or "").encode()).hexdigest()).encode()).hexdigest()[:15], 16) for i, t, _ in rows]
    sums = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        sums[s] = sums.get(s, 0) + n
    target, copies = test_llm_mixing_quality.brute_targets(sums), [0] * len(rows)
    for s, total in sums.items():
        own = [k for k in range(len(rows)) if rows[k][2] == s]
        times = math.floor(target[s] / total) if total else 0
        wanted, upto, edge = target[s] - times * total, 0, -1
        for value in sorted({h[k] for k in own}) if wanted > 0 else []:
            n = sum(size[k] for k in own if h[k] == value)
            if upto + n >= wanted:
                edge = value if (wanted - upto) * 2 >= n else edge
                break
            upto, edge = upto + n, value
        for k in own:
            copies[k] = times + (h[k] <= edge)
    return [r for r, n in zip(rows, copies, strict=True) for _ in range(n)]


def test_every_stage_against_a_plain_one(spark):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghijk"), int(rng.integers(2, 7))))
    passage = [word() for _ in range(40)]
    rows, labels = [], []
    for i in range(150):
        good, body = i % 5 != 0, [word() for _ in range(int(rng.integers(30, 70)))]
        if i % 6 == 1:
            body[9:9] = passage[int(rng.integers(0, 10)) :]
        if i % 7 == 2 and rows:
            body = (rows[-1][1] or "a").split()
            body[len(body) // 2] = word()  # a near copy
        rows.append((i, " ".join(body) + "." if good else " ".join(w.upper() + "!!" for w in body[:8] * 3) + " 123", ["a", "a", "a", "b", None][i % 5 if i % 3 else 0]))
        labels.append((i, int(good), 0))
    rows += [(900, None, "a"), (901, "", "b"), (902, " ".join(word() for _ in range(15000)), "b"), (903, rows[7][1], "a"), (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (904, "<|endoftext|> two  spaces\n ", None)]
    schema = "doc_id bigint, text string, source string, lang string, n_chars int, `_text` string, size long"
    docs = spark.createDataFrame([(i, t, s, "en", len(t or ""), "mine", 5) for i, t, s in rows], schema)
    labelled = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labelled)
    assert model.weighted
    key = lambda found: sorted(map(str, found))
    plain = [r for r in rows if model.predict(np.array([_statistics(r[1])]))[0] >= quality.THRESHOLD]

    def same(out, want):
        assert key((r["doc_id"], r["text"], r["source"]) for r in out.collect()) == key(want)
        assert out.columns == docs.columns and out.where("`_text` <> 'mine' or size <> 5").isEmpty()
        return spark.createDataFrame(out.collect(), docs.schema)

    docs = same(quality.kept_documents(docs, labelled), plain)
    with_words = [r for r in plain if (r[1] or "").split()]
    keepers = {min(g) for g in test_llm_neardup.brute([r[:2] for r in with_words])}
    kept, seen = [], set()
    for r in plain:
        if not (r[1] or "").split() or r[0] in keepers and r[0] not in seen:
            kept.append(r)
        seen.add(r[0])
    docs = same(corpus_pipeline.drop_near_duplicates(spark, docs, DIR), kept)
    kept = _without_repeats(kept)
    docs = same(corpus_pipeline.cut_repeated_substrings(spark, docs, DIR), kept)
    assert docs.where("n_chars <> length(text)").isEmpty()
    kept = _mixed(kept)
    docs = same(corpus_pipeline.mix_to_targets(spark, docs, DIR), kept)
    lib = Tokenizer.from_file(bpe.default_path())
    out = corpus_pipeline.encode(spark, docs, DIR).collect()
    assert key((r["doc_id"], tuple(r["ids"])) for r in out) == key((i, tuple(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in kept)
    assert len(kept) > 100 and len(kept) != len(rows)


def test_run_is_the_chain_of_the_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    key = lambda df: sorted((r["doc_id"], r["ids_sha256"]) for r in df.select("doc_id", "ids_sha256").collect())
    assert key(docs) == key(corpus_pipeline.run(spark, DIR))
