import gzip
import hashlib
import pathlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from notice_engine.llm import chat, topk, warc


def test_instruction_template_is_reversible():
    rng = np.random.default_rng(0)
    bits = [*chat.CONTROLS, "\\", "\\\\", " ", "\n", "a", "[", "<", "/", "s>", "INST]"]
    for _ in range(300):
        turns = [("".join(rng.choice(bits, 3)), "".join(rng.choice(bits, int(rng.integers(0, 9))))) for _ in range(int(rng.integers(0, 4)))]
        out = chat.instruction_template(turns)
        assert chat.read_back(out) == turns
        found = chat.incremental(turns, chat.instruction_template)
        assert not found.rewrites_history and [chat.unescaped(out[a:b]) for a, b in found.contents] == [t for _, t in turns]
        assert "".join(out[a:b] for a, b in found.turns) == out


def test_rewriting_templates_are_noticed():
    def forgetful(turns):  # earlier texts are cut
        return "".join(f"<{r}>{t if k == len(turns) - 1 else t[:2]};" for k, (r, t) in enumerate(turns))

    turns = [("u", "hello there"), ("a", "answer"), ("u", "more")]
    found = chat.incremental(turns, forgetful)
    assert found.rewrites_history and [found.text[a:b] for a, b in found.contents] == ["he", "an", "more"]
    assert not chat.incremental(turns[:1], forgetful).rewrites_history
    silent = chat.incremental(turns, lambda ts: "".join(r for r, _ in ts))
    assert all(a == b for a, b in silent.contents)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (None, 0, "assistant", "n"), (3, None, "assistant", "first"), (3, 0, "assistant", "ü" * 50000), (4, 0, "user", "</s>[INST] ok [/INST]"), (4, 1, "assistant", "\\</s>")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, n_turns int")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {1: ([("user", ""), ("assistant", "b")], "b"), 2: ([("", "x"), ("", "x")], ""), None: ([("assistant", "n")], "n"), 3: ([("assistant", "first"), ("assistant", "ü" * 50000)], "first" + "ü" * 50000), 4: ([("user", "</s>[INST] ok [/INST]"), ("assistant", "\\</s>")], "\\</s>")}
    assert set(got) == set(want)
    for k, (turns, loss) in want.items():
        assert (got[k]["n_turns"], got[k]["turns_sha256"], got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    assert chat.format_conversations(df.limit(0)).count() == 0


def brute_topk(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in ok:
        if i % 50 == 0:
            asked.setdefault((i, tuple(v)), v)
    for (i, _), v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ok if j != i and len(w) == len(v))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], start=1)]
    return sorted(out)


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = [rng.normal(0, 0.2, 8).astype(np.float32).tolist() for _ in range(40)]
    rows = [(int(i), base[rng.integers(40)] if rng.random() < 0.3 else rng.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + k, base[0]) for k in range(60)]  # many equal vectors
    rows += [(2000, None), (2001, [None] * 8), (2050, [float("nan")] * 8), (2002, [float("inf")] * 8), (None, base[1]), (2100, [0.5, 0.5]), (2101, [1.0, -1.0]), (2150, []), (50, rows[50][1]), (7, base[3])]
    df = spark.createDataFrame([(i, v, 1, "p") for i, v in rows], "vec_id bigint, embedding array<float>, id int, v string")

    def run(d):
        use = d.where(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding")))
        return topk.top_k(use.select(F.col("vec_id").alias("id"), topk.integers(F.col("embedding")).alias("v")), F.col("id") % 50 == 0, 5)

    assert sorted(map(tuple, run(df).collect())) == brute_topk(rows, 5)
    assert run(df.limit(0)).count() == 0 and run(df.where("vec_id = 50").limit(1)).count() == 0


def test_bounds_skip_candidates():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 1, (500, 6)) for c in (0, 40, 80, 120)]).round()
    pivots = x[::250]
    table = topk._distances(x, pivots)
    found, evaluated = topk.best_in_block(np.array([1999]), x[-1:], table[-1:], np.array([-np.inf]), np.arange(2000), x, table, 5)
    scores = x @ x[-1]
    scores[1999] = -(10**9)
    assert [f[2] for f in found] == sorted(scores.tolist(), reverse=True)[:5] and evaluated < 1000


def test_candidates_are_dropped_before_they_are_sent(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 100)
    rng = np.random.default_rng(6)
    rows = [(int(i), (rng.normal(0, 0.05, 6) + np.eye(6)[i % 6] * 4).astype(np.float32).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    vectors = df.select(F.col("vec_id").alias("id"), topk.integers(F.col("embedding")).alias("v"))
    pairs = topk.scored_pairs(vectors, F.col("id") % 50 == 0, 5)
    assert sorted(map(tuple, topk.best_of(pairs, 5).collect())) == brute_topk(rows, 5)
    assert pairs.agg(F.sum("evaluated")).first()[0] < 24 * 1200 / 3  # a third of all pairs at most


def test_components_of_any_size(spark):
    rows = [(0, [1e10, 0.0]), (50, [1.5e10, -3.0]), (1, [2.0**45, 1.0]), (2, [0.25, 1e9]), (3, [-7.0, 0.3])]
    run = lambda r: topk.top_k(spark.createDataFrame(r, "id bigint, v array<double>").where(topk.usable(F.col("v"))).select("id", topk.integers(F.col("v")).alias("v")), F.col("id") % 50 == 0, 5)
    small = [(i, [x / 2**20 for x in v]) for i, v in rows]
    assert sorted(map(tuple, run(small).collect())) == brute_topk(small, 5)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        run([(0, [1e12]), (1, [1e12])]).collect()
    with pytest.raises(Exception, match="beyond a double"):
        run([(0, [1e308]), (1, [1.0])]).collect()
    assert run([(0, [1e12]), (1, [1e-3]), (2, [0.0])]).count() == 2


def test_probe_when_all_letters_occur():
    every = "".join(map(chr, range(0xE000, 0xF900)))
    turns = [("user", every), ("assistant", every[::-1] + "x")]
    found = chat.incremental(turns, chat.instruction_template)
    assert [found.text[a:b] for a, b in found.contents] == [t for _, t in turns]


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "f", 2) for r in rows], "page_id bigint, url string, html string, seq int, file string, start int")


def _archive(spark, rows, label):
    return warc.read_files(spark, warc.write_files(rows, label))


def test_audit_finds_exactly_the_damage(spark):
    rows = [(k, f"http://h/{k}", f"<p>{'x' * (k % 37)}</p>\r\n\r\nmore") for k in range(300)] + [(None, None, None), (None, "u", ""), (5, "http://h/5", "<p>x</p>"), (5, "http://h/5", "<p>x</p>"), (900, "long", "y" * 200000)]
    d = pages(spark, rows)
    same = warc.fixity(d, lambda p: p)
    assert same.where("finding <> 'ok'").count() == 0 and same.count() == len(rows)
    assert sorted(str(r["page_id"]) for r in same.collect()) == sorted(str(r[0]) for r in rows)
    placed = warc.placed(d)
    hurt = F.when(F.col("page_id").isin(17, 140), F.concat(F.lit("DAMAGE"), F.substr("html", F.lit(7)))).otherwise(F.col("html"))
    left, right = _archive(spark, placed, "l"), _archive(spark, placed.withColumn("html", hurt), "r")
    found, compared = warc.audit(left, right)
    assert {(r["id"], r["finding"]) for r in found.collect()} == {("17", "bytes"), ("140", "bytes")} and compared < 2 * len(rows)
    # one record lost, one twice: the others have only moved
    other = placed.where("page_id is null or page_id <> 30").unionByName(placed.where("page_id = 8").withColumn("html", F.lit("new")))
    got = warc.audit(left, _archive(spark, other, "m"))[0].collect()
    assert sorted((r["id"], r["finding"]) for r in got if r["finding"] != "moved") == [("30", "missing"), ("8", "extra")]
    assert all(r["id"] not in ("30", "8") or r["finding"] != "moved" or r["id"] == "8" for r in got)
    assert warc.fixity(d.limit(0)).count() == 0


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rows = warc.placed(pages(spark, [(1, "u", f"page {k}") for k in range(1000)]))
    assert rows.groupBy("file").count().agg(F.max("count")).first()[0] < 200


def test_records_offsets_and_digests(spark):
    rows = [(3, "http://h/\r\nx", "é\r\n\r\nWARC/1.1"), (None, None, None), (12, "u", "b" * 100)]
    (folder,) = [warc.write_files(warc.placed(pages(spark, rows)), "t")]
    content = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(folder).collect())
    want, at = [], 0
    for name, url, html in (("", "", ""), ("3", "http://h/  x", "é\r\n\r\nWARC/1.1"), ("12", "u", "b" * 100)):
        body = html.encode()
        record = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: {url}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
        want.append((name, at, len(record), hashlib.sha256(record).hexdigest()))
        at += len(record)
    got = [(r["id"], r["start"], r["size"], r["sha256"]) for r in warc.read_files(spark, folder).orderBy("file", "seq").collect()]
    assert got == want and len(content) == at  # all in one file
    assert list(warc.records_in(content + b"junk"))[-1][0] is None and list(warc.records_in(b"")) == []


def test_damage_is_found_in_the_query(spark):
    rows = [(k, f"u{k}", f"<p>text {k} {'z' * 50}</p>") for k in range(400)]
    mark = {k: zlib.crc32(str(k).encode()) for k in range(400)}
    lost = {k for k, m in mark.items() if m % 103 == 9}
    hurt = {k for k, m in mark.items() if m % 97 == 5 or m % 101 == 7} - lost
    added = {k for k, m in mark.items() if m % 107 == 11} - lost
    got = warc.fixity(pages(spark, rows)).collect()
    pick = lambda f: {r["page_id"] for r in got if r["finding"] == f}
    assert (pick("bytes"), pick("missing"), pick("extra")) == (hurt, lost, added) and hurt and lost and added
    assert len([r for r in got if r["finding"] != "extra"]) == 400


def test_gzip_files_give_the_records_of_plain_ones(spark):
    rows = warc.placed(pages(spark, [(k, f"u{k}", f"<p>{'z' * (k * 7 % 90)} é</p>\r\n\r\n") for k in range(200)]))
    read = lambda codec: sorted(map(tuple, warc.read_files(spark, warc.write_files(rows, "z", codec)).collect()))
    assert read("gzip") == read("none") and len(read("none")) == 200
    noise = np.random.default_rng(1).integers(0, 256, 50_000, dtype=np.uint8).tobytes()
    stored = gzip.compress(noise)
    assert warc.plain(stored) == warc.plain(noise) == noise and warc.plain(b"") == b""
    assert warc.plain(gzip.compress(b"ab") + gzip.compress(b"") + stored) == b"ab" + noise
    assert warc.plain(stored[:-3]) == noise + b"\0"
    hurt = stored[:20_000] + bytes(40) + stored[20_040:]
    assert warc.plain(hurt) != noise and warc.plain(hurt)[:15_000] == noise[:15_000]


def test_replicas_take_less_than_the_pages(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    held = lambda: sum(f.stat().st_size for f in pathlib.Path(root).glob("notice-warc-*/**/*") if f.is_file())
    html = ["".join(np.random.default_rng(k).choice(list("abcdefgh"), 20_000)) for k in range(60)]
    before, setting = held(), spark.conf.get(warc.CLEANUP)
    assert warc.fixity(pages(spark, [(k, f"u{k}", h) for k, h in enumerate(html)])).count() >= 60
    assert held() - before < 60 * 20_000 and spark.conf.get(warc.CLEANUP) == setting
