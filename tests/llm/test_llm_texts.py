import hashlib
import itertools
import math
import os
import subprocess

import numpy as np
import pyarrow as pa
import pytest

from notice_engine.llm import bpe, lm, media, substring, words
from notice_engine.llm.blocks import pack, pack_sorted, shard_edges, unpack, unpack_sorted
from notice_engine.llm.fmindex import FMIndex, WaveletMatrix

KIND = "doc_id bigint, text string, digest string, first int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", 1, 2) for i, t in rows], KIND)


def corpus(seed=0, n=120):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcde"), 3)) for _ in range(300)]
    passages = [[words[k] for k in rng.integers(300, size=int(rng.integers(5, 70)))] for _ in range(12)]
    rows = [(0, None), (1, ""), (2, " \t\x0b\n"), (3, "short text here"), (4, "long " * 30000), (5, "Ä b\u00a0c \u3000 d <|endoftext|>  e\n\n f")]
    for _ in range(n):
        t = [words[k] for k in rng.integers(300, size=int(rng.integers(0, 60)))]
        if rng.random() < 0.6:
            k = int(rng.integers(0, len(t) + 1))
            t[k:k] = passages[rng.integers(12)]
        rows.append((len(rows), "  \n".join(t) if rng.random() < 0.2 else " ".join(t)))
    rows += [(len(rows) + k, rows[40][1]) for k in range(8)]  # copies
    rows += [(41, rows[42][1]), (43, rows[43][1]), (None, rows[44][1]), (-1, rows[45][1])]  # ids that repeat, none, smaller
    return rows


def brute_substrings(rows):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - 12):
                g = tuple(w[k : k + 13])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_substrings_against_brute_force(spark):
    for seed in (0, 1):
        rows = corpus(seed)
        got = sorted((tuple(r) for r in substring.repeated(frame(spark, rows)).collect()), key=str)
        assert got == brute_substrings(rows)
    assert substring.repeated(frame(spark, rows).limit(0)).count() == 0


def test_substring_stage_keeps_columns_and_clean_texts(spark):
    rows = corpus(2)
    d = frame(spark, rows)
    out = substring.without_repeated_substrings(d)
    assert out.columns == d.columns and out.count() == len(rows)
    want = {(i, s): n for i, _, n, s in brute_substrings(rows)}
    whole = {i: t for i, t in rows}
    for r in out.collect():
        sha = hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest()
        assert (r["doc_id"], sha) in want
        if r["doc_id"] == 3:
            assert r["text"] == whole[3]


def test_matching_statistics_against_all_places():
    rng = np.random.default_rng(4)
    for _ in range(60):
        text, depth = np.append(0, rng.integers(0, 5, int(rng.integers(1, 200)))), int(rng.integers(1, 7))
        index = FMIndex(text, 4, depth, np.arange(len(text)))
        stream = rng.integers(0, 5, 60)
        stream[stream == 0] = -1  # words that the index does not hold
        cuts = [0, 20, 45, 60]
        size, low, high = index.matching_statistics(stream, np.array(cuts[:-1]), np.array(cuts[1:]))
        for a, b in zip(cuts, cuts[1:], strict=False):
            for i in range(a, b):
                places = []
                for n in range(1, min(depth, b - i) + 1):
                    met = [p for p in range(len(text) - n + 1) if (text[p : p + n] == stream[i : i + n]).all()]
                    if not met:
                        break
                    places = [n, met]
                assert size[i] == (places[0] if places else 0)
                assert not places or sorted(index.piece[low[i] : high[i]].tolist()) == places[1]


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_minimizers_are_split(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_TEXTS", hot)
    rng = np.random.default_rng(8)
    stock = "we may use cookies on this site".split()
    rows = [(i, " ".join([*rng.choice(list("abcdefgh"), int(rng.integers(0, 9))), *stock, *rng.choice(list("ab"), int(rng.integers(0, 9)))])) for i in range(150)]
    got = sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in substring.repeated(frame(spark, rows)).collect())
    first = {}
    for _, t in sorted(rows):
        w = t.split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), _)
    want = []
    for i, t in rows:
        w = t.split()
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want.append((i, len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    assert got == sorted(want)


def test_counts_beyond_32_and_53_bits():
    group, values = np.array([0, 1, 0]), np.array([2**53 + 1, 3, 2])
    assert lm._summed(group, values, 2).tolist() == [2**53 + 3, 3]
    asked = pa.table({"block": pa.array([0], pa.int32()), "digest": [b"x"], "text": [b"w " * 3000], "train": [2_000_000], "deleted": [0]})
    counted = lm._counted(pa.Table.from_batches([b for b in lm._asked(asked, 1).to_batches() if b["kind"][0].as_py() == 0]).slice(0, 1))
    assert sorted(unpack(counted["train"][0].as_py(), "<i8").tolist()) == [2_000_000, 6_000_000_000]


def test_wavelet_ranks():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 37, 300)
    w = WaveletMatrix(x, 36)
    v, lo = rng.integers(0, 37, 50), rng.integers(0, 301, 50)
    a, _ = w.ranks(v, lo, lo)
    assert (a == [(x[:k] == q).sum() for q, k in zip(v, lo, strict=True)]).all()


def test_packing():
    keys = np.unique(np.random.default_rng(6).integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (unpack_sorted(pack_sorted(keys)) == keys).all() and len(unpack_sorted(pack_sorted(keys[:0]))) == 0
    assert (unpack(pack(np.arange(5, dtype="<u4")), "<u4") == np.arange(5)).all()
    edges = shard_edges(keys, 7)
    assert edges[0] == 0 and edges[-1] == len(keys) and (np.diff(edges) >= 0).all()


def test_lm_counts_and_base_scores(spark):
    import zlib

    rows = [*corpus(3, 60), (400, "zzz Zzz unseen")]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    toks = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    count, pairs = {}, {}
    for i, ts in toks:
        if not held(i):
            for a, b in zip([0, *ts[:-1]], ts, strict=True):
                count[b] = count.get(b, 0) + 1
                pairs[a, b] = pairs.get((a, b), 0) + 1
    n, v = sum(count.values()), len(count)
    starts = sum(not held(i) for i, _ in rows)
    model = lm.Model(frame(spark, rows))
    assert (model.tokens, model.types, model.starts) == (n, v, starts)
    w = model.weights
    assert np.allclose(w.sum(axis=1), 1) and w[0, 2] == 0
    want = []
    for i, ts in toks:
        base = sum(math.log10((count.get(t, 0) + 1) / (n + v + 1)) for t in ts)
        score = 0.0
        for a, b in zip([0, *ts[:-1]], ts, strict=True):
            c = starts if a == 0 else count.get(a, 0)
            m = w[0 if c == 0 else min(c.bit_length(), lm.BUCKETS - 1)]
            score += math.log10(m[0] / (v + 1) + m[1] * count.get(b, 0) / n + m[2] * pairs.get((a, b), 0) / max(c, 1))
        want.append((i, held(i), len(ts), sum(t in count for t in ts), n, base, score))
    got = lm.scored(frame(spark, rows)).collect()
    order = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert tuple(a)[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 + 1e-9 * abs(b[5]) and abs(a[6] - b[6]) < 1e-6 + 1e-9 * abs(b[6])
    assert lm.scored(frame(spark, rows).limit(0)).count() == 0


def test_mixture_finds_the_likeliest_weights():
    rng = np.random.default_rng(7)
    p2, p1 = rng.random(500) * 0.5, rng.random(500) * 0.1
    w = lm.learn_mixture(np.full(500, 3), p2, p1, np.ones(500), 1e-4)
    fit = lambda a, b: np.log((1 - a - b) * 1e-4 + b * p1 + a * p2).sum()
    best = max(fit(a, b) for a in np.linspace(0.01, 0.98, 60) for b in np.linspace(0.005, 0.99 - a, 20))
    assert fit(w[3, 2], w[3, 1]) > best - 0.5


def test_bpe_against_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    lib = Tokenizer.from_file(path)
    odd = ["a" * 3000, " " * 300 + "b", "can't WON'T it's'll ſ'S", "日本語 テスト 😀😀 \u200d", "<|endoftext|><|endoftext|>x<|endoft", "\x00\x01\xad", "x\n \n y \n\n\nz  ", "   ", "1234567 8.9%$#@!", "\u2028 \u3000 a"]
    rows = corpus(5, 45) + [(500 + k, t) for k, t in enumerate(odd)]
    want = sorted((str(i), len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()) for i, t in rows for e in [lib.encode(t or "", add_special_tokens=False)])
    out = bpe.encoded(frame(spark, rows), path)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect())
    assert got == want and out.where("not round_trip").count() == 0 and out.where("size(ids) <> n_tokens").count() == 0
    assert bpe.encoded(frame(spark, rows).limit(0), path, False).count() == 0


def test_bpe_backtracks_exactly_on_random_pieces():
    import json

    path = bpe.default_path()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)["model"]
    letters = bpe._byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    ids = {raw(k): v for k, v in spec["vocab"].items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["merges"]]
    rank = {ids[raw(a)] << 32 | ids[raw(b)]: k for k, (a, b) in enumerate(pairs)}
    words = {v: k for k, v in ids.items()}
    v = bpe.vocabulary(path)
    rng = np.random.default_rng(1)
    pieces = ["".join(rng.choice(list("aeinrst hEo.\u00c3\u00e9"), int(rng.integers(0, 25)))) for _ in range(1500)] + ["ab" * 700, "\u00e9" * 900, ""]
    found, size = v.encode_pieces(pa.array(pieces))
    for piece, own in zip(pieces, np.split(found, np.cumsum(size)[:-1]), strict=True):
        assert own.tolist() == bpe._merged(piece.encode(), ids, rank, words)


def test_bpe_slices_and_white_space(monkeypatch):
    from tokenizers import Tokenizer

    lib, v = Tokenizer.from_file(bpe.default_path()), bpe.vocabulary(bpe.default_path())
    monkeypatch.setattr(bpe, "SLICE", 40)
    rng = np.random.default_rng(2)
    bits = [" ", "\n", "  ", "a", "the", " wor", "ld", "\t", "'s", "<|endoftext|>", "\u3000", "\x1c", "!", "zq", "12"]
    texts = ["".join(rng.choice(bits, int(rng.integers(0, 9)))) for _ in range(600)]
    ids, n = v.encode_all(texts)
    for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert own.tolist() == lib.encode(t, add_special_tokens=False).ids and v.decode(own) == t.encode()


def test_words_are_those_of_split():
    rng = np.random.default_rng(4)
    for _ in range(300):
        texts = [bytes(rng.choice(list(b"ab \t\n\r\x0b\x0c\x00"), int(rng.integers(0, 12))).astype(np.uint8)) for _ in range(int(rng.integers(0, 6)))]
        w = words.words_of(texts)
        got = [[bytes(w.data[a:b]) for a, b in zip(w.starts[i:j], w.ends[i:j], strict=True)] for i, j in zip(w.first, w.first[1:], strict=False)]
        assert got == [t.split() for t in texts] and (w.hashes() == words.hashes([x for t in texts for x in t.split()])).all()
    long = [b"x" * 200, b"y" * 64 + b"z", b"x" * 201, b"X" * 200]
    assert len(set(words.hashes(long).tolist())) == 4 and words.words_of(long).hashes(lower=True)[3] == words.hashes(long)[0]
    column = pa.array([None, b"", b"ab c", b"d" * 50], pa.binary()).slice(1)
    assert [list(r) for r in words.slices(column, 10)] == [[0, 2], [2, 3]] and len(words.words_of(column).starts) == 3


def test_media_round_trip(spark):
    rows = corpus(6, 60)
    long = "".join(chr(33 + k) for k in np.random.default_rng(0).integers(0, 90, 40000))
    rows += [(700, long), (701, "prefix " + long), (702, long + " suffix"), (703, long)]
    got = media.features(media.read_back(media.store(frame(spark, rows)))).collect()
    want = []
    for i, t in rows:
        raw = (t or "").encode()
        p = raw + bytes(64 * max(1, -(-len(raw) // 64)) - len(raw))
        want.append((str(i), len(raw), len(p), hashlib.sha256(p).hexdigest(), hashlib.sha256(media.wav(p)).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["media_sha256"]) for r in got) == sorted(want)
    assert media.features(media.read_back(media.store(frame(spark, rows).limit(0)))).count() == 0


def test_equal_stretches_are_stored_once(spark):
    long = "".join(chr(33 + k) for k in np.random.default_rng(0).integers(0, 90, 60000))
    rows = [(k, f"{k} " + long) for k in range(10)]
    for limit in (media.BROADCAST_ROWS, 0):
        old, media.BROADCAST_ROWS = media.BROADCAST_ROWS, limit
        stored = media.store(frame(spark, rows)).collect()
        media.BROADCAST_ROWS = old
        kept = sum(len(r["own"]) + sum(len(k["bytes"]) for k in r["kept"]) for r in stored)
        assert kept < 2.2 * 60000


def test_chunks_cover_and_resynchronise():
    data = np.random.default_rng(2).integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    parts = media.chunks(data)
    assert b"".join(parts) == data and max(map(len, parts)) <= media.MOST and 1500 < np.mean(list(map(len, parts))) < 4500
    assert len(set(media.chunks(b"xyz" + data)) & set(parts)) > 0.9 * len(parts)
    assert b"".join(media.chunks(bytes(100_000))) == bytes(100_000) and media.samples(media.wav(b"abc")) == b"abc"
    with pytest.raises(ValueError):
        media.samples(media.wav(b"abc") + b"x")


def test_library_works_without_the_subpackage(tmp_path):
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run(["cp", "-r", f"{top}/notice_engine", f"{top}/__spark_entry__.py", str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "notice_engine/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q"
    subprocess.run(["python", "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})


def test_minimizers_of_a_block_are_found_at_once(monkeypatch):
    rng = np.random.default_rng(6)
    lengths = [0, 12, 13, 1, 40, 0, 14, 200, 13, 5]
    texts = [" ".join(rng.choice(["a", "b", "c"], n)).encode() for n in lengths]
    own = words.words_of(texts)
    h, found = own.hashes(), []
    for k, (a, b) in enumerate(zip(own.first, own.first[1:], strict=False)):
        g = words.grams(h[a:b], substring.MINIMIZER).tolist()
        for p in range(b - a - substring.WINDOW + 1):
            inside = g[p : p + substring.WINDOW - substring.MINIMIZER + 1]
            found.append((k, a + p, a + p + inside.index(min(inside)), min(inside)))
    runs = [list(r) for _, r in itertools.groupby(found, lambda f: (f[0], f[2]))]
    got = list(zip(*[x.tolist() for x in substring.minimizer_runs(h, own.first)], strict=True))
    assert got == [(r[0][0], r[0][1], r[-1][1] + 1, int(words.mixed(np.array([r[0][3]], np.uint64))[0])) for r in runs]

    with monkeypatch.context() as small:
        small.setattr(substring, "WORDS_AT_ONCE", 30)
        assert got == list(zip(*[x.tolist() for x in substring.minimizer_runs(h, own.first)], strict=True))
    calls = []
    monkeypatch.setattr(substring, "grams", lambda *a: calls.append(1) or words.grams(*a))
    digest = [hashlib.md5(t).digest() for t in texts]
    block = pa.table({"block": pa.array([0] * 10, pa.int32()), "digest": digest, "text": pa.array(texts, pa.binary()), "first": pa.array(range(10), pa.int64())})
    asked = substring._asked(block, 3)
    substring._stretches(block, substring._shared(asked), 3)
    assert len(calls) == 2  # not one for each text
