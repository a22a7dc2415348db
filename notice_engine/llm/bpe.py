"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table.

A sequence of tokens is what the merges give exactly when each token is what the
merges give for its own bytes and each neighbouring pair is what they give for
the bytes of the two together. The encoder takes the longest token at each place
(from one pass of an Aho-Corasick automaton over the bytes) and asks a table of
token pairs whether it may follow the one before; if not, it tries the next
shorter token, and if none fits it steps back and shortens the one before. A
place from which no way led on is never entered twice, so the work is linear in
the length of the text. The pair table is filled as pairs occur: an entry
compares the merges along the two edges that meet.

Texts are encoded some megabytes at a time. They are cut before spaces, and each
different stretch is encoded once: one pass of the automaton gives the longest
matches of all its pieces, the pairs of all of them are looked up together, and only
pieces with a pair that may not be go back. Ids of the texts are then gathered from
those of their stretches. Decoding takes the bytes of all ids from one blob by a table
of offsets.

The vocabulary is compiled on the driver from the file and sent to the tasks, a few
megabytes; nothing is kept in a worker from one task to the next.

Text is split as the file's pre-tokenizer splits it, which must be the byte-level
one with its own pattern; tokens added to the file (``<|endoftext|>``) are cut out of
the text first and get their own ids.

Defined cases: null text is empty and has no tokens; texts of any length are
encoded whole, piece by piece; repeated rows give repeated rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.llm.lean import give_back, lean_batches
from notice_engine.llm.words import slices
from notice_engine.session import ship, table

#: Fixed value: how byte-level files of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that a cut before each space could divide: two in a row with a space as the second, next to more or at the end.
_RUNS = re.compile(r"\s \s|  |\s \Z")
#: Bytes of text encoded at once and, of those, gathered at once; and pieces looked up at once.
AT_ONCE, SLICE, PIECES = 16_000_000, 4_000_000, 50_000
#: Between pieces in the automaton's input; no token holds it.
_GAP = "Ā"
_NEVER = (1 << 31) - 1
#: Slots of the table of merges: 2 to this power.
_SLOT_BITS = 18
#: Pieces that go back are handled together, step by step; when so few are left, one after the other.
_FEW = 48


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the file: itself if it prints, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _spread(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of some runs that lie one after the other."""
    total = int(lengths.sum())
    kind = np.int32 if total < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) - np.repeat((np.cumsum(lengths) - lengths).astype(kind), lengths)


def _merged(raw: bytes, ids: dict[bytes, int], rank: dict[int, int], words: dict[int, bytes]) -> list[int]:
    """The merges, one after the other: lowest place first, leftmost first. For building the tables from short strings."""
    parts = [ids[raw[i : i + 1]] for i in range(len(raw))]
    while len(parts) > 1:
        ranks = [rank.get(a << 32 | b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        best = min(ranks)
        if best == _NEVER:
            break
        i = ranks.index(best)
        parts[i : i + 2] = [ids[words[parts[i]] + words[parts[i + 1]]]]
    return parts


class BytePairs:
    """One vocabulary, compiled to arrays: ``encode`` and ``decode``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("not a byte-level file with its own split and without normalisation")
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        ids = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        words = {v: k for k, v in ids.items()} | {v: k.encode() for k, v in self.added.items()}
        n = max(words) + 1
        #: bytes of token i: letters[offsets[i]:offsets[i + 1]]
        self.sizes = np.array([len(words.get(i, b"")) for i in range(n)], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.letters = np.frombuffer(b"".join(words.get(i, b"") for i in range(n)), np.uint8)
        left, right = (np.array([ids[as_bytes(m[k])] for m in merges], np.int64) for k in (0, 1))
        made = np.array([ids[as_bytes(a + b)] for a, b in merges], np.int64)
        self.merges = np.stack([left, right, made]).astype(np.int32)
        self._tables(n)
        #: tokens that their own bytes give; and for each the longest other that it starts with (-1: none)
        rank = {a << 32 | b: k for k, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True))}
        alone = {word: i for word, i in ids.items() if _merged(word, ids, rank, words) == [i]}
        self.shorter = np.full(n, -1, np.int64)
        for word, i in alone.items():
            self.shorter[i] = next((alone[word[:k]] for k in range(len(word) - 1, 0, -1) if word[:k] in alone), -1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, i in alone.items():
            self.automaton.add_word(word.decode("latin-1"), i)
        self.automaton.make_automaton()

    def _tables(self, n: int) -> None:
        """What follows from the list of merges; a task makes it anew."""
        left, right, made = self.merges.astype(np.int64)
        #: the pairs that merge, in a table of slots, with their places in the list of merges; and the pair that makes each token (-1: none)
        self._fill(left << 32 | right)
        self.made = np.full((3, n), -1, np.int64)  # left, right, place
        for row, values in enumerate((left, right, np.arange(len(left)))):
            self.made[row, made[::-1]] = values[::-1]
        #: at each end of a token: the tokens that lie there while it is being merged, each with the place of the merge that takes it in
        self.ends, self.starts = (self._edges(side) for side in (1, 0))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("pairs", "places", "made", "ends", "starts")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._tables(len(self.sizes))

    def _edges(self, side: int) -> tuple[np.ndarray, np.ndarray]:
        token, taken = np.arange(self.made.shape[1]), np.full(self.made.shape[1], _NEVER)
        tokens, places = [token], [taken]
        while (self.made[side][token] >= 0).any():
            inner = (token >= 0) & (self.made[side][token] >= 0)
            taken = np.where(inner, self.made[2][token], _NEVER)
            token = np.where(inner, self.made[side][token], -1)
            tokens.append(token)
            places.append(taken)
            if not (token >= 0).any():
                break
        return np.stack(tokens, 1).astype(np.int32), np.stack(places, 1).astype(np.int32)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _fill(self, pairs: np.ndarray) -> None:
        """Each pair goes to the first free slot from its own on."""
        bits = 1 << _SLOT_BITS
        if len(pairs) * 2 > bits:
            raise ValueError("too many merges for the table")
        self.pairs, self.places = np.full(bits, -1, np.int64), np.full(bits, _NEVER, np.int32)
        at, rest = self._slot(pairs), np.arange(len(pairs))
        while len(rest):
            spot, one = np.unique(at[rest], return_index=True)
            free = self.pairs[spot] < 0
            put = rest[one[free]]
            self.pairs[spot[free]], self.places[spot[free]] = pairs[put], put
            rest = np.setdiff1d(rest, put)
            at[rest] = (at[rest] + 1) % bits

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        """Places of pairs in the list of merges, or ``_NEVER``."""
        at = self._slot(pairs)
        out = self.places[at]
        rest = np.flatnonzero(self.pairs[at] != pairs)
        while len(rest):
            rest = rest[self.pairs[at[rest]] >= 0]  # an empty slot ends the search
            at[rest] = (at[rest] + 1) % len(self.pairs)
            out[rest] = self.places[at[rest]]
            rest = rest[self.pairs[at[rest]] != pairs[rest]]
        return np.where(self.pairs[at] == pairs, out, _NEVER)

    def may_follow(self, pairs: np.ndarray) -> np.ndarray:
        """For pairs of tokens (first << 32 | second): whether merging the bytes of both leaves the border between them alone.

        It does not if somewhere a token at the end of the first and one at the start of
        the second merge before either is taken in by its own neighbour; of equal merges
        the leftmost goes first.
        """
        good, open_ = np.ones(len(pairs), bool), np.arange(len(pairs))
        for i in range(self.ends[0].shape[1]):
            x = self.ends[0][pairs[open_] >> 32, i].astype(np.int64)
            open_, x = open_[x >= 0], x[x >= 0]
            x_taken = self.ends[1][pairs[open_] >> 32, i]
            now = np.arange(len(open_))
            for j in range(self.starts[0].shape[1]):
                b = pairs[open_[now]] & 0xFFFFFFFF
                y = self.starts[0][b, j]
                now, b, y = now[y >= 0], b[y >= 0], y[y >= 0]
                if not len(now):
                    break
                place = self._place(x[now] << 32 | y)
                merge = (place < x_taken[now]) & (place <= self.starts[1][b, j])
                good[open_[now[merge]]] = False
                now = now[~merge]
            open_ = open_[good[open_]]
            if not len(open_):
                break
        return good

    def _steps(self):
        """The same table for one pair at a time, and sizes and shorter tokens, as Python values."""
        used = self.pairs >= 0
        rank = dict(zip(self.pairs[used].tolist(), self.places[used].tolist(), strict=True))
        left, right, taken_at = (row.tolist() for row in self.made)
        known: dict[int, bool] = {}

        def fits(pair: int) -> bool:
            good = known.get(pair)
            if good is None:
                good, x, x_taken = True, pair >> 32, _NEVER
                while good and x >= 0:
                    y, y_taken = pair & 0xFFFFFFFF, _NEVER
                    while y >= 0:
                        place = rank.get(x << 32 | y, _NEVER)
                        if place < x_taken and place <= y_taken:
                            good = False
                            break
                        y, y_taken = left[y], taken_at[y]
                    x, x_taken = right[x], taken_at[x]
                known[pair] = good
            return good

        return fits, self.sizes.tolist(), self.shorter.tolist()

    def backtrack(self, raw: str, longest: dict[int, int], steps) -> list[int]:
        """Ids of one piece (its bytes as Latin-1 letters) from its longest matches (place -> token), by shortening and stepping back."""
        fits, sizes, shorter = steps
        n = len(raw)
        dead = bytearray(n + 1)
        chosen: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            before = chosen[-1] if chosen else -1
            while token >= 0:
                stop = at + sizes[token]
                if not dead[stop] and (before < 0 or fits(before << 32 | token)):
                    break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at = stop
                if at < n:
                    token = longest.get(at, -1)
                    if token < 0:
                        token = longest[at] = next(self.automaton.iter_long(raw, at))[1]
            elif chosen:
                dead[at] = 1
                token = chosen.pop()
                at -= sizes[token]
                token = shorter[token]
            else:
                raise ValueError("no tokens spell these bytes")
        return chosen

    def backtrack_all(self, letters: list[str], longest: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """:meth:`backtrack` for many pieces at once, one step of each at a time.

        ``longest`` has the known longest match at each place of all pieces together (-1:
        unknown); piece k lies at begin[k], with one place more than it has letters. A way
        is kept as the token that ends at each place on it. Returns the tokens of all
        ways, by place of their ends, those places, and the pieces that are left over.
        """
        ending, dead = np.full(len(longest) + 1, -1, np.int64), np.zeros(len(longest) + 1, bool)
        piece, at, token = np.arange(len(letters)), begin.copy(), longest[begin]
        while len(piece) > _FEW:
            tried = token >= 0
            stop = np.where(tried, at + self.sizes[token], at)
            good = tried & ~dead[stop]
            ask = np.flatnonzero(good & (at > begin[piece]))
            good[ask] = self.may_follow(ending[at[ask]] << 32 | token[ask])
            # no token is left: this place is dead, and the token before it is to be shorter
            back = np.flatnonzero(~tried)
            dead[at[back]] = True
            if (at[back] == begin[piece[back]]).any():
                raise ValueError("no tokens spell these bytes")
            token[back] = ending[at[back]]
            at[back] -= self.sizes[token[back]]
            token[~good] = self.shorter[token[~good]]
            # a token fits: go on behind it
            ending[stop[good]] = token[good]
            at = np.where(good, stop, at)
            going = at < begin[piece] + length[piece]
            piece, at, token, good = piece[going], at[going], token[going], good[going]
            next_ = longest[at]
            for k in np.flatnonzero(good & (next_ < 0)).tolist():
                w = int(piece[k])
                next_[k] = longest[at[k]] = next(self.automaton.iter_long(letters[w], int(at[k] - begin[w])))[1]
            token = np.where(good, next_, token)
        done = np.ones(len(letters), bool)
        done[piece] = False
        # read the ways from their ends
        places, at, start = [], (begin + length)[done], begin[done]
        while len(at):
            places.append(at)
            at = at - self.sizes[ending[at]]
            at, start = at[at > start], start[at > start]
        places = np.sort(np.concatenate([np.empty(0, np.int64), *places]))
        return ending[places], places, piece.tolist()

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        found_ids, found_sizes, steps = [np.empty(0, np.int64)], [np.empty(0, np.int64)], None
        for k in range(0, len(pieces), PIECES):
            letters = [p.encode().decode("latin-1") for p in pieces.slice(k, PIECES).to_pylist()]
            length = np.array([len(x) for x in letters])
            begin = np.cumsum(length + 1) - length - 1
            met = np.fromiter(chain.from_iterable(self.automaton.iter_long(_GAP.join(letters))), np.int64).reshape(-1, 2)
            ids, stop = met[:, 1], met[:, 0] + 1
            owner = np.searchsorted(begin, stop - 1, "right") - 1
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, back = np.unique(ids[inside] << 32 | ids[inside + 1], return_inverse=True)
            wrong = np.zeros(len(letters), bool)
            wrong[owner[inside[~self.may_follow(pairs)[back]]]] = True
            if wrong.any():
                longest = np.full(begin[-1] + length[-1] + 1, -1, np.int64)
                longest[stop - self.sizes[ids]] = ids
                right = ~wrong[owner]
                which = np.flatnonzero(wrong)
                own, ends, left = self.backtrack_all([letters[w] for w in which.tolist()], longest, begin[which], length[which])
                ids, stop = [ids[right], own], [stop[right], ends]
                for w in which[left].tolist():
                    steps = steps or self._steps()
                    start = begin[w]
                    known = longest[start : start + length[w]]
                    one = np.array(self.backtrack(letters[w], {i: int(known[i]) for i in np.flatnonzero(known >= 0).tolist()}, steps), np.int64)
                    ids.append(one)
                    stop.append(start + np.cumsum(self.sizes[one]))
                ids, stop = np.concatenate(ids), np.concatenate(stop)
                order = np.argsort(stop)
                ids, owner = ids[order], np.searchsorted(begin, stop[order] - 1, "right") - 1
            found_ids.append(ids)
            found_sizes.append(np.bincount(owner, minlength=len(letters)))
        return np.concatenate(found_ids), np.concatenate(found_sizes)

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, ids one after the other, how many each row has) for ranges of some megabytes of a string column."""
        split = regex.compile(SPLIT)
        cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        plain = np.array([not _RUNS.search(t) and not any(a in t for a in self.added) for t in map(pa.StringScalar.as_py, texts)], bool)
        # stretches: text up to a space, or with the space before it. Code: 2 * its place among the different ones, and 1 for a space
        parts = pc.split_pattern(pc.if_else(pa.array(plain), texts, ""), " ")
        counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten().dictionary_encode()
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int32) * 2 + 1
        code[(np.cumsum(counts) - counts)] -= 1
        names = words.dictionary.to_pylist()
        del parts, words
        seen = np.zeros(2 * len(names), bool)
        seen[code] = True
        code = (np.cumsum(seen) - 1).astype(np.int32)[code]
        stretches, found, n_stretch = np.flatnonzero(seen).tolist(), [], [np.empty(0, np.int64)]
        for k in range(0, len(stretches), PIECES):
            pieces = [split.findall(" " * (s & 1) + names[s >> 1]) for s in stretches[k : k + PIECES]]
            n_stretch.append(np.array([len(p) for p in pieces], np.int64))
            found.append(pa.array(chain.from_iterable(pieces), pa.large_string()))
        del names, stretches
        # texts with runs of white space or added tokens are pieces of their own
        odd = {}
        for k in np.flatnonzero(~plain).tolist():
            text = texts[k].as_py()
            odd[k] = [x for t in (cut.split(text) if cut else [text]) for x in ([t] if t in self.added else split.findall(t))]
        n_stretch, n_odd = np.concatenate(n_stretch), np.array([len(p) for p in odd.values()], np.int64)
        found.append(pa.array(chain.from_iterable(odd.values()), pa.large_string()))
        del odd
        flat = pa.concat_arrays(found).dictionary_encode()
        piece_of, known = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
        del found, flat
        is_added = pc.is_in(known, pa.array(self.added, pa.large_string()))
        added = np.flatnonzero(is_added.to_numpy(zero_copy_only=False))
        ids, size = self.encode_pieces(pc.if_else(is_added, "", known))
        if len(added):
            ids = np.insert(ids, (np.cumsum(size) - size)[added], [self.added[known[i].as_py()] for i in added.tolist()])
            size[added] = 1
        del known
        ids = ids.astype("<u4")
        # ids of stretches, then of texts
        stretch_ids, stretch_size = _gathered(ids, size, piece_of[: n_stretch.sum()], n_stretch)
        odd_ids, odd_size = _gathered(ids, size, piece_of[n_stretch.sum() :], n_odd)
        del ids, size, piece_of
        code_stop, odd_stop, odd_row = np.cumsum(counts), np.cumsum(odd_size), np.cumsum(~plain)
        for a, b in slices(texts.cast(pa.large_binary()), SLICE):
            first = code_stop[a] - counts[a]
            out, n = _gathered(stretch_ids, stretch_size, code[first : code_stop[b - 1]], counts[a:b])
            if not plain[a:b].all():
                stop, joined = np.cumsum(n), []
                upto = 0
                for k in np.flatnonzero(~plain[a:b]).tolist():  # such a text is one empty stretch so far
                    row = odd_row[a + k] - 1
                    joined += [out[upto : stop[k]], odd_ids[odd_stop[row] - odd_size[row] : odd_stop[row]]]
                    upto, n[k] = stop[k], odd_size[row]
                out = np.concatenate([*joined, out[upto:]])
            yield a, b, out, n

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        found = list(self.encode_column(pa.array(texts, pa.string()))) if texts else []
        return tuple(np.concatenate([empty, *[f[k] for f in found]]) for k, empty in ((2, np.empty(0, "<u4")), (3, np.empty(0, np.int64))))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens, gathered from one blob by the offset table."""
        return self._decoded(ids).tobytes()

    def _decoded(self, ids: np.ndarray) -> np.ndarray:
        ids = ids.astype(np.int64)
        sizes = self.sizes[ids]
        return self.letters[np.repeat(self.offsets[ids], sizes) + _spread(sizes)] if len(ids) else self.letters[:0]


def _gathered(values: np.ndarray, sizes: np.ndarray, which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs (given by ``sizes``) ``which`` of ``values``, one after the other, and how many values the first counts[0], next counts[1], ... runs have."""
    n = sizes[which]
    out = values[np.repeat((np.cumsum(sizes) - sizes)[which], n) + _spread(n)]
    upto = np.concatenate([[0], np.cumsum(n)])
    stop = np.cumsum(counts)
    return out, upto[stop] - upto[stop - counts]


def _valid(column: pa.Array) -> pa.Array:
    """Bytes as text; null is empty, bytes that are not UTF-8 are replaced."""
    try:
        text = column.cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([None if raw is None else raw.decode("utf-8", "replace") for raw in column.to_pylist()], pa.string())
    return pc.fill_null(text, "")


def vocabulary(path: str) -> BytePairs:
    """Compiled on the driver, which does not keep it."""
    try:
        return BytePairs(path)
    finally:
        give_back()


def encoded(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>, if ``keep_ids``), ids_sha256, decoded_sha256 and round_trip for each row. ``path`` is read on the driver."""
    ship(docs.sparkSession)
    v = vocabulary(path)

    def rows(raws: pa.Array, ids: np.ndarray, n: np.ndarray) -> dict[str, pa.Array]:
        stop = np.cumsum(n)
        shas, backs, whole = [], [], []
        for raw, a, b in zip(raws, (stop - n).tolist(), stop.tolist(), strict=True):
            raw, own = raw.as_py() or b"", ids[a:b]
            back = v.decode(own)
            if back != raw:
                back = back.decode("utf-8", "replace").encode()
            shas.append(hashlib.sha256(own).hexdigest())
            backs.append(hashlib.sha256(back).hexdigest())
            whole.append(back == raw)
        out = {"n_tokens": pa.array(n, pa.int64())}
        if keep_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]), pa.int32()), pa.array(ids.view("<i4")))
        return out | {"ids_sha256": pa.array(shas, pa.string()), "decoded_sha256": pa.array(backs, pa.string()), "round_trip": pa.array(whole, pa.bool_())}

    @lean_batches
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column(1), AT_ONCE):
                part = batch.slice(start, stop - start)
                for a, b, ids, n in v.encode_column(_valid(part.column(1))):
                    made = rows(part.column(1).slice(a, b - a), ids, n)
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), *made.values()], names=["doc_id", *made])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, " + "ids array<int>, " * keep_ids + "ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), default_path(), keep_ids=False)
