"""Byte-level BPE: propose tokens greedily, check every adjacent pair, merge only what fails.

Each distinct word of a slice of text is covered by the longest tokens that fit, from the left.
That is the BPE result if each token is the result for its own bytes and no merge would ever
cross a boundary of the proposal. Whether one does depends on the two tokens at the boundary
only: merges happen in order of rank, so at any rank the two pieces that meet there are known
from how the two tokens are built. All adjacent pairs are walked down together in arrays. Words
with a failing pair, few of them, are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from basketry.llm import words as W
from basketry.llm.ship import ship

#: Fixed value: how byte-level vocabularies of this kind cut text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 150_000
LONG_WORD = 256
WORDS_AT_ONCE = 100_000
NEVER = int(np.iinfo(np.int64).max)
_RUN = re.compile(r" \s|\s ")


def _byte_symbols() -> dict[str, int]:
    """The character by which such vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of each token, merges as (left, right, result) in order of rank, special tokens."""

    tokens: list[bytes]
    merges: np.ndarray
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level BPE vocabulary")
        ids, symbols = spec["model"]["vocab"], _byte_symbols()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for name, i in ids.items():
            tokens[i] = bytes(symbols[c] for c in name)
        for name, i in special.items():
            tokens[i] = name.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        return cls(tokens, np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int64), special)


class Coder:
    """Encodes and decodes words; holds the tables and a bounded cache of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        tokens, merges = vocabulary.tokens, vocabulary.merges
        self.size = len(tokens)
        self.special = vocabulary.special
        plain = {t: i for i, t in enumerate(tokens) if t and i not in set(self.special.values())}
        self.byte_ids = np.array([plain[bytes([b])] for b in range(256)], np.int64)
        self._plant(plain)
        ranks = np.arange(len(merges))
        self.rank = np.full(self.size, -1, np.int64)
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.rank[merges[:, 2]], self.left[merges[:, 2]], self.right[merges[:, 2]] = ranks, merges[:, 0], merges[:, 1]
        keys = merges[:, 0] * self.size + merges[:, 1]
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], ranks[order]
        self.rank_of = {(int(a), int(b)): r for r, (a, b, _) in enumerate(merges)}
        self.result = merges[:, 2]
        self.bytes_flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.bytes_size = np.array([len(t) for t in tokens], np.int64)
        self.bytes_start = np.cumsum(self.bytes_size) - self.bytes_size
        self.whole = self._whole_tokens(tokens)
        self._clear()
        self._cut = regex.compile(WORD_PATTERN)
        self._split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    # The cache: word -> number; the tokens of all numbered words in one row.

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q")
        if self.special:
            self._add(list(self.special), np.array(list(self.special.values())), np.ones(len(self.special), np.int64))

    def _add(self, words: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.ends), len(self.ends) + len(words))))
        self.ends.frombytes((len(self.flat) + np.cumsum(count)).astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.int32).tobytes())

    def _plant(self, tokens: dict[bytes, int]) -> None:
        """The tree of all token prefixes: edges (node, byte) in order, and the token at a node."""
        nodes, edges = {b"": 0}, {}
        for token in tokens:
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    edges[nodes[token[: end - 1]] * 256 + token[end - 1]] = nodes[token[:end]]
        self._edges = np.array(sorted(edges), np.int64)
        self._child = np.array([edges[int(k)] for k in self._edges], np.int64)
        self._token = np.full(len(nodes), -1, np.int64)
        for token, i in tokens.items():
            self._token[nodes[token]] = i

    def _whole_tokens(self, tokens: list[bytes]) -> np.ndarray:
        """Whether merging a token's own bytes gives the token."""
        some = [i for i, t in enumerate(tokens) if t]
        ids, count = self.merged(
            np.frombuffer(b"".join(tokens[i] for i in some), np.uint8), np.array([len(tokens[i]) for i in some])
        )
        first = ids[np.cumsum(count) - count]
        out = np.zeros(self.size, bool)
        out[some] = (count == 1) & (first == some)
        return out

    # Pairs

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, key), self._keys.size - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses from token a into token b.

        Going back in rank, the piece formed last is taken apart; of two equal tokens the left
        one is formed first. A merge of the two pieces that meet happens if it comes before
        each is used up in its own token; at equal rank the left one goes first.
        """
        out = np.ones(a.size, bool)
        row = np.arange(a.size)
        until_a, until_b = np.full(a.size, NEVER), np.full(a.size, NEVER)
        while row.size:
            rank = self.merge_rank(a, b)
            crossed = (rank < until_a) & (rank <= until_b) & (rank != NEVER)
            out[row[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            row, a, b, ra, rb = row[go], a[go], b[go], ra[go], rb[go]
            until_a, until_b = until_a[go], until_b[go]
            first = ra > rb
            until_a, until_b = np.where(first, ra, until_a), np.where(first, until_b, rb)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    # Words

    def propose(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cover each word (its bytes in a row, `size` of them) by the longest tokens that fit,
        from the left. All words walk down a tree of token prefixes at the same time. Gives the
        tokens in a row and the number of tokens of each word."""
        ends = np.cumsum(size)
        row, at, tokens, owner = np.arange(size.size), ends - size, [], []
        while row.size:
            live = np.arange(row.size)
            node, deep = np.zeros(row.size, np.int64), at.copy()
            best, stop = np.full(row.size, -1, np.int64), at.copy()
            while live.size:
                key = node[live] * 256 + data[deep[live]]
                slot = np.minimum(np.searchsorted(self._edges, key), self._edges.size - 1)
                found = self._edges[slot] == key
                live, slot = live[found], slot[found]
                node[live] = self._child[slot]
                deep[live] += 1
                token = self._token[node[live]]
                hit = token >= 0
                best[live[hit]], stop[live[hit]] = token[hit], deep[live[hit]]
                live = live[deep[live] < ends[row[live]]]
            tokens.append(best)
            owner.append(row)
            more = stop < ends[row]
            row, at = row[more], stop[more]
        flat, own = np.concatenate(tokens), np.concatenate(owner)
        return flat[np.argsort(own, kind="stable")], np.bincount(own, minlength=size.size)

    def merged(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging, in the same form: in each word the pair of the lowest rank first, the
        leftmost of equal ones; one merge in every word at a time."""
        tok = self.byte_ids[data]
        own = np.repeat(np.arange(size.size), size)
        rank = np.full(tok.size, NEVER)
        inner = np.flatnonzero(own[1:] == own[:-1])
        rank[inner] = self.merge_rank(tok[inner], tok[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while tok.size:
            start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            low = np.minimum.reduceat(rank, start)
            count = np.diff(np.append(start, tok.size))
            still = np.repeat(low != NEVER, count)
            done.append((tok[~still], own[~still]))
            at = np.flatnonzero(still & (rank == np.repeat(low, count)))
            if at.size == 0:
                break
            at = at[np.concatenate([[True], own[at[1:]] != own[at[:-1]]])]
            tok[at] = self.result[rank[at]]
            keep = still
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            tok, own, rank = tok[keep], own[keep], rank[keep]
            at = place[at]
            at = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[at] = NEVER
            at = at[at + 1 < tok.size]
            at = at[own[at] == own[at + 1]]
            rank[at] = self.merge_rank(tok[at], tok[at + 1])
        flat = np.concatenate([np.zeros(0, np.int64), *[t for t, _ in done]])
        owner = np.concatenate([np.zeros(0, np.int64), *[o for _, o in done]])
        return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=size.size)

    def _merged_long(self, word: bytes) -> list[int]:
        """The same with a heap, for words of any length."""
        ids = [int(self.byte_ids[b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(p: int, q: int) -> None:
            if p >= 0 and q < len(ids):
                rank = self.rank_of.get((ids[p], ids[q]))
                if rank is not None:
                    heapq.heappush(heap, (rank, p, ids[p], ids[q]))

        for i in range(len(ids) - 1):
            offer(i, i + 1)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.result[rank]), -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str]) -> None:
        """Encode new words into the cache."""
        if not words:
            return
        raw = [w.encode() for w in words]
        for w, r in zip(words, raw):
            if len(r) > LONG_WORD:
                ids = np.array(self._merged_long(r), np.int32)
                self._add([w], ids, np.array([ids.size]))
        if len(long := [w for w, r in zip(words, raw) if len(r) > LONG_WORD]):
            words = [w for w in words if w not in set(long)]
            return self.learn(words)
        data = np.frombuffer(b"".join(raw), np.uint8)
        size = np.array([len(r) for r in raw], np.int64)
        flat, count = self.propose(data, size)
        owner = np.repeat(np.arange(size.size), count)
        failing = np.zeros(size.size, bool)
        failing[owner[~self.whole[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing[owner[inner[~good[place]]]] = True
        again = np.flatnonzero(failing)
        if again.size:
            start = np.cumsum(size) - size
            exact, n = self.merged(data[W.spread(start[again], size[again])], size[again])
            keep = ~failing[owner]
            flat, owner = np.concatenate([flat[keep], exact]), np.concatenate([owner[keep], np.repeat(again, n)])
            flat = flat[np.argsort(owner, kind="stable")]
            count[again] = n
        self._add(words, flat, count)

    def _strings(self, text: str) -> Iterator[str]:
        """Cut a text where a new word surely begins: before a space between two characters that
        are not white space, and around special tokens."""
        for part in self._split.split(text) if self._split else [text]:
            if part in self.special or not part:
                yield from [part] if part else []
            elif _RUN.search(part):
                yield from (m[0] for m in self._cut.finditer(part))
            else:
                first, *rest = part.split(" ")
                yield from [first] if first else []
                yield from (" " + r for r in rest)

    def _numbers(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > CACHED_WORDS:
            self._clear()
        known = self.number
        if new := [s for s in set(strings) if s not in known]:
            cut = {s: [s] if s[1:].isalpha() and (s[0] == " " or s[0].isalpha()) else self._cut.findall(s) for s in new}
            self.learn([w for w in {w for words in cut.values() for w in words} if w not in known])
            several = [s for s, words in cut.items() if len(words) > 1]
            if several:
                ids, count = self._known([w for s in several for w in cut[s]])
                total = np.concatenate([[0], np.cumsum(count)])
                ends = np.cumsum([len(cut[s]) for s in several])
                self._add(several, ids, np.diff(total[np.concatenate([[0], ends])]))
        return self._known(strings)

    def _known(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.number.__getitem__, strings), np.int64, len(strings))
        ends = np.frombuffer(self.ends, np.int64)
        start = np.where(at > 0, ends[at - 1], 0)
        count = ends[at] - start
        return np.frombuffer(self.flat, np.int32)[W.spread(start, count)], count

    def encode(self, text: str) -> np.ndarray:
        """Token ids; a very long text is worked through in pieces."""
        out, stream = [np.zeros(0, np.int32)], self._strings(text)
        while strings := list(islice(stream, WORDS_AT_ONCE)):
            out.append(self._numbers(strings)[0])
        return np.concatenate(out)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        if sum(map(len, texts)) > 8 * W.CHUNK_BYTES:
            each = [self.encode(t) for t in texts]
            return np.concatenate(each), np.array([e.size for e in each], np.int64)
        strings: list[str] = []
        ends = []
        for t in texts:
            strings += self._strings(t)
            ends.append(len(strings))
        if not strings:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ids, count = self._numbers(strings)
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(total[[0, *ends]])

    def decode_all(self, ids: np.ndarray, size: np.ndarray) -> pa.Array:
        """The text of each row of ids; bytes that are not UTF-8 become U+FFFD."""
        ids = ids.astype(np.int64)
        length = self.bytes_size[ids]
        raw = self.bytes_flat[W.spread(self.bytes_start[ids], length)].tobytes()
        total = np.concatenate([[0], np.cumsum(length)])
        cut = np.concatenate([[0], total[np.cumsum(size)]])
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])], pa.string())


_coders: dict[str, Coder] = {}


def _coder(key: str, shared) -> Coder:
    """One per worker process."""
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(shared.value)
    return _coders[key]


def _lists(ids: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))


def _shared(df: DataFrame, path: str):
    ship(df.sparkSession)
    # One vocabulary file; its size does not depend on the data.
    return df.sparkSession.sparkContext.broadcast(Vocabulary.read(path))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The frame with a column of token ids, array<int>. A null text counts as empty and an
    empty text has no ids. A column already called `ids` is replaced; all other columns, rows
    and their order stay."""
    shared = _shared(docs, path)
    base = docs.drop(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            for first, part in W.chunks(batch.column(text)):
                flat, size = coder.encode_all([t or "" for t in part.to_pylist()])
                rows = batch.slice(first, len(part))
                yield pa.RecordBatch.from_arrays([*rows.columns, _lists(flat, size)], [*rows.schema.names, ids])

    return base.mapInArrow(run, base.withColumn(ids, F.lit(None).cast("array<int>")).schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The frame with the text of a column of token ids. Null ids give an empty text. A column
    already called `text` is replaced. Ids that the vocabulary lacks raise an error."""
    shared = _shared(docs, path)
    base = docs.drop(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                column = rows.column(ids)
                size = np.array([len(x) if x is not None else 0 for x in column], np.int64)
                flat = np.asarray(column.flatten())
                out = coder.decode_all(flat, size)
                yield pa.RecordBatch.from_arrays([*rows.columns, out], [*rows.schema.names, text])

    return base.mapInArrow(run, base.withColumn(text, F.lit("")).schema)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encode and decode in one pass over the rows, with one Python worker per task: the frame
    with both columns, and without the text itself."""
    shared = _shared(docs, path)
    base = docs.drop(ids, decoded)
    kept = base.drop(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            names = [c for c in batch.schema.names if c != text]
            for first, part in W.chunks(batch.column(text)):
                flat, size = coder.encode_all([t or "" for t in part.to_pylist()])
                rows = batch.slice(first, len(part))
                columns = [*[rows.column(c) for c in names], _lists(flat, size), coder.decode_all(flat, size)]
                yield pa.RecordBatch.from_arrays(columns, [*names, ids, decoded])

    schema = kept.withColumn(ids, F.lit(None).cast("array<int>")).withColumn(decoded, F.lit("")).schema
    return base.mapInArrow(run, schema)
