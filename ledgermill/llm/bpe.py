"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Encoding a word starts from one symbol per byte. The leaves of a segment tree
hold the merge rank of every adjacent pair with its place, so that the root is
the leftmost pair of the lowest rank. A merge changes three leaves at most, each
updated along one path to the root, until the root holds no mergeable pair:
n log n for a word of n bytes, also for one of millions of bytes. The trees of
all new words of a batch are updated together, one numpy operation per step;
a word of more than `LONG_WORD` bytes has a tree of its own in plain lists,
where a single update is far cheaper.

A text is cut into special tokens, pieces (see `pieces`) and words by the
pattern of the vocabulary; equal words are encoded once per worker, up to
`CACHE_WORDS`. Null and empty texts have no ids and decode to the empty text.
Bytes that are no UTF-8 after decoding become the replacement character. Only
the key and the text are read, so other columns cannot clash; repeated rows give
repeated results, and an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from ledgermill.llm.arrays import ragged, slices, small_batches
from ledgermill.llm.pieces import cut

# Fixed value: the published pattern that splits text before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHE_WORDS = 200_000
WORD_CHARS = 64  # longer words are encoded each time
RUN_BYTES = 1 << 20
TREE_CELLS = 1 << 16
LONG_WORD = 1 << 10

_NONE = np.int64(np.iinfo(np.int64).max)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ByteBpe:
    """The vocabulary of a byte-level BPE file, ready for encoding and decoding arrays of ids."""

    def __init__(self, model: bytes):
        config = json.loads(model)
        bpe, splitter = config["model"], config["pre_tokenizer"]
        if bpe["type"] != "BPE" or splitter["type"] != "ByteLevel" or config.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without normalisation is needed")
        letters = byte_letters()
        vocab = bpe["vocab"]
        self.first_ids = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in bpe["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        into = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special = {t["content"]: t["id"] for t in config.get("added_tokens", [])}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        pairs = left * self.size + right
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks, self.into = pairs[order], order.astype(np.int64), into
        self.rank_of = dict(zip(self.pairs.tolist(), self.ranks.tolist()))
        byte_of = {letter: b for b, letter in letters.items()}
        spelled = [b""] * self.size
        for token, i in vocab.items():
            spelled[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.token_lengths = np.array([len(s) for s in spelled], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.words = regex.compile(PATTERN)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        )
        self.cache: dict[str, bytes] = {}  # words and pieces

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, or the largest number if it cannot merge."""
        pair = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (none empty), by segment trees of equal width side by side."""
        out = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[i] = self._merge_tree(word)
                continue
            by_width.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(i)
        for width, members in by_width.items():
            step = max(1, TREE_CELLS // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._merge_trees([words[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_trees(self, words: list[bytes], width: int) -> list[bytes]:
        n = len(words)
        lengths = np.array([len(w) for w in words])
        places = np.arange(width)
        inside = places < lengths[:, None]
        ids = np.full((n, width), -1, np.int64)
        ids[inside] = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.where(places + 1 < lengths[:, None], places + 1, -1)  # the next symbol of the word
        before = np.broadcast_to(places - 1, (n, width)).copy()
        shift = np.int64(width.bit_length())
        tree = np.full((n, 2 * width), _NONE, np.int64)  # node k has children 2k and 2k + 1
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        ranks[~inside[:, 1:]] = _NONE
        tree[:, width : 2 * width - 1] = np.where(ranks == _NONE, _NONE, (ranks << shift) | places[:-1])
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & ((np.int64(1) << shift) - 1)
            gone = after[rows, at]
            ids[rows, at] = self.into[root >> shift]
            ids[rows, gone] = -1
            later = after[rows, gone]
            after[rows, at] = later
            tail = later >= 0
            before[rows[tail], later[tail]] = at[tail]
            self._set(tree, rows, gone, np.full(len(rows), _NONE))
            leaf = np.full(len(rows), _NONE)
            fresh = self.rank(ids[rows[tail], at[tail]], ids[rows[tail], later[tail]])
            leaf[tail] = np.where(fresh == _NONE, _NONE, (fresh << shift) | at[tail])
            self._set(tree, rows, at, leaf)
            head = before[rows, at]
            has = head >= 0
            r, h, a = rows[has], head[has], at[has]
            fresh = self.rank(ids[r, h], ids[r, a])
            self._set(tree, r, h, np.where(fresh == _NONE, _NONE, (fresh << shift) | h))
            rows = rows[tree[rows, 1] != _NONE]
        left = ids >= 0
        flat = ids[left].astype(np.uint32).tobytes()
        ends = np.cumsum(4 * left.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_tree(self, word: bytes) -> bytes:
        """Ids of one long word, by the same tree in a plain list."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        shift, mask, none = width.bit_length(), (1 << width.bit_length()) - 1, int(_NONE)
        start = self.first_ids[np.frombuffer(word, np.uint8)]
        ranks = self.rank(start[:-1], start[1:])
        level = np.full(width, _NONE, np.int64)
        level[: n - 1] = np.where(ranks == _NONE, _NONE, (ranks << np.int64(shift)) | np.arange(n - 1))
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [none, *np.concatenate(levels[::-1]).tolist()]  # node k has children 2k and 2k + 1
        ids, after, before = start.tolist(), [*range(1, n), -1], [*range(-1, n - 1)]
        into, rank_of, size = self.into.tolist(), self.rank_of, self.size

        def put(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                least = value if value < other else other
                if tree[node] == least:
                    return
                tree[node] = value = least

        def pair(a: int, b: int) -> int:
            rank = rank_of.get(ids[a] * size + ids[b])
            return none if rank is None else (rank << shift) | a

        while tree[1] != none:
            at = tree[1] & mask
            gone = after[at]
            ids[at] = into[tree[1] >> shift]
            ids[gone] = -1
            later = after[at] = after[gone]
            put(gone, none)
            if later >= 0:
                before[later] = at
                put(at, pair(at, later))
            else:
                put(at, none)
            if before[at] >= 0:
                put(before[at], pair(before[at], at))
        return np.array([i for i in ids if i >= 0], np.uint32).tobytes()

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
        """Point update: the leaf, then every node above it."""
        node = places + tree.shape[1] // 2
        tree[rows, node] = values
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids (32 bits each) of each piece of text, special tokens inside it included."""
        known = self.cache
        found = list(map(known.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if not missing:
            return found
        split = [self._parts(pieces[i]) for i in missing]
        new = list({part for parts in split for part in parts if isinstance(part, str) and part not in known})
        fresh = dict(zip(new, self.merge([w.encode() for w in new])))
        for i, parts in zip(missing, split):
            ids = [
                np.uint32(p).tobytes() if isinstance(p, int) else known.get(p) or fresh[p] for p in parts
            ]
            found[i] = ids[0] if len(ids) == 1 else b"".join(ids)
        if len(known) + len(missing) + len(new) > CACHE_WORDS:
            known.clear()
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= WORD_CHARS)
        known.update((pieces[i], found[i]) for i in missing if len(pieces[i]) <= WORD_CHARS)
        return found

    def _parts(self, piece: str) -> list[str | int]:
        """Ids of the special tokens and the words between them, in order."""
        if not any(token in piece for token in self.special):
            return self.words.findall(piece)
        parts: list[str | int] = []
        for i, run in enumerate(self.cut_special.split(piece)):
            if i & 1:
                parts.append(self.special[run])
            else:
                parts += self.words.findall(run)
        return parts

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins, with the end."""
        pieces = cut(texts)
        encoded = self.encode(pieces.distinct)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        pool = np.frombuffer(b"".join(encoded), np.uint32)
        starts = np.cumsum(lengths) - lengths
        per_piece = lengths[pieces.index]
        ids = pool[ragged(starts[pieces.index], per_piece)]
        ends = np.concatenate([[0], np.cumsum(per_piece)])
        return ids, ends[pieces.first]

    def decode(self, ids: np.ndarray) -> str:
        """The text of `ids`, special tokens included."""
        ids = ids.astype(np.int64)
        spelled = self.token_bytes[ragged(self.token_starts[ids], self.token_lengths[ids])]
        return spelled.tobytes().decode("utf-8", "replace")


_LOADED: dict[int, ByteBpe] = {}


def _loaded(model: bytes) -> ByteBpe:
    mark = hash(model)
    if mark not in _LOADED:
        _LOADED.clear()
        _LOADED[mark] = ByteBpe(model)
    return _LOADED[mark]


def _batches(model, keep: list[str], column: str, detail: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model.value)
        for batch in batches:
            for part in slices(batch, column, RUN_BYTES):
                ids, ends = bpe.encode_texts(pc.fill_null(part.column(column), ""))
                rows = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
                texts = [bpe.decode(row) for row in rows]
                arrays = [part.column(c) for c in keep]
                if detail:
                    arrays += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))]
                    arrays += [pa.array(texts, pa.string())]
                else:
                    arrays += [pa.array(np.diff(ends))]
                    arrays += [pa.array([hashlib.sha256(row.astype("<u4").tobytes()).hexdigest() for row in rows])]
                    arrays += [pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, *(_DETAIL if detail else _DIGEST)])

    return run


_DETAIL = ["ids", "decoded"]
_DIGEST = ["n_tokens", "ids_sha256", "decoded_sha256"]


def _mapped(docs: DataFrame, tokenizer: str, text: str, key: str, detail: bool) -> DataFrame:
    small_batches(docs.sparkSession)
    with open(tokenizer, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = dict(docs.dtypes)[key]
    columns = "ids array<int>, decoded string" if detail else "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(key, text).mapInArrow(
        _batches(model, [key], text, detail), f"`{key}` {kind}, {columns}"
    )


def encode_and_decode(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key, the ids and the decoded text of every row. The vocabulary, a few megabytes, is broadcast."""
    return _mapped(docs, tokenizer, text, key, True)


def encoding_digests(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key, n_tokens and the SHA-256 of ids (little-endian, 32 bits) and of the decoded text."""
    return _mapped(docs, tokenizer, text, key, False)
