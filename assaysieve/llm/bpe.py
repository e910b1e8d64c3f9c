"""BPE encoding and decoding by speculation and checks.

Greedy longest match proposes the tokens of a word. The proposal is the true encoding exactly if no two neighbours would have merged
otherwise across their border, which array operations decide for all pairs at once. Only words with a failing pair are merged step by step.
"""

import json
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.llm.text import per_text, pieces, sha256

CACHED_BYTES = 16_000_000  # of encoded words that a task remembers, and as much of those before
LONG = 96  # bytes of a word from which its pairs are merged from a heap
NEVER = np.iinfo(np.int64).max
NO_RANK = 1 << 60
# The published pattern of byte-level tokenizers: contractions, letters, digits, other signs, white space.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@cache
def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def token_bytes(content: str) -> list[bytes]:
    """The bytes of each token of a vocabulary file, by id."""
    spec, letters = json.loads(content), byte_letters()
    tokens = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]


def decoded(tokens: list[bytes], ids: bytes) -> str:
    """The text of the ids, special tokens included; bytes that are no UTF-8 become the replacement character."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class Tokenizer:
    """Tables of one byte-level vocabulary file, and the encoder over them."""

    def __init__(self, content: str) -> None:
        spec, letters = json.loads(content), byte_letters()
        kind = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a byte-level BPE file without prefix space and normalizer")
        raw = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.number = raw
        self.longest = max(map(len, raw), default=1)
        self.single = [raw[bytes([b])] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*raw.values(), *self.special.values()], default=-1) + 1
        self.bytes = [b""] * size
        for token, i in raw.items():
            self.bytes[i] = token
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        # Tokens as a tree of bytes: each byte leads to the next ones and to the token that ends here, if any.
        self.tree: dict[int, tuple[dict, int]] = {}
        for token, i in sorted(raw.items(), key=lambda t: len(t[0])):
            node = self.tree
            for b in token[:-1]:
                if b not in node:
                    node[b] = ({}, -1)
                node = node[b][0]
            node[token[-1]] = (node[token[-1]][0] if token[-1] in node else {}, i)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)  # of the merge that makes the token; single bytes are there before all merges
        self.merge: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = (bytes(letters[c] for c in part) for part in (merge if isinstance(merge, list) else merge.split(" ")))
            i, j, made = raw[a], raw[b], raw[a + b]
            self.left[made], self.right[made], self.rank[made] = i, j, rank
            self.merge[i, j] = rank
            self.made.append(made)
        codes = np.array([i * size + j for i, j in self.merge], np.int64)
        order = np.argsort(codes)
        self.codes, self.code_rank = codes[order], np.array(list(self.merge.values()), np.int64)[order]
        self.size = size
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        # Tokens that their own bytes do not encode to: a proposal with one of them always fails.
        self.alone = np.array([i in self.special.values() or self.merged(t) == [i] for i, t in enumerate(self.bytes)])
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = 0

    def merged(self, word: bytes) -> list[int]:
        """The exact encoding: the pair of lowest rank is merged, the leftmost first, until none is left."""
        if len(word) >= LONG:
            return self._merged_long(word)
        parts, rank = [self.single[b] for b in word], self.merge.get
        ranks = [rank(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) != NO_RANK:
            at = ranks.index(best)
            parts[at:at + 2] = [self.made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), NO_RANK)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), NO_RANK)
        return parts

    def _merged_long(self, word: bytes) -> list[int]:
        """The same from a heap of pairs, whose parts are linked to their neighbours: the time grows with the word, not with its square.

        An entry is a rank and a place in one number; it is out of date if the pair at the place has another rank by now.
        """
        parts, rank, made, size = [self.single[b] for b in word], self.merge.get, self.made, len(word)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        bits = size.bit_length()
        mask = (1 << bits) - 1
        now = [rank(pair, NO_RANK) for pair in zip(parts, parts[1:], strict=False)] + [NO_RANK]
        heap = [r << bits | i for i, r in enumerate(now) if r != NO_RANK]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, r = entry & mask, entry >> bits
            if now[i] != r:
                continue
            gone = after[i]
            parts[i], following = made[r], after[gone]
            after[i], now[gone] = following, NO_RANK
            if following < size:
                before[following] = i
                now[i] = new = rank((parts[i], parts[following]), NO_RANK)
                if new != NO_RANK:
                    heappush(heap, new << bits | i)
            else:
                now[i] = NO_RANK
            left = before[i]
            if left >= 0:
                now[left] = new = rank((parts[left], parts[i]), NO_RANK)
                if new != NO_RANK:
                    heappush(heap, new << bits | left)
        out, i = [], 0
        while i < size:
            out.append(parts[i])
            i = after[i]
        return out

    def proposed(self, word: bytes) -> list[int]:
        """The longest token that fits, again and again."""
        tokens, at, size, tree, longest = [], 0, len(word), self.tree, self.longest
        while at < size:
            node, end = tree, at
            for i, b in enumerate(word[at:at + longest], at + 1):
                if (step := node.get(b)) is None:
                    break
                node, found = step
                if found >= 0:
                    token, end = found, i
            tokens.append(token)
            at = end
        return tokens

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the tokens of each pair stay apart.

        Just before a token was made, its two halves lay there. Going back in time along the right edge of the left token and the
        left edge of the right token gives every two pieces that ever met at the border. They would have merged there if that merge
        ranks before the next one of either piece; of two equal merges the one further left comes first.
        """
        x, y = left.copy(), right.copy()
        until_x, until_y = np.full(x.size, NEVER), np.full(x.size, NEVER)
        apart, open_ = np.ones(x.size, bool), np.arange(x.size)
        while open_.size:
            a, b = x[open_], y[open_]
            code = a * self.size + b
            at = np.minimum(np.searchsorted(self.codes, code), self.codes.size - 1)
            rank = np.where(self.codes[at] == code, self.code_rank[at], NEVER) if self.codes.size else np.full(a.size, NEVER)
            joins = (rank < until_x[open_]) & (rank <= until_y[open_]) & (rank != NEVER)
            apart[open_[joins]] = False
            older = self.rank[a] >= self.rank[b]  # take back the later of the two merges
            done = joins | ((self.rank[a] < 0) & (self.rank[b] < 0))
            back = open_[older & ~done]
            until_x[back], x[back] = self.rank[x[back]], self.right[x[back]]
            back = open_[~older & ~done]
            until_y[back], y[back] = self.rank[y[back]], self.left[y[back]]
            open_ = open_[~done]
        return apart

    def learn(self, words: list[str]) -> None:
        """Encode words that are not remembered yet."""
        raw = [w.encode() for w in words]
        tokens = [self.proposed(w) for w in raw]
        flat = np.array([t for own in tokens for t in own], np.int64)
        of = np.repeat(np.arange(len(words)), [len(own) for own in tokens])
        fails = np.zeros(len(words), bool)
        fails[of[~self.alone[flat]]] = True
        pair = np.flatnonzero(of[1:] == of[:-1])
        codes, where = np.unique(flat[pair] * self.size + flat[pair + 1], return_inverse=True)
        fails[of[pair[~self.compatible(codes // self.size, codes % self.size)[where]]]] = True
        known, packed = self.known, self.packed
        for word, data, own, failed in zip(words, raw, tokens, fails.tolist(), strict=True):
            known[word] = b"".join([packed[t] for t in (self.merged(data) if failed else own)])
            self.held += 2 * len(data) + 200  # the word, its ids and what holds them

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The token ids of each text as little-endian unsigned 32-bit numbers."""
        cut = []
        for text in texts:
            segments = [] if not text else self.split.split(text) if self.split else [text]
            cut.append([(s, None) if s in self.special else (None, PATTERN.findall(s)) for s in segments])
        if self.held > CACHED_BYTES:
            self.known, self.before, self.held = {}, self.known, 0
        known, before = self.known, self.before
        new = {w for segments in cut for special, words in segments if special is None for w in words if w not in known}
        known.update({w: before[w] for w in new if w in before})
        fresh = [w for w in new if w not in known]
        if fresh:
            self.learn(fresh)
        return [
            b"".join(np.array([self.special[s]], "<u4").tobytes() if s is not None else b"".join([known[w] for w in words]) for s, words in segments)
            for segments in cut
        ]

    def forget(self) -> None:
        """Drop the remembered words: between tasks a worker keeps the tables alone."""
        self.known, self.before, self.held = {}, {}, 0

    def decode(self, ids: bytes) -> str:
        return decoded(self.bytes, ids)


_loaded: dict[int, Tokenizer] = {}


def _tokenizer(shared) -> Tokenizer:
    """One tokenizer per Python worker and broadcast, kept for the worker's next tasks."""
    if shared.id not in _loaded:
        _loaded.clear()
        _loaded[shared.id] = Tokenizer(shared.value)
    return _loaded[shared.id]


class _Shared:
    """A broadcast file text with a number that tells it from others."""

    def __init__(self, broadcast) -> None:
        self.broadcast = broadcast
        self.id = broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self) -> str:
        return self.broadcast.value


def share(spark, path: str) -> _Shared:
    """Read a vocabulary file (a few MB) on the driver and broadcast it, so that executors need no file."""
    with open(path, encoding="utf-8") as file:
        return _Shared(spark.sparkContext.broadcast(file.read()))


def encode(documents: DataFrame, path: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """The documents with a struct column `out`: n_tokens, and ids as little-endian unsigned 32-bit numbers.

    Null and empty texts have no tokens. A column called `out` is replaced, all others stay.
    """
    shared = share(documents.sparkSession, path)

    def make():
        tokenizer = _tokenizer(shared)

        def rows(texts: list[str | None]) -> list[tuple]:
            return [(len(ids) // 4, ids) for ids in tokenizer.encode(texts)]

        rows.done = tokenizer.forget
        return rows

    return documents.withColumn(out, per_text(make, "n_tokens bigint, ids binary")(F.col(text)))


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The frame with a string column `out`: the text of little-endian unsigned 32-bit ids, special tokens included; null for null.

    Bytes that are no UTF-8 become the replacement character. Ids that are not in the vocabulary raise an error. A column called `out` is replaced.
    Workers hold the bytes of the tokens alone, not the encoder's tables: next to `encode` there are two workers per core.
    """
    with open(path, encoding="utf-8") as file:
        shared = tokens.sparkSession.sparkContext.broadcast(token_bytes(file.read()))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for piece in pieces(batch):
                yield pa.array([None if i is None else decoded(shared.value, i) for i in piece.to_pylist()], pa.string())

    return tokens.withColumn(out, arrow_udf(run, returnType="string")(F.col(ids)))


def digest(documents: DataFrame, path: str) -> DataFrame:
    """Per document: the number of tokens, and digests of the ids and of the text decoded from them."""
    shared = share(documents.sparkSession, path)

    def make():
        tokenizer = _tokenizer(shared)

        def rows(texts: list[str | None]) -> list[tuple]:
            return [(len(ids) // 4, sha256(ids), sha256(tokenizer.decode(ids).encode())) for ids in tokenizer.encode(texts)]

        rows.done = tokenizer.forget
        return rows

    tokens = per_text(make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")(F.col("text"))
    return documents.select("doc_id", tokens.alias("t")).select("doc_id", "t.n_tokens", "t.ids_sha256", "t.decoded_sha256")
