"""Encoding of a corpus with a public byte-level BPE vocabulary, by prefix-sharing trie traversal.

The distinct words of a batch are walked in byte order, which is a depth-first traversal of their trie. The state of a
trie node is the last token of the encoding of its prefix; a token may follow another one only if the merges leave the
two apart, and exactly one token fits a node. Prefixes that words share are therefore encoded once, and a word's ids
are read back from its node. Nothing is shuffled: words of a partition are kept up to a bound and dropped beyond it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how the vocabulary's texts are split before the merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MOST_WORDS = 500_000
MOST_SEAMS = 2_000_000


class TrieEncoder:
    """Ids of texts under a rank file; keeps what it has learnt between batches."""

    def __init__(self, vocabulary: str = VOCABULARY, pattern: str = PATTERN):
        with open(vocabulary, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.split = regex.compile(pattern)
        # a token that the merges never make can't end a prefix
        self.whole = {token: rank for token, rank in self.ranks.items() if len(token) == 1 or self._merge(token) == [rank]}
        self.seams: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}

    def _merge(self, word: bytes) -> list[int]:
        """The plain merge loop, for the short strings of which states are checked."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _apart(self, left: int, right: int) -> bool:
        known = self.seams.get((left, right))
        if known is None:
            if len(self.seams) >= MOST_SEAMS:
                self.seams.clear()
            known = self.seams[left, right] = self._merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def _learn(self, words: set[str]) -> None:
        path = b""
        # at each depth of the current path: its last token, and where that token starts
        last: list[int] = [-1]
        begin: list[int] = [0]
        whole, apart, longest = self.whole, self._apart, self.longest
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            shared = 0
            for a, b in zip(path, raw):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest), end):
                    token = whole.get(raw[start:end])
                    if token is not None and (start == 0 or apart(last[start], token)):
                        last.append(token)
                        begin.append(start)
                        break
            path = raw
            ids, at = [], len(raw)
            while at:
                ids.append(last[at])
                at = begin[at]
            self.words[word] = ids[::-1]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids per text, without special tokens; an empty list for a null or empty text."""
        split = [self.split.findall(t) if t else [] for t in texts]
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        unseen = set(chain.from_iterable(split)).difference(self.words)
        if unseen:
            self._learn(unseen)
        words = self.words
        return [list(chain.from_iterable([words[w] for w in s])) for s in split]


_encoders: dict[tuple[str, str], TrieEncoder] = {}


def encoder(vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> TrieEncoder:
    """One encoder per worker process."""
    if (vocabulary, pattern) not in _encoders:
        _encoders[vocabulary, pattern] = TrieEncoder(vocabulary, pattern)
    return _encoders[vocabulary, pattern]


def _batches(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def encode(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY, ids: str = "ids") -> DataFrame:
    """``keep`` columns and ``ids``, the token ids of ``text``: one row per row, an empty list for null and empty texts.
    Text that looks like a control token is encoded as plain text. Lone surrogates cannot occur in UTF-8 columns."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for whole in batches:
            for batch in _batches(whole):
                encoded = coder.encode(batch.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(encoded, pa.list_(pa.int32()))], names=[*keep, ids])

    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(work, schema)


def count_tokens(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY, name: str = "n_tokens") -> DataFrame:
    """As ``encode``, with the number of ids instead of the ids."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(name, T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for whole in batches:
            for batch in _batches(whole):
                lengths = [len(ids) for ids in coder.encode(batch.column(text).to_pylist())]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(lengths, pa.int64())], names=[*keep, name])

    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(work, schema)
