"""Byte-level BPE by prefix dynamic programming.

The encoding of a byte string ends in one token only. So for each prefix of a word the last token of its
encoding is kept, and the encoding is read off backwards. A token may stand last on a prefix when its own
bytes encode to itself and when the pair it makes with the last token of what precedes it encodes to that
pair. Appending bytes leaves every stored entry as it is; an edit invalidates those behind it only.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicegate.llm.pretokens import cut, lines, word_and_tail
from sluicegate.llm.rows import ChunkCache, map_rows, memo

# Pairs of tokens whose standing side by side is remembered, per worker.
PAIRS = 1 << 19
# Bytes of a word whose stored tokens are kept for other words that begin alike.
HEAD = 6


class Ranks:
    """A vocabulary: the bytes of each token and their rank, read from a rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = {rank: token for token, rank in self.rank.items()}
        self._halves: dict[int, tuple[int, int]] = {}
        # Tokens that can stand in an encoding at all: their own bytes encode to them.
        self.standing = {token: rank for token, rank in self.rank.items() if self.merged(token) == [rank]}
        self.longest = max(map(len, self.standing))
        self.beside = Pairs(self)

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one."""
        known = self._halves.get(token)
        if known is None:
            left, right = self.merged(self.token[token], 2)
            known = self._halves[token] = left, right
        return known

    def merged(self, data: bytes, least: int = 1) -> list[int]:
        """The encoding by its definition: the lowest-ranked neighbours merge first, the left ones at a tie.

        Stops at ``least`` parts. Only for tokens; its cost grows with the square of the length.
        """
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            ranked = [self.rank.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            best = min((r for r in ranked if r >= 0), default=-1)
            if best < 0:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[part] for part in parts]


class Pairs(dict):
    """Whether two tokens stay as they are when they meet, worked out when first asked for.

    While two neighbours merge from their bytes, the parts that touch are those on the right edge of the left
    token and on the left edge of the right one. Each such part lives until the merge that absorbs it. The
    neighbours stay apart when no two parts that touch make a token that comes before both of these merges;
    at equal rank the merge further left comes first.
    """

    def __init__(self, ranks: Ranks):
        super().__init__()
        self.ranks = ranks
        self.edges: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}

    def edge(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """Parts at one edge from a byte to the token, with the rank of the merge that absorbs each."""
        known = self.edges.get((token, right))
        if known is None:
            data, known = self.ranks.token[token], []
            if len(data) > 1:
                known = self.edge(self.ranks.halves(token)[right], right)[:-1]
                part = self.ranks.token[self.ranks.halves(token)[right]]
                known.append((part, token))
            known.append((data, float("inf")))
            self.edges[token, right] = known
        return known

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= PAIRS:
            self.clear()
        rank = self.ranks.rank.get
        left, right = iter(self.edge(pair[0], True)), iter(self.edge(pair[1], False))
        (one, one_until), (other, other_until) = next(left), next(right)
        stay = True
        while True:
            together = rank(one + other)
            if together is not None and together < one_until and together <= other_until:
                stay = False
                break
            if one_until == other_until == float("inf"):
                break
            if one_until <= other_until:
                one, one_until = next(left)
            else:
                other, other_until = next(right)
        self[pair] = stay
        return stay


class PrefixEncoder:
    """A growing byte string with the last token of each of its prefixes."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, bytearray(), []
        self.append(data)

    def append(self, data: bytes) -> None:
        start = len(self.data)
        self.data += data
        whole, last = bytes(self.data), self.last
        standing, beside, longest = self.ranks.standing.get, self.ranks.beside, self.ranks.longest
        for end in range(start + 1, len(whole) + 1):
            for begin in range(end - longest if end > longest else 0, end):
                token = standing(whole[begin:end])
                if token is not None and (begin == 0 or beside[last[begin - 1], token]):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}: the vocabulary lacks a byte")

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in the place of bytes ``start`` to ``end``; what precedes them is not encoded again."""
        rest = bytes(self.data[end:])
        del self.data[start:], self.last[start:]
        self.append(data + rest)

    def ids(self) -> list[int]:
        ids, end = [], len(self.data)
        while end:
            ids.append(self.last[end - 1])
            end -= len(self.ranks.token[ids[-1]])
        return ids[::-1]


class Encoder:
    """Texts to ids and back: words by the pattern, each word by its prefixes."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = Ranks(path), regex.compile(pattern)
        self.words = ChunkCache(self._word, 1 << 17)
        self.chunks = ChunkCache(self._chunk)
        # Chunks that had a blank before them, without it.
        self.spaced = ChunkCache(self._spaced_chunk)
        self.heads = ChunkCache(lambda head: PrefixEncoder(self.ranks, head).last)

    def _word(self, word: str) -> bytes:
        data = word.encode("utf-8", "replace")
        whole = self.ranks.standing.get(data)
        if whole is not None:
            return array("I", [whole]).tobytes()
        grown = PrefixEncoder(self.ranks)
        # Words share their beginnings, and what is stored for a prefix holds whatever is appended.
        head = data[:HEAD]
        grown.data, grown.last = bytearray(head), self.heads[head][:]
        grown.append(data[HEAD:])
        return array("I", grown.ids()).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        word, tail = word_and_tail(chunk)
        if tail:
            return self.chunks[word] + self.chunks[tail]
        return b"".join(map(self.words.__getitem__, self.pattern.findall(chunk)))

    def _spaced_chunk(self, chunk: str) -> bytes:
        word, tail = word_and_tail(chunk)
        if tail:
            return self.spaced[word] + self.chunks[tail]
        return b"".join(map(self.words.__getitem__, self.pattern.findall(" " + chunk)))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        return self.words["\n"].join(map(self._line, lines(text)))

    def _line(self, text: str) -> bytes:
        first, *others = cut(text)
        return self.chunks[first] + b"".join(map(self.spaced.__getitem__, others))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.token.__getitem__, array("I", ids)))


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process, so that tasks share what it remembers."""
    return memo((Encoder, path, pattern), lambda: Encoder(path, pattern))


ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.BinaryType()),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The ids of every text as 32-bit integers, and the bytes that the ids decode to.

    A null text is an empty one: no ids, no bytes. Repeated rows give repeated rows, a null doc_id stays
    null, and other columns are dropped. One projection, no shuffle.
    """

    def rule(keys: list, texts: list) -> Iterator[tuple]:
        codec = encoder(path, pattern)
        for key, text in zip(keys, texts):
            ids = codec.encode(text or "")
            yield key, ids, codec.decode(ids)

    return map_rows(docs, ("doc_id", "text"), rule, ENCODED)


def encoding_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The same encoding, as counts and digests; ids and bytes don't leave the task."""

    def rule(keys: list, texts: list) -> Iterator[tuple]:
        codec = encoder(path, pattern)
        for key, text in zip(keys, texts):
            ids = codec.encode(text or "")
            yield key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

    return map_rows(docs, ("doc_id", "text"), rule, DIGESTS)
