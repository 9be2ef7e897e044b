"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into matches of the public pattern.  Each match is encoded by
halves: both halves recursively, then joined.  The join re-encodes a boundary
window of ``w`` tokens from either side, ``w`` growing, until the tokens next
to the window provably stay what they are: a token sequence is the BPE
encoding of its bytes exactly if every two neighbours are (re-encoding the
bytes of the pair gives the pair back).  Pairs inside the untouched left and
right parts hold because those parts are encodings; pairs inside the window
hold because it was encoded; so checking the two pairs at its edges decides.
The join is associative, as both sides name the one encoding of the bytes, so
the halves may be cut anywhere.  The vocabulary's property behind this (each
token's bytes encode to that token) is checked when the ranks are read.

Decoding concatenates the tokens' bytes up the same kind of tree.

Matches repeat as words do, so encodings are kept per chunk of text (see
``tokens``), per half and per pair, in bounded caches of each Python worker.
A text is handled chunk by chunk: memory holds its ids once, never its tree.

Defined results: a null text counts as empty and has 0 ids; repeated rows get
equal results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import documents, whole_text
from starloom.llm.tokens import Cache

#: Bytes up to which the merge loop runs directly.
LEAF = 8
#: Entries of the caches of short pieces and of pairs.
SHORT, PAIRS = 300_000, 200_000


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.matches = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, tuple[int, ...]] = {}
        self.whole = {t: (i,) for t, i in ranks.items() if self._merge(t) == (i,)}

    def _merge(self, piece: bytes) -> tuple[int, ...]:
        """The definition: merge the adjacent pair of lowest rank, the leftmost first."""
        if len(piece) > 40:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        rank, none = self.ranks.get, len(self.ranks)
        scores = [rank(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while scores:
            best = min(scores)
            if best == none:
                break
            at = scores.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = rank(parts[at] + parts[at + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same over a heap of pairs, for long windows."""
        n = len(piece)
        end = list(range(1, n + 1))     # of the part that starts here; 0 once merged away
        before = list(range(-1, n))
        rank = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if end[i] < n and (r := rank(piece[i:end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[end[i]]))

        while heap:
            _, i, stop = heapq.heappop(heap)
            if not end[i] or end[i] == n or end[end[i]] != stop:
                continue
            end[end[i]], end[i] = 0, stop
            before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """``_merge``, kept for short pieces."""
        known = self.whole.get(piece) or self.short.get(piece)
        if known is None:
            known = self._merge(piece)
            if len(piece) <= 24:
                if len(self.short) >= SHORT:
                    self.short.clear()
                self.short[piece] = known
        return known

    def stable(self, a: int, b: int) -> bool:
        """Whether the tokens a, b stay as they are next to each other."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
        return known

    def join(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        if not a or not b or self.stable(a[-1], b[0]):
            return a + b
        width = 1
        while True:
            left, right = a[:-width], b[width:]
            window = self.merge(self.decode(a[-width:] + b[:width]))
            if (not left or self.stable(left[-1], window[0])) and (not right or self.stable(window[-1], right[0])):
                return left + window + right
            width *= 2

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of the bytes of one match (or of any part of one)."""
        known = self.whole.get(piece)
        if known is not None:
            return known
        if len(piece) <= LEAF:
            return self.merge(piece)
        cut = len(piece) // 2
        return self.join(self.encode(piece[:cut]), self.encode(piece[cut:]))

    def encode_text(self, text: str) -> list[int]:
        out: list[int] = []
        for m in self.matches(text):
            out += self._match(m)
        return out

    def _match(self, match: str) -> tuple[int, ...]:
        piece = match.encode()
        return (self.ranks[piece],) if piece in self.ranks else self.encode(piece)

    def decode(self, ids: tuple[int, ...] | list[int]) -> bytes:
        """Concatenation up a tree: halves until a run is short."""
        if len(ids) <= 64:
            return b"".join([self.bytes_of[i] for i in ids])
        cut = len(ids) // 2
        return self.decode(ids[:cut]) + self.decode(ids[cut:])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Codec(ranks, pattern)


@lru_cache(maxsize=2)
def _chunk_cache(path: str, pattern: str) -> Cache:
    own = codec(path, pattern)

    def coded(chunk: str) -> tuple[str, int, bytes]:
        ids = own.encode_text(chunk)
        return " ".join(map(str, ids)), len(ids), own.decode(ids)
    return Cache(lambda chunks: [coded(c) for c in chunks], 200_000)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids in decimal, joined by a space, and their bytes."""
    return _run(docs, path, pattern, "ids string, decoded binary",
                lambda ids, raw: (" ".join(ids), b"".join(raw)), (pa.string(), pa.binary()))


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), without moving the ids out of the task."""
    def digests(ids: list[str], raw: list[bytes]) -> tuple[str, str]:
        return (hashlib.sha256(" ".join(ids).encode()).hexdigest(),
                hashlib.sha256(b"".join(raw)).hexdigest())
    return _run(docs, path, pattern, "ids_sha256 string, decoded_sha256 string", digests,
                (pa.string(), pa.string()))


def _run(docs: DataFrame, path: str, pattern: str, schema: str, finish, kinds) -> DataFrame:
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _chunk_cache(path, pattern)
        for batch in batches:
            n, first, second = [], [], []
            for values in cache.of_texts(map(str, batch.column(1))):
                ids, counts, raw = zip(*values)
                x, y = finish([i for i in ids if i], raw)
                n.append(sum(counts))
                first.append(x)
                second.append(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])],
                names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", *[c.split()[0] for c in schema.split(", ")]]
    return docs.select("doc_id", whole_text().alias("text")) \
        .mapInArrow(coded, f"doc_id {kind}, n_tokens long, {schema}")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)
