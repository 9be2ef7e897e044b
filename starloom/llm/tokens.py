"""Cutting text so that its byte-pair tokens can be kept by piece.

The public pattern never matches across a single space that stands between
two characters that are no white space: what comes before ends there, and the
space opens the next match.  So a text may be cut before every such space,
and each chunk's tokens depend on the chunk alone.  Chunks repeat as words do,
which makes a bounded cache of them worth its memory.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space other than the space and the line feed.
_RARE = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def cut(text: str) -> tuple[str, list[str]]:
    """``text`` cut before each single space between two visible characters.

    The first chunk, and the others without the space that opens them:
    ``" ".join([head, *rest]) == text``.
    """
    if not text:
        return "", []
    if (text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text
            or _RARE.search(text)):
        head, *rest = _CUT.split(text)
    else:  # every space stands between two visible characters
        head, *rest = text.split(" ")
    return head, rest


#: The public pattern that a byte-level tokenizer splits text by unless told otherwise.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters below this one have had their classes in every version of Unicode since 2.0.
_SETTLED = "\u0180"


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level tokenizer file writes each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _same_by_rank(path: str):
    """An encoder by ranks with the ids of the tokenizer file, or None if the file is of another kind.

    The ids are the same if a merge's place is its token's id, and nothing but
    the usual byte-level splitting comes before the merges.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
             and split.get("use_regex", True) and model.get("type") in (None, "BPE") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not model.get("ignore_merges"))
    if not plain:
        return None
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    vocabulary = model["vocab"]
    letters = _byte_letters()
    first = len(letters)
    if any(vocabulary.get(m) != first + i for i, m in enumerate(merges)):
        return None
    merged = [t for t in vocabulary if vocabulary[t] < first + len(merges)]
    if len(merged) != first + len(merges):
        return None
    return tiktoken.Encoding("file", pat_str=_PATTERN, special_tokens={}, mergeable_ranks={
        bytes(letters[c] for c in t): vocabulary[t] for t in merged})


class Encoder:
    """Ids of chunks by a byte-level tokenizer file, many chunks a call.

    A chunk that opens with a space and ends in a visible character may follow
    another such chunk without changing its ids, so such chunks are joined and
    their ids told apart by the number of bytes each id stands for.
    """

    JOINED = 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.own.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.by_rank = _same_by_rank(path)

    def __call__(self, chunks: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each chunk."""
        out: list[bytes] = [b""] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if len(c) > 1 and c[0] == " " and not c[-1].isspace()]
        joined = set(plain)
        alone = [i for i in range(len(chunks)) if i not in joined]
        for i, e in zip(alone, self._encode([chunks[i] for i in alone])):
            out[i] = np.array(e, "<u4").tobytes()
        groups = [plain[k:k + self.JOINED] for k in range(0, len(plain), self.JOINED)]
        for group, e in zip(groups, self._encode_joined(["".join([chunks[i] for i in g]) for g in groups])):
            ids = np.array(e, "<u4")
            ends = np.cumsum([len(chunks[i].encode()) for i in group])
            stops = (4 * (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1)).tolist()
            raw = ids.tobytes()
            for i, a, b in zip(group, [0, *stops], stops):
                out[i] = raw[a:b]
        return out

    def _encode_joined(self, texts: list[str]) -> list[list[int]]:
        """The same ids; texts of settled characters by rank, in a fraction of the time."""
        if self.by_rank is None:
            return self._encode(texts)
        simple = [max(t) < _SETTLED for t in texts]
        rest = iter(self._encode([t for t, s in zip(texts, simple) if not s]))
        return [self.by_rank.encode_ordinary(t) if s else next(rest) for t, s in zip(texts, simple)]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]


class Cache:
    """What ``make`` says of chunks, kept in two generations of about ``most`` entries each.

    ``make`` takes a list of chunks and gives a list of values, none None.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int = 200_000):
        self.make, self.most = make, most
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def of_texts(self, texts: Iterable[str], most: int = 1 << 20) -> Iterator[list]:
        """Per text the values of its chunks; texts of about ``most`` characters at a time."""
        group, size = [], 0
        for text in texts:
            group.append(cut(text))
            size += len(text)
            if size >= most:
                yield from self._of_group(group)
                group, size = [], 0
        if group:
            yield from self._of_group(group)

    def _of_group(self, group: list[tuple[str, list[str]]]) -> Iterator[list]:
        young, old = self.young, self.old
        unknown = {c for _, rest in group for c in rest if c not in young}
        young.update({c: old[c] for c in unknown if c in old})
        fresh = [c for c in unknown if c not in young]
        young.update(zip(fresh, self.make([" " + c for c in fresh])))
        for first, (_, rest) in zip(self.make([head for head, _ in group]), group):
            yield [first, *map(young.__getitem__, rest)]
        for c in fresh:
            if len(c) > 64:  # a freak chunk is not worth the room
                del young[c]
        if len(young) >= self.most:
            self.old, self.young = young, {}
