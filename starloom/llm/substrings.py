"""Long repeated passages by recompression of the token sequence.

Each document is a sequence of words.  Rounds of recompression shorten it:
a pair round halves the alphabet by one bit of each symbol's name and renames
every adjacent (left, right) pair; a run round renames every run of one
symbol.  A new name is a fixed 64-bit function of the parts' names, so every
task on the cluster gives equal parts equal names without a dictionary, and
the rounds need no exchange between them.

What a symbol says about its text is local: for every symbol the span of words
on which its existence depends is carried along.  A symbol whose dependency
lies inside a window of ``WINDOW`` words is an interior symbol of the window,
and equal windows have equal interior symbols.  Each window is represented by
its largest interior symbol (ties by name, then leftmost) - its *anchor*.

Spark then finds the repeats:

1. anchors (name, document, the windows it stands for, a fingerprint of their
   text) are written once and meet by name; a name that occurs once is done;
2. where all occurrences of a name have the same text around them, and where
   two of them have, all their windows repeat;
3. for the other texts around a shared name, one occurrence of each is read
   again, and its windows meet by name and are compared one by one (by name
   and fingerprint, that is 128 bits);
4. the windows found are gathered by document and their words removed.

A window's words are compared on the input, not on what is left.  No word is
ever matched by a partial rule: rounds only decide *where* to compare, so any
number of rounds gives the same result.

Names meet in sorted partitions, each handled in one pass.  Names that hold
more than ``1 / (HOT + 1)`` of all anchors (a Misra-Gries summary names them,
``HOT`` at most) never go there: the same questions are answered for them by
map-side partial sums and joins with a unique other side, which the adaptive
skew join may split.  So no task holds more than that share of the anchors.
Per-document lists are bounded by the document.

Defined results: null and empty texts have no words; repeated rows are
occurrences of one another, so all their windows repeat; a null ``doc_id`` is
carried through; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.exact import heavy_candidates
from starloom.llm.frames import documents, keyed, partitions, text_batches, text_offsets, whole_groups
from starloom.llm.words import Ranges, mix, split_words, word_hashes
from starloom.session import reliable_checkpoint

WINDOW = 35
ROUNDS = 3
#: Names counted as hot by the Misra-Gries summary, at most.
HOT = 1024

_U = np.uint64
_FAR = 1 << 40


def _pair_name(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    return mix(a * _U(0x9E3779B97F4A7C15) + mix(b + _U(2 * n + 1)))


def recompress(names: np.ndarray, doc: np.ndarray, window: int = WINDOW,
               rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, ...]]:
    """Per round the new symbols: (name, start, end, first and last word it depends on).

    ``doc`` is each word's document; nothing is paired across documents, and
    what depends on a document's border depends on a word that does not exist.
    """
    n = len(names)
    s = np.arange(n)
    e = s + 1
    lo, hi, h = s.copy(), e.copy(), names.copy()
    yield h, s, e, lo, hi
    for r in range(rounds):
        if len(h) < 2:
            return
        # pairs: a left symbol directly before a right one
        joint = doc[:-1] == doc[1:]
        left = (mix(h + _U(r * 7919 + 1)) >> _U(63)) == 0
        pair = joint & left[:-1] & ~left[1:] & (e[1:] - s[:-1] <= window)
        first = np.zeros(len(h), bool)
        first[:-1] = pair
        second = np.zeros(len(h), bool)
        second[1:] = pair
        # a symbol that stays alone depends on the neighbour it was not paired with
        next_hi = np.append(np.where(joint, hi[1:], _FAR), _FAR)
        prev_lo = np.append(-_FAR, np.where(joint, lo[:-1], -_FAR))
        alone = ~first & ~second
        new_hi = np.where(alone & left, np.maximum(hi, next_hi), hi)
        new_lo = np.where(alone & ~left, np.minimum(lo, prev_lo), lo)
        at = np.flatnonzero(pair)
        h = h.copy()
        h[at] = _pair_name(h[at], h[at + 1], 2 * r)
        e = e.copy()
        e[at] = e[at + 1]
        new_hi[at] = np.maximum(hi[at], hi[at + 1])
        new_lo[at] = np.minimum(lo[at], lo[at + 1])
        yield h[at], s[at], e[at], new_lo[at], new_hi[at]
        keep = ~second
        h, s, e, lo, hi, doc = h[keep], s[keep], e[keep], new_lo[keep], new_hi[keep], doc[keep]
        if not len(at) or (hi - lo > window).all():
            return
        # runs: maximal blocks of one symbol, which depend on both neighbours
        joint = doc[:-1] == doc[1:]
        begins = np.append(True, ~(joint & (h[1:] == h[:-1])))
        start = np.flatnonzero(begins)
        stop = np.append(start[1:], len(h)) - 1
        before = np.where(start > 0, joint[start - 1], False)
        after = np.where(stop < len(h) - 1, np.append(joint, False)[stop], False)
        run_lo = np.where(before, lo[start - 1], -_FAR)
        run_hi = np.where(after, hi[np.minimum(stop + 1, len(h) - 1)], _FAR)
        lo = np.minimum(np.minimum(run_lo, np.minimum.reduceat(lo, start)), s[start])
        hi = np.maximum(np.maximum(run_hi, np.maximum.reduceat(hi, start)), e[stop])
        length = stop - start + 1
        many = length > 1
        h, s, e, doc = h[start], s[start], e[stop], doc[start]
        h = np.where(many, _pair_name(h, length.astype(_U), 2 * r + 1), h)
        if many.any():
            yield h[many], s[many], e[many], lo[many], hi[many]


def anchors(names: np.ndarray, at: np.ndarray, window: int = WINDOW,
            rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(document, first window, number of windows, name, fingerprint) of each anchor's windows.

    ``at`` holds the first word of each document and, last, the number of words.
    """
    n = len(names)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    begin, end = at[:-1][doc], at[1:][doc] if n else at[:0]
    best = [np.zeros(n, _U) for _ in range(int(window).bit_length())]
    named: list[tuple[np.ndarray, np.ndarray]] = []
    for h, s, e, lo, hi in recompress(names, doc, window, rounds):
        name, span = np.zeros(n, _U), np.zeros(n, np.int16)
        # windows that hold the whole dependency and lie in the document
        a = np.maximum(hi - window, begin[s])
        b = np.minimum(lo, end[s] - window)
        ok = a <= b
        h, s, e, a, b = h[ok], s[ok], e[ok], a[ok], b[ok]
        name[s], span[s] = h, e - s
        named.append((name, span))
        rank = ((e - s).astype(_U) << _U(57)) | ((mix(h) >> _U(38)) << _U(31)) | (_U(n) - s.astype(_U))
        k = np.frexp(b - a + 1)[1] - 1
        for level in range(len(best)):
            of = np.flatnonzero(k == level)
            if len(of):
                np.maximum.at(best[level], a[of], rank[of])
                np.maximum.at(best[level], b[of] - (1 << level) + 1, rank[of])
    for level in range(len(best) - 1, 0, -1):
        half, top, below = 1 << (level - 1), best[level], best[level - 1]
        np.maximum(below, top, out=below)
        np.maximum(below[half:], top[:max(0, len(top) - half)], out=below[half:])
    windows = np.flatnonzero(np.arange(n) + window <= end) if n else np.zeros(0, np.int64)
    if not len(windows):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(_U), z.astype(_U)
    rank = best[0][windows]
    first = np.flatnonzero(np.append(True, (rank[1:] != rank[:-1]) | (np.diff(windows) > 1)
                                     | (doc[windows[1:]] != doc[windows[:-1]])))
    count = np.diff(np.append(first, len(windows)))
    w, rank = windows[first], rank[first]
    start = n - (rank & _U((1 << 31) - 1)).astype(np.int64)
    size = (rank >> _U(57)).astype(np.int64)
    name = np.zeros(len(w), _U)
    for by_start, span in named:
        hit = span[start] == size
        name[hit] = by_start[start[hit]]
    # where the anchor lies in its windows is part of what the windows look like
    text = mix(Ranges(names).of(w, w + count + window - 1) ^ mix((start - w).astype(_U)))
    return doc[w], w - at[doc[w]], count, name, text


def _hashed(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word fingerprints, first word of each row) of parts of a batch."""
    raw, at = text_offsets(batch.column(column))
    for lo, hi in text_batches(batch, column):
        part = at[lo:hi + 1]
        starts, ends, first = split_words(raw, part)
        yield lo, word_hashes(raw, part, starts, ends), first


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64))


def anchor_table(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, names, at in _hashed(batch, "text"):
                doc, first, count, name, text = anchors(names, at, window, rounds)
                take = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(first.astype(np.int32)),
                     pa.array(count.astype(np.int32)), _long(name), _long(text)],
                    ["dk", "th", "first", "n", "name", "around"])
    return docs.select("dk", "th", "text").mapInArrow(
        parse, "dk long, th long, first int, n int, name long, around long")


_FOUND = "dk long, th long, first int, n int, name long, repeats boolean, sample boolean"


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, length) of each run of equal keys."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    start = np.flatnonzero(change)
    return start, np.diff(np.append(start, len(change)))


def _meet_cold(table: DataFrame) -> DataFrame:
    """Occurrences of shared names: whether all their windows repeat, and one sample per other text."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["name"], 1 << 24):
            name, around = (t.column(c).to_numpy() for c in ("name", "around"))
            start, size = _runs(name)
            of_name = np.repeat(np.arange(len(start)), size)
            text, copies = _runs(name, around)
            texts = np.bincount(of_name[text], minlength=len(start))
            repeats = np.repeat(copies > 1, copies)
            sample = np.zeros(len(name), bool)
            sample[text] = texts[of_name[text]] > 1
            row = pa.array(np.flatnonzero((size > 1)[of_name] & (repeats | sample)))
            yield pa.RecordBatch.from_arrays(
                [t.column(c).combine_chunks().take(row) for c in ("dk", "th", "first", "n", "name")]
                + [pa.array(x).take(row) for x in (repeats, sample)],
                ["dk", "th", "first", "n", "name", "repeats", "sample"])
    n = partitions(table.sparkSession)
    return (table.repartition(n, "name").sortWithinPartitions("name", "around")
            .select("dk", "th", "first", "n", "name", "around").mapInArrow(meet, _FOUND))


def _meet_hot(table: DataFrame) -> DataFrame:
    """The same for hot names, by partial sums and joins."""
    texts = reliable_checkpoint(
        table.groupBy("name", "around").agg(F.count(F.lit(1)).alias("k"),
                                            F.min(F.struct("dk", "th", "first", "n")).alias("o")), "texts")
    several = texts.groupBy("name").agg(F.count(F.lit(1)).alias("t")).where("t > 1").select("name")
    twice = table.join(texts.where("k > 1").select("name", "around"), ["name", "around"], "left_semi")
    sample = texts.join(F.broadcast(several), "name")  # at most HOT names
    columns = ["dk", "th", "first", "n", "name"]
    return (twice.select(*columns, F.lit(True).alias("repeats"), F.lit(False).alias("sample"))
            .unionByName(sample.select("o.*", "name", (F.col("k") > 1).alias("repeats"), F.lit(True).alias("sample"))))


def _window_table(docs: DataFrame, samples: DataFrame, window: int) -> DataFrame:
    """(name, open, dk, th, first, prints): the windows of the sampled occurrences, from their texts."""
    per_doc = samples.groupBy("dk", "th").agg(F.collect_list(F.struct("first", "n", "name", "open")).alias("p"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            inner, ends = lists.flatten(), np.diff(lists.offsets.to_numpy())
            row_of = np.repeat(np.arange(batch.num_rows), ends)
            first, n, name = (inner.field(i).to_numpy() for i in range(3))
            still = inner.field(3).to_numpy(zero_copy_only=False)
            for lo, names, at in _hashed(batch, "text"):
                hi = lo + len(at) - 1
                here = np.flatnonzero((row_of >= lo) & (row_of < hi))
                if not len(here):
                    continue
                ends = np.cumsum(n[here])
                begin = np.repeat(at[row_of[here] - lo] + first[here], n[here])
                begin += np.arange(ends[-1]) - np.repeat(ends - n[here], n[here])
                prints = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)),
                                                  _long(Ranges(names).of(begin, begin + window)))
                take = pa.array(row_of[here])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[here]), pa.array(still[here]), batch.column(0).take(take),
                     batch.column(1).take(take), pa.array(first[here]), prints],
                    ["name", "open", "dk", "th", "first", "prints"])
    return docs.join(per_doc, ["dk", "th"]).select("dk", "th", "text", "p").mapInArrow(
        read, "name long, open boolean, dk long, th long, first int, prints array<long>")


def _compare_cold(windows: DataFrame) -> DataFrame:
    """(dk, th, first, n): windows of open samples that another sample of the name has too."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["name"], 1 << 24):
            lists = t.column("prints").combine_chunks()
            n = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(t.num_rows), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            name, prints = t.column("name").to_numpy()[row], lists.flatten().to_numpy()
            order = np.lexsort((prints, name))
            start, size = _runs(name[order], prints[order])
            again = np.zeros(len(row), bool)
            again[order] = np.repeat(size > 1, size)
            hit = np.flatnonzero(again & t.column("open").to_numpy()[row])
            take = pa.array(row[hit])
            yield pa.RecordBatch.from_arrays(
                [t.column("dk").combine_chunks().take(take), t.column("th").combine_chunks().take(take),
                 pa.array((t.column("first").to_numpy()[row] + step)[hit].astype(np.int32)),
                 pa.array(np.ones(len(hit), np.int32))], ["dk", "th", "first", "n"])
    n = partitions(windows.sparkSession)
    return (windows.repartition(n, "name").sortWithinPartitions("name")
            .mapInArrow(compare, "dk long, th long, first int, n int"))


def _compare_hot(windows: DataFrame) -> DataFrame:
    each = windows.select("name", "open", "dk", "th", "first", F.posexplode("prints").alias("step", "print"))
    common = each.groupBy("name", "print").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("name", "print")
    return each.where("open").join(common, ["name", "print"], "left_semi") \
        .select("dk", "th", (F.col("first") + F.col("step")).alias("first"), F.lit(1).alias("n"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(dk, th, first, n): blocks of windows of ``keyed`` documents that start elsewhere too."""
    table = reliable_checkpoint(anchor_table(docs, window, rounds), "anchors")
    named = table.select(F.col("name").cast("string").alias("digest"))
    hot = reliable_checkpoint(heavy_candidates(named, HOT).select(F.col("digest").cast("long").alias("name")), "hot")
    hot = F.broadcast(hot)  # at most HOT rows
    found = reliable_checkpoint(_meet_cold(table.join(hot, "name", "left_anti"))
                                .unionByName(_meet_hot(table.join(hot, "name", "left_semi"))), "found")
    samples = found.where("sample").select("dk", "th", "first", "n", "name", (~F.col("repeats")).alias("open"))
    windows = reliable_checkpoint(_window_table(docs, samples, window), "windows")
    return (found.where("repeats").select("dk", "th", "first", "n")
            .unionByName(_compare_cold(windows.join(hot, "name", "left_anti")))
            .unionByName(_compare_hot(windows.join(hot, "name", "left_semi"))))


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row; kept words are joined by one space."""
    own = keyed(docs)
    spans = repeated_windows(own, window, rounds)
    per_doc = spans.groupBy("dk", "th").agg(F.collect_list(F.struct("first", "n")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            first, n = (lists.values.field(i).to_numpy() for i in range(2))
            for i, text in enumerate(batch.column(1)):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                gone = 0
                if lists[i].is_valid and ends[i] < ends[i + 1]:
                    step = np.zeros(len(words) + 1, np.int64)
                    f = first[ends[i]:ends[i + 1]]
                    np.add.at(step, f, 1)
                    np.add.at(step, f + n[ends[i]:ends[i + 1]] + window - 1, -1)
                    stay = np.cumsum(step[:-1]) == 0
                    gone = len(words) - int(stay.sum())
                    total_words = len(words)
                    words = list(compress(words, stay))
                else:
                    total_words = len(words)
                total.append(total_words)
                removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (own.join(per_doc, ["dk", "th"], "left").select("doc_id", "text", "spans")
            .mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string"))


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT r, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) AS g
        FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM t)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM hit, generate_series(0, 34) AS s(k)),
gone_of AS (SELECT r, list(p) AS ps, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN ws ELSE
           list_filter(ws, lambda w, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM t LEFT JOIN gone_of USING (r)
"""


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
