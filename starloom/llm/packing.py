"""Packing documents into training sequences by cutting-stock column generation.

A document's ids (with an end id) are cut into full pieces of ``WIDTH`` and a
rest.  Full pieces are sequences of their own.  The rests make a cutting-stock
problem over their length histogram: a linear program whose columns are
patterns (multisets of lengths that fit one sequence) is solved by column
generation, where an unbounded knapsack by dynamic programming prices new
columns.  The pattern counts are rounded down; the few rests that are left
(fewer than one sequence per pattern) are filled sequence by sequence with
the subset of lengths that leaves the least gap.  Rests of one length are
then ranked, and a rest's rank decides its pattern, sequence and offset.

The histogram has at most ``WIDTH - 1`` rows, so the program and its patterns
are bounded whatever the corpus' size; they are all that the driver sees.
Ranks need no global sort and no group in one task: a tokenizing task numbers
its own rests per length, and only the counts per task and length are
cumulated.

Tokens of a piece stay in the task (their CRC-32, and the ids on request).

Defined results: a null text counts as empty and packs its end id alone;
repeated rows are packed one by one; ``doc_id`` may be null; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import documents, whole_text
from starloom.llm.tokens import Cache, Encoder
from starloom.session import reliable_checkpoint

WIDTH = 1024
END = 0
#: Share of the sequences up to which the linear program may stay above its bound.
GAP = 2e-4
#: Columns generated at most.
ROUNDS = 400


# --- the cutting-stock program (driver; bounded by WIDTH) --------------------------------

def price(lengths: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """The most valuable pattern that fits, by dynamic programming over the capacity."""
    best = np.zeros(width + 1)
    item = np.full(width + 1, -1)
    fits = np.searchsorted(lengths, np.arange(width + 1), side="right")
    for c in range(1, width + 1):
        best[c] = best[c - 1]
        if fits[c]:
            gain = value[:fits[c]] + best[c - lengths[:fits[c]]]
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-12:
                best[c], item[c] = gain[k], k
    pattern, c = np.zeros(len(lengths), np.int64), width
    while c > 0:
        if item[c] < 0:
            c -= 1
        else:
            pattern[item[c]] += 1
            c -= lengths[item[c]]
    return pattern, float(best[width])


def best_fill(left: dict[int, float], width: int) -> Counter:
    """The longest length with the subset of the others that leaves the least gap."""
    first = max(left)
    room = width - first
    taken = Counter([first])
    sums, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(left, reverse=True):
        n = min(int(np.ceil(left[length])) - (length == first), room // length)
        k = 1
        while n > 0:  # n copies as 1 + 2 + 4 + ...
            k = min(k, n)
            more = sums | (sums << (k * length)) & mask
            if more != sums:
                steps.append((length, k, sums))
                sums = more
            n -= k
            k *= 2
        if sums >> room & 1:
            break
    at = sums.bit_length() - 1
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += k
            at -= k * length
    return taken


def start(lengths: np.ndarray, demand: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A first basis: each pattern fills one sequence well and uses up one more length.

    Ordered by the lengths used up the basis is triangular, hence regular.
    """
    left = dict(zip(lengths.tolist(), demand.tolist()))
    row = {n: i for i, n in enumerate(lengths.tolist())}
    columns, use = np.zeros((len(row), len(row))), np.zeros(len(row))
    while left:
        pattern = best_fill(left, width)
        out = min(pattern, key=lambda n: left[n] / pattern[n])
        times = left[out] / pattern[out]
        for n, k in pattern.items():
            columns[row[n], row[out]] = k
            left[n] -= times * k
        use[row[out]] = times
        left = {n: x for n, x in left.items() if n != out}
    return columns, use


def solve(lengths: np.ndarray, demand: np.ndarray, width: int, gap: float = GAP,
          rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, fractional uses): the linear program by revised simplex.

    Stops at the optimum, within ``gap`` of a lower bound (all tokens / width,
    or use / value of the best column), or after ``rounds`` columns; any
    basis on the way covers the demand exactly, it only uses more sequences.
    """
    columns, use = start(lengths, demand, width)
    inverse = np.linalg.inv(columns)
    least = float(lengths @ demand) / width
    for _ in range(rounds):
        if use.sum() <= least * (1 + gap):
            break
        duals = inverse.sum(0)
        pattern, value = price(lengths, duals, width)
        if value <= 1 + 1e-9 or use.sum() * (1 - 1 / value) <= gap * use.sum():
            break
        enter = inverse @ pattern
        ratio = np.where(enter > 1e-9, use / np.where(enter > 1e-9, enter, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        use -= step * enter
        use[out] = step
        np.clip(use, 0, None, out=use)
        row = inverse[out] / enter[out]
        inverse -= np.outer(enter, row)
        inverse[out] = row
        columns[:, out] = pattern
    return columns.astype(np.int64), use


def fill(left: Counter, width: int) -> list[Counter]:
    """Sequences for a bounded rest, one after the other."""
    out = []
    while left:
        out.append(best_fill(left, width))
        left = left - out[-1]
    return out


def plan(histogram: dict[int, int], width: int = WIDTH, gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """(pattern, times): uses of patterns that hold every rest of the histogram exactly once."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[int(n)] for n in lengths], float)
    columns, use = solve(lengths, demand, width, gap)
    times = np.floor(use + 1e-6).astype(np.int64)
    over = columns @ times > demand  # rounding in the last digits only
    while over.any():
        p = int(np.flatnonzero((columns[int(np.flatnonzero(over)[0])] > 0) & (times > 0))[0])
        times[p] -= 1
        over = columns @ times > demand
    out = [({int(lengths[i]): int(columns[i, p]) for i in np.flatnonzero(columns[:, p])}, int(times[p]))
           for p in np.flatnonzero(times)]
    rest = (demand - columns @ times).astype(np.int64)
    extra = fill(Counter({int(n): int(k) for n, k in zip(lengths, rest) if k}), width)
    same = Counter(tuple(sorted(x.items(), reverse=True)) for x in extra)
    return out + [(dict(p), n) for p, n in same.items()]


def slots(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, copies a sequence, offset)."""
    out, seen, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            out.append((length, seen[length], seen[length] + n * times, sequence, n, offset))
            seen[length] += n * times
            offset += n * length
        sequence += times
    return out


# --- Spark jobs --------------------------------------------------------------------------

@lru_cache(maxsize=2)
def _ids(path: str) -> Cache:
    return Cache(Encoder(path), 250_000)


def cut(docs: DataFrame, path: str, width: int = WIDTH, end: int = END) -> DataFrame:
    """One row per document: its pieces' checksums and ids, its rest, and the rest's number.

    ``number`` counts the rests of that length in the task ``part``, ``full``
    the full pieces before the document's own.
    """
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part = _ids(path), TaskContext.get().partitionId()
        seen, full = np.zeros(width, np.int64), 0
        last = np.array([end], "<u4").tobytes()
        for b in batches:
            tokens, crcs, rests, numbers, before = [], [], [], [], []
            for ids in cache.of_texts(map(str, b.column(1))):
                raw = b"".join([*ids, last])
                n = len(raw) // 4
                rest = n % width
                tokens.append(n)
                crcs.append([zlib.crc32(raw[i:i + 4 * width]) for i in range(0, len(raw), 4 * width)])
                rests.append(rest)
                numbers.append(int(seen[rest]))
                before.append(full)
                seen[rest] += 1
                full += n // width
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([part] * b.num_rows, pa.int32()), pa.array(tokens, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.int32()),
                 pa.array(numbers, pa.int64()), pa.array(before, pa.int64())],
                ["doc_id", "part", "doc_tokens", "crcs", "rest", "number", "full"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        tokenize, f"doc_id {kind}, part int, doc_tokens long, crcs array<long>, rest int, number long, full long")


def pack(docs: DataFrame, path: str, width: int = WIDTH, end: int = END, gap: float = GAP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = reliable_checkpoint(cut(docs, path, width, end), "pieces")
    per_task = rows.where("rest > 0").groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n"))
    per_task = reliable_checkpoint(per_task, "rests")
    histogram = {r["rest"]: r["n"] for r in per_task.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(histogram, width, gap))  # bounded by the patterns, at most about 2 * width
    place = docs.sparkSession.createDataFrame(
        table, "s_rest int, s_from long, s_to long, s_sequence long, s_copies long, s_offset long")
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("rest", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    size = F.lit(width)
    n_full = F.floor(F.col("doc_tokens") / size)
    rests = (rows.where("rest > 0").join(before, ["rest", "part"])
             .withColumn("rank", F.col("before") + F.col("number"))
             .join(F.broadcast(place), (F.col("rest") == F.col("s_rest")) & (F.col("rank") >= F.col("s_from"))
                   & (F.col("rank") < F.col("s_to"))))
    slot = F.col("rank") - F.col("s_from")
    rests = rests.select(
        "doc_id", (n_full * size).alias("start"), F.col("rest").cast("long").alias("length"),
        F.element_at("crcs", -1).alias("ids_crc32"), "doc_tokens",
        (F.col("s_sequence") + F.floor(slot / F.col("s_copies"))).alias("sequence_id"),
        (F.col("s_offset") + F.col("rest") * (slot % F.col("s_copies"))).alias("offset"))
    # a full piece is a sequence of its own, numbered in its task above all packed ones
    fulls = (rows.where(n_full > 0)
             .select("doc_id", "doc_tokens", "part", "full", F.posexplode(F.slice("crcs", F.lit(1), n_full.cast("int"))))
             .select("doc_id", (F.col("pos") * size).cast("long").alias("start"), size.cast("long").alias("length"),
                     F.col("col").alias("ids_crc32"), "doc_tokens",
                     (F.shiftleft((F.col("part") + 1).cast("long"), 40) + F.col("full") + F.col("pos")).alias("sequence_id"),
                     F.lit(0).cast("long").alias("offset")))
    return rests.unionByName(fulls)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
