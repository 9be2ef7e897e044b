"""Near duplicates by SetSketch registers, their joint likelihood, and exact verification.

A document's set holds its distinct ``SHINGLE``-word shingles; two documents
are linked when intersection / union of their sets is at least ``THRESHOLD``.

*Registers.*  Each of ``REGISTERS`` registers is ``floor(1 - log_b x)`` of the
least of the set's exponential hash values x, truncated to two bytes (Ertl,
2021).  Registers of a union are the maximum of the registers (``merge``),
equal positions agree with a probability close to the similarity, and which
of two registers is larger says how the sets differ.

1. Equal sets form one node, named by a digest of the whole set.
2. Bands of ``ROWS`` registers are bucket keys.  A pair at the threshold meets
   in some bucket with probability 1 - (1 - 0.8 ** 4) ** 32 = 1 - 5e-8.  Pairs of
   a small bucket are pruned by likelihood (3.); the members of a larger one are
   connected to its least node, without forming pairs.  Connected candidates
   make a candidate group.
3. The likelihood of a pair's similarity J follows from how many registers are
   greater, less and equal, and the two known set sizes.  A pair is dropped
   when its sizes alone exclude the threshold, or when J at the maximum lies below it
   and the likelihood ratio against the threshold exceeds ``RATIO`` (six
   standard deviations).
4. Inside a block of a group plausible pairs are verified on the full sets, the
   likeliest first, and only while their ends are not connected yet: a class of
   g near copies costs about g verifications.

A group of any size is cut into blocks of bounded size.  First each block
alone, where a node is sent once.  Then the blocks' classes meet by one
representative each, again in blocks.  Where a group still has more
than one class, a node is sent to those other blocks that hold another class
than its own, and only pairs of different classes are tried.  So no task
holds a whole large group, and no pair is written as a row.

Defined results: a text of one to three words has one shingle, all its words;
a null or empty text, or one of white space, has none and is linked with
nothing (it is its own component); copies share a node, so repeated rows share
their result; a null ``doc_id`` names a component only if all its documents
lack one; other columns are ignored; an empty table gives no rows.  Sets are
compared by 64-bit fingerprints of their shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.frames import documents, group_starts, keyed, partitions, text_batches, text_offsets, whole_groups
from starloom.llm.words import Ranges, mix, split_words, word_hashes
from starloom.session import reliable_checkpoint

SHINGLE = 4
THRESHOLD = 0.8
ROWS, BANDS = 4, 32
REGISTERS = ROWS * BANDS
#: SetSketch parameters: base and rate of the exponential spacing, largest register.
BASE, RATE, TOP = 1.001, 20.0, 65535
RATIO = 37.0
#: Members of a bucket whose pairs are looked at there; nodes and shingles of a block.
SMALL = 64
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20

_U = np.uint64
_U32 = np.uint32
_SEEDS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(7))
_FACTOR = (_SEEDS[:REGISTERS] >> _U(32)).astype(_U32) | _U32(1)
_SHIFT = (_SEEDS[REGISTERS:] >> _U(32)).astype(_U32)


# --- sets and registers ------------------------------------------------------------------

def shingle_sets(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, set of each row) of parts of a batch: sorted distinct fingerprints."""
    raw, at = text_offsets(batch.column(column))
    for lo, hi in text_batches(batch, column):
        part = at[lo:hi + 1] - at[lo]
        text = raw[at[lo]:at[hi]].copy()
        text[(text >= 65) & (text <= 90)] += 32
        starts, ends, first = split_words(text, part)
        count = np.diff(first)
        ranges = Ranges(word_hashes(text, part, starts, ends))
        n = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
        bounds = np.append(0, np.cumsum(n))
        begin = np.repeat(first[:-1], n) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
        prints = ranges.of(begin, np.minimum(begin + SHINGLE, np.repeat(first[1:], n)))
        yield lo, [np.unique(prints[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of each set (rows of zeros for empty ones)."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if not len(full):
        return out
    x = (np.concatenate([sets[i] for i in full]) >> _U(32)).astype(_U32)
    starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    y, z = np.empty_like(x), np.empty_like(x)
    least = np.empty((len(full), REGISTERS), _U32)
    for k in range(REGISTERS):
        np.multiply(x, _FACTOR[k], out=y)
        np.add(y, _SHIFT[k], out=y)
        np.right_shift(y, 15, out=z)      # without this step the order of values would be linear in x
        np.bitwise_xor(y, z, out=y)
        np.multiply(y, _U32(0x846CA68B), out=y)
        least[:, k] = np.minimum.reduceat(y, starts)
    # the least uniform value is the least exponential one
    value = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union."""
    return np.maximum(a, b)


# --- joint likelihood ----------------------------------------------------------------------

_STEP = (BASE - 1) / BASE


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * _STEP) / np.log(BASE)


def _log_likelihood(j, u, v, more, less, same) -> np.ndarray:
    above, below = _p(u - v * j), _p(v - u * j)
    tiny = 1e-300
    return (more * np.log(np.maximum(above, tiny)) + less * np.log(np.maximum(below, tiny))
            + same * np.log(np.maximum(1 - above - below, tiny)))


def estimate(regs: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity at the maximum of the likelihood, whether the threshold stays possible) of pairs (i, j)."""
    likely, possible = np.zeros(len(i)), np.zeros(len(i), bool)
    fits = np.flatnonzero(np.minimum(size[i], size[j]) >= THRESHOLD * np.maximum(size[i], size[j]) - 1e-9)
    for lo in range(0, len(fits), 1 << 14):
        some = fits[lo:lo + (1 << 14)]
        a, b = regs[i[some]], regs[j[some]]
        same = (a == b).sum(1)
        more = (a > b).sum(1)
        # agreeing in less than a third lies far beyond any likelihood ratio in question
        near = np.flatnonzero(same * 3 >= REGISTERS)
        some, same, more = some[near], same[near], more[near]
        counts = more, REGISTERS - more - same, same
        u = size[i[some]] / (size[i[some]] + size[j[some]])
        v = 1 - u
        low, high = np.zeros(len(some)), np.minimum(u / v, v / u)
        for _ in range(24):  # the likelihood is concave in J
            third = (high - low) / 3
            left, right = low + third, high - third
            up = _log_likelihood(left, u, v, *counts) < _log_likelihood(right, u, v, *counts)
            low, high = np.where(up, left, low), np.where(up, high, right)
        best = (low + high) / 2
        ratio = 2 * (_log_likelihood(best, u, v, *counts) - _log_likelihood(THRESHOLD, u, v, *counts))
        likely[some] = best
        possible[some] = (best >= THRESHOLD) | (ratio <= RATIO)
    return likely, possible


def _pairs(m: int, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of m rows, about ``most`` at a time."""
    row = 0
    while row < m - 1:
        rows = np.arange(row, min(m - 1, row + max(1, most // m)))
        after = m - 1 - rows
        i = np.repeat(rows, after)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        row = int(rows[-1]) + 1


class Classes:
    """Union-find over rows, in arrays; a class is named by its least row."""

    def __init__(self, names: np.ndarray):
        self.name = names.copy()

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.name[i], self.name[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.name, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.name[self.name]
                if (up == self.name).all():
                    break
                self.name = up


def linked_classes(regs: np.ndarray, sets: list[np.ndarray], start: np.ndarray,
                   meet=lambda i, j: slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """(class, links found) of each row: classes joined by verified pairs, the likeliest pairs first.

    ``start`` names the classes known already; ``meet`` picks the pairs to look at.
    """
    size = np.array([len(s) for s in sets])
    lefts, rights, likely = [], [], []
    for i, j in _pairs(len(sets)):
        i, j = i[meet(i, j)], j[meet(i, j)]
        apart = start[i] != start[j]
        i, j = i[apart], j[apart]
        value, possible = estimate(regs, size, i, j)
        lefts.append(i[possible].astype(np.int32))
        rights.append(j[possible].astype(np.int32))
        likely.append(value[possible].astype(np.float32))
    classes, links = Classes(start), np.zeros(len(sets), np.int64)
    if not lefts:
        return classes.name, links
    i, j = np.concatenate(lefts), np.concatenate(rights)
    order = np.argsort(-np.concatenate(likely), kind="stable")
    i, j = i[order], j[order]
    if not len(i):
        return classes.name, links
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    bounds = np.append(0, np.cumsum(size))
    has = np.zeros(int(number.max()) + 1, bool)
    lo, most = 0, 256
    while lo < len(i):
        a, b = i[lo:lo + most], j[lo:lo + most]
        lo, most = lo + most, min(2 * most, 1 << 14)
        apart = classes.name[a] != classes.name[b]
        a, b = a[apart], b[apart]
        true = _verified(a, b, number, bounds, size, has)
        a, b = a[true], b[true]
        np.add.at(links, a, 1)
        np.add.at(links, b, 1)
        classes.join(a, b)
    return classes.name, links


def _verified(a: np.ndarray, b: np.ndarray, number: np.ndarray, bounds: np.ndarray, size: np.ndarray,
              has: np.ndarray) -> np.ndarray:
    """Whether the full sets of each pair reach the threshold."""
    true = np.zeros(len(a), bool)
    order = np.argsort(a, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(a[order]) != 0)) if len(a) else []
    for x, y in zip(cuts, np.append(cuts[1:], len(a)) if len(a) else []):
        left, rows = a[order[x]], order[x:y]
        right = b[rows]
        mine = number[bounds[left]:bounds[left + 1]]
        has[mine] = True
        n = size[right]
        ends = np.cumsum(n)
        spot = np.repeat(bounds[right] - (ends - n), n) + np.arange(ends[-1])
        both = np.add.reduceat(has[number[spot]].astype(np.int64), ends - n)
        has[mine] = False
        true[rows] = 100 * both >= round(100 * THRESHOLD) * (size[left] + n - both)
    return true


# --- Spark jobs ----------------------------------------------------------------------------

def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, dk, th, node, n_shingles, regs) of every row; node and regs are null for an empty set."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in shingle_sets(b, "text"):
                regs = registers(sets)
                part = b.slice(lo, len(sets))
                node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(node, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([r.tobytes() if len(s) else None for r, s in zip(regs, sets)], pa.binary())],
                    ["doc_id", "dk", "th", "node", "n_shingles", "regs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return keyed(docs).select("doc_id", "dk", "th", "text").mapInArrow(
        sketch, f"doc_id {kind}, dk long, th long, node binary, n_shingles long, regs binary")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """(a, b): edges that connect all plausible pairs; at most one per node and bucket."""
    width = 2 * ROWS
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring("regs", b * width + 1, F.lit(width))))).alias("bucket")
    bands = nodes.select("node", band)
    busy = reliable_checkpoint(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("least"))
                               .where("m > 1"), "buckets")
    members = reliable_checkpoint(bands.join(busy, "bucket"), "members")
    star = members.where(F.col("m") > SMALL).where("node <> least") \
        .select(F.col("node").alias("a"), F.col("least").alias("b"))
    rows = members.where(F.col("m") <= SMALL).select("node", "bucket") \
        .join(nodes.select("node", "n_shingles", "regs"), "node")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket"], 1 << 22):
            regs, size = _matrix(table.column("regs")), table.column("n_shingles").to_numpy()
            starts = group_starts(table, ["bucket"])
            i, j = _group_pairs(starts, np.append(starts[1:], table.num_rows))
            possible = estimate(regs, size, i, j)[1]
            classes = Classes(np.arange(table.num_rows))
            classes.join(i[possible], j[possible])
            rest = np.flatnonzero(classes.name != np.arange(table.num_rows))
            node = table.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(rest)), node.take(pa.array(classes.name[rest]))], ["a", "b"])

    pruned = (rows.repartition(partitions(nodes.sparkSession), "bucket").sortWithinPartitions("bucket", "node")
              .mapInArrow(prune, "a binary, b binary"))
    return pruned.unionByName(star).distinct()


def _group_pairs(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside each range of rows (small ranges)."""
    size = stops - starts
    row = np.repeat(starts, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    after = np.repeat(stops, size) - row - 1
    i = np.repeat(row, after)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)


def _blocked(members: DataFrame, salt: str) -> DataFrame:
    """Members of groups with the number of blocks of their group and their own."""
    size = members.groupBy("grp").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("nb"))
    return members.join(size, "grp").withColumn(
        "own", F.when(F.col("nb") > 1, F.pmod(F.xxhash64("node", F.lit(salt)), F.col("nb"))).otherwise(0).cast("int"))


def _sets_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` with their sets (``prints``), each about once."""
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()  # repeated rows of a task give their set once
        for b in batches:
            names = b.column(1).to_pylist()
            new = [k for k, name in enumerate(names) if not (name in done or done.add(name))]
            b = b.take(pa.array(new, pa.int64()))
            for lo, sets in shingle_sets(b, "text"):
                part = b.slice(lo, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(1, 7)] + [pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "grp", "nb", "own", "n_shingles", "regs", "prints"])

    return keyed(docs).select("dk", "th", "text").join(members, ["dk", "th"]).select(
        "text", "node", "grp", "nb", "own", "n_shingles", "regs").mapInArrow(
        shingle, "node binary, grp long, nb int, own int, n_shingles long, regs binary, prints binary")


def _in_blocks(rows: DataFrame, keys: list[str], across: bool = False) -> DataFrame:
    """(node, root): the class of every row of a block, named by the row with most links found.

    ``rows``: keys, node, own, label (binary; the class known so far), regs, prints.
    With ``across`` only pairs of different ``own`` are looked at.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, 1 << 24):
            starts = group_starts(table, keys)
            for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
                yield _block_classes(table.slice(a, b - a), across)

    return (rows.select(*keys, *[c for c in ("node", "own", "label", "regs", "prints") if c not in keys])
            .repartition(partitions(rows.sparkSession), *keys)
            .sortWithinPartitions(*keys, "node").mapInArrow(work, "node binary, root binary"))


def _block_classes(table: pa.Table, across: bool) -> pa.RecordBatch:
    names = table.column("node").to_pylist()
    once = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]
    table = table.take(pa.array(once, pa.int64()))
    names = [names[k] for k in once]
    sets = [np.frombuffer(s, _U) for s in table.column("prints").to_pylist()]
    own = table.column("own").to_numpy()
    known = np.unique(np.array([x.hex() for x in table.column("label").to_pylist()]), return_index=True, return_inverse=True)
    start = known[1][known[2]]  # a class is named by its first row
    meet = (lambda i, j: own[i] != own[j]) if across else (lambda i, j: slice(None))
    found, links = linked_classes(_matrix(table.column("regs")), sets, start, meet)
    order = np.lexsort((np.arange(len(found)), -links, found))
    first = np.flatnonzero(np.append(True, np.diff(found[order]) != 0))
    root = np.empty(len(found), np.int64)
    root[found[order[first]]] = order[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.binary()), pa.array([names[r] for r in root[found]], pa.binary())], ["node", "root"])


def _group_classes(docs: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, label): verified classes of the nodes of candidate groups."""
    members = groups.select("node", F.xxhash64("label").alias("grp")).join(nodes, "node") \
        .select("node", "grp", "dk", "th", "n_shingles", "regs")
    rows = reliable_checkpoint(_sets_of(docs, _blocked(members, "first")).withColumn("label", F.col("node")), "sets")
    label = reliable_checkpoint(_in_blocks(rows, ["grp", "own"]).select("node", F.col("root").alias("label")), "block-classes")
    if rows.where("nb > 1").isEmpty():
        return label
    large = rows.where("nb > 1").drop("label").join(label, "node")

    # classes of different blocks meet by one representative each
    heads = large.where("node = label").drop("nb", "own")
    met = _in_blocks(_blocked(heads, "second"), ["grp", "own"]).select(F.col("node").alias("label"), "root")
    label = reliable_checkpoint(label.join(met, "label", "left")
                                .select("node", F.coalesce("root", "label").alias("label")), "head-classes")

    # what is left of different classes in one group: other blocks that hold another class
    small = rows.where("nb > 1").select("node", "grp", "nb", "own").join(label, "node")
    mixed = small.groupBy("grp").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("grp")
    small = reliable_checkpoint(small.join(mixed, "grp", "left_semi"), "mixed")
    if small.isEmpty():
        return label
    held = small.groupBy("grp", F.col("own").alias("other")).agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    sent = small.select("grp", "node", "own", "label", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")) \
        .where("own <> other").join(held, ["grp", "other"]).where("lo <> label OR hi <> label") \
        .select("grp", "node", "label", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"))
    pairs = sent.join(rows.where("nb > 1").select("node", "own", "regs", "prints"), "node")
    found = _in_blocks(pairs, ["grp", "bi", "bj"], across=True)
    edges = found.where("node <> root").join(label, "node") \
        .join(label.select(F.col("node").alias("root"), F.col("label").alias("other")), "root") \
        .where("label <> other").select(F.col("label").alias("a"), F.col("other").alias("b")).distinct()
    over = components(edges).select(F.col("node").alias("label"), F.col("label").alias("over"))
    return label.join(over, "label", "left").select("node", F.coalesce("over", "label").alias("label"))


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, node) of every row."""
    rows = reliable_checkpoint(sketched(docs), "sketched")
    nodes = reliable_checkpoint(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.min(F.struct("dk", "th")).alias("one"), F.min("n_shingles").alias("n_shingles"),
        F.min("regs").alias("regs")).select("node", "doc", "one.dk", "one.th", "n_shingles", "regs"), "nodes")
    label = _group_classes(docs, nodes, components(candidate_edges(nodes)))
    info = reliable_checkpoint(nodes.select("node", "doc").join(label, "node", "left")
                               .select("node", "doc", F.coalesce("label", "node").alias("label")), "labelled")
    classes = info.groupBy("label").agg(F.min("doc").alias("component_id"))
    per_node = info.join(classes, "label").select("node", "component_id")
    full = rows.where("node IS NOT NULL").select("doc_id", "n_shingles", "node").join(per_node, "node")
    empty = rows.where("node IS NULL").select("doc_id", "n_shingles", "node", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "node")


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
link AS (SELECT x, y FROM shared JOIN n u ON u.r = x JOIN n v ON v.r = y WHERE 100 * shared.n >= 80 * (u.n + v.n - shared.n)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id, d.doc_id IS NOT DISTINCT FROM min(o.doc_id) AS kept
FROM d JOIN reach ON reach.x = d.r JOIN d o ON o.r = reach.y LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id, n.n
"""


def query(spark, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir)).drop("node")
