"""Similarity join on word shingles with Bayesian candidate pruning.

Two documents are linked when the Jaccard similarity of their sets of
``SHINGLE``-word shingles is at least ``THRESHOLD``.

1. Equal texts form one node; its copies are counted, never expanded.
2. Each node gets ``HASHES`` MinHash values of one byte.  Bands of ``ROWS``
   values are bucket keys; a pair at the threshold meets in some bucket with
   probability 1 - (1 - 0.8 ** 5) ** 30 = 1 - 6.6e-6.
3. The pairs of a bucket are compared value by value.  After k values with m
   matches the posterior of the similarity under a flat prior is Beta(m + 1,
   k - m + 1); a pair is dropped as soon as the posterior probability of
   reaching the threshold falls below ``TOLERANCE`` (Satuluri and
   Parthasarathy, 2012).  What is left of a bucket is reported as a spanning
   forest, so its rows grow with its members and not with its pairs.
4. Connected candidates form groups.  Inside a group all pairs pass through
   the same pruning, and those left are verified exactly on their shingles.

A bucket or group of any size is cut into blocks of bounded size, and the
tasks take pairs of blocks: no cap, no dropped rows, and no task that holds a
whole large group.  Verification counts links, again without a row per pair.

Defined results: a text of one to four words has one shingle, all its words;
a null or empty text has none and is linked to equal texts only; repeated rows
are copies; a null ``doc_id`` never names a class unless all its copies lack
one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.frames import (documents, group_starts, keep_rows, keyed, partitions, text_batches,
                                 text_offsets, whole_groups)
from starloom.llm.words import Ranges, mix, split_words, word_hashes
from starloom.session import reliable_checkpoint

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 30
HASHES = ROWS * BANDS
TOLERANCE = 1e-9
STEP = 10
#: Nodes of a bucket, and nodes or shingles of a group, in one block.
BUCKET_BLOCK = 4096
GROUP_BLOCK, GROUP_SHINGLES = 1024, 1 << 20

_U = np.uint64
_SEED = mix(np.arange(1, 2 * HASHES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_FACTOR = (_SEED[:HASHES] >> _U(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (_SEED[HASHES:] >> _U(32)).astype(np.uint32)


# --- shingles and signatures -------------------------------------------------------------

def shingles(batch: pa.RecordBatch, column: str, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle fingerprints, first shingle of each row) of parts of a batch."""
    raw, at = text_offsets(batch.column(column))
    for lo, hi in text_batches(batch, column):
        part = at[lo:hi + 1]
        starts, ends, first = split_words(raw, part)
        count = np.diff(first)
        ranges = Ranges(word_hashes(raw, part, starts, ends))
        n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        bounds = np.append(0, np.cumsum(n))
        begin = np.repeat(first[:-1], n) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
        stop = np.minimum(begin + size, np.repeat(first[1:], n))
        yield lo, ranges.of(begin, stop), bounds


def signatures(prints: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One byte of each of ``HASHES`` minima per row; rows without shingles are left out."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(full), HASHES), np.uint8)
    x = (prints >> _U(32)).astype(np.uint32)
    y = np.empty_like(x)
    for k in range(HASHES):
        np.multiply(x, _FACTOR[k], out=y)
        np.add(y, _SHIFT[k], out=y)
        least = np.minimum.reduceat(y, bounds[:-1][full]) if len(full) else y[:0]
        out[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


# --- Bayesian pruning --------------------------------------------------------------------

def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP,
                  hashes: int = HASHES) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on).

    One-byte values also agree by chance, which lifts the threshold by
    (1 - threshold) / 256.  P(similarity >= t | m of k) = P(Binomial(k + 1, t) <= m).
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for k in range(step, hashes + 1, step):
        total, m = 0.0, -1
        while total < tolerance and m <= k:
            m += 1
            total += comb(k + 1, m) * t ** m * (1 - t) ** (k + 1 - m)
        out.append((k, m))
    return out


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Numbers of the pairs (i, j) that are not pruned."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int16)
    done = 0
    for k, least in needed:
        matches += (sig[i, done:k] == sig[j, done:k]).sum(1, dtype=np.int16)
        go = matches >= least
        if not go.all():
            alive, matches, i, j = alive[go], matches[go], i[go], j[go]
        done = k
        if not len(alive):
            break
    return alive


def pairs_of(starts: np.ndarray, stops: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs inside each range of rows, about ``most`` at a time."""
    # row r meets the rows after it in its range
    size = stops - starts
    row = np.repeat(starts, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    after = np.repeat(stops, size) - row - 1
    total = np.cumsum(after)
    lo = 0
    while lo < len(row):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + most, side="right")))
        n = after[lo:hi]
        i = np.repeat(row[lo:hi], n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        if len(i):
            yield i, j
        lo = hi


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the classes of i and j in place; a class is named by its least row."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(label, np.maximum(a, b), low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _sig_matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw, at = _binary(column)
    return raw[at[0]:at[-1]].reshape(len(column), HASHES)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8), at


# --- Spark jobs --------------------------------------------------------------------------

def _nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and one row per distinct text.

    A node is named by 128 bits of its text's SHA-256.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, prints, bounds in shingles(b, "text"):
                n = np.diff(bounds)
                sig = signatures(prints, bounds)
                cells = np.full(len(n), None, object)
                cells[n > 0] = [s.tobytes() for s in sig]
                part = b.slice(lo, len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(3),
                     pa.array(cells, pa.binary()), pa.array(n, pa.int64())],
                    ["doc_id", "dk", "th", "node", "sig", "n_shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs).select("doc_id", "dk", "th", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("node"), "text") \
        .mapInArrow(sign, f"doc_id {kind}, dk long, th long, node binary, sig binary, n_shingles long")
    rows = reliable_checkpoint(rows, "signed")
    nodes = reliable_checkpoint(rows.groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.min("dk").alias("dk"), F.min("th").alias("th"),
        F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig"), F.min("n_shingles").alias("n_shingles")), "nodes")
    return rows.select("doc_id", "dk", "th", "node"), nodes


def _blocks(n_blocks, own):
    """For a row in block ``own``: every pair of blocks that it takes part in."""
    return F.explode(F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda x: F.struct(
        F.least(x, own).alias("bi"), F.greatest(x, own).alias("bj"))))


def _block_of(n_blocks, *salt: str):
    return F.when(n_blocks > 1, F.pmod(F.xxhash64(*salt), n_blocks)).otherwise(0).cast("int")


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the pairs that survive in each bucket."""
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring("sig", b * ROWS + 1, F.lit(ROWS))))).alias("bucket")
    bands = nodes.where("sig IS NOT NULL").select("node", band)
    busy = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1") \
        .select("bucket", F.ceil(F.col("m") / BUCKET_BLOCK).cast("int").alias("nb"))
    members = bands.join(busy, "bucket") \
        .withColumn("own", _block_of(F.col("nb"), "node", "bucket")) \
        .select("node", "bucket", _blocks(F.col("nb"), F.col("own")).alias("p")) \
        .select("node", "bucket", "p.*")
    rows = members.join(nodes.select("node", "sig"), "node")
    n = partitions(nodes.sparkSession)
    needed = least_matches()

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket", "bi", "bj"], 1 << 24):
            sig = _sig_matrix(table.column("sig"))
            starts = group_starts(table, ["bucket", "bi", "bj"])
            label = np.arange(table.num_rows)
            for i, j in pairs_of(starts, np.append(starts[1:], table.num_rows)):
                ok = surviving(sig, i, j, needed)
                merge_labels(label, i[ok], j[ok])
            rest = np.flatnonzero(label != np.arange(len(label)))
            node = table.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array(rest)), node.take(pa.array(label[rest]))], ["a", "b"])

    return (rows.select("bucket", "bi", "bj", "node", "sig").repartition(n, "bucket", "bi", "bj")
            .sortWithinPartitions("bucket", "bi", "bj", "node").mapInArrow(prune, "a binary, b binary"))


def _verified(docs: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, links, to): weighted links found for a node, and its place in a spanning forest."""
    size = groups.join(nodes.select("node", "n_shingles"), "node").groupBy("label").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK), F.ceil(F.sum("n_shingles") / GROUP_SHINGLES))
        .cast("int").alias("nb"))
    members = groups.join(size, "label") \
        .join(nodes.select("node", "dk", "th", "copies", "sig"), "node")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, prints, bounds in shingles(b, "text"):
                part = b.slice(lo, len(bounds) - 1)
                cells = [np.unique(prints[x:y]).tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(5)] + [pa.array(cells, pa.binary())],
                    ["node", "grp", "nb", "copies", "sig", "prints"])

    texts = keyed(docs).select("dk", "th", "text").join(members, ["dk", "th"]).select(
        "node", F.xxhash64("label").alias("grp"), "nb", "copies", "sig", "text") \
        .mapInArrow(shingle, "node binary, grp long, nb int, copies long, sig binary, prints binary")
    blocks = texts.withColumn("own", _block_of(F.col("nb"), "node")) \
        .withColumn("p", _blocks(F.col("nb"), F.col("own"))) \
        .select("grp", "p.bi", "p.bj", "own", "node", "copies", "sig", "prints")
    n = partitions(docs.sparkSession)
    needed = least_matches()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["grp", "bi", "bj"], 1 << 24):
            starts = group_starts(table, ["grp", "bi", "bj"])
            for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
                yield _verify_group(table.slice(a, b - a), needed)

    return (blocks.repartition(n, "grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj", "node")
            .mapInArrow(verify, "node binary, links long, `to` binary"))


def _verify_group(table: pa.Table, needed: list[tuple[int, int]]) -> pa.RecordBatch:
    node = table.column("node").combine_chunks()
    names = node.to_pylist()
    once = [k for k in range(len(names)) if not k or names[k] != names[k - 1]]  # repeated rows
    if len(once) < len(names):
        table = table.take(pa.array(once))
        node = table.column("node").combine_chunks()
    m = len(node)
    sig = _sig_matrix(table.column("sig"))
    raw, at = _binary(table.column("prints").combine_chunks())
    prints = raw[at[0]:at[-1]].view(_U)
    bounds = (at - at[0]) // 8
    sizes = np.diff(bounds)
    column = np.unique(prints, return_inverse=True)[1]
    has = np.zeros(int(column.max()) + 1 if len(column) else 1, bool)
    own, copies = table.column("own").to_numpy(), table.column("copies").to_numpy()
    across = table.column("bi")[0].as_py() != table.column("bj")[0].as_py()
    label, links = np.arange(m), np.zeros(m, np.int64)
    for i, j in pairs_of(np.array([0]), np.array([m])):
        if across:  # pairs inside a block are met where the block meets itself
            other = own[i] != own[j]
            i, j = i[other], j[other]
        ok = surviving(sig, i, j, needed)
        i, j = i[ok], j[ok]
        linked = np.zeros(len(i), bool)
        cuts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else []
        for x, y in zip(cuts, np.append(cuts[1:], len(i)) if len(i) else []):
            left, right = i[x], j[x:y]
            mine = column[bounds[left]:bounds[left + 1]]
            has[mine] = True
            n = sizes[right]
            ends = np.cumsum(n)
            spot = np.repeat(bounds[right] - (ends - n), n) + np.arange(ends[-1])
            both = np.add.reduceat(has[column[spot]].astype(np.int32), ends - n)
            has[mine] = False
            linked[x:y] = both >= THRESHOLD * (sizes[left] + n - both) - 1e-9
        i, j = i[linked], j[linked]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        merge_labels(label, i, j)
    return pa.RecordBatch.from_arrays(
        [node, pa.array(links), node.take(pa.array(label))], ["node", "links", "to"])


def similarity_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, dk, th, node, class_id, class_size, n_links, first) of every row.

    ``class_id`` is the least doc_id of the documents connected by links,
    ``n_links`` the number of other rows at or above the threshold; ``first``
    marks the text that ``class_id`` names.
    """
    rows, nodes = _nodes(docs)
    groups = components(candidate_edges(nodes))
    found = reliable_checkpoint(_verified(docs, nodes, groups), "verified")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.where("node <> `to`").select(F.col("node").alias("a"), F.col("to").alias("b")))
    info = nodes.select("node", "doc", "copies") \
        .join(links, "node", "left").join(label, "node", "left") \
        .select("node", "doc", "copies", F.coalesce("label", "node").alias("label"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    info = reliable_checkpoint(info, "classes")
    classes = info.groupBy("label").agg(F.min("doc").alias("class_id"), F.sum("copies").alias("class_size"),
                                        F.min(F.struct(F.col("doc").isNull(), "doc", "node")).alias("f"))
    per_node = info.join(classes, "label").select(
        "node", "class_id", "class_size", "n_links", (F.col("f.node") == F.col("node")).alias("first"))
    return rows.join(per_node, "node")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns: the one ``class_id`` names."""
    rows = similarity_classes(docs).where("first AND doc_id <=> class_id").select("dk", "th").distinct()
    return keep_rows(docs, reliable_checkpoint(rows, "kept"))


SQL = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, text, copies, doc, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws
    FROM (SELECT coalesce(text, '') AS text, count(*) AS copies, min(doc_id) AS doc FROM documents GROUP BY ALL)),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM t),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
link AS (SELECT x, y FROM shared JOIN n u ON u.r = x JOIN n v ON v.r = y WHERE 10 * shared.n >= 8 * (u.n + v.n - shared.n)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
met AS (SELECT edge.x AS r, sum(t.copies) AS others FROM edge JOIN t ON t.r = edge.y GROUP BY edge.x),
reach AS (SELECT r AS x, r AS y FROM t UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y),
classes AS (SELECT reach.x AS r, min(t.doc) AS class_id, sum(t.copies)::BIGINT AS class_size FROM reach JOIN t ON t.r = reach.y GROUP BY reach.x)
SELECT d.doc_id, class_id, class_size, (copies - 1 + coalesce(others, 0))::BIGINT AS n_links
FROM documents d JOIN t ON t.text = coalesce(d.text, '') JOIN classes USING (r) LEFT JOIN met USING (r)
"""


def query(spark, sf_dir: str) -> DataFrame:
    return similarity_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "n_links")
