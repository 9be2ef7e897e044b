"""Target-distribution importance resampling over hashed word n-grams.

Features of a text are its runs of one to three consecutive words (ASCII
letters lower-cased), repeats counted, hashed into ``BUCKETS`` by CRC-32.  A
bucket's gain compares its share among a target's features with its share
among the corpus'; a document's weight is the sum of its features' gains, and
the documents with the highest weight plus Gumbel noise (keyed by the id) are
the sample, which is a draw without replacement in proportion to exp(weight).

Words come by *batch concatenation*: the texts of a batch are joined with a
sentinel that is no word character, one regular expression pass finds all words, and
``searchsorted`` against the documents' offsets tells which document a word
belongs to.  N-grams whose ends lie in different documents are masked before
the ``bincount``.  CRC-32 is linear, so hashes of words come from a table per
place in the word, and hashes of n-grams from those of words, all as arrays.

Plan: one map-only pass counts buckets (each task hands on at most ``BUCKETS``
rows), the gains (``BUCKETS`` numbers, whatever the input's size) go to every
task, a second pass writes five numbers a document, and only those numbers
are range-partitioned by score to give the ranks; nothing is cut off before.

Defined results: a null or empty text has no features and weight 0; the noise
of a null ``doc_id`` is that of the empty string, and it loses ties; repeated
rows count, and are drawn, each on its own (rows that tie in everything are
interchangeable); with no target the gains only follow the corpus; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import documents, text_batches, text_offsets, whole_text
from starloom.operators.numbering import dense_index
from starloom.session import reliable_checkpoint

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SENTINEL = b"\x00"

# --- CRC-32 as arrays --------------------------------------------------------------------

_U = np.uint32
#: Words and second halves up to this many bytes are hashed by table.
PLACES = 64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """``shift[n, k, v]``: byte k of a register, of value v, after n zero bytes;
    ``empty[n]``: the hash of n zero bytes, which every hash of n bytes contains."""
    step = np.array([zlib.crc32(bytes([v])) ^ zlib.crc32(b"\0") for v in range(256)], _U)
    shift = np.empty((PLACES + 1, 4, 256), _U)
    shift[0] = np.arange(256, dtype=_U)[None, :] << (np.arange(4, dtype=_U)[:, None] * _U(8))
    for n in range(PLACES):
        shift[n + 1] = step[shift[n] & _U(255)] ^ (shift[n] >> _U(8))
    return shift, np.array([zlib.crc32(b"\0" * n) for n in range(PLACES + 1)], _U)


_SHIFT, _EMPTY = _tables()


def word_crcs(blob: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each word ``blob[start:end]``."""
    size = ends - starts
    out = np.empty(len(starts), _U)
    short = np.flatnonzero(size <= PLACES)
    n = size[short]
    if len(short):
        raw = np.frombuffer(blob, np.uint8)
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(first, n)          # from the word's start
        byte = raw[np.repeat(starts[short], n) + place]
        left = np.repeat(n, n) - place                            # the byte itself takes one step
        out[short] = np.bitwise_xor.reduceat(_SHIFT[left, 0, byte], first) ^ _EMPTY[n]
    for i in np.flatnonzero(size > PLACES):
        out[i] = zlib.crc32(blob[starts[i]:ends[i]])
    return out


def joined_crcs(left: np.ndarray, right: np.ndarray, blob: bytes, starts: np.ndarray,
                ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each text with hash ``left``, a space, and the word with hash ``right``."""
    x = left ^ _U(0x20)
    spaced = _SHIFT[1, 0, x & _U(255)] ^ (x >> _U(8))
    spaced ^= _SPACE_BASE
    n = np.minimum(ends - starts, PLACES)
    out = right.copy()
    for k in range(4):
        out ^= _SHIFT[n, k, (spaced >> _U(8 * k)) & _U(255)]
    for i in np.flatnonzero(ends - starts > PLACES):
        out[i] = zlib.crc32(blob[starts[i]:ends[i]], int(spaced[i]))
    return out


#: What the step over a byte adds besides the shift of the register.
_SPACE_BASE = _U(zlib.crc32(b" ")) ^ _SHIFT[1, 0, 0x20]


# --- features of a batch -----------------------------------------------------------------

def features(texts: list[bytes], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every feature of a batch, and the words of each document."""
    blob = _SENTINEL.join(texts).lower()      # bytes: only A-Z change
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(size + 1) - size - 1  # where each document begins
    spans = np.fromiter((x for m in _WORD.finditer(blob) for x in m.span()), np.int64).reshape(-1, 2)
    starts, ends = spans[:, 0], spans[:, 1]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    one = word_crcs(blob, starts, ends)
    found_docs, found = [doc], [one]
    grams = one
    for n in (2, 3):
        grams = joined_crcs(grams[:len(one) - n + 1] if len(one) >= n else one[:0], one[n - 1:], blob,
                            starts[n - 1:], ends[n - 1:])
        inside = doc[n - 1:] == doc[:len(grams)]  # not across a sentinel
        found_docs.append(doc[:len(grams)][inside])
        found.append(grams[inside])
    buckets = (np.concatenate(found) % _U(most)).astype(np.int64)
    return np.concatenate(found_docs), buckets, np.bincount(doc, minlength=len(texts))


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of parts of a batch of bounded size; a text is never cut."""
    raw, at = text_offsets(batch.column(column))
    data = memoryview(raw)
    for lo, hi in text_batches(batch, column):
        yield lo, [bytes(data[at[i]:at[i + 1]]) for i in range(lo, hi)]


# --- Spark jobs --------------------------------------------------------------------------

def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in _parts(b, "text"):
                total += np.bincount(features(texts, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return (docs.select(whole_text().alias("text")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from the two counts (``buckets`` rows at most)."""
    both = corpus.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in both.collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"] or 0, row["t"] or 0
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of SHA-256 of ``seed:doc_id``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weights(docs: DataFrame, gain: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    table = np.array(gain, np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, texts in _parts(b, "text"):
                doc, bucket, words = features(texts, len(table))
                order = np.argsort(doc, kind="stable")
                total = np.append(0, np.cumsum(table[bucket[order]]))
                n = np.bincount(doc, minlength=len(texts))
                at = np.append(0, np.cumsum(n))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(texts)), pa.array(words), pa.array(n),
                     pa.array(total[at[1:]] - total[at[:-1]])],
                    ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every row.

    ``rank`` numbers the drawn documents, best first; the others have none.
    Ranks come from a range partitioning by score (every document of at least
    ``min_words`` words takes part), so no task sorts all of them.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    scored = reliable_checkpoint(
        weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("at", F.monotonically_increasing_id()), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("at")]
    ranked = dense_index(scored.where(able), order, "place")
    rest = scored.where(~able).withColumn("place", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("place") <= drawn, F.col("place")).alias("rank"), "n_words")


def _half_byte_steps() -> str:
    """What CRC-32 (reflected polynomial 0xEDB88320) makes of each half byte, as a SQL list."""
    steps = list(range(16))
    for _ in range(4):
        steps = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in steps]
    return "[" + ", ".join(f"{c}::BIGINT" for c in steps) + "]"


SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS id, doc_id, text, true AS corpus FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
lists AS (SELECT id, doc_id, corpus, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
spots AS (SELECT id, unnest(words) AS word, unnest(range(len(words))) AS place FROM lists),
runs AS (SELECT id, word, lead(word) OVER w AS second, lead(word, 2) OVER w AS third FROM spots
    WINDOW w AS (PARTITION BY id ORDER BY place)),
features AS (SELECT id, unnest([word, word || ' ' || second, word || ' ' || second || ' ' || third]) AS feature FROM runs),
counted AS (SELECT id, feature, count(*) AS n FROM features WHERE feature IS NOT NULL GROUP BY ALL),
-- CRC-32 by half bytes, the low one first
hashed AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h)),
        lambda k: strpos('123456789ABCDEF', substr(h, xor(k, 1) + 1, 1))::BIGINT)),
    lambda c, x: xor(c >> 4, %s[(xor(c, x) & 15) + 1])), 4294967295) %% 10000 AS bucket
    FROM (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counted))),
bucketed AS (SELECT id, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL),
shares AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE id > 0), 0) AS s, coalesce(sum(n) FILTER (WHERE id < 0), 0) AS t
    FROM bucketed GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT
    AS g FROM shares),
weighed AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM bucketed JOIN gain USING (bucket) GROUP BY id),
scored AS (SELECT id, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296)))::BIGINT AS score FROM lists LEFT JOIN weighed USING (id) WHERE corpus),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
    count(*) FILTER (WHERE n_words >= 20) OVER () * 5 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank, n_words FROM placed
""" % _half_byte_steps()


def query(spark, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return resample(documents(spark, sf_dir), benchmark)
