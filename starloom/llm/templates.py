"""Recurring lines by a fixed-depth template tree.

A line is parsed as in the Drain log parser: the first level of the tree is
its number of tokens, the next ``DEPTH`` levels its leading tokens (a token
with a digit reads ``<*>``), which leads to a leaf.  A token's support is the
number of the leaf's distinct texts that carry it at its position.  Each line
has its own bar: the greatest of ``MIN_TEXTS`` times 1, 2, 4, ... that at
least half of its tokens reach.  Tokens that reach it are constant, the others
are variable fields and generalise to ``<*>``.  The result is the line's
template; a line without a bar has none.  A template that occurs in
``MIN_TEXTS`` distinct texts or more recurs, and its lines are dropped.

The bar grows with the template: its fixed words have the support of all its
texts, a field's value that of its own share, so a common value stays a field
however many texts there are.  Only a value that more than half of a
template's texts share can pass for a fixed word.

Unlike the parser's own update rule, support does not depend on the order in
which lines arrive, so any partitioning gives the same templates.  Support
counts distinct texts: copies of one document do not make its lines recur.

No step gathers a leaf or a template in one task: everything is counted over
distinct masked lines with map-side partial sums, and the one join against
occurrences has a unique right side, which the adaptive skew join may split.

The registered query parses every line that is not blank.  A line of up to
``DEPTH`` tokens has its leaf to itself, so its masked tokens are its template.
Callers of ``drop_lines`` who want to keep short lines set ``min_tokens``,
which is ``MIN_TOKENS`` unless given.

Defined results: null and empty texts have no lines to drop; blank lines and
lines with a digit in more than half of their tokens (a page number alone, say)
always stay; repeated rows get equal results; a null ``doc_id`` is carried
through; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import documents, keyed
from starloom.session import reliable_checkpoint

MIN_TEXTS = 10
MIN_TOKENS = 4
DEPTH = 3
WILD = "<*>"

_DIGIT = re.compile(r"\d")


def mask(tokens: list[str]) -> list[str]:
    return [WILD if _DIGIT.search(t) else t for t in tokens]


def leaf(tokens: list[str], depth: int = DEPTH) -> int:
    """The leaf of the tree: token count, then the leading tokens."""
    path = "\x00".join([str(len(tokens)), *mask(tokens[:depth])])
    return xxhash.xxh64_intdigest(path) - (1 << 63)


def _lines_of(text: str, min_tokens: int) -> Iterator[tuple[int, list[str]]]:
    for i, line in enumerate(text.split("\n")):
        tokens = line.split()
        if len(tokens) >= min_tokens:
            yield i, tokens


def _leaves(docs: DataFrame, min_tokens: int) -> DataFrame:
    """(dk, th, line, leaf) of every line that is long enough."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, at, leaves = [], [], []
            for r, text in enumerate(map(str, b.column(2))):
                for i, tokens in _lines_of(text, min_tokens):
                    row.append(r)
                    at.append(i)
                    leaves.append(leaf(tokens))
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(at, pa.int32()),
                 pa.array(leaves, pa.int64())], ["dk", "th", "line", "leaf"])
    return docs.select("dk", "th", "text").mapInArrow(parse, "dk long, th long, line int, leaf long")


def _candidates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(dk, th, line, leaf, masked) of the lines in recurring leaves, from the whole texts."""
    per_doc = lines.groupBy("dk", "th").agg(F.collect_set(F.struct("line", "leaf")).alias("lines"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, at, leaves, masked = [], [], [], []
            for r, (text, wanted) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                split = text.split("\n")
                for w in wanted:
                    row.append(r)
                    at.append(w["line"])
                    leaves.append(w["leaf"])
                    masked.append(mask(split[w["line"]].split()))
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(at, pa.int32()),
                 pa.array(leaves, pa.int64()), pa.array(masked, pa.list_(pa.string()))],
                ["dk", "th", "line", "leaf", "masked"])
    return (docs.join(per_doc, ["dk", "th"]).select("dk", "th", "text", "lines")
            .mapInArrow(read, "dk long, th long, line int, leaf long, masked array<string>"))


def _support(rows: DataFrame, keys: list[str], min_texts: int) -> DataFrame:
    """Keys that at least ``min_texts`` distinct texts carry."""
    return (rows.select(*keys, "th").distinct().groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts))


def _token_support(found: DataFrame, distinct: DataFrame, min_texts: int) -> DataFrame:
    """(leaf, pos, token, n): the n distinct texts, ``min_texts`` or more, that carry the token there.

    Counted over distinct lines; what texts with several lines in one leaf
    count too often is taken off again.
    """
    counted = distinct.select("leaf", F.col("texts").alias("n"), F.posexplode("masked").alias("pos", "token"))
    several = (found.groupBy("leaf", "th").agg(F.min("mline").alias("a"), F.max("mline").alias("b"))
               .where("a < b").select("leaf", "th"))
    again = (found.join(several, ["leaf", "th"]).select("leaf", "th", "mline", "masked").distinct()
             .select("leaf", "th", F.posexplode("masked").alias("pos", "token"))
             .groupBy("leaf", "th", "pos", "token").agg((1 - F.count(F.lit(1))).alias("n")).where("n < 0")
             .select("leaf", "n", "pos", "token"))
    return (counted.unionByName(again).where(F.col("token") != WILD).groupBy("leaf", "pos", "token")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= min_texts))


def _bar(tokens: Column, min_texts: int) -> Column:
    """``min_texts`` times the greatest power of two that half of the tokens' supports reach; null if none."""
    support = F.sort_array(F.transform(tokens, lambda x: F.coalesce(x["n"], F.lit(0))), False)
    half = F.element_at(support, F.ceil(F.size(tokens) / 2).cast("int"))
    doublings = F.length(F.bin(F.floor(half / min_texts))) - 1
    return F.when(half >= min_texts, min_texts * F.pow(F.lit(2), doublings).cast("long"))


def recurring(docs: DataFrame, min_texts: int = MIN_TEXTS, min_tokens: int = MIN_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(template, texts) that recur, and the (dk, th, line) to drop, of ``keyed`` documents."""
    lines = reliable_checkpoint(_leaves(docs, min_tokens), "leaves")
    busy = _support(lines, ["leaf"], min_texts).select("leaf")
    found = reliable_checkpoint(_candidates(docs, lines.join(busy, "leaf")), "candidates")

    found = found.withColumn("mline", F.xxhash64("leaf", "masked"))
    # each distinct masked line once, with the distinct texts that carry it
    distinct = (found.select("leaf", "mline", "masked", "th").distinct()
                .groupBy("leaf", "mline").agg(F.count(F.lit(1)).alias("texts"), F.first("masked").alias("masked")))
    distinct = reliable_checkpoint(distinct, "lines")
    tokens = distinct.select("leaf", "mline", F.posexplode("masked").alias("pos", "token"))
    shape = (tokens.join(_token_support(found, distinct, min_texts), ["leaf", "pos", "token"], "left")
             .groupBy("leaf", "mline").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "n"))).alias("t"))
             .withColumn("bar", _bar(F.col("t"), min_texts)).where("bar IS NOT NULL")
             .select("leaf", "mline", F.array_join(F.transform(
                 "t", lambda x: F.when(x["n"] >= F.col("bar"), x["token"]).otherwise(WILD)), " ").alias("template")))
    shape = reliable_checkpoint(shape, "shapes")
    # a template's distinct texts, over all its lines
    texts = (found.select("leaf", "mline", "th").distinct().join(shape, ["leaf", "mline"])
             .select("leaf", "template", "th").distinct().groupBy("leaf", "template")
             .agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts))
    texts = reliable_checkpoint(texts, "templates")
    dropped = shape.join(texts, ["leaf", "template"]).select("leaf", "mline")
    rows = found.select("dk", "th", "line", "leaf", "mline").join(dropped, ["leaf", "mline"], "left_semi")
    return texts.select("template", "texts"), rows.select("dk", "th", "line")


def drop_lines(docs: DataFrame, min_texts: int = MIN_TEXTS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every row."""
    own = keyed(docs)
    _, lines = recurring(own, min_texts, min_tokens)
    per_doc = lines.groupBy("dk", "th").agg(F.collect_set("line").alias("lines"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for text, lines in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                split = text.split("\n") if text else []
                drop = set(lines or ())
                n.append(len(split))
                gone.append(len(drop))
                kept.append("\n".join([x for i, x in enumerate(split) if i not in drop]) if drop else text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (own.join(per_doc, ["dk", "th"], "left").select("doc_id", "text", "lines")
            .mapInArrow(cut, f"doc_id {kind}, n_lines long, n_dropped long, kept_text string"))


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS k, text, string_split(text, chr(10)) AS split
    FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
lines AS (SELECT k, unnest(split) AS line, unnest(range(len(split))) AS place FROM t WHERE text <> ''),
-- white space and digits as Unicode has them
parsed AS (SELECT k, place, list_transform(regexp_extract_all(line,
    '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'),
    lambda x: CASE WHEN regexp_matches(x, '\p{Nd}') THEN '<*>' ELSE x END) AS masked FROM lines),
found AS (SELECT k, place, masked FROM parsed WHERE len(masked) > 0),
carried AS (SELECT DISTINCT k, masked FROM found),
support AS (SELECT size, lead, pos, token, count(DISTINCT k) AS n FROM (SELECT k, len(masked) AS size, masked[1:%(depth)d] AS lead,
    unnest(range(len(masked))) AS pos, unnest(masked) AS token FROM carried) WHERE token <> '<*>' GROUP BY ALL HAVING count(DISTINCT k) >= %(texts)d),
tokens AS (SELECT masked, len(masked) AS size, masked[1:%(depth)d] AS lead, unnest(range(len(masked))) AS pos, unnest(masked) AS token
    FROM (SELECT DISTINCT masked FROM carried)),
rated AS (SELECT masked, size, lead, list({'token': token, 'n': coalesce(n, 0)} ORDER BY pos) AS ts,
    list_reverse_sort(list(coalesce(n, 0)))[(size + 1) // 2] AS half
    FROM tokens LEFT JOIN support USING (size, lead, pos, token) GROUP BY masked, size, lead),
shape AS (SELECT masked, size, lead, list_transform(ts, lambda x: CASE WHEN x.n >= bar THEN x.token ELSE '<*>' END) AS template
    FROM (SELECT *, %(texts)d * (1 << (length(bin(half // %(texts)d)) - 1)) AS bar FROM rated WHERE half >= %(texts)d)),
recurring AS (SELECT size, lead, template FROM carried JOIN shape USING (masked) GROUP BY ALL HAVING count(DISTINCT k) >= %(texts)d),
gone AS (SELECT k, place FROM found JOIN shape USING (masked) JOIN recurring USING (size, lead, template)),
kept AS (SELECT k, count(gone.k) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone.k IS NULL), '') AS kept_text
    FROM lines LEFT JOIN gone USING (k, place) GROUP BY k)
SELECT d.doc_id, CASE WHEN t.text = '' THEN 0 ELSE len(split) END::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
    length(coalesce(kept_text, ''))::BIGINT AS kept_chars, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM documents d JOIN t ON t.text = coalesce(d.text, '') LEFT JOIN kept USING (k)
""" % {"texts": MIN_TEXTS, "depth": DEPTH}


def query(spark, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines, and a digest of the text that is left."""
    return (drop_lines(documents(spark, sf_dir), min_tokens=1)
            .select("doc_id", "n_lines", "n_dropped", F.length("kept_text").cast("long").alias("kept_chars"),
                    F.sha2("kept_text", 256).alias("kept_sha256")))
