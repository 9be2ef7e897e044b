"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the
measurements and one bit per failed rule; a policy is a named, versioned set
of rules, so a new policy or an ablation is bitwise work on the stored bits
and never reads the texts again.

Only DataFrame functions run here.  One document's ledger is one expression:
``_bind`` evaluates a value once and names it, however often it is used, so a
filter on the verdict cannot make Spark split the words again.

Defined results: a null or empty text has no words and fails ``few_words``;
repeated rows each get their own, equal ledger row; a null ``doc_id`` is
carried through; other columns are not read by the rules and stay untouched in
``accept``; an empty table gives an empty ledger.

Repeated windows are found by 64-bit fingerprints compared within one
document only (n windows collide with probability below n * n / 2**65).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import whole_text

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements, in whole numbers."""

    name: str
    fails: str


#: The order fixes the bits: append new rules, never reorder.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 14 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("stutter", "100 * n_stutter > 30 * n_words"),
    Rule("repeated_text", "10 * dup_line_chars > 3 * line_chars"),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_stutter", "line_chars", "dup_line_chars")


@dataclass(frozen=True)
class Policy:
    """A document passes when none of the policy's rules failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(r) for r in self.rules)


def bit(rule: str) -> int:
    return 1 << [r.name for r in RULES].index(rule)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
#: A count of repeated lines rejects a document whose first line is its last, around any text ...
FULL_1 = Policy("full-1", ("few_words", "repeated_windows", "symbols", "short_words", "long_words",
                           "repeated_lines", "stutter"))
#: ... so since this version the share of the text that lies in repeated lines decides.
FULL = Policy("full-2", ("few_words", "repeated_windows", "symbols", "short_words", "long_words",
                         "stutter", "repeated_text"))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window found twice or more."""
    hashed = F.slice(F.transform(words, lambda w, i: F.xxhash64(
        w, *[F.get(words, i + k) for k in range(1, WINDOW)])),
        F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))

    def covered(at: Column) -> Column:
        # each place adds the words up to the next one, the last a whole window
        gaps = F.transform(at, lambda p, i: F.least(
            F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda n, g: n + g)

    def repeated(pairs: Column) -> Column:
        same = F.filter(pairs, lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]) |
                        F.coalesce(p["h"] == F.get(pairs, i + 1)["h"], F.lit(False)))
        return _bind(F.sort_array(F.transform(same, lambda p: p["i"])), covered)

    return _bind(hashed, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        _bind(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
              repeated)))


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.length(x))


def ledger_column(text: Column) -> Column:
    """Measurements and ``fail_bits`` of one text, as a struct."""
    def measured(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _bind(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), lambda x: _bind(
                F.array_distinct(x), lambda once: F.struct(
                    F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(once)).cast("long").alias("n_dup_lines"),
                    _chars(x).alias("line_chars"), (_chars(x) - _chars(once)).alias("dup_line_chars")))).alias("lines"),
            F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("long").alias("n_stutter"),
            _repeat_words(words).cast("long").alias("n_repeat_words"))

    def judged(m: Column) -> Column:
        value = {k: m["lines"][k] if "line" in k else m[k] for k in MEASURES}
        bits = F.lit(0).cast("long")
        for rule in RULES:
            bits = bits + F.when(_fails(rule, value), F.lit(bit(rule.name))).otherwise(0)
        return F.struct(*[value[k].alias(k) for k in MEASURES], bits.alias("fail_bits"))

    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    return _bind(_bind(words, measured), judged)


def _fails(rule: Rule, value: dict[str, Column]) -> Column:
    """``[a *] x  <|>  [b *] y`` over the measurements."""
    left, sign, right = rule.fails.replace("<", "|<|").replace(">", "|>|").split("|")

    def side(s: str) -> Column:
        out = F.lit(1).cast("long")
        for part in s.split("*"):
            out = out * (value[part.strip()] if part.strip() in value else F.lit(int(part)))
        return out
    return side(left) < side(right) if sign == "<" else side(left) > side(right)


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, fail_bits) for every row."""
    q = docs.select("doc_id", ledger_column(whole_text()).alias("q"))
    return q.select("doc_id", "q.*")


def passes(fail_bits: Column, policy: Policy) -> Column:
    return fail_bits.bitwiseAND(F.lit(policy.mask)) == 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else, kept without it.

    One count per distinct bit pattern (at most 2**rules rows) answers all of
    it; the texts are not read.
    """
    seen = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("b"))
                      for r in policy.rules])
    fails = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    without = fails.bitwiseAND(F.bitwise_not(F.col("r.b")))
    has = fails.bitwiseAND(F.col("r.b")) != 0
    return (seen.withColumn("r", F.explode(rules)).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(has, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(has & (without == 0), F.col("n")).otherwise(0)).alias("failed_alone"),
                 F.sum(F.when(without == 0, F.col("n")).otherwise(0)).alias("kept_without"))
            .withColumn("policy", F.lit(policy.version)))


def accept(docs: DataFrame, policy: Policy = FULL) -> DataFrame:
    """The rows that pass the policy, with their own columns."""
    return docs.where(passes(ledger_column(whole_text())["fail_bits"], policy))


def verdicts(docs: DataFrame) -> DataFrame:
    """The ledger with both verdicts of the current policies; what rules beyond the base read stands last."""
    base = MEASURES[:MEASURES.index("n_repeat_words") + 1]
    return ledger(docs).select(
        "doc_id", *base, (~passes(F.col("fail_bits"), BASE)).alias("base_failed"),
        passes(F.col("fail_bits"), FULL).alias("kept"), *[k for k in MEASURES if k not in base], "fail_bits")


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
win AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
        FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, generate_series(0, 4) AS s(k) GROUP BY r),
m AS (SELECT t.doc_id, len(ws)::BIGINT AS n_words,
        length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        len(list_filter(list_zip(ws, list_slice(ws, 2, len(ws))), lambda x: x[1] = x[2]))::BIGINT AS n_stutter,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM t JOIN w USING (r) LEFT JOIN rep USING (r)),
v AS (SELECT * EXCLUDE (ls), len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0)::BIGINT AS line_chars,
        coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0)::BIGINT
        - coalesce(list_sum(list_transform(list_distinct(ls), lambda x: length(x))), 0)::BIGINT AS dup_line_chars FROM m),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM v)
SELECT *, ((n_words < 10)::BIGINT + (100 * n_repeat_words > 20 * n_words)::BIGINT * 2
    + (10 * n_symbols > n_words)::BIGINT * 4 + (word_chars < 2 * n_words)::BIGINT * 8
    + (word_chars > 14 * n_words)::BIGINT * 16 + (10 * n_dup_lines > 3 * n_lines)::BIGINT * 32
    + (100 * n_stutter > 30 * n_words)::BIGINT * 64 + (10 * dup_line_chars > 3 * line_chars)::BIGINT * 128)::BIGINT AS fail_bits,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words
       OR 100 * n_stutter > 30 * n_words OR 10 * dup_line_chars > 3 * line_chars) AS kept
FROM f
"""
