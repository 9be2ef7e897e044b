"""Conversation structure repair by generalised LR parsing with weighted edits.

A conversation is well formed when the first letters of its roles spell
``(s?(ua)+)?``.  The role grammar below is made into an LR automaton; a
repair reads the rows once, from left to right, and keeps a graph-structured
stack: every cell is a (state, cell below) pair that all stacks share, and a
set of stack tops stands for all repairs of the rows read so far.  At each row
every top may *delete* it, *keep* it (shift its letter) or *rerole* it (shift
the other one), after any *inserted* empty turns.  Equal tops are merged, and
of what they cost the least (cost, audit) stays, so a conversation of any
length has a handful of tops.

Audits are compared without being copied: after a row every top's audit
ends in that row's own letter, so none is the beginning of another, and the
order of the tops' audits (a small rank) and the letters added by the next row
decide the order of the longer ones.  The choices are kept as one byte per row
and top, from which the winner's audit is read back; the repaired text is hashed
on the way, a SHA-256 state per top.

Plan: the rows are shuffled once by conversation, with the text.  A window in
that partitioning marks repeats of (role, text), a sort inside the partition
puts the rows in order, and each task streams over them: what it holds of a
conversation is bounded by the tops, and a byte per row and top for the
audit, never its texts.  One conversation's rows do meet in one task: its result is a
single SHA-256 chain over all its texts, which cannot be split; both sorts spill.

Defined results: nulls read as one space (role, text, and in the key of the
damage); a null turn comes first and takes no part in the gaps; rows of one
turn go by role and text; a role counts by its first letter as it stands, and
an empty role has none, so it can only be deleted or reroled; a null
``conv_id`` is a conversation of its own; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import partitions

#: Productions of the role grammar; capitals are nonterminals, the first one is the start.
GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
END = "$"


# --- the LR automaton ----------------------------------------------------------------------

class Automaton:
    """SLR(1) tables of a grammar: ``shift[state, letter]``, ``reduce[state, letter]``, ``goto``."""

    def __init__(self, grammar: tuple[tuple[str, str], ...]):
        self.rules = (("", grammar[0][0]), *grammar)
        names = {left for left, _ in grammar}
        follow = self._follow(names)
        states = [self._closure({(0, 0)})]
        self.shift: dict[tuple[int, str], int] = {}
        self.goto: dict[tuple[int, str], int] = {}
        self.reduce: dict[tuple[int, str], tuple[str, int]] = {}
        self.accept: set[int] = set()
        for number, items in enumerate(states):  # grows while it is read
            after: dict[str, set] = {}
            for rule, dot in items:
                left, right = self.rules[rule]
                if dot < len(right):
                    after.setdefault(right[dot], set()).add((rule, dot + 1))
                elif not rule:
                    self.accept.add(number)
                else:
                    for letter in follow[left]:
                        self.reduce[number, letter] = (left, len(right))
            for symbol, kernel in after.items():
                target = self._closure(kernel)
                if target not in states:
                    states.append(target)
                (self.goto if symbol in names else self.shift)[number, symbol] = states.index(target)

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            new = {(k, 0) for k, (left, _) in enumerate(self.rules)
                   if k and left == self.rules[rule][1][dot:dot + 1]} - items
            items |= new
            todo += new
        return frozenset(items)

    def _follow(self, names: set) -> dict[str, set]:
        empty = {left for left, right in self.rules if not right}
        first = {n: set() for n in names}
        follow = {n: set() for n in names} | {"": {END}}
        while True:
            before = repr((first, follow))
            for left, right in self.rules:
                tail = set(follow[left])
                for symbol in reversed(right):
                    start = first[symbol] if symbol in names else {symbol}
                    if symbol in names:
                        follow[symbol] |= tail
                    tail = tail | start if symbol in empty else set(start)
                if left and right:
                    first[left] |= first[right[0]] if right[0] in names else {right[0]}
            if repr((first, follow)) == before:
                return follow


class Cell:
    """A cell of the graph-structured stack: a state and the cell below it, shared by equal stacks."""

    __slots__ = ("state", "below", "above")

    def __init__(self, state: int, below: Cell | None):
        self.state, self.below, self.above = state, below, {}

    def push(self, state: int) -> Cell:
        if state not in self.above:
            self.above[state] = Cell(state, self)
        return self.above[state]


class Repair:
    """Cheapest edits of one conversation after another, over one shared stack graph."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = GRAMMAR):
        self.lr = Automaton(grammar)
        self.bottom = Cell(0, None)
        self._shifted: dict[tuple[Cell, str], Cell | None] = {}
        self._inserted: dict[Cell, list[tuple[str, Cell]]] = {}

    def shifted(self, cell: Cell, letter: str) -> Cell | None:
        """The stack after reductions and the shift of ``letter``; None if it does not fit."""
        key = (cell, letter)
        if key not in self._shifted:
            at = self._reduced(cell, letter)
            state = self.lr.shift.get((at.state, letter))
            self._shifted[key] = None if state is None else at.push(state)
        return self._shifted[key]

    def _reduced(self, cell: Cell, letter: str) -> Cell:
        while (cell.state, letter) in self.lr.reduce:
            left, size = self.lr.reduce[cell.state, letter]
            for _ in range(size):
                cell = cell.below
            cell = cell.push(self.lr.goto[cell.state, left])
        return cell

    def complete(self, cell: Cell) -> bool:
        return self._reduced(cell, END).state in self.lr.accept

    def inserted(self, cell: Cell) -> list[tuple[str, Cell]]:
        """(inserted letters, stack): every stack that insertions lead to, by the fewest of them."""
        if cell not in self._inserted:
            found, seen = [("", cell)], {cell}
            for letters, at in found:  # grows while it is read
                for letter in ROLES:
                    to = self.shifted(at, letter)
                    if to is not None and to not in seen:
                        seen.add(to)
                        found.append((letters + letter, to))
            self._inserted[cell] = found
        return self._inserted[cell]


class Conversation:
    """The tops of one conversation's stack graph, fed row by row.

    A top is (stack, cost, text hash); tops stand in the order of their audits.
    """

    def __init__(self, repair: Repair):
        self.repair = repair
        self.tops = [(repair.bottom, 0, None)]
        self.steps: list[bytes] = []  # per row and top: which top it came from, and the letters
        self.codes: dict[tuple[int, str], int] = {}
        self.names: list[tuple[int, str]] = []

    def _code(self, parent: int, letters: str) -> int:
        key = (parent, letters)
        if key not in self.codes:
            self.codes[key] = len(self.names)
            self.names.append(key)
        return self.codes[key]

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        best: dict[Cell, tuple] = {}

        def offer(cell: Cell | None, cost: int, parent: int, letters: str, lines: tuple) -> None:
            if cell is not None:
                new = (cost, parent, letters, lines)
                if cell not in best or new[:3] < best[cell][:3]:
                    best[cell] = new

        extra = TRUNCATED if truncated else 0
        for parent, (cell, cost, _) in enumerate(self.tops):
            # an insertion before a deletion costs what it does after it, where its audit is less
            offer(cell, cost + DELETE, parent, "D", ())
            if must_go:
                continue
            for new, at in self.repair.inserted(cell):
                c, letters = cost + INSERT * len(new) + extra, "I" * len(new)
                offer(self.repair.shifted(at, role[:1]), c + KEEP, parent, letters + "K", (new, role))
                for letter, name in ROLES.items():
                    offer(self.repair.shifted(at, letter), c + REROLE, parent, letters + "R", (new, name))
        order = sorted(best.items(), key=lambda x: x[1][1:3])
        tops = []
        for cell, (cost, parent, letters, lines) in order:
            sha = self.tops[parent][2]
            if lines:
                sha = _said(_said(sha, lines[0]), None, f"{lines[1]}:{text}")
            tops.append((cell, cost, sha))
        self.steps.append(bytes(self._code(p, letters) for _, (_, p, letters, _) in order))
        self.tops = tops

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired text)."""
        cost, top, letters, sha = min(
            ((cost + INSERT * len(new), top, "I" * len(new), _said(sha, new))
             for top, (cell, cost, sha) in enumerate(self.tops)
             for new, at in self.repair.inserted(cell) if self.repair.complete(at)),
            key=lambda x: x[:3])
        audit = [letters]
        for step in reversed(self.steps):
            top, letters = self.names[step[top]]
            audit.append(letters)
        return cost, "".join(reversed(audit)), (sha or hashlib.sha256()).hexdigest()


def _said(sha, inserted: str | None, line: str | None = None):
    """A hash state with more lines; the state given is shared and stays as it is."""
    lines = [f"{ROLES[x]}:" for x in inserted or ""] + ([line] if line is not None else [])
    if not lines:
        return sha
    if sha is None:
        sha = hashlib.sha256()
    else:
        sha = sha.copy()
        sha.update(b"\n")
    sha.update("\n".join(lines).encode())
    return sha


# --- Spark jobs ----------------------------------------------------------------------------

_BLANKS = " \t\n\x0b\f\r"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows after the contract's damage.

    A dropped row stays as a mark of its conversation (``gone``), without its text.
    """
    def part(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).cast("int")
    text = F.coalesce("text", F.lit(" "))
    out = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"))
    return out.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")) \
        .drop("copy")


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, gone): faults, gaps and the cheapest repair."""
    last = F.right(F.rtrim(F.col("text"), F.lit(_BLANKS)), F.lit(1))
    marked = rows.withColumn("blank", last == "").withColumn("open", ~last.isin("", ".", "!", "?"))
    said = Window.partitionBy("conv_id", "role", F.xxhash64("text"), "text", "gone") \
        .orderBy(F.col("turn").asc_nulls_first())
    spread = marked.repartition(partitions(rows.sparkSession), "conv_id") \
        .withColumn("again", F.row_number().over(said) > 1)
    ordered = spread.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again") \
        .select("conv_id", "turn", "role", "text", "gone", "blank", "again", "open")
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    return ordered.mapInArrow(_repair_rows, schema)


@lru_cache(maxsize=1)
def _repair() -> Repair:
    return Repair()


class _Report:
    """Counts of one conversation while its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.edits = conv_id, Conversation(_repair())
        self.low = self.high = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn, role: str, text: str, blank: bool, again: bool, cut: bool) -> None:
        if turn is not None:
            if turn != self.high:  # rows come by turn
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.before is not None and (self.before + role[:1]) not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        again, cut = again and not blank, cut and not again
        self.blank += blank
        self.duplicate += again
        self.truncated += cut
        self.edits.row(role, text, blank or again, cut)

    def values(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.edits.result())


def _repair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    report, done, kind = None, [], None

    def rows_out() -> pa.RecordBatch:
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
            + [pa.array(c, pa.string()) for c in columns[7:]], names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, turn, role, text, gone, blank, again, cut in zip(*(c.to_pylist() for c in batch.columns)):
            if report is None or conv != report.conv_id:
                if report is not None:
                    done.append(report.values())
                report = _Report(conv)
            if not gone:
                report.row(turn, role, text, blank, again, cut)
        if done:
            yield rows_out()
            done = []
    if report is not None:
        done.append(report.values())
        yield rows_out()


SQL = r"""
WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
base AS (SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hit AS (SELECT base.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''),
    lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM base, poly),
dam AS (SELECT id, conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again FROM hit WHERE kind <> 0),
lined AS (SELECT *, row_number() OVER c AS n, coalesce(left(role, 1), '') AS letter, lag(left(role, 1)) OVER c AS prev,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, id, again) > 1 AS seen,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS fin FROM dam
    WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, id, again)),
faults AS (SELECT *, fin = '' AS blank, fin <> '' AND seen AS dup, fin <> '' AND NOT seen AND fin NOT IN ('.', '!', '?') AS cut FROM lined),
-- from a letter ('0': none yet), by a letter, after these insertions, to that letter
moves(f, x, ins, k) AS (VALUES ('0', 's', '', 0), ('0', 'u', '', 0), ('s', 'u', '', 0), ('a', 'u', '', 0), ('u', 'u', 'assistant:', 1),
    ('u', 'a', '', 0), ('0', 'a', 'user:', 1), ('s', 'a', 'user:', 1), ('a', 'a', 'user:', 1)),
step AS (
    SELECT conv_id, 0::BIGINT AS n, '0' AS state, 0 AS cost, '' AS audit, '' AS out FROM (SELECT DISTINCT conv_id FROM dam)
    UNION ALL
    SELECT conv_id, n, state, cost, audit, out FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS best FROM (
            SELECT s.conv_id, r.n, s.state, s.cost + 3 AS cost, s.audit || 'D' AS audit, s.out
            FROM step s JOIN faults r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.n = s.n + 1
            UNION ALL
            SELECT s.conv_id, r.n, m.x, s.cost + 2 * m.k + r.cut::INT + e.c, s.audit || repeat('I', m.k) || e.a,
                s.out || CASE WHEN s.out = '' OR m.ins = '' THEN '' ELSE chr(10) END || m.ins
                || CASE WHEN s.out = '' AND m.ins = '' THEN '' ELSE chr(10) END
                || CASE e.a WHEN 'K' THEN r.role WHEN 'R' THEN CASE m.x WHEN 'u' THEN 'user' ELSE 'assistant' END END || ':' || r.text
            FROM step s JOIN faults r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.n = s.n + 1
            JOIN moves m ON m.f = s.state JOIN (VALUES ('K', 0), ('R', 2)) e(a, c)
                ON NOT (r.blank OR r.dup) AND CASE e.a WHEN 'K' THEN m.x = r.letter ELSE m.x <> 's' END) q) q
    WHERE best = 1),
size AS (SELECT conv_id, max(n) AS n, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS duplicate,
    count(*) FILTER (WHERE cut) AS truncated,
    count(*) FILTER (WHERE prev IS NOT NULL AND prev || letter NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM faults GROUP BY conv_id),
ends AS (SELECT s.conv_id, s.cost + e.k * 2 AS cost, s.audit || repeat('I', e.k) AS audit,
    s.out || CASE WHEN e.t = '' OR s.out = '' THEN '' ELSE chr(10) END || e.t AS out
    FROM step s JOIN size z ON z.conv_id IS NOT DISTINCT FROM s.conv_id AND z.n = s.n
    JOIN (VALUES ('0', 0, ''), ('a', 0, ''), ('u', 1, 'assistant:'), ('s', 2, 'user:' || chr(10) || 'assistant:')) e(f, k, t) ON e.f = s.state),
won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM ends) WHERE best = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(out, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN size z ON z.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN won w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def query(spark, sf_dir: str) -> DataFrame:
    return repaired(damaged(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")))
