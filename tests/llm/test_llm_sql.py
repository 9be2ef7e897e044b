"""The SQL twins of operators 4 and 5 against plain Python, without Spark."""

import hashlib
import random

import duckdb
import pyarrow as pa
from llm_brute import dropped_lines, near

from starloom.llm import jaccard, templates


def over(sql, rows):
    with duckdb.connect() as db:
        db.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()),
                                           "text": pa.array([r[1] for r in rows], pa.string())}))
        return db.sql(sql).fetchall()


def test_templates_sql():
    rng = random.Random(3)
    people = [f"name{'abcdefghijklmnopqrst'[i]}" for i in range(20)]
    kinds = ["Page {n} of {n}", "Written by {p} for {p} on day {n}", "{n}", "All rights reserved.",
             "Filed under   {p}", "<*> kept {p} {p}", "  ", "", "{p} {p} {p} {p} {n} {n} {n}", "count ٣ of {n}"]
    rows = [(i, "\n".join(rng.choice(kinds).replace("{n}", str(rng.randrange(50))).replace("{p}", rng.choice(people))
                          for _ in range(rng.randrange(1, 12)))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, rows[3][1]), (152, rows[3][1]), (None, rows[4][1]), (153, "\n\n")]
    gone = dropped_lines([t or "" for _, t in rows], templates.MIN_TEXTS, 1)
    assert sum(map(len, gone)) > 200
    want = []
    for (doc, text), drop in zip(rows, gone):
        split = text.split("\n") if text else []
        kept = "\n".join(x for i, x in enumerate(split) if i not in drop)
        want.append((doc, len(split), len(drop), len(kept), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(over(templates.SQL, rows), key=repr) == sorted(want, key=repr)


def test_jaccard_sql():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randrange(8, 90))] for _ in range(25)]
    texts = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(words) + rng.choice(["", "", " ", "\n"]))
    texts += ["", None, "one two", "one  two", "one", "Zürich " * 9, "a b c d e", texts[0], texts[0]]
    want = near(list(enumerate(texts)))
    assert sorted(over(jaccard.SQL, list(enumerate(texts)))) == sorted((k, *v) for k, v in want.items())
    assert any(links > size - 1 - links > 0 for _, size, links in want.values())  # chains, not only cliques
