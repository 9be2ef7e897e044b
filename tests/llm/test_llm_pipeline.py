"""The pipeline against the brute-force versions of its stages."""

from llm_brute import near, quality
from test_llm_operators import TOKENS, _tokens, check_pieces

import corpus_pipeline
from starloom.llm import pii

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {k: t for k, t in docs.items() if quality(t)["kept"]}
    last = {}
    for k in sorted(kept):
        last[kept[k] or ""] = k
    kept = {k: t for t, k in last.items()}
    first = {c for c, _, _ in near(sorted(kept.items())).values()}
    stage = spark.read.parquet(f"{SF}/documents.parquet")
    counts = []
    for name, f in corpus_pipeline.STAGES[:4]:
        stage = f(spark, stage, SF).cache()
        assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(stage.count())
    left = {r["doc_id"]: r["text"] for r in stage.collect()}
    assert set(left) == first and counts[1] == len(kept)
    changed = [k for k in left if left[k] != docs[k]]
    assert changed and all(any(c.isdigit() or c == "@" for c in docs[k]) for k in changed)

    rows = corpus_pipeline.run(spark, SF).collect()
    order = sorted(left)
    ids = _tokens([left[k] for k in order])
    place = {k: i for i, k in enumerate(order)}
    renamed = [r.asDict() | {"doc_id": place[r["doc_id"]]} for r in rows]
    assert check_pieces(renamed, ids, 1024) <= 1.05 * sum(map(len, ids)) / 1024 + 2
    assert TOKENS and pii.FORMS


def test_empty_table_passes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0


def test_odd_rows_and_clashing_columns(spark):
    import random

    rng = random.Random(3)
    def prose(n):
        return ". ".join(" ".join(rng.choice("abcdefgh") + str(rng.randrange(10)) + "word" for _ in range(8)) for _ in range(n))
    a, b, c = prose(6), prose(7), prose(200)
    rows = [(1, a), (1, a), (2, a), (None, b), (None, b), (3, None), (4, ""), (5, c), (None, None), (6, prose(5))]
    extra = "lang string, source string, n_chars long, node string, label int, dk string, th string, kept string, rest int, part string"
    docs = spark.createDataFrame([(*r, "x", "y", 1, "n", 2, "d", "t", "k", 3, "p") for r in rows],
                                 "doc_id long, text string, " + extra).repartition(3)
    columns, stage = docs.columns, docs
    left = []
    for _, f in corpus_pipeline.STAGES[:4]:
        stage = f(spark, stage, SF)
        assert stage.columns == columns
        left.append(sorted((r["doc_id"] or 0) for r in stage.collect()))
    assert left == [[0, 0, 1, 1, 2, 5, 6], [0, 2, 5, 6], [0, 2, 5, 6], [0, 2, 5, 6]]
    pieces = corpus_pipeline.STAGES[4][1](spark, stage, SF).collect()
    assert sorted({(r["doc_id"] or 0) for r in pieces}) == [0, 2, 5, 6]


def test_run_leaves_only_its_last_table(spark):
    import os

    from starloom.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0
    assert [x for x in os.listdir(root) if x not in before and x.startswith("starloom-packing")] == \
        [x for x in os.listdir(root) if x not in before]
