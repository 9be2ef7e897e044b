"""Importance resampling against a plain version over every n-gram."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from starloom.llm import resampling as R

SCHEMA = "doc_id long, text string, n_words string, weight int, at long, bucket string, lang string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text):
    ws = words(text)
    return [zlib.crc32(" ".join(ws[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def brute(rows, target):
    """(doc_id, n_features, weight, score, rank) of every row, in the order drawn."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(grams(text))
    for text in target:
        t.update(grams(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
            for b in range(10000)}
    out = []
    for doc, text in rows:
        g = grams(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(g), weight, score, len(words(text)) >= 20))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    drawn = 5 * len(able) // 100
    ranked = [(*r[:4], i if i <= drawn else None) for i, r in enumerate(able, 1)]
    return ranked + [(*r[:4], None) for r in out if not r[4]]


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcXYZé9ß") for _ in range(rng.choice([1, 2, 4, 7, 70]))) for _ in range(120)]
    rows = []
    for i in range(n):
        k = rng.choice([0, 1, 2, 3, 19, 20, 21, 40, 90])
        rows.append((i, "".join(rng.choice(vocab) + rng.choice([" ", " ", ". ", "\n", "\x00", "--"]) for _ in range(k))))
    rows += [(n, None), (n + 1, ""), (n + 2, " .,!\n"), (n + 3, "long " * 30000), (n + 4, "z" * 5000), (n + 4, "z" * 5000),
             (7, rows[7][1]), (None, rows[8][1]), (None, rows[8][1]), (None, "A word " * 40)]
    return rows, ["".join(rng.choice(vocab[:20]) + " " for _ in range(60)) for _ in range(10)] + [None, ""]


def frames(spark, rows, target):
    docs = spark.createDataFrame([(d, t, "x", 1, None, "b", None) for d, t in rows], SCHEMA).repartition(5)
    return docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


def test_resample_equals_brute_force(spark):
    rows, target = corpus()
    got = R.resample(*frames(spark, rows, target)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, target), key=key)


def test_no_target_and_empty_table(spark):
    rows, _ = corpus(60)
    got = R.resample(*frames(spark, rows, [])).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, []), key=repr)
    assert R.resample(*frames(spark, [], ["some text here"])).count() == 0


def test_given_tables(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{d}/benchmark.parquet").select("text").collect()]
    got = R.query(spark, d).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, target), key=repr)


def test_sql_equals_brute_force():
    import duckdb
    import pyarrow as pa

    rows, target = corpus(200, seed=9)
    documents = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows])})
    benchmark = pa.table({"item_id": list(range(len(target))), "text": pa.array(target)})
    with duckdb.connect() as db:
        db.register("documents", documents)
        db.register("benchmark", benchmark)
        got = [r[:5] for r in db.sql(R.SQL).fetchall()]
    assert sorted(got, key=repr) == sorted(brute(rows, target), key=repr)


def test_features_do_not_cross_documents():
    doc, bucket, n = R.features([b"one two", b"three", b"", b"four five six"], 10000)
    want = [Counter(grams(t)) for t in ("one two", "three", "", "four five six")]
    assert [Counter(bucket[doc == i].tolist()) for i in range(4)] == want
    assert n.tolist() == [2, 1, 0, 3]
