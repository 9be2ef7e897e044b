"""Toxicity by non-negative positive-unlabelled learning.

Training sees confirmed toxic examples and unlabelled text only: a label 0 is
never read as "clean".  With class prior p the risk of a linear classifier is

    p * R_pos(+1)  +  max(0, R_unl(-1) - p * R_pos(-1)),

the non-negative estimator of Kiryo et al. (2017): where the second term
turns negative, the step follows its negation, so the classifier cannot
overfit by calling every known positive an outlier.

``MEMBERS`` numpy classifiers are fitted in parallel, each in one task on its
own part of a bounded sample, and their weights averaged.  Features are the
lower-cased words of a text and their beginnings (compounds share a stem),
each as found once, twice or three times and more.  A member keeps the ``VOCABULARY`` features whose share among the
positives stands out most against the unlabelled text, so the weights, which
go to every task, have a proven bound.

Sample bound (documented parameter): at most ``POSITIVES`` toxic rows and
``UNLABELLED`` rows of the label table with their labels hidden, taken in the
order of a hash of the id, texts that occur twice once.  Scoring covers every
whole text.

Defined results: a null or empty text has no words and gets the score of the
intercept; repeated rows get equal scores; without any toxic example in the
training rows every score is 0; ``lang``, ``source``, ``doc_id`` and labels
are never features; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import documents, whole_text
from starloom.session import reliable_checkpoint

POSITIVES = 2_000
UNLABELLED = 8_000
MEMBERS = 4
VOCABULARY = 2_048
FOLDS = 5

_WORDS = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


#: A feature says that a word or beginning occurs so many times at least.
TIMES = (1, 2, 3)


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def forms_of(word: str) -> list[str]:
    """The word, and its beginnings of 3 to 7 letters (marked by a caret)."""
    return [word, *["^" + word[:n] for n in range(3, min(len(word), 7) + 1)]]


def counted(forms: Counter) -> list[str]:
    return [f"{form}*{k}" for form, n in forms.items() for k in TIMES if n >= k]


def features(text: str) -> set[str]:
    return set(counted(Counter(f for w in words(text) for f in forms_of(w))))


def training_sample(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
                    unlabelled: int = UNLABELLED) -> tuple[DataFrame, DataFrame]:
    """(member, positive, text) of the bounded sample, and (prior): the share of toxic rows.

    Only rows outside the held-out fold are read for labels.  The unlabelled
    side is drawn from all those rows alike, toxic or not.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"))
    prior = known.agg(F.avg(F.col("toxic").cast("double")).alias("prior"))
    order = F.xxhash64("doc_id")
    pos = known.where("toxic = 1").orderBy(order, "doc_id").limit(positives) \
        .select("doc_id", F.lit(True).alias("positive"))
    unl = known.orderBy(order, "doc_id").limit(unlabelled) \
        .select("doc_id", F.lit(False).alias("positive"))
    chosen = reliable_checkpoint(pos.unionByName(unl), "sample")
    # the sample's size is bounded by the two parameters, so it may be broadcast
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id") \
        .select("text", "positive").dropDuplicates(["text", "positive"])
    all_members = F.array(*[F.lit(m) for m in range(MEMBERS)])
    member = F.when(F.col("positive"), all_members).otherwise(
        F.array(F.pmod(F.xxhash64("text"), F.lit(MEMBERS)).cast("int")))
    return texts.withColumn("member", F.explode(member)), prior


def fit(pos: list, unl: list, prior: float, vocabulary: int = VOCABULARY, steps: int = 1_000,
        rate: float = 0.02, decay: float = 3e-4, read: Callable[[object], set[str]] = set,
        ) -> tuple[dict[str, float], float]:
    """Weights by feature and the intercept of one nnPU classifier (logistic loss, Adam).

    ``read`` gives a document's features; it is called anew for every pass, so
    the features of one document at a time are held.
    """
    seen: Counter[str] = Counter()
    for doc in pos:
        seen.update(read(doc))
    least = 2 if len(pos) < 50 else 3
    common = {w: n for w, n in seen.items() if n >= least}
    del seen
    every: Counter[str] = Counter()
    for doc in unl:
        every.update(read(doc) & common.keys())

    def stands_out(w: str) -> float:
        p, u = common[w] / len(pos), every[w] / max(1, len(unl))
        return (p - u) ** 2 / (u + 1 / len(pos))
    vocab = {w: i for i, w in enumerate(sorted(common, key=lambda w: (-stands_out(w), w))[:vocabulary])}
    docs = [np.array(sorted(vocab[w] for w in read(doc) & vocab.keys()), np.int64) for doc in [*pos, *unl]]
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    col = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    n_pos, n_unl = len(pos), max(1, len(unl))
    is_pos = np.arange(len(docs)) < n_pos
    w = np.zeros(len(vocab) + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], len(docs)) + w[-1]
        up = 1 / (1 + np.exp(-z))                      # d loss(-1) / dz; up - 1 for loss(+1)
        soft = np.logaddexp(0, z)
        negative = soft[~is_pos].sum() / n_unl - prior * soft[is_pos].sum() / n_pos
        unl_part = np.where(is_pos, -prior * up / n_pos, up / n_unl)
        pos_part = np.where(is_pos, prior * (up - 1) / n_pos, 0)
        g = pos_part + unl_part if negative >= 0 else -unl_part
        grad = np.append(np.bincount(col, g[row], len(vocab)), g.sum())
        grad[:-1] += decay * w[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return {word: float(w[i]) for word, i in vocab.items()}, float(w[-1])


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float] | None:
    """Averaged weights and intercept of the members; None without a toxic example."""
    sample, prior_row = training_sample(docs, labels)
    share = prior_row.first()["prior"]
    if not share:
        return None
    prior = min(max(float(share), 0.001), 0.5)

    def member(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("text", "ascending")])  # the same sums in any order of arrival
        texts, flag = rows.column("text").to_pylist(), rows.column("positive").to_pylist()
        pos = [t for t, p in zip(texts, flag) if p]
        unl = [t for t, p in zip(texts, flag) if not p]
        if not pos or not unl:
            return pa.table({"word": pa.array([], pa.string()), "weight": pa.array([], pa.float64())})
        by_word, bias = fit(pos, unl, prior, read=features)
        return pa.table({"word": pa.array([*by_word, None], pa.string()),
                         "weight": pa.array([*by_word.values(), bias], pa.float64())})

    weights = (sample.groupBy("member").applyInArrow(member, "word string, weight double")
               .groupBy("word").agg((F.sum("weight")).alias("total"), F.count(F.lit(1)).alias("n")))
    rows = weights.collect()  # at most MEMBERS * VOCABULARY + 1 rows
    bias = next((r for r in rows if r["word"] is None), None)
    if bias is None:
        return None
    return {r["word"]: r["total"] / bias["n"] for r in rows if r["word"] is not None}, bias["total"] / bias["n"]


def score(docs: DataFrame, model: tuple[dict[str, float], float] | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from the whole text alone."""
    weights, bias = model or ({}, None)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = {f.rpartition("*")[0] for f in weights}
        known: dict[str, tuple[str, ...]] = {}

        def weighted(word: str) -> tuple[str, ...]:
            if len(known) >= 300_000:
                known.clear()
            hit = known[word] = tuple([f for f in forms_of(word) if f in forms])
            return hit

        def total(text: str) -> float:
            found = Counter()
            for w in words(text):
                hit = known.get(w)
                if hit is None:
                    hit = weighted(w)
                for f in hit:
                    found[f] += 1
            return sum(sorted([weights[f] for f in counted(found) if f in weights]))
        for batch in batches:
            z = np.array([total(t) for t in map(str, batch.column(2))], float) + (bias or 0.0)
            p = 1 / (1 + np.exp(-z)) if bias is not None else np.zeros(len(z))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()),
                 pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text")) \
        .mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score(docs, train(docs, labels))
