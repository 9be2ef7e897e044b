"""The training-data operators against brute force, on fixtures with every odd case."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_brute import dropped_lines, near, quality, repeats
from pyspark.sql import functions as F

import public_tokenizers
from starloom.llm import (bpe, exact, jaccard, lengths, packing, quality as Q, substrings, templates, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, node long, part int, q string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENS = public_tokenizers.path("byte_bpe_50k.json")


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = [rng.choice(vocab) for _ in range(80)]
    texts = []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 4, 5, 12, 60, 150]))]
        if i % 5 == 0:
            ws += passage[: rng.randint(30, 80)]
        if i % 7 == 0:
            ws = ws + ws[:40]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "  ", ".\n", "\t"]) for w in ws)
        texts.append(text + f"\nLicensed to user{i} under version {i % 3}.0 of it\n" if i % 3 == 0 else text)
    for i in range(12):  # near copies of one text
        ws = texts[14].split() + passage * 3
        ws[rng.randrange(len(ws))] = "changed"
        texts.append(" ".join(ws))
    texts += [texts[3], texts[3], texts[20], "", "", None, "   \n\t ", "one", "one", "a b c d", "x " * 5000, "Ⅷ² wide gap",
              "z" * 3000, "# * $ % " * 40]
    return texts


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, None, "s", None, "k", None, 7, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


# --- 1 ---------------------------------------------------------------------------------------

def test_quality_ledger(docs):
    got = by_id(Q.verdicts(docs))
    for i, t in enumerate(corpus()):
        want = quality(t)
        assert {k: got[i][k] for k in want} == want, (i, t)


def test_header_that_is_the_footer_is_no_repeated_text(spark):
    body = " ".join(f"word{i}" for i in range(60))
    texts = [f"A heading\n{body}\nA heading", "\n".join([body[:200]] * 3 + [f"tail {i} of it" for i in range(3)])]
    got = by_id(Q.verdicts(frame(spark, texts)))
    assert [got[i]["kept"] for i in range(2)] == [True, False]
    assert all(got[i]["fail_bits"] & Q.bit("repeated_lines") for i in range(2))  # the older policy rejects both
    assert [got[i]["fail_bits"] & Q.FULL_1.mask != 0 for i in range(2)] == [True, True]


def test_quality_policies_and_ablation(docs):
    rows = Q.ledger(docs).cache()
    bits = [r["fail_bits"] for r in rows.collect()]
    kept = {r["doc_id"] for r in Q.accept(docs).collect()}
    assert len(kept) == sum(b & Q.FULL.mask == 0 for b in bits)
    assert Q.accept(docs).columns == docs.columns
    for r in Q.ablation(rows, Q.FULL).collect():
        b = Q.bit(r["rule"])
        fails = [x & Q.FULL.mask for x in bits]
        assert r["failed"] == sum(x & b != 0 for x in fails)
        assert r["failed_alone"] == sum(x == b for x in fails)
        assert r["kept_without"] == sum(x & ~b == 0 for x in fails)


# --- 2 ---------------------------------------------------------------------------------------

def test_nnpu_separates_and_uses_no_clean_label():
    rng = random.Random(0)
    def doc(toxic):
        return {f"w{rng.randrange(40)}" for _ in range(20)} | ({rng.choice(["bad", "vile"])} if toxic else set())
    pos = [doc(True) for _ in range(60)]
    unl = [doc(rng.random() < 0.2) for _ in range(600)]
    w, b = toxicity.fit(pos, unl, 0.2)
    def score(d):
        return b + sum(w.get(x, 0) for x in d)
    test = [(doc(t), t) for t in [True] * 50 + [False] * 200]
    assert sum((score(d) > 0) == t for d, t in test) >= 0.95 * len(test)


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    rows = toxicity.query(spark, d).where("held_out")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = rows.join(labels, "doc_id").select("predicted", "toxic", "score").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit >= 0.75 * sum(r["toxic"] for r in got)      # a tenth of the labels is noise
    assert hit >= 0.9 * sum(r["predicted"] for r in got)


def test_toxicity_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(40)] + [(None, None, None), (3, 0, None)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == len(corpus()) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["held_out"]} == {i for i in range(len(got)) if zlib.crc32(str(i).encode()) % 5 == 0}
    none = labels.where("false")
    assert toxicity.train(docs, none) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(empty, None).count() == 0


# --- 3 ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("window,hot", [(4, 0), (4, 3), (35, 0), (35, 1024)])
def test_recompression(docs, window, hot, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", hot)
    want = repeats(corpus(), window)
    got = by_id(substrings.remove_repeats(docs, window))
    for i, (n, gone, kept) in enumerate(want):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_text"]) == (n, gone, kept), i


def test_recompression_rounds_do_not_matter(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) for _ in range(12)] + ["a " * 60, "a b " * 40]
    for rounds in (1, 4, 8):
        got = by_id(substrings.remove_repeats(frame(spark, texts), 9, rounds))
        assert [(got[i]["n_words"], got[i]["n_removed"], got[i]["kept_text"]) for i in range(len(texts))] == repeats(texts, 9)


# --- 4 ---------------------------------------------------------------------------------------

def test_line_templates(docs):
    texts = corpus()
    want = dropped_lines(texts, 5, 4)
    assert any(want)
    got = by_id(templates.drop_lines(docs, min_texts=5))
    for i, t in enumerate(texts):
        lines = t.split("\n") if t else []
        assert got[i]["n_lines"] == len(lines) and got[i]["n_dropped"] == len(want[i])
        assert got[i]["kept_text"] == "\n".join(x for k, x in enumerate(lines) if k not in want[i])


def test_templates_generalise_fields(spark):
    texts = [f"Intro {i} text here\nSession opened for user u{i} at gate\nown {'word ' * i}" for i in range(12)]
    from starloom.llm.frames import keyed
    found, _ = templates.recurring(keyed(frame(spark, texts)), min_texts=10)
    assert "Session opened for user <*> at gate" in {r["template"] for r in found.collect()}


# --- 5 ---------------------------------------------------------------------------------------

def test_jaccard_join(docs):
    want = near(list(enumerate(corpus())))
    got = by_id(jaccard.similarity_classes(docs))
    assert {k: (r["class_id"], r["class_size"], r["n_links"]) for k, r in got.items()} == want


def test_jaccard_blocks_give_the_same(docs, monkeypatch):
    want = near(list(enumerate(corpus())))
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 3)
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", 4)
    got = by_id(jaccard.similarity_classes(docs))
    assert {k: (r["class_id"], r["class_size"], r["n_links"]) for k, r in got.items()} == want


def test_near_copies_keep_one(spark, docs):
    want = near(list(enumerate(corpus())))
    kept = jaccard.drop_near_copies(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _, _ in want.values()})
    assert kept.columns == docs.columns
    twice = docs.unionByName(docs)
    assert sorted(r["doc_id"] for r in jaccard.drop_near_copies(twice).collect()) == sorted({c for c, _, _ in want.values()})


def test_pruning_bound():
    for k, m in jaccard.least_matches():
        assert 0 <= m <= k
    assert jaccard.least_matches()[-1][1] < 0.8 * jaccard.HASHES


# --- 6 ---------------------------------------------------------------------------------------

def _tokens(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENS)
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def test_chunks_keep_their_ids():
    import numpy as np
    from tokenizers import Tokenizer

    from starloom.llm.tokens import Cache, Encoder, cut
    own, rng = Tokenizer.from_file(TOKENS), random.Random(6)
    own.encode_special_tokens = True
    signs = "aethsn  ..,'é#1你🎉\x85\xa0\t\n\r\x1c\u3000ßÀ²Ⅷ<|>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["<|endoftext|> a <|endoftext|>", "w" * 500 + " x", " a", "a ", "\n", "a b c " * 400]
    for text, ids in zip(texts, Cache(Encoder(TOKENS), 300).of_texts(texts, 5000)):
        head, rest = cut(text)
        assert " ".join([head, *rest]) == text
        assert np.frombuffer(b"".join(ids), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


def check_pieces(rows, ids, width):
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append(r)
        of_sequence[r["sequence_id"]].append(r)
    assert set(of_doc) == set(range(len(ids)))
    for i, own in enumerate(ids):
        at = 0
        for r in sorted(of_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(own)
            piece = own[at:at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece))
            at += r["length"]
        assert at == len(own)
    for rows in of_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= width
    return len(of_sequence)


def test_packing(docs):
    texts = corpus()
    ids = _tokens(texts)
    for width in (64, 1024):
        n = check_pieces(packing.pack(docs, TOKENS, width).collect(), ids, width)
        assert n <= 1.1 * sum(map(len, ids)) / width + 2


def test_cutting_stock_covers_exactly():
    rng = random.Random(2)
    for n in (1, 7, 300, 5000):
        h = Counter(min(255, int(rng.expovariate(1 / 90)) + 1) for _ in range(n))
        plan = packing.plan(h, 256)
        used = Counter()
        for pattern, times in plan:
            assert sum(k * c for k, c in pattern.items()) <= 256
            used.update({k: c * times for k, c in pattern.items()})
        assert used == h
        total = sum(k * c for k, c in h.items())
        assert sum(t for _, t in plan) <= 1.02 * total / 256 + 3
    assert packing.plan({}) == []


# --- 7 ---------------------------------------------------------------------------------------

def test_exact_groups(docs):
    texts = [t or "" for t in corpus()]
    last, size = {t: i for i, t in enumerate(texts)}, Counter(texts)
    got = by_id(exact.groups(docs))
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (last[t], size[t], last[t] == i, sha(t))


def test_exact_drop_keeps_one_of_repeated_rows(docs):
    texts = [t or "" for t in corpus()]
    want = sorted({t: i for i, t in enumerate(texts)}.values())
    out = exact.drop_copies(docs.unionByName(docs))
    assert sorted(r["doc_id"] for r in out.collect()) == want and out.columns == docs.columns


def test_misra_gries_names_every_heavy_digest(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, "warm")
                                    .otherwise(F.col("id").cast("string")).alias("digest")).repartition(90)
    got = {r["digest"] for r in exact.heavy_candidates(rows, most=10).collect()}
    assert {"hot", "warm"} <= got and len(got) <= 10


# --- 9, 10 -----------------------------------------------------------------------------------

def test_length_histogram(docs):
    n = [len(x) - 1 for x in _tokens(corpus())]
    rows = lengths.histogram(lengths.encoded_lengths(docs, TOKENS)).cache()
    got = {r["length"]: r for r in rows.collect()}
    assert set(got) == set(n)
    for k, r in got.items():
        assert r["docs"] == n.count(k)
        assert r["docs_upto"] == sum(x <= k for x in n) and r["docs_from"] == sum(x >= k for x in n)
        assert r["tokens_upto"] == sum(x for x in n if x <= k) and r["truncated"] == sum(min(x, k) for x in n)
    at = {r["context_limit"]: r for r in lengths.totals_at(rows, [1, 50, 100000]).collect()}
    for k, r in at.items():
        assert (r["docs_cut"], r["kept_tokens"]) == (sum(x > k for x in n), sum(min(x, k) for x in n))
    assert rows.agg(lengths.quantile(rows, 0.5)).first()[0] == sorted(n)[(len(n) + 1) // 2 - 1]


def _tiktoken():
    import base64

    import tiktoken
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(docs):
    enc = _tiktoken()
    got = by_id(bpe.round_trip_digests(docs, RANKS, public_tokenizers.PATTERN))
    full = by_id(bpe.encode(docs, RANKS, public_tokenizers.PATTERN))
    for i, t in enumerate(corpus()):
        ids = enc.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids) and got[i]["decoded_sha256"] == sha(t)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert full[i]["ids"] == " ".join(map(str, ids)) and bytes(full[i]["decoded"]) == (t or "").encode()


def test_bpe_monoid_on_random_bytes():
    codec, enc, rng = bpe.codec(RANKS, public_tokenizers.PATTERN), _tiktoken(), random.Random(9)
    assert len(codec.whole) == len(codec.ranks)
    for n in [*range(40), 200, 3000]:
        for alphabet in ("a", "ab", "aeths ingo", "é🎉x1 '"):
            t = "".join(rng.choice(alphabet) for _ in range(n))
            assert codec.encode_text(t) == enc.encode_ordinary(t)
        a, b = (tuple(codec.encode(("".join(rng.choice("thering") for _ in range(n + k))).encode())) for k in (0, 3))
        assert codec.join(a, b) == codec.encode(codec.decode(a) + codec.decode(b))


# --- odd inputs ------------------------------------------------------------------------------

def test_empty_table(empty):
    assert Q.verdicts(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0
    assert templates.drop_lines(empty).count() == 0
    assert jaccard.similarity_classes(empty).count() == 0
    assert packing.pack(empty, TOKENS).count() == 0
    assert exact.groups(empty).count() == 0 and exact.drop_copies(empty).count() == 0
    assert lengths.histogram(lengths.encoded_lengths(empty, TOKENS)).count() == 0
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_null_ids_and_repeated_rows(spark):
    texts = ["a b c d e f g " * 8, None, "a b c d e f g " * 8, "", "q r s t u v w x y z " * 9]
    rows = frame(spark, texts + texts, [None, None, 4, 5, 6] * 2)
    n = len(texts) * 2
    assert substrings.remove_repeats(rows).count() == n
    assert templates.drop_lines(rows).count() == n
    assert exact.groups(rows).count() == n
    assert jaccard.similarity_classes(rows).count() == n
    assert packing.pack(rows, TOKENS).count() == n
    assert exact.drop_copies(rows).count() == 3
    assert jaccard.drop_near_copies(rows).count() == 3
    for op in (lambda d: Q.ledger(d), lambda d: bpe.round_trip_digests(d, RANKS, public_tokenizers.PATTERN)):
        assert op(rows).count() == n


def test_components(spark):
    from starloom.llm.components import components

    rng = random.Random(8)
    for edges in ([], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
                  [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]):
        up = {x: x for e in edges for x in e}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in edges:
            x, y = sorted((root(a), root(b)))
            up[y] = x
        want = {x: root(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}
        got = components(spark.createDataFrame(edges, "a long, b long"))
        assert {r["node"]: r["label"] for r in got.collect()} == want
