"""Pseudonyms of values of any length, undone in plain Python; one tokenizing pass; ids by rank."""

import hashlib
import json
import random
import string

from pyspark.sql import functions as F

import public_tokenizers
from starloom.llm import lengths, pii
from starloom.llm.tokens import Cache, Encoder

TOKENS = public_tokenizers.path("byte_bpe_50k.json")


def undone(s, kind, key):
    half = len(s) // 2
    left, right = s[:half], s[half:]

    def back(part, other, i):
        seed = "|".join([key, kind, str(i), other])
        stream = "".join(hashlib.sha512(f"{seed}|{k}".encode()).hexdigest() for k in range(max(1, -(-len(part) // 32))))
        out = []
        for at, c in enumerate(part):
            letters = next((x for x in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in x), None)
            out.append(letters[(letters.index(c) - int(stream[4 * at:4 * at + 4], 16)) % len(letters)] if letters else c)
        return "".join(out)
    for i in reversed(range(pii.ROUNDS)):
        left, right = (back(left, right, i), right) if i % 2 == 0 else (left, back(right, left, i))
    return left + right


def test_values_of_any_length_are_permuted_and_can_be_undone(spark):
    rng = random.Random(1)
    values = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
              for n in (1, 2, 3, 31, 32, 33, 63, 64, 65, 127, 128, 129, 130, 186, 196, 257, 400)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: r["p"] for r in df.select("v", pii.permute_characters(F.col("v"), "x", "k").alias("p")).collect()}
    for v in values:
        assert len(got[v]) == len(v) and undone(got[v], "x", "k") == v
        assert len(v) < 8 or got[v] != v


def test_long_addresses_keep_their_length(spark):
    label = "abcdefghij" * 6
    address = f"{'n' * 40}@{label}.{label[:50]}.example.org"
    row = spark.createDataFrame([(f"write to {address} now",)], "text string") \
        .select(pii.pseudonymise_text(F.col("text"), "k").alias("p")).first()["p"]
    new = row["text"].split()[2]
    assert row["kinds"] == ["email"] and len(new) == len(address) and new != address
    assert [i for i, c in enumerate(new) if c in "@."] == [i for i, c in enumerate(address) if c in "@."]


def test_the_key_comes_from_the_session(spark):
    docs = spark.createDataFrame([("reach jane.roe@example.org today",)], "text string")
    public = pii.pseudonymise(docs).first()["text"]
    spark.conf.set(pii.KEY_SETTING, "a secret")
    try:
        secret = pii.pseudonymise(docs).first()["text"]
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert secret == pii.pseudonymise(docs, "a secret").first()["text"] != public


def test_texts_are_encoded_once_and_limits_have_their_rows(spark, monkeypatch):
    texts = ["", "a", "a b", None, "some words here " * 40, "é ü " * 700]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    h = lengths.histogram(lengths.encoded_lengths(docs, TOKENS), (512, 100_000))
    assert "MapInArrow" not in h._jdf.queryExecution().executedPlan().toString()
    rows = {r["length"]: r for r in h.collect()}
    plain = lengths.histogram(lengths.encoded_lengths(docs, TOKENS)).collect()
    assert all(rows[r["length"]] == r for r in plain) and set(rows) == {r["length"] for r in plain} | {512, 100_000}
    all_lengths = sorted(n for r in plain for n in [r["length"]] * r["docs"])
    for limit in (512, 100_000):
        assert rows[limit]["truncated"] == sum(min(n, limit) for n in all_lengths) and rows[limit]["docs"] == 0
        assert rows[limit]["docs_upto"] == sum(n <= limit for n in all_lengths)
        assert rows[limit]["docs_from"] == sum(n >= limit for n in all_lengths)


def test_ids_by_rank_are_those_of_the_file(tmp_path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(TOKENS)
    own.encode_special_tokens = True
    rng = random.Random(7)
    letters = [chr(c) for c in range(1, 0x250)] + list("'' stll  ²³ªµ\x1c\x85\xa0 ͅǅ語")
    texts = ["".join(rng.choice(letters) if rng.random() < 0.5 else rng.choice("etaoin s'd0.,") for _ in range(rng.randint(0, 60)))
             for _ in range(4000)] + ["a <|endoftext|> b", "we'll they've I'm 'll 12 3½ Ünïcödé"]
    encode = Encoder(TOKENS)
    assert encode.by_rank is not None
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    got = [b"".join(ids) for ids in Cache(encode).of_texts(texts)]
    assert [[int.from_bytes(g[i:i + 4], "little") for i in range(0, len(g), 4)] for g in got] == want

    other = json.load(open(TOKENS))
    other["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(other))
    assert Encoder(str(tmp_path / "other.json")).by_rank is None
