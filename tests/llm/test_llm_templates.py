"""Line templates whose fields have common values."""

import pytest
from llm_brute import dropped_lines
from test_llm_operators import by_id, frame

from starloom.llm import templates


def filed(values):
    return [f"own{i}x{j} words\nFiled under section: {'s' * (i + 1)} by author {'a' * (j + 1)}"
            for i in range(values) for j in range(values)]


@pytest.mark.parametrize("values", [4, 20, 24])
def test_common_field_values_stay_fields(spark, values):
    texts = filed(values)
    want = dropped_lines(texts, 10, 4)
    assert all(w == {1} for w in want)
    got = by_id(templates.drop_lines(frame(spark, texts)))
    assert [got[i]["n_dropped"] for i in range(len(texts))] == [1] * len(texts)


def test_one_text_is_no_support(spark):
    # ten lines of one text make "same" no fixed word, and the line of nine texts does not recur
    texts = ["\n".join(f"We saw it {x} same words {x} here {x} end" for x in "abcdefghijkl")]
    texts += [f"t{i}\nWe saw it {x}p {x}q {x}r {x}s {x}t {x}u {x}v" for i, x in enumerate("abcdefghijkl")]
    texts += [f"u{i}\nWe saw it m same words {x}m here n end" for i, x in enumerate("abcdefgh")]
    want = dropped_lines(texts, 10, 4)
    got = by_id(templates.drop_lines(frame(spark, texts)))
    assert [got[i]["n_dropped"] for i in range(len(texts))] == [len(w) for w in want]
    assert not any(want)


def test_query_drops_short_lines(spark, tmp_dir):
    short = ["Les.", "And ornd.", "All rights reserved.", "Page {}"]
    texts = ["\n".join([f"own{i} a b", *short, "", str(i)]).format(i) for i in range(12)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    for r in templates.query(spark, tmp_dir).collect():
        left = f"own{r['doc_id']} a b\n\n{r['doc_id']}"
        # "own1 a b" has two of its three tokens in common with the others, so it goes as well
        assert (r["n_lines"], r["n_dropped"]) == (7, 5) and r["kept_chars"] == len(left.split("\n", 1)[1])
