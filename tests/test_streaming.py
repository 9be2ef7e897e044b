import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import survey_df, survey_row
from starloom import spec as S
from starloom.operators.clean import clean_survey
from starloom.operators.star import build_star
from starloom.sources import files as FS
from starloom.streaming.incremental import process_batch, read_rejected, read_star, start_year_stream


def _ids(star, table, key, cols):
    return {tuple(r[c] for c in cols): r[key] for r in star[table].collect()}


def test_stable_keys_and_idempotent_replay(spark, tmp_dir):
    b0 = survey_df(spark, [survey_row(SEX=1.0), survey_row(SEX=2.0)])
    # batch 1 shares one demographic tuple with batch 0 and adds a new one
    b1 = survey_df(spark, [survey_row(SEX=2.0, _AGEG5YR=9.0), survey_row(SEX=2.0)]) \
        .withColumn("row_key", F.col("row_key") + 10)
    process_batch(b0, 0, tmp_dir)
    star0 = read_star(spark, tmp_dir)
    demo_cols = ["sex", "age_group", "education_level", "income_bracket"]
    ids0 = _ids(star0, "dim_demographics", "demographic_id", demo_cols)
    process_batch(b1, 1, tmp_dir)
    star1 = read_star(spark, tmp_dir)
    ids1 = _ids(star1, "dim_demographics", "demographic_id", demo_cols)
    assert all(ids1[k] == v for k, v in ids0.items())          # old tuples keep their keys
    assert sorted(ids1.values()) == [1, 2, 3]                  # one new tuple, next key
    assert ids1[("Female", 9.0, 4.0, 6.0)] == 3
    rec = sorted(r["record_id"] for r in star1["fact_health_records"].collect())
    assert rec == [1, 2, 3, 4]
    # replaying batch 1 rewrites the same rows
    before = {t: sorted(map(tuple, df.collect()), key=repr) for t, df in star1.items()}
    process_batch(b1, 1, tmp_dir)
    star2 = read_star(spark, tmp_dir)
    after = {t: sorted(map(tuple, df.collect()), key=repr) for t, df in star2.items()}
    assert before == after


def test_batches_without_a_valid_row(spark, tmp_dir):
    """First, middle and last batch empty after cleaning; each replayed."""
    none = survey_df(spark, [survey_row(DIABETE3=9.0)])
    some = survey_df(spark, [survey_row(SEX=1.0), survey_row(SEX=2.0)])
    more = survey_df(spark, [survey_row(SEX=2.0), survey_row(_AGEG5YR=9.0)])
    want = []
    for i, batch in enumerate([none, some, none, more, none]):
        for _ in range(2):
            process_batch(batch, i, tmp_dir)
            star = read_star(spark, tmp_dir)
            got = sorted(r["record_id"] for r in star["fact_health_records"].collect())
            assert got == list(range(1, [0, 2, 2, 4, 4][i] + 1))
        want.append({t: df.count() for t, df in star.items()})
    assert want[0] == {t: 0 for t in want[0]} and want[-1]["dim_demographics"] == 3


def _yearly_csv(path, rows, order, extra=()):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".tmp", "w") as f:
        f.write(",".join([*extra, *order]) + "\n")
        for r in rows:
            f.write(",".join([*("17" for _ in extra), *(str(r[c]) for c in order)]) + "\n")
    os.rename(path + ".tmp", path)


def _rows(n, seed):
    return [survey_row(SEX=1.0 + (i * 7 + seed) % 2, _AGEG5YR=1.0 + (i * 5 + seed) % 13, _BMI5=2000.0 + seed * 100 + i)
            for i in range(n)]


def _drain(spark, src, out, ckpt):
    q = start_year_stream(spark, src, out, ckpt)
    q.awaitTermination()
    assert q.exception() is None, q.exception()


def _tables(star):
    return {t: sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect()))) for t, df in star.items()}


def test_stream_over_plain_yearly_files_equals_the_batch_star(spark, tmp_dir):
    """Extra leading columns, other column orders, a part folder with two orders; no key column."""
    src, cols = f"{tmp_dir}/in", list(S.SELECTED_COLUMNS)
    _yearly_csv(f"{src}/2013.csv", _rows(40, 1), cols)
    _drain(spark, src, f"{tmp_dir}/star", f"{tmp_dir}/ck")
    _yearly_csv(f"{src}/2014.csv", _rows(30, 2), cols[::-1], ("STATE", "IDATE"))
    _drain(spark, src, f"{tmp_dir}/star", f"{tmp_dir}/ck")
    _yearly_csv(f"{src}/2015.csv/part-0.csv", _rows(20, 3), cols[5:] + cols[:5])
    _yearly_csv(f"{src}/2015.csv/part-1.csv", _rows(20, 4), cols, ("STATE",))
    _yearly_csv(f"{src}/notes.csv", [], ["note"])
    _drain(spark, src, f"{tmp_dir}/star", f"{tmp_dir}/ck")
    got = _tables(read_star(spark, f"{tmp_dir}/star"))
    want = _tables(build_star(clean_survey(FS.union_years(spark, src, file_order=True).drop("DATA_YEAR"))))
    assert got == want and len(got["fact_health_records"]) == 110
    assert read_rejected(spark, f"{tmp_dir}/star").count() == 0


def test_stream_sets_malformed_years_aside_and_refuses_other_files(spark, tmp_dir):
    src, cols = f"{tmp_dir}/in", list(S.SELECTED_COLUMNS)
    _yearly_csv(f"{src}/2013.csv", _rows(5, 1), cols)
    _yearly_csv(f"{src}/2014.csv", _rows(5, 2), cols)
    with open(f"{src}/2014.csv", "a") as f:
        f.write(",".join(["1"] * 23) + "\n")
    _drain(spark, src, f"{tmp_dir}/star", f"{tmp_dir}/ck")
    assert read_star(spark, f"{tmp_dir}/star")["fact_health_records"].count() == 5
    bad = read_rejected(spark, f"{tmp_dir}/star").collect()
    assert [(r["DATA_YEAR"], r["line"]) for r in bad] == [(2014, ",".join(["1"] * 23))]
    # a batch of malformed years alone brings nothing and does not stop the stream
    _yearly_csv(f"{src}/2016.csv", [], cols)
    with open(f"{src}/2016.csv", "a") as f:
        f.write(",".join(["1"] * 24) + "\n")
    _drain(spark, src, f"{tmp_dir}/star", f"{tmp_dir}/ck")
    assert read_star(spark, f"{tmp_dir}/star")["fact_health_records"].count() == 5
    assert read_rejected(spark, f"{tmp_dir}/star").count() == 2
    _yearly_csv(f"{src}/2017.csv", [], ["x", "y"])
    q = start_year_stream(spark, src, f"{tmp_dir}/star", f"{tmp_dir}/ck")
    with pytest.raises(StreamingQueryException, match="target"):
        q.awaitTermination()
