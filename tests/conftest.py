import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import get_spark

    s = get_spark("starloom-tests", cores="*", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        # tests own their scratch folder; library code only reads the setting
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="starloom-test-", dir="/tmp")


def survey_row(**over):
    """A valid raw survey row (all codes in domain) with overrides."""
    from starloom import spec as S

    base = {c: 1.0 for c in S.SELECTED_COLUMNS}
    base.update({"DIABETE3": 3.0, "_BMI5": 2500.0, "MENTHLTH": 0.0, "PHYSHLTH": 0.0,
                 "GENHLTH": 2.0, "SEX": 2.0, "_AGEG5YR": 5.0, "EDUCA": 4.0, "INCOME2": 6.0})
    base.update(over)
    return base


def survey_df(spark, rows):
    from starloom import spec as S

    cols = ["row_key"] + list(S.SELECTED_COLUMNS)
    schema = "row_key bigint, " + ", ".join(f"{c} double" for c in S.SELECTED_COLUMNS)
    data = [tuple([i + 1] + [r.get(c) for c in S.SELECTED_COLUMNS]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema).select(*cols)
