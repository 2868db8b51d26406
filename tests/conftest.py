import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kymora.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "kymora-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"},
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def series(spark, data: dict, key: str = "a", **columns):
    """(recording_id, i, t, ...) from equal-length arrays."""
    import pandas as pd

    n = len(next(iter(data.values())))
    pdf = pd.DataFrame({"recording_id": key, "i": np.arange(n), **{k: np.asarray(v) for k, v in data.items()}})
    return spark.createDataFrame(pdf)
