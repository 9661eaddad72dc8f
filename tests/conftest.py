import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rhythmica.operators.layout import ROWS_PER_BLOCK_KEY  # noqa: E402
from rhythmica.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, partitions=4)


@pytest.fixture
def small_blocks(spark):
    """Force series longer than 40 rows to be cut into blocks."""
    spark.conf.set(ROWS_PER_BLOCK_KEY, "40")
    yield 40
    spark.conf.unset(ROWS_PER_BLOCK_KEY)


@pytest.fixture(scope="session")
def panel_pdf():
    """Three series; one of them holds two thirds of all rows. Rows are shuffled, times repeat."""
    rng = np.random.default_rng(7)
    parts = []
    for name, n in (("hot", 600), ("mid", 250), ("tiny", 3)):
        ts = pd.Timestamp("2020-01-01") + pd.to_timedelta(np.sort(rng.integers(0, n, n)), unit="D")
        y = rng.normal(100, 20, n).round(2)
        parts.append(pd.DataFrame({"series": name, "ts": ts, "y": y}))
    out = pd.concat(parts, ignore_index=True)
    out["id"] = np.arange(len(out))
    out.loc[out.index % 11 == 3, "y"] = np.nan
    return out.sample(frac=1, random_state=1).reset_index(drop=True)


@pytest.fixture(scope="session")
def panel(spark, panel_pdf):
    rows = [(s, t.to_pydatetime(), None if np.isnan(y) else float(y), int(i)) for s, t, y, i in panel_pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double, id bigint").repartition(5)


ORDER = ["ts", "id"]


def by_id(df, *columns):
    pdf = df.select("id", *columns).toPandas()
    return pdf.sort_values("id").reset_index(drop=True)
