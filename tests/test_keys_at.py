"""Keys at positions of a cut table: odd keys, few and many positions, and how many rows are searched."""

import datetime as dt

import pytest

from rhythmica.operators.layout import Layout, keys_at

ORDER = ["t", "at", "id"]


@pytest.fixture(scope="module")
def rows():
    """Null and equal times, a fifth of the rows at one time, rows that come twice."""
    made = [(None if i % 31 == 0 else 7 if i % 5 == 0 else i // 3, None if i % 11 == 0 else dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i % 17), i) for i in range(1200)]
    return [*made, *made[:60]]


@pytest.mark.parametrize("wanted", [[], [0], [1259], [0, 5, 640, 1259, 1260], [400, 400, 3], list(range(0, 1260, 30))])
@pytest.mark.parametrize("block", ["40", "2000000"])
def test_keys_at_equal_the_sorted_rows(spark, rows, wanted, block):
    df = spark.createDataFrame(rows, "t int, at timestamp_ntz, id int").repartition(4)
    placed = sorted(rows, key=lambda r: [(v is not None, v) for v in r])
    spark.conf.set("spark.rhythmica.rowsPerBlock", block)
    try:
        got = keys_at(df, ORDER, lambda n: wanted)
    finally:
        spark.conf.unset("spark.rhythmica.rowsPerBlock")
    assert [g and tuple(g.values()) for g in got] == [placed[p] if p < len(placed) else None for p in wanted]


def test_only_rows_of_wanted_blocks_are_searched(spark, rows, small_blocks, monkeypatch):
    searched, spread = [], Layout.spread

    def counted(self, df, **how):
        searched.append(df.count())
        return spread(self, df, **how)

    monkeypatch.setattr(Layout, "spread", counted)
    keys_at(spark.createDataFrame(rows, "t int, at timestamp_ntz, id int"), ORDER, lambda n: [n // 2, n // 4])
    assert searched[0] == len(rows)  # the blocks are counted
    assert 0 < searched[-1] <= len(rows) // 4
