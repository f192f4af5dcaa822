"""The first n rows at any size: counting finds the same rows as a sort."""
import random
from datetime import datetime as T
from datetime import timedelta

import pytest

from stratum.operators.sample import _nth_time, first_rows


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one instant, some have no time; the rest lie up to 20 years apart."""
    rng = random.Random(2)
    start = T(2004, 1, 1)
    out = [(i, start + timedelta(microseconds=rng.randrange(20 * 365 * 86_400 * 10 ** 6))) for i in range(400)]
    out += [(1000 + i, T(2010, 5, 5, 5)) for i in range(250)] + [(2000 + i, None) for i in range(50)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("n", [1, 2, 100, 260, 400, 649, 650, 651, 699, 700, 5000])
def test_counting_finds_the_rows_of_a_sort(spark, rows, n):
    df = spark.createDataFrame(rows, "id LONG, at TIMESTAMP").repartition(5)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or T.min, r[0]))[:n]
    got = [tuple(r) for r in first_rows(df, n, "at", "id", top_n=0).collect()]
    assert len(got) == len(want) and set(got) == set(want)
    assert {tuple(r) for r in first_rows(df, n, "at", "id").collect()} == set(want)


def test_nth_time_of_negative_and_equal_times(spark):
    values = [-5, -5, 0, 7, 7, 7, 10 ** 15]
    df = spark.createDataFrame([(v,) for v in values], "t LONG")
    for n in range(1, len(values) + 1):
        t = sorted(values)[n - 1]
        assert _nth_time(df, n, bins=4) == (t, sum(v < t for v in values))


def test_an_empty_table_and_no_rows(spark):
    df = spark.createDataFrame([], "id LONG, at TIMESTAMP")
    assert first_rows(df, 10, "at", "id", top_n=0).count() == 0
    assert first_rows(spark.createDataFrame([(1, None)], df.schema), 0, "at", "id").count() == 0
