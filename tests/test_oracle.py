"""Differential test: every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from ordwise.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

KEYS = sorted(QUERIES)


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, duck_small, key):
    ok, msg = compare(E.queries()[key](spark, SF_SMALL), duck_small, E.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["revenue_tier", "order_count", "avg_total", "total_revenue"]
    assert df.count() == 3


@pytest.mark.parametrize("totals", [["0.01", "0.02"], ["-0.01", "-0.02"], ["0.01", "0.01", "0.02"],
                                    ["1.00", "1.00", "1.01"], ["2.67", "2.68"], ["0.00"], ["99.99"] * 3 + ["0.01"]])
def test_decimal_mean_half_up_matches_spark(spark, totals):
    import duckdb
    from decimal import Decimal
    from ordwise.oracle import DECIMAL_MEAN_2DP
    from ordwise.operators import reports
    df = spark.createDataFrame([(Decimal(t), 0.0) for t in totals], "order_total decimal(12,2), rating_safe double")
    want = reports.summary_stats(df).first().avg_total
    values = ", ".join(f"(CAST({t} AS DECIMAL(12,2)))" for t in totals)
    got = duckdb.sql(f"SELECT {DECIMAL_MEAN_2DP.format(c='order_total')} FROM (VALUES {values}) AS t(order_total)")
    assert got.fetchall()[0][0] == want


@pytest.mark.parametrize("ratings", [["0.0"] * 7 + ["3.5"], ["3.5", "4.0", "4.0"], ["4.5", "0.0", "0.0"],
                                     ["5.0"], ["1.0", "2.0", "0.0"]])
def test_rating_mean_half_up_matches_spark(spark, ratings):
    import duckdb
    from decimal import Decimal
    from pyspark.sql import functions as F
    from ordwise.oracle import RATING_MEAN_2DP
    df = spark.createDataFrame([(Decimal(r),) for r in ratings], "rating_safe decimal(3,1)")
    want = df.agg(F.round(F.avg("rating_safe"), 2)).first()[0]
    values = ", ".join(f"(CAST({r} AS DECIMAL(3,1)))" for r in ratings)
    got = duckdb.sql(f"SELECT {RATING_MEAN_2DP.format(c='rating_safe')} FROM (VALUES {values}) AS t(rating_safe)")
    assert got.fetchall()[0][0] == want


def test_decimal_mean_matches_two_step_half_up():
    """Property: the oracle's integer mean equals avg rounded half-up to 6 places, then to 2."""
    from decimal import ROUND_HALF_UP, Decimal

    import duckdb
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from ordwise.oracle import DECIMAL_MEAN_2DP, decimal_avg

    con = duckdb.connect()

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=40))
    def check(cents):
        values = ", ".join(f"(CAST({c} AS DECIMAL(18,0)) * 0.01)" for c in cents)
        sql = (f"SELECT {DECIMAL_MEAN_2DP.format(c='x')}, {decimal_avg('x', 2, 'DECIMAL(16,6)')} "
               f"FROM (SELECT CAST(v AS DECIMAL(12,2)) AS x FROM (VALUES {values}) AS t(v))")
        got2, got6 = con.sql(sql).fetchall()[0]
        mean6 = (Decimal(sum(cents)) / 100 / len(cents)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert got6 == mean6
        assert got2 == mean6.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)

    check()


def test_share_of_total_half_up_property():
    """Property: the oracle's share equals round(cnt * 100 / total, 1) half-up, as Spark's decimal."""
    from decimal import ROUND_HALF_UP, Decimal

    import duckdb
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from ordwise.oracle import PCT_DECIMAL

    con = duckdb.connect()

    @settings(max_examples=200, deadline=None)
    @given(st.integers(1, 10**12), st.data())
    def check(total, data):
        cnt = data.draw(st.integers(0, total))
        got = con.sql(f"SELECT {PCT_DECIMAL.format(cnt=f'CAST({cnt} AS BIGINT)', tot=f'CAST({total} AS BIGINT)')}")
        want = (Decimal(cnt) * 100 / Decimal(total)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)
        assert got.fetchall()[0][0] == want

    check()
