"""Property tests: Spark column rules against plain-Python statements of the same rules."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylake.functions import buckets
from paylake.functions.numeric import percent
from paylake.sources import fixed

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def py_amount_bucket(a):
    if a is None:
        return fixed.HIGH_VALUE
    for bound, label in fixed.AMOUNT_BUCKETS:
        if a < bound:
            return label
    return fixed.HIGH_VALUE


def py_time_of_day(h):
    if h is not None:
        for lo, hi, label in fixed.TIME_OF_DAY_BUCKETS:
            if lo <= h <= hi:
                return label
    return fixed.LATE_NIGHT


def py_percent(num, den, scale):
    if den == 0:
        return None
    q = Decimal(num) * 100 / Decimal(den)
    return float(q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


amounts = st.lists(st.one_of(st.none(), st.decimals(min_value=Decimal("-100"), max_value=Decimal("99999.99"),
                                                    places=2, allow_nan=False)), min_size=1, max_size=300)
hours = st.lists(st.one_of(st.none(), st.integers(-3, 30)), min_size=1, max_size=300)
ratios = st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 10**7)), min_size=1, max_size=300)


@SETTINGS
@given(amounts)
def test_amount_bucket_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a decimal(12,2)")
    got = [r[0] for r in df.select(buckets.amount_bucket("a")).collect()]
    assert got == [py_amount_bucket(v) for v in values]


@SETTINGS
@given(hours)
def test_time_of_day_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "h int")
    got = [r[0] for r in df.select(buckets.time_of_day("h")).collect()]
    assert got == [py_time_of_day(v) for v in values]


@SETTINGS
@given(ratios, st.sampled_from([1, 2]))
def test_percent_is_exact_half_up(spark, pairs, scale):
    pairs = [(min(n, d), d) for n, d in pairs]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r[0] for r in df.select(percent(F.col("n"), F.col("d"), scale)).collect()]
    assert got == [py_percent(n, d, scale) for n, d in pairs]
