"""Property tests: the name formatter against its definition; outputs independent of input order."""

from hypothesis import given, settings
from hypothesis import strategies as st

from airmart.functions import format_location_name
from airmart.operators.clean import clean
from airmart.operators.consumption import build_consumption
from airmart.plans.registry import warehouse_for
from tests.conftest import SF_SMALL
from tests.test_functions import py_format

WORDS = st.sampled_from(["de", "DEL", "la", "Las", "el", "los", "y", "e", "a", "al", "san", "JUAN", "lurigancho",
                         "villa", "x1", "ñandú", ""])
NAMES = st.lists(WORDS, min_size=0, max_size=6).map(lambda ws: "_".join(ws))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(NAMES, st.none()), min_size=1, max_size=40))
def test_format_matches_definition(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.f for r in df.select(format_location_name("n").alias("f")).collect()]
    assert got == [py_format(n) for n in names]


def test_consumption_independent_of_input_order(spark):
    raw = warehouse_for(spark, SF_SMALL).raw
    a = build_consumption(clean(raw))
    b = build_consumption(clean(raw.repartition(13).sortWithinPartitions("_stg_file_md5")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


CENTS = st.integers(min_value=-10**7, max_value=10**7)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.one_of(CENTS, st.none()), min_size=1, max_size=30), min_size=1, max_size=12),
       st.integers(min_value=0, max_value=3))
def test_round_avg_matches_decimal_brute_force(spark, groups, digits):
    from decimal import ROUND_HALF_UP, Decimal

    from airmart.functions import round_avg

    rows = [(g, None if c is None else Decimal(c).scaleb(-2)) for g, cs in enumerate(groups) for c in cs]
    df = spark.createDataFrame(rows, "g int, x decimal(12,2)")
    got = {r.g: r.a for r in df.groupBy("g").agg(round_avg("x", digits).alias("a")).collect()}
    for g, cs in enumerate(groups):
        vals = [Decimal(c).scaleb(-2) for c in cs if c is not None]
        if not vals:
            assert got[g] is None
            continue
        exact = sum(vals) / Decimal(len(vals))
        assert got[g] == exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP), (g, cs, digits)
