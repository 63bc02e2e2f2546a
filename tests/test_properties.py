"""Property tests: Column functions against plain-Python statements of the
same rules, on random inputs (one Spark job per generated batch)."""

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation, localcontext

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from velostat.functions import columns as C

IDS = st.text(alphabet="0123456789.AJC- ", min_size=0, max_size=8)
NUMS = st.one_of(
    st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False).map(str),
    st.integers(min_value=-10**12, max_value=10**12).map(str),
    st.text(alphabet="0123456789.e-x", min_size=1, max_size=6),
)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _norm(x: str, strict: bool) -> str:
    pattern = r"[0-9]+\.[0-9]+" if strict else r"[0-9]+(\.[0-9]+)?"
    return x.rstrip("0").rstrip(".") if re.fullmatch(pattern, x) else x


def _bigint(x: str):
    try:
        d = Decimal(x)
    except InvalidOperation:
        return None
    if not d.is_finite() or abs(d) >= 10**30:
        return None
    with localcontext() as ctx:
        ctx.prec = 100
        v = int(d.quantize(Decimal(1), rounding=ROUND_HALF_UP))
    return v if -(2**63) <= v < 2**63 else None


def _rows(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", expr("s")).collect())]


@SETTINGS
@given(st.lists(IDS, min_size=50, max_size=200))
def test_station_id_normalization(spark, ids):
    assert _rows(spark, ids, C.normalize_station_id) == [_norm(x, False) for x in ids]
    assert _rows(spark, ids, lambda c: C.normalize_station_id(c, strict=True)) == [_norm(x, True) for x in ids]


@SETTINGS
@given(st.lists(NUMS, min_size=50, max_size=200))
def test_safe_bigint_rounds_half_away_from_zero(spark, texts):
    got = _rows(spark, texts, C.safe_bigint)
    want = [_bigint(x) for x in texts]
    # Decimal accepts a few spellings a SQL cast rejects ('1e', '.'): compare where Decimal is strict
    for g, w, x in zip(got, want, texts):
        if re.fullmatch(r"-?[0-9]+(\.[0-9]*)?(e-?[0-9]+)?|-?\.[0-9]+", x) and abs(Decimal(x)) < 10**18:
            assert g == w, x


@SETTINGS
@given(st.lists(st.text(alphabet=" ab\t\n", max_size=5), min_size=50, max_size=200))
def test_clean_text_trims_spaces_only(spark, texts):
    want = [(t.strip(" ") or None) for t in texts]
    assert _rows(spark, texts, C.clean_text) == want
