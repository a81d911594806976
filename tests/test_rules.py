"""Labelling rules on literal rows (FIXTURES.md section 4)."""

from decimal import Decimal

from pyspark.sql import functions as F

from canvass.functions.rules import (
    amount_band,
    cancer_flag,
    email_shape_ok,
    multipet_group,
    new_policy_product,
    pets_topcoded,
    product_group,
    species_mix,
    term_group,
    wellcare_type,
)


def _apply(spark, values, typ, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_amount_bands(spark):
    vals = [Decimal(v) if v is not None else None
            for v in ["-1", None, "0", "100", "100.01", "1000", "1200", "5000", "5000.01"]]
    got = _apply(spark, vals, "decimal(18,2)", amount_band)
    assert got == [None, None, "a0 to 100", "a0 to 100", "b101 to 200", "j901 to 1000", "k1001 to 1200",
                   "r4001 to 5000", "s5000 Higher"]


def test_term_group(spark):
    assert _apply(spark, [0, 3, 5, 6, None, -1], "int", term_group) == ["0", "1 to 3", "4 to 5", "5 Higher", None, None]


def test_pet_topcoding_differs_on_null_and_zero(spark):
    vals = [None, 0, 1, 6, 7, 9]
    assert _apply(spark, vals, "bigint", multipet_group) == [7, 7, 1, 6, 7, 7]
    assert _apply(spark, vals, "bigint", pets_topcoded) == [None, 0, 1, 6, 7, 7]


def test_product_fold(spark):
    assert _apply(spark, ["I250", "I250G", "I25", None], "string", product_group) == [
        "I250 (Reg/I250G)", "I250 (Reg/I250G)", "I25", None]


def test_new_policy_products(spark):
    got = _apply(spark, ["M10", "FS1", "I250", "NI1", "WB1", "X1", "Z9", None], "string", new_policy_product)
    assert got == [True, True, True, True, True, False, False, None]


def test_wellcare_type_and_cancer_flag(spark):
    assert _apply(spark, [99, 144, 264, 0, None], "int", wellcare_type) == ["VRCC", "Core", "Premier", None, None]
    assert _apply(spark, [0, 1, None], "int", cancer_flag) == ["N", "Y", "Y"]


def test_email_shape(spark):
    assert _apply(spark, ["a@b", "a.b", "ab", None], "string", email_shape_ok) == [True, True, False, None]
    strict = _apply(spark, ["a@b", "a.b", "a@b.c"], "string", lambda c: email_shape_ok(c, strict=True))
    assert strict == [False, False, True]


def test_species_mix_patterns(spark):
    # (dogs, cats, avian, exotic) -> label; first match wins
    cases = [((0, 2, 0, 0), "A_AllFeline"), ((3, 0, 0, 0), "B_AllCanine"), ((0, 0, 1, 0), "C_AllAvianExotic"),
             ((0, 0, 0, 2), "C_AllAvianExotic"), ((1, 1, 0, 0), "D_CanineFelineMix"),
             ((1, 0, 0, 1), "E_CanineOthersMix"), ((0, 1, 1, 0), "F_FelineOthersMix"),
             ((1, 1, 1, 1), "G_CanineFelineorOthersMix"), ((0, 0, 0, 0), "Unknown"),
             ((None, 1, 0, 0), "Unknown")]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)],
                               "i int, dogs bigint, cats bigint, avian bigint, exoticothers bigint")
    got = [r["m"] for r in df.select("i", species_mix().alias("m")).orderBy("i").collect()]
    assert got == [label for _, label in cases]


def test_report_date_month_first(spark):
    import datetime as dt

    from canvass.config import Config
    from canvass.functions.dates import parse_report_date, to_report_date
    assert parse_report_date("02/28/2013") == dt.date(2013, 2, 28)
    assert Config.from_text("02/28/2013", "03/01/2013").as_of == dt.date(2013, 3, 1)
    got = _apply(spark, ["02/28/2013", "13/40/2013", None], "string", to_report_date)
    assert got == [dt.date(2013, 2, 28), None, None]


def test_config_rejects_bad_values():
    import pytest

    from canvass.config import Config
    for bad in ({"n_main": -1}, {"materialize": "local"}, {"hot_key_rows": 0}):
        with pytest.raises(ValueError):
            Config(**bad)
