import datetime as dt
import math

import pytest
from pyspark.errors import DateTimeException
from pyspark.sql import functions as F

from vaultline.functions import derive, masks


def values(spark, schema, rows, column):
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    return [r[0] for r in frame.select(column).collect()]


def test_malformed_timestamps_become_null_unless_strict(spark):
    rows = [("2024-03-01T10:20:30.123456",), ("nonsense",), (None,)]
    assert values(spark, "t string", rows, derive.parse_timestamp("t").cast("timestamp_ntz")) == [
        dt.datetime(2024, 3, 1, 10, 20, 30, 123456),
        None,
        None,
    ]
    with pytest.raises(DateTimeException):
        values(spark, "t string", rows, derive.parse_timestamp("t", strict=True))


def test_epoch_second_drops_fractions_downwards(spark):
    rows = [(dt.datetime(1970, 1, 1, 0, 0, 1, 999999),), (dt.datetime(1969, 12, 31, 23, 59, 58, 500000),)]
    assert values(spark, "t timestamp_ntz", rows, derive.epoch_second("t")) == [1, -2]


def test_names_and_mails(spark):
    assert values(spark, "s string", [("  Zoé d'Or ",)], derive.upper_trimmed("s")) == ["ZOÉ D'OR"]
    assert values(spark, "s string", [(" A@B.Com ",)], derive.lower_trimmed("s")) == ["a@b.com"]


def test_amounts_are_rounded_before_they_are_banded(spark):
    rows = [(99.994,), (99.996,), (999.99,), (1000.0,), (4999.99,), (5000.0,), (None,), (-3.0,)]
    assert values(spark, "a double", rows, derive.amount_category(derive.rounded_money("a"))) == [
        "small", "medium", "medium", "large", "large", "very_large", "very_large", "small",
    ]


def test_high_balance_and_suspicion_treat_unknown_as_no(spark):
    assert values(spark, "b double", [(20000.0,), (20000.01,), (None,)], derive.is_high_balance("b")) == [
        False, True, False,
    ]
    rows = [(True, 1.0), (None, 1.0), (None, 8000.01), (False, 8000.0), (False, None), (True, None)]
    assert values(spark, "f boolean, a double", rows, derive.is_suspicious("f", "a")) == [
        True, False, True, False, False, True,
    ]


def test_risk_score_has_its_gap_at_two(spark):
    rows = [(0,), (1,), (2,), (3,), (None,)]
    assert values(spark, "n long", rows, derive.risk_score("n")) == ["low", "medium", "low", "high", "low"]


def test_alert_levels(spark):
    rows = [(4, 0), (3, 0), (2, 9), (1, 4), (1, 3), (0, 0)]
    schema = "n long, v long"
    assert values(spark, schema, rows, derive.alert_level("n", "v")) == [
        "critical", "high", "high", "medium", "low", "low",
    ]
    levels = [("critical",), ("high",), ("medium",), ("low",), (None,)]
    assert values(spark, "l string", levels, derive.requires_investigation("l")) == [
        True, True, False, False, False,
    ]


def test_money_sums_do_not_depend_on_row_order(spark):
    cents = [(0.1,)] * 7 + [(1e12,), (0.2,), (-1e12,)]
    total = derive.money_sum("m")
    forward = spark.createDataFrame(cents, "m double").repartition(5).agg(total).first()[0]
    backward = spark.createDataFrame(cents[::-1], "m double").coalesce(1).agg(total).first()[0]
    assert forward == backward == 0.9


MAILS = [("radhia@mail.com",), ("noat",), ("a@b@c",), ("@x",), (None,)]


def test_masks(spark):
    assert values(spark, "e string", MAILS, masks.mask_email("e")) == [
        "r***@mail.com", None, "a***@b", "@***@x", None,
    ]
    assert values(spark, "p string", [("+33612345678",), ("12345",), (None,)], masks.mask_phone("p")) == [
        "+336*****678", "1234*****345", None,
    ]
    assert values(spark, "i string", [("FR7630006000011234",)], masks.mask_iban("i")) == ["FR76***234"]


def test_engineers_see_clear_values(spark):
    engineer = {"data-engineers"}
    for mask in (masks.mask_email, masks.mask_phone, masks.mask_iban):
        assert values(spark, "c string", MAILS, mask("c", engineer)) == [m[0] for m in MAILS]


@pytest.mark.parametrize(
    ("groups", "seen"),
    [
        ((), []),
        (("data-analysts-fr",), ["FR"]),
        (("data-analysts-be",), ["BE"]),
        (("data-analysts-be", "data-analysts-fr"), ["FR"]),
        (("data-engineers", "data-analysts-be"), ["FR", "BE", "DE", None]),
        (("others",), []),
    ],
)
def test_rows_visible_by_nationality(spark, groups, seen):
    people = spark.createDataFrame([("FR",), ("BE",), ("DE",), (None,)], "n string").coalesce(1)
    assert [r[0] for r in people.filter(masks.rls_by_nationality("n", groups)).collect()] == seen


@pytest.mark.parametrize("groups", [(), ("data-analysts-fr",), ("data-engineers",)])
def test_sql_functions_agree_with_the_columns(spark, groups):
    masks.register_sql(spark, groups)
    frame = spark.createDataFrame(MAILS + [("FR",), ("+33612345678",)], "c string")
    row = frame.select(
        F.expr("mask_email(c)").eqNullSafe(masks.mask_email("c", groups)).alias("email"),
        F.expr("mask_phone(c)").eqNullSafe(masks.mask_phone("c", groups)).alias("phone"),
        F.expr("mask_iban(c)").eqNullSafe(masks.mask_iban("c", groups)).alias("iban"),
        F.expr("rls_by_nationality(c)").eqNullSafe(masks.rls_by_nationality("c", groups)).alias("rls"),
    )
    assert row.filter("NOT (email AND phone AND iban AND rls)").count() == 0


def test_one_text_is_not_a_set_of_groups(spark):
    for function in (masks.mask_email, masks.mask_phone, masks.mask_iban, masks.rls_by_nationality):
        with pytest.raises(TypeError):
            function("c", "former-data-engineers")


def test_money_sums_take_any_number(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "m double").agg(derive.money_sum("m")).first()[0]

    assert total(0.1, 0.2, None) == 0.3
    assert total(None) is None
    assert total(1e17, 1.0) == 1e17 + 1
    assert total(1e30, 1e30) == 2e30
    assert total(10.0, float("inf")) == float("inf")
    assert math.isnan(total(10.0, float("nan")))
