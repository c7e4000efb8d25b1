from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratebook.functions import exprs as X


def one(spark, expression, **values):
    """Value of an expression over one row of string columns."""
    schema = ", ".join(f"{name} string" for name in values) or "x string"
    row = tuple(values.values()) or (None,)
    return spark.createDataFrame([row], schema).select(expression.alias("v")).first()[0]


@pytest.mark.parametrize(
    "url, version",
    [
        ("https://h/offers/v1.0/x/S/20250401/us-east-1/index.json", "20250401"),
        ("https://h/offers/v1.0/x/S/20250401/us-east-1/index.json//", "20250401"),
        ("a/b", ""),
        ("a/b/c", "a"),
        ("", ""),
    ],
)
def test_version_from_url(spark, url, version):
    assert one(spark, X.version_from_url(F.col("u")), u=url) == version


@pytest.mark.parametrize(
    "url, absolute",
    [
        ("https://other/x", "https://other/x"),
        ("http://other/x", "http://other/x"),
        ("/x/y", "https://base/x/y"),
        ("x/y", "https://base/x/y"),
    ],
)
def test_absolute_url(spark, url, absolute):
    assert one(spark, X.absolute_url(F.col("u"), "https://base//"), u=url) == absolute


@pytest.mark.parametrize(
    "bound, kept",
    [
        ("0", "0"),
        (" 51200\t\n", "51200"),
        ("Inf", None),
        (" INFINITY ", None),
        ("", None),
        ("  \t", None),
        (None, None),
    ],
)
def test_normalise_range(spark, bound, kept):
    assert one(spark, X.normalise_range(F.col("b")), b=bound) == kept


@pytest.mark.parametrize(
    "prices, picked",
    [
        ('{"USD": "1", "CNY": "2"}', ("1", "USD")),
        ('{"CNY": "2", "USD": "1"}', ("1", "USD")),
        ('{"EUR": "3", "CNY": "2"}', ("3", "EUR")),
        ('{"USD": null, "CNY": "2"}', (None, "USD")),
        ("{}", (None, None)),
        (None, (None, None)),
    ],
)
def test_picked_price(spark, prices, picked):
    parsed = F.from_json("p", "map<string, string>")
    both = F.struct(X.picked_price(parsed), X.picked_currency(parsed))
    assert tuple(one(spark, both, p=prices)) == picked


@pytest.mark.parametrize(
    "text, exact",
    [
        ("0.0960000000", Decimal("0.096")),
        ("1.0E-4", Decimal("0.0001")),
        ("0.0000000000000001", Decimal("1E-16")),
        (None, None),
    ],
)
def test_exact_price(spark, text, exact):
    assert one(spark, X.exact_price(F.col("p")), p=text) == exact


def test_malformed_price_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, X.exact_price(F.col("p")), p="abc")


@pytest.mark.parametrize(
    "text, kept",
    [
        ("{}", None),
        ("[]", None),
        ("null", None),
        ('{"a":1}', '{"a":1}'),
        ("[1]", "[1]"),
        ('"text"', '"text"'),
        (None, None),
    ],
)
def test_json_or_null(spark, text, kept):
    assert one(spark, F.to_json(X.json_or_null(F.parse_json("t"))), t=text) == kept


@pytest.mark.parametrize(
    "path, value",
    [("$.a", "1"), ("$.b", "x"), ("$.o", None), ("$.l", None), ("$.n", None), ("$.z", None), ("$.o.c", "true")],
)
def test_json_value_is_scalar_only(spark, path, value):
    text = '{"a": 1, "b": "x", "o": {"c": true}, "l": [1], "n": null}'
    assert one(spark, X.json_value(F.parse_json("t"), path), t=text) == value


@pytest.mark.parametrize(
    "text, name",
    [
        ('{"servicename": "a", "serviceName": "b"}', "a"),
        ('{"servicename": "", "serviceName": "b"}', "b"),
        ('{"ServiceName": "c"}', "c"),
        ('{"ServiceName": ""}', ""),
        ('{"other": "x"}', None),
        (None, None),
    ],
)
def test_service_name(spark, text, name):
    assert one(spark, X.service_name(F.parse_json("t")), t=text) == name


@pytest.mark.parametrize(
    "text, day",
    [("2025-04-01T00:00:00Z", date(2025, 4, 1)), ("2025-04-01", date(2025, 4, 1)), ("", None), (None, None)],
)
def test_effective_date(spark, text, day):
    assert one(spark, X.effective_date(F.col("t")), t=text) == day


def test_fallbacks(spark):
    assert one(spark, X.rate_code(F.col("c"), F.col("t")), c="", t="T") == "T"
    assert one(spark, X.rate_code(F.col("c"), F.col("t")), c="C", t="T") == "C"
    assert one(spark, X.effective_version(F.col("a"), F.col("b")), a="", b=None) == ""
    assert one(spark, X.effective_version(F.col("a"), F.col("b")), a=None, b="d") == "d"
    assert one(spark, X.description(F.col("a"), F.col("b")), a="", b="plan") == "plan"
    assert one(spark, X.description(F.col("a"), F.col("b")), a=None, b=None) is None


def test_plan_term_attributes_keep_null_members(spark):
    made = X.plan_term_attributes(
        F.parse_json(F.lit(None).cast("string")), F.col("d"), F.col("e")
    )
    text = one(spark, F.to_json(made), d=None, e="2025")
    assert text == '{"description":null,"effectiveDate":"2025","leaseContractLength":{}}'


def test_error_text_and_names(spark):
    assert one(spark, X.error_text(F.col("e")), e=None) == ""
    assert len(one(spark, X.error_text(F.col("e")), e="x" * 10_000)) == 8_000
    name = X.safe_object_name(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, name, a="S/ x", b="us-east-1", c="2025:04") == "S_x--us-east-1--2025_04"
    assert X.service_codes(" A, ,B,A,") == ["A", "B"]
    assert X.service_codes("") == []


def test_blanks_of_any_kind_and_dotted_keys(spark):
    row = spark.sql(
        "SELECT ' \u00a0Inf\u2003' AS bound, ' 5\u00a0' AS tier, "
        "parse_json('{\"a.b\": \"x\", \"it\\'s\": \"y\"}') AS v"
    ).select(
        X.normalise_range(F.col("bound")).alias("bound"),
        X.tier_bound(F.col("tier")).alias("tier"),
        X.attribute(F.col("v"), "a.b").alias("dotted"),
    ).first()
    assert row.bound is None and row.tier == 5 and row.dotted == "x"
