from decimal import Decimal

from pyspark.sql import functions as F

from estrato import functions as X


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("r")).first()["r"]


def test_text(spark):
    assert one(spark, X.clean_text("a"), a="  x y ") == "x y"
    assert one(spark, X.clean_text("a"), a="   ") is None
    assert one(spark, X.clean_text("a"), a="\t") == "\t"
    assert one(spark, X.dash_to_null("a"), a=" - ") is None
    assert one(spark, X.dash_to_null("a"), a="--") == "--"
    assert one(spark, X.parse_yes_no("a"), a=" sim ") is True
    assert one(spark, X.parse_yes_no("a"), a="não") is False
    assert one(spark, X.parse_yes_no("a"), a="NAO") is None
    assert one(spark, X.is_blank_only("a"), a=" ") is True
    assert one(spark, X.is_blank_only("a"), a="") is False
    assert one(spark, X.normalize_location("a"), a=" s3a://b/c// ") == "s3a://b/c"
    assert one(spark, X.normalize_location("a"), a=None) == ""
    assert one(spark, X.is_safe_id("a"), a="run_2026-09.1") is True
    assert one(spark, X.is_safe_id("a"), a="run 1; drop") is False


def test_money(spark):
    assert one(spark, X.parse_decimal_br("a"), a="1234,56") == Decimal("1234.56")
    assert one(spark, X.parse_decimal_br("a"), a="1234.56") == Decimal("1234.56")
    assert one(spark, X.parse_decimal_br("a"), a="-0,5") == Decimal("-0.50")
    assert one(spark, X.parse_decimal_br("a"), a="1.234,56") is None
    assert one(spark, X.parse_decimal_br("a"), a="9" * 20) is None
    assert one(spark, X.parse_decimal_br("a"), a="0,005") == Decimal("0.01")
    rows = spark.createDataFrame([("0.10",), ("0.20",), (None,)], "v string")
    assert rows.agg(X.exact_sum(F.col("v").cast("decimal(17,2)"))).first()[0] == Decimal("0.30")
    assert rows.filter("false").agg(X.exact_sum(F.col("v").cast("decimal(17,2)"))).first()[0] == Decimal("0.00")


def test_dates(spark):
    import datetime as dt

    assert one(spark, X.parse_date_br("a"), a="15/03/0011") == dt.date(11, 3, 15)
    assert one(spark, X.parse_date_br("a"), a="31/02/2001") is None
    assert one(spark, X.parse_date_br("a"), a="2001-02-03") is None
    for text, key in ((None, -1), ("", -1), ("31/12/1989", -2), ("01/01/1990", 19900101), ("31/12/2050", 20501231),
                      ("01/01/2051", -2), ("01/01/3012", -2), ("31/12/5008", -2)):
        assert one(spark, X.date_sk(X.parse_date_br("a")), a=text) == key
    assert str(one(spark, X.parse_control_timestamp("a"), a="16/09/2026 06:32:11")) == "2026-09-16 06:32:11"
    for bad in ("", "31/02/2026 10:00:00", "2026-09-16T06:32:11"):
        assert one(spark, X.parse_control_timestamp("a"), a=bad) is None


def test_hash_key_separates_tuples(spark):
    key = X.hash_key("a", "b")
    seen = {one(spark, key, a=a, b=b) for a, b in (("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("-1:", "c"), (None, None))}
    assert len(seen) == 6 and None not in seen
    assert one(spark, X.sha256_in_path("a"), a="raw/x/sha256=AbC1/f.zip") == "AbC1"
    assert one(spark, X.sha256_in_path("a"), a="raw/x/f.zip") is None
