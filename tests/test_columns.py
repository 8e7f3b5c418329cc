from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tagloom.functions import columns as X
from tagloom.operators.masking import mask_message_text, scale_amounts


def value(spark, column, **given):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()]).select(column).first()[0]


def test_base24(spark):
    for number in [1, 23, 24, 576, 1234567, 24**9 + 5]:
        digits, n = "", number
        while n:
            digits, n = "0123456789abcdefghijklmn"[n % 24] + digits, n // 24
        assert value(spark, X.base24_to_long(F.col("t")), t=digits) == number
        assert value(spark, X.base24_to_long(F.col("t")), t=f"'{digits.upper()}'") == number
    for bad in ["undefined", "zz", "", "1-2"]:
        assert value(spark, X.base24_to_long(F.col("t")), t=bad) == 0


def test_ip_to_long(spark):
    assert value(spark, X.ip_to_long(F.col("ip")), ip="10.1.2.3") == 10 * 2**24 + 2**16 + 2 * 256 + 3
    assert value(spark, X.ip_to_long(F.col("ip")), ip="not an ip") is None


def test_iso_date(spark):
    for text in ["2024/1/5", "2024-1-5", "2024-01-05", "2024/01/5"]:
        assert value(spark, X.iso_date(F.col("d")), d=text) == date(2024, 1, 5)
    assert value(spark, X.iso_date(F.col("d")), d="2024/12/13") == date(2024, 12, 13)
    assert value(spark, X.iso_date(F.col("d")), d="soon") is None


def test_time_zones(spark):
    assert value(spark, X.ingest_timestamp(F.col("t").cast("timestamp_ntz")), t="2024-07-01 00:00:00") == datetime(2024, 7, 1, 4)
    # 04:30 UTC is still the day before in New York in winter, 00:30 in summer
    assert value(spark, X.tenant_date(F.col("t").cast("timestamp_ntz")), t="2024-01-10 04:30:00") == date(2024, 1, 9)
    assert value(spark, X.tenant_date(F.col("t").cast("timestamp_ntz")), t="2024-07-10 04:30:00") == date(2024, 7, 10)


def test_time_zones_do_not_follow_the_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        test_time_zones(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_band_takes_highest_threshold(spark):
    bands = {10: 1, 50: 2, 100: 3}
    band = X.band_by_threshold(lambda t: F.col("v") >= t, bands)
    assert [value(spark, band, v=v) for v in (9, 10, 49, 50, 99, 100, 5000)] == [0, 1, 1, 2, 2, 3, 3]


def test_message_text(spark):
    texts = {
        "會員 #abc123@shop#存款 ¥1,234 完成": "會員 #abc*****@shop#存款 ℗12.34 完成",
        "會員 #abcdef@shop#提款 ¥500 (500)": "會員 #abc*****@shop#提款 ℗5.0 (5.0)",
        "會員 #abcdef@shop#提款 ¥1,205": "會員 #abc*****@shop#提款 ℗12.05",
        "no amount": "no amount",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in texts], "content string")
    got = [r[0] for r in mask_message_text(df.withColumn("key", F.col("content"))).select("content").collect()]
    assert got == list(texts.values())


def test_scale_amounts_is_exact(spark):
    df = spark.createDataFrame([(1, 12345), (2, None)], "id int, balance bigint")
    assert [str(r.balance) for r in scale_amounts(df).orderBy("id").collect()] == ["123.4500", "0.0000"]


def test_conform_types_keeps_digits_and_knows_all_names(spark):
    df = spark.createDataFrame(
        [("7", None, Decimal("1.239"), 1.239, "1.239", 5, "3.50")],
        "id string, promotion_id string, amount decimal(10,3), payoff double, bet_amount string, deposit_amount long, balance string")
    got = X.conform_types(df).first()
    assert got.asDict() == {
        "id": 7, "promotion_id": 0, "amount": Decimal("1.239"), "payoff": 1.239, "bet_amount": 1.239,
        "deposit_amount": Decimal("5.00"), "balance": Decimal("3.50")}
    wide = spark.createDataFrame([(Decimal(10) ** 35, None)], "amount decimal(38,1), balance string")
    assert X.conform_types(wide).first() == (Decimal(10) ** 35, None)
    with pytest.raises(Exception, match="more than two decimals"):
        X.conform_types(df.withColumn("balance", F.lit("3.505"))).collect()
