import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from loomvault.functions import dates, scoring, text
from loomvault.functions.keys import has_key, hash_diff, hash_key


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


def test_hash_rules(spark):
    df = spark.createDataFrame([(None, "a", 12345678.9, True), ("", "a", 1.0, None), ("^^", "a", 0.5, False)], "x string, y string, d double, b boolean")
    keys = [r[0] for r in df.select(hash_key(df, "x")).collect()]
    diffs = [r[0] for r in df.select(hash_diff(df, "x")).collect()]
    assert keys[0] == keys[1] == sha("")
    assert diffs[0] == diffs[2] == sha("^^") and diffs[1] == sha("")
    assert df.select(hash_key(df, "y")).first()[0] == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    assert df.select(hash_diff(df, "y", "d", "b")).first()[0] == sha("a||12345678.9000||true")
    pair = spark.createDataFrame([("a||", "b"), ("a", "||b")], "x string, y string")
    assert pair.select(hash_key(pair, "x", "y")).distinct().count() == 1  # the separator is not escaped


def test_has_key(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("  ", "b"), ("a", "")], "x string, y string")
    assert [r[0] for r in df.select(has_key("x", "y")).collect()] == [True, False, False, False]


def test_boundary_differences(spark):
    a, b = dates.at("2024-01-31 00:59:59"), dates.at("2024-02-01 01:01:00")
    assert one(spark, dates.hours_between(dates.at("2024-01-01 00:59:00"), dates.at("2024-01-01 01:01:00")),
               dates.months_between(a, b), dates.days_between(a, b), dates.minutes_between(a, b), dates.seconds_between(a, b)) == (1, 1, 1, 1442, 86461)


def test_zone_does_not_matter(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 2024-03-10 has 23 hours there
        assert one(spark, dates.hours_between(dates.at("2024-03-09 12:00:00"), dates.at("2024-03-11 12:00:00")),
                   dates.epoch_seconds(dates.at("1970-01-02 00:00:01"))) == (48, 86401)
        assert one(spark, dates.hour_start(dates.at("2024-03-10 02:30:00")))[0] == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_fiscal_calendar(spark):
    got = [one(spark, dates.fiscal_year(F.lit(d).cast("date")), dates.fiscal_quarter(F.lit(d).cast("date")))
           for d in ("2024-03-31", "2024-04-01", "2024-12-31", "2024-07-01")]
    assert got == [(2023, 4), (2024, 1), (2024, 3), (2024, 2)]


def test_capitalise_words(spark):
    got = one(spark, *[text.capitalise_words(F.lit(s)) for s in ("mary-ann o'neil", "NATION_0", " two  words", "a.b/c", "")])
    assert got == ("Mary-Ann O'neil", "Nation_0", " Two  Words", "A.B/C", "")
    assert one(spark, text.capitalise_words(F.lit(None).cast("string"))) == (None,)


def test_safe_cast(spark):
    assert one(spark, text.safe_cast(F.lit("x"), "int", 7), text.safe_cast(F.lit("12"), "int", 7), text.safe_cast(F.lit("x"), "date")) == (7, 12, None)


def test_tiers(spark):
    def tier(v):
        return one(spark, scoring.ltv_tier(F.lit(v)))[0]
    assert [tier(v) for v in (10000, 9999.99, 5000, 1000, 0.01, 0)] == ["PLATINUM", "GOLD", "GOLD", "SILVER", "BRONZE", "NEW"]
    assert [one(spark, scoring.churn_risk(F.lit(d)))[0] for d in (366, 365, 181, 180, 91, 90, 9999)] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "ACTIVE", "HIGH"]
    cases = {(5, 5, 1): "CHAMPION", (4, 2, 1): "LOYAL", (4, 1, 5): "BIG_SPENDER", (4, 1, 1): "NEW_CUSTOMER", (2, 3, 1): "AT_RISK", (1, 1, 5): "LOST", (3, 3, 3): "REGULAR"}
    for (r, f, m), label in cases.items():
        assert one(spark, scoring.rfm_segment(F.lit(r), F.lit(f), F.lit(m)))[0] == label


def test_sla(spark):
    def met(status, shipping, hours):
        return one(spark, scoring.sla_met(F.lit(status), F.lit(shipping), F.lit(hours)))[0]
    assert met("DELIVERED", "EXPRESS", 24) is True and met("SHIPPED", "EXPRESS", 25) is False
    assert met("DELIVERED", "STANDARD", 72) is True and met("DELIVERED", "STANDARD", 73) is False
    assert met("DELIVERED", "OVERNIGHT", 1) is False and met("PENDING", "EXPRESS", 1) is None and met("CANCELLED", "EXPRESS", 1) is False
    assert one(spark, scoring.lifecycle_stage(F.lit("ON_HOLD")))[0] == "UNKNOWN"


def test_predict_clv(spark):
    def clv(n, aov, days, tier):
        return one(spark, scoring.predict_clv(F.lit(n), F.lit(aov), F.lit(days), F.lit(tier)))[0]
    assert clv(0, 50.0, 10, "GOLD") == 0.0
    assert clv(10, 50.0, 365, "GOLD") == 650.0
    assert clv(10, 50.0, 365, "OTHER") == 500.0
    assert clv(1, 1.0, 0, "BRONZE") == 365.0


def test_predict_clv_matches_plain_python(spark):
    cases = [(n, a, d, t) for n in (0, 1, 7) for a in (0.0, 12.5) for d in (0, 1, 400) for t in ("PLATINUM", "SILVER", None)]
    df = spark.createDataFrame(cases, "n int, a double, d int, t string")
    got = [r[0] for r in df.select(scoring.predict_clv(F.col("n"), F.col("a"), F.col("d"), F.col("t"))).collect()]
    weight = {"PLATINUM": 1.5, "GOLD": 1.3, "SILVER": 1.1, "BRONZE": 1.0}
    assert got == [0.0 if n == 0 else round(n / (max(d, 1) / 365.0) * a * weight.get(t, 1.0), 2) for n, a, d, t in cases]
