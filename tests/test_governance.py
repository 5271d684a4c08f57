from datetime import date

from pyspark.sql import functions as F

from loomvault.operators import governance as gov

PERSON = ("ali@m.com", "+15551234567", "Alice", "123-45-6789", date(1990, 5, 17), "1 Main St")


def masked(spark, role):
    df = spark.createDataFrame([PERSON], "e string, p string, n string, s string, d date, a string")
    return tuple(df.select(gov.mask_email(F.col("e"), role), gov.mask_phone(F.col("p"), role), gov.mask_name(F.col("n"), role),
                           gov.mask_ssn(F.col("s"), role), gov.mask_dob(F.col("d"), role), gov.mask_address(F.col("a"), role)).first())


def test_masks_by_role(spark):
    hidden = ("al***@m.com", "***-***-4567", "A****", "***-**-****", date(1990, 1, 1), "*** REDACTED ***")
    assert masked(spark, "ANALYST") == hidden
    assert masked(spark, "PLATFORM_ADMIN") == PERSON
    for role in ("DATA_STEWARD", "DATA_ENGINEER"):
        assert masked(spark, role) == (*PERSON[:3], "***-**-****", *PERSON[4:])


def test_email_that_does_not_fit_is_hidden(spark):
    df = spark.createDataFrame([("a@m.com",), ("no address",), (None,)], "e string")
    assert [r[0] for r in df.select(gov.mask_email(F.col("e"), "ANALYST")).collect()] == ["***", "***", None]


def test_inline_masks_know_fewer_roles(spark):
    df = spark.createDataFrame([("ali@m.com",)], "e string")
    got = [df.select(gov.mask_inline(F.col("e"), kind, role)).first()[0] for kind, role in
           (("EMAIL", "DATA_ENGINEER"), ("EMAIL", "DATA_STEWARD"), ("EMAIL", "ACCOUNTADMIN"), ("NONE", "ANALYST"))]
    assert got == ["ali@m.com", "al***@m.com", "al***@m.com", "ali@m.com"]


def test_tags_travel_in_metadata(spark):
    df = gov.tag_columns(spark.createDataFrame([("ali@m.com", "x")], "EMAIL string, other string"), {"EMAIL": "EMAIL"})
    assert gov.tags_of(df.where("other = 'x'").select("EMAIL")) == {"EMAIL": "EMAIL"}
    assert tuple(gov.apply_tag_policies(df, "ANALYST").first()) == ("al***@m.com", "x")


def test_row_policies(spark):
    df = spark.createDataFrame([("US", "PUBLIC"), ("DE", "CONFIDENTIAL")], "COUNTRY_CODE string, SENSITIVITY_LEVEL string")
    def seen(f):
        return f.count()
    assert seen(gov.row_access_country(df, "ANALYST")) == 0 and seen(gov.row_access_country(df, "ANALYST", ["US"])) == 1
    assert seen(gov.row_access_country(df, "TRANSFORMER")) == 2 and seen(gov.row_access_country(df, "GUEST")) == 0
    assert seen(gov.row_access_sensitivity(df, "ANALYST")) == 1 and seen(gov.row_access_sensitivity(df, "TRANSFORMER")) == 0
    assert seen(gov.row_access_roles(df, "A", ["A"])) == 2 and seen(gov.row_access_roles(df, "B", ["A"])) == 0


def test_classification_threshold(spark):
    df = spark.createDataFrame([("a@b.com", "a@b.com"), ("c@d.org", "no"), (None, "no")], "all_mail string, mixed string")
    assert [(r["COLUMN_NAME"], r["TAG_VALUE"]) for r in gov.classify_columns(df).collect()] == [("all_mail", "EMAIL")]
