"""Column masks, tags, row policies and detection of personal data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: roles, masks and patterns ---------------------------------------------
CLEAR_ROLES = ("DATA_ENGINEER", "PLATFORM_ADMIN", "ACCOUNTADMIN", "DATA_STEWARD")
CLEAR_ROLES_SSN = ("PLATFORM_ADMIN", "ACCOUNTADMIN")
CLEAR_ROLES_INLINE = ("DATA_ENGINEER", "PLATFORM_ADMIN")
COUNTRY_ALL_ROLES = ("PLATFORM_ADMIN", "DATA_ENGINEER", "ACCOUNTADMIN", "DATA_STEWARD", "TRANSFORMER")
SENSITIVITY_ALL_ROLES = ("PLATFORM_ADMIN", "DATA_STEWARD", "ACCOUNTADMIN", "DATA_ENGINEER")
OPEN_LEVELS = ("PUBLIC", "INTERNAL")
EMAIL_PARTS = r"^(.{2})(.*)(@.*)$"
MASKED_PHONE_PREFIX = "***-***-"
MASKED_NAME_SUFFIX = "****"
MASKED_SSN = "***-**-****"
MASKED_ADDRESS = "*** REDACTED ***"
MASKED_UNKNOWN = "***"
PATTERNS = {
    "EMAIL": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "PHONE": r"^\+?[1-9]\d{1,14}$",
    "SSN": r"^\d{3}-\d{2}-\d{4}$",
}
PII_TAGS = {
    "EMAIL": "EMAIL", "PHONE": "PHONE", "FIRST_NAME": "NAME", "LAST_NAME": "NAME", "FULL_NAME": "NAME",
    "DATE_OF_BIRTH": "DOB", "SHIPPING_ADDRESS": "ADDRESS", "BILLING_ADDRESS": "ADDRESS",
}
TAG_KEY = "pii"


def _masked_email(col: Column) -> Column:
    """First two characters and the domain; an address the pattern does not fit is hidden whole."""
    return (
        F.when(col.isNull(), F.lit(None).cast("string"))
        .when(col.rlike(EMAIL_PARTS), F.regexp_replace(col, EMAIL_PARTS, "$1***$3"))
        .otherwise(MASKED_UNKNOWN)
    )


def _masked_phone(col: Column) -> Column:
    return F.concat(F.lit(MASKED_PHONE_PREFIX), F.right(col, F.lit(4)))


def _masked_name(col: Column) -> Column:
    return F.concat(F.left(col, F.lit(1)), F.lit(MASKED_NAME_SUFFIX))


def mask_email(col: Column, role: str, clear: Sequence[str] = CLEAR_ROLES) -> Column:
    return col if role in clear else _masked_email(col)


def mask_phone(col: Column, role: str, clear: Sequence[str] = CLEAR_ROLES) -> Column:
    return col if role in clear else _masked_phone(col)


def mask_name(col: Column, role: str, clear: Sequence[str] = CLEAR_ROLES) -> Column:
    return col if role in clear else _masked_name(col)


def mask_ssn(col: Column, role: str) -> Column:
    return col if role in CLEAR_ROLES_SSN else F.lit(MASKED_SSN)


def mask_dob(col: Column, role: str) -> Column:
    return col if role in CLEAR_ROLES else F.make_date(F.year(col), F.lit(1), F.lit(1))


def mask_address(col: Column, role: str) -> Column:
    return col if role in CLEAR_ROLES else F.lit(MASKED_ADDRESS)


MASKS: dict[str, Callable[[Column, str], Column]] = {
    "EMAIL": mask_email, "PHONE": mask_phone, "NAME": mask_name, "SSN": mask_ssn, "DOB": mask_dob, "ADDRESS": mask_address,
}


def mask_inline(col: Column, pii_type: str, role: str) -> Column:
    """Masking inside a model: fewer clear roles, unknown types pass through."""
    inline = {"EMAIL": mask_email, "PHONE": mask_phone, "NAME": mask_name}.get(pii_type)
    return col if inline is None else inline(col, role, CLEAR_ROLES_INLINE)


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Store each column's personal-data type in its metadata, where it travels with the column."""
    for name, tag in tags.items():
        if name in df.columns:
            df = df.withMetadata(name, {**df.schema[name].metadata, TAG_KEY: tag})
    return df


def tags_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG_KEY] for f in df.schema if TAG_KEY in f.metadata}


def apply_tag_policies(df: DataFrame, role: str, tags: Mapping[str, str] | None = None) -> DataFrame:
    """Replace every tagged column by its mask for the role; the role is known on the driver."""
    tagged = tags_of(df) if tags is None else {c: t for c, t in tags.items() if c in df.columns}
    return df.withColumns({c: MASKS[t](F.col(c), role) for c, t in tagged.items()}) if tagged else df


def row_access_country(df: DataFrame, role: str, allowed: Sequence[str] | None = None, column: str = "COUNTRY_CODE") -> DataFrame:
    """Full view for trusted roles, listed countries for analysts, nothing for anyone else."""
    if role in COUNTRY_ALL_ROLES:
        return df
    if role == "ANALYST":
        return df.where(F.col(column).isin(list(allowed if allowed is not None else ["ALL"])))
    return df.where(F.lit(False))


def row_access_sensitivity(df: DataFrame, role: str, column: str = "SENSITIVITY_LEVEL") -> DataFrame:
    if role in SENSITIVITY_ALL_ROLES:
        return df
    if role == "ANALYST":
        return df.where(F.col(column).isin(*OPEN_LEVELS))
    return df.where(F.lit(False))


def row_access_roles(df: DataFrame, role: str, allowed_roles: Sequence[str]) -> DataFrame:
    return df if role in allowed_roles else df.where(F.lit(False))


def secure_customer_profiles(customers: DataFrame, role: str) -> DataFrame:
    """Current customers with personal columns masked for the role."""
    current = customers.where("IS_CURRENT").select(
        "CUSTOMER_SK", "CUSTOMER_ID", "FULL_NAME", "EMAIL", "PHONE", "COUNTRY_CODE", "CITY", "STATE", "GENDER",
        "CUSTOMER_SEGMENT", "LOYALTY_TIER", "RFM_SEGMENT", "LTV_TIER", "CHURN_RISK", "IS_ACTIVE", "TOTAL_ORDERS",
        "TOTAL_REVENUE", "AVG_ORDER_VALUE", "LAST_ORDER_DATE", "LAST_UPDATED_AT",
    )
    return apply_tag_policies(current, role, PII_TAGS)


def match_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of non-null values that fit each pattern, for all text columns in one pass."""
    names = list(columns) if columns else [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    shares = df.agg(*[
        F.avg(F.col(c).rlike(p).cast("double")).alias(f"{c}|{tag}") for c in names for tag, p in PATTERNS.items()
    ])
    cells = F.array(*[
        F.struct(F.lit(c).alias("COLUMN_NAME"), F.lit(tag).alias("TAG_VALUE"), F.col(f"`{c}|{tag}`").alias("MATCH_SHARE"))
        for c in names for tag in PATTERNS
    ])
    return shares.select(F.explode(cells).alias("c")).select("c.*")


def classify_columns(df: DataFrame, threshold: float = 0.8, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns whose values mostly fit one personal-data pattern."""
    return match_shares(df, columns).where(F.col("MATCH_SHARE") >= threshold)


def classification_report(tags: DataFrame) -> DataFrame:
    """Live tags of the personal-data and sensitivity kinds, ordered by object and column."""
    wanted = tags.where(F.col("TAG_NAME").isin("PII", "SENSITIVITY_LEVEL", "SEMANTIC_CATEGORY") & F.col("DELETED").isNull())
    return wanted.select(
        "TAG_NAME", "OBJECT_NAME", "COLUMN_NAME", "TAG_VALUE", F.lit("AUTO_CLASSIFIED").alias("CLASSIFICATION_METHOD")
    ).orderBy("OBJECT_NAME", "COLUMN_NAME", "TAG_NAME")
