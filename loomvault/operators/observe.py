"""Health, freshness, cost and lag reports over warehouse tables and logs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import add_days, at, hour_start, hours_between, minutes_between, seconds_between
from ..functions.keys import row_id
from ..functions.scoring import bucket_at_least, bucket_at_most
from ..schemas import DATA_PRODUCT_REGISTRY, ERROR_EVENT_LOG, TASK_EXECUTION_LOG


def audit_columns(df: DataFrame, schema: str, model: str, run_id: str, now: str) -> DataFrame:
    return df.withColumns({
        "_DW_LOADED_AT": at(now), "_DW_SCHEMA": F.lit(schema), "_DW_MODEL_NAME": F.lit(model), "_DW_INVOCATION_ID": F.lit(run_id),
    })


def vault_health_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every vault table."""
    parts = [df.agg(F.count("*").alias("ROW_COUNT")).select(F.lit(n.upper()).alias("ENTITY"), "ROW_COUNT") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("ENTITY")


def layer_sla_monitor(tables: Sequence[tuple[str, str, DataFrame, str]], now: str) -> DataFrame:
    """(layer, model, frame, instant column) -> newest record, its age in hours and a colour."""
    parts = []
    for layer, model, df, column in tables:
        newest = df.agg(F.max(column).alias("LATEST_RECORD"))
        age = hours_between(F.col("LATEST_RECORD"), at(now))
        parts.append(newest.select(
            F.lit(layer).alias("LAYER"), F.lit(model).alias("MODEL"), "LATEST_RECORD", age.alias("HOURS_AGO"),
            bucket_at_most(age, config.LAYER_SLA_HOURS, "RED").alias("SLA_STATUS"),
        ))
    return reduce(DataFrame.unionByName, parts).orderBy("LAYER", "MODEL")


def sla_monitor(df: DataFrame, now: str, max_age_hours: int = 24, column: str = "LOAD_DATETIME") -> DataFrame:
    newest = df.agg(F.max(column).alias("LATEST_RECORD"))
    age = hours_between(F.col("LATEST_RECORD"), at(now))
    return newest.select(
        F.when(age <= max_age_hours, "WITHIN_SLA").otherwise("SLA_BREACH").alias("SLA_STATUS"), "LATEST_RECORD",
        age.alias("HOURS_SINCE_UPDATE"), F.lit(max_age_hours).alias("SLA_THRESHOLD_HOURS"),
    )


def ingestion_freshness(log: DataFrame, now: str) -> DataFrame:
    """Files and rows of the last day per source, and how late the newest load is."""
    recent = log.where(F.col("LOAD_START_TS") >= add_days(at(now), -1))
    latest = F.col("LATEST_LOAD")
    return recent.groupBy("SOURCE_SYSTEM").agg(
        F.count("*").alias("FILES_LOADED_24H"), F.sum("ROWS_LOADED").alias("ROWS_LOADED_24H"), F.max("LOAD_END_TS").alias("LATEST_LOAD"),
    ).withColumns({
        "MINUTES_SINCE_LAST_LOAD": minutes_between(latest, at(now)),
        "SLA_STATUS": bucket_at_most(hours_between(latest, at(now)), (
            (config.FRESHNESS_WARN_HOURS, "WITHIN_SLA"), (config.FRESHNESS_ERROR_HOURS, "WARNING")), "SLA_BREACH"),
    }).orderBy(F.desc("LATEST_LOAD"))


def ingestion_check(log: DataFrame, source: str, max_age_hours: int, now: str) -> DataFrame:
    newest = log.where(F.col("SOURCE_SYSTEM") == source).agg(F.max("LOAD_START_TS").alias("t"))
    age = hours_between(F.col("t"), at(now))
    return newest.select(
        F.when(age <= max_age_hours, "HEALTHY").otherwise("SLA_BREACH").alias("STATUS"),
        F.concat(F.lit("Last ingestion: "), F.coalesce(F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit("NEVER"))).alias("DETAIL"),
        at(now).alias("CHECKED_AT"),
    )


def safe_ingestion_check(spark: SparkSession, read_log: Callable[[], DataFrame], source: str, max_age_hours: int, now: str,
                         log_error: Callable[[DataFrame], None]) -> DataFrame:
    """The check, or an ERROR row and an entry in the error log when it cannot run."""
    try:
        row = ingestion_check(read_log(), source, max_age_hours, now).first()
        return spark.createDataFrame([(row["STATUS"], row["DETAIL"])], "STATUS string, DETAIL string").withColumn("CHECKED_AT", at(now))
    except Exception as error:
        message = str(error).splitlines()[0][:4000]
        log_error(error_row(spark, "SAFE_INGESTION_CHECK", type(error).__name__, message, now,
                            parameters=f'{{"source_system":"{source}","max_age_hours":{max_age_hours}}}'))
        return spark.createDataFrame([("ERROR", message)], "STATUS string, DETAIL string").withColumn("CHECKED_AT", at(now))


def error_row(spark: SparkSession, procedure: str, code: str, message: str, now: str, severity: str = "ERROR",
              state: str | None = None, trace: str | None = None, parameters: str | None = None) -> DataFrame:
    """One row for the error log."""
    values = {
        "ERROR_ID": row_id(F.lit(procedure), F.lit(code), F.lit(message), F.lit(now)), "ERROR_TIMESTAMP": at(now),
        "PROCEDURE_NAME": F.lit(procedure), "ERROR_CODE": F.lit(code), "ERROR_MESSAGE": F.lit(message), "ERROR_STATE": F.lit(state),
        "STACK_TRACE": F.lit(trace), "INPUT_PARAMETERS": F.lit(parameters), "SEVERITY": F.lit(severity),
        "RESOLUTION_STATUS": F.lit("OPEN"), "CREATED_AT": at(now),
    }
    return spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ERROR_EVENT_LOG])


def task_row(spark: SparkSession, task: str, task_type: str, status: str, started: str, completed: str | None = None,
             rows: int | None = None, model: str | None = None, run_id: str | None = None, error: str | None = None) -> DataFrame:
    """One row for the task log."""
    seconds = seconds_between(at(started), at(completed)) if completed else F.lit(None)
    values = {
        "EXECUTION_ID": row_id(F.lit(task), F.lit(run_id), F.lit(started)), "TASK_NAME": F.lit(task), "TASK_TYPE": F.lit(task_type),
        "RUN_ID": F.lit(run_id), "MODEL_NAME": F.lit(model), "STATUS": F.lit(status), "ROWS_AFFECTED": F.lit(rows),
        "EXECUTION_TIME_SEC": seconds, "ERROR_MESSAGE": F.lit(error), "STARTED_AT": at(started),
        "COMPLETED_AT": at(completed) if completed else F.lit(None),
    }
    return spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TASK_EXECUTION_LOG])


def ingestion_source_status(log: DataFrame, now: str, hours: int = 1) -> DataFrame:
    """Files, rows and newest load per ingestion route within the last hours."""
    recent = log.where(F.col("LOAD_START_TS") >= add_hours_back(now, hours))
    return recent.groupBy("PIPE_NAME").agg(
        F.count("*").alias("FILES_LOADED"), F.sum("ROWS_LOADED").alias("TOTAL_ROWS"), F.max("LOAD_END_TS").alias("LATEST_LOAD"))


def add_hours_back(now: str, hours: int) -> Column:
    return at(now) - F.make_dt_interval(F.lit(0), F.lit(hours))


def error_trend_hourly(errors: DataFrame, now: str, days: int = 7) -> DataFrame:
    """Errors of the last days per hour, procedure and severity, with their distinct codes."""
    recent = errors.where(F.col("ERROR_TIMESTAMP") >= add_days(at(now), -days))
    return recent.groupBy(hour_start(F.col("ERROR_TIMESTAMP")).alias("ERROR_HOUR"), "PROCEDURE_NAME", "SEVERITY").agg(
        F.count("*").alias("ERROR_COUNT"), F.array_join(F.sort_array(F.collect_set("ERROR_CODE")), ",").alias("ERROR_CODES"),
    ).orderBy(F.desc("ERROR_HOUR"), F.desc("ERROR_COUNT"))


# fixed values: monthly budgets and the shares of them that trigger an action
BUDGETS = {
    "ACCOUNT": (5000, ((100, "SUSPEND_IMMEDIATE"), (90, "SUSPEND"), (50, "NOTIFY"))),
    "LOADER_WH": (200, ((100, "SUSPEND_IMMEDIATE"), (90, "SUSPEND"), (70, "NOTIFY"))),
    "TRANSFORMER_WH": (1500, ((100, "SUSPEND_IMMEDIATE"), (95, "SUSPEND"), (60, "NOTIFY"))),
    "CI_WH": (100, ((100, "SUSPEND_IMMEDIATE"), (80, "NOTIFY"))),
    "DEV_WH": (200, ((100, "SUSPEND_IMMEDIATE"), (95, "SUSPEND"), (75, "NOTIFY"))),
    "ANALYTICS_WH": (2000, ((100, "SUSPEND_IMMEDIATE"), (90, "SUSPEND"), (50, "NOTIFY"))),
}


def cost_attribution(usage: DataFrame, start: str, end: str) -> DataFrame:
    """Usage per warehouse, tag and cost centre in [start, end)."""
    inside = usage.where((F.col("PERIOD_START") >= at(start)) & (F.col("PERIOD_START") < at(end)))
    return inside.groupBy("WAREHOUSE_NAME", "QUERY_TAG", "COST_CENTER").agg(
        F.sum("CREDITS_USED").alias("CREDITS_USED"), F.sum("QUERIES_EXECUTED").alias("QUERIES_EXECUTED"), F.sum("BYTES_SCANNED").alias("BYTES_SCANNED"))


def budget_status(usage: DataFrame, start: str, end: str) -> DataFrame:
    """Share of each warehouse's budget used in the period and the action it calls for."""
    spent = cost_attribution(usage, start, end).groupBy("WAREHOUSE_NAME").agg(F.sum("CREDITS_USED").alias("CREDITS_USED"))
    name = F.col("WAREHOUSE_NAME")
    budget, label = F.lit(None).cast("int"), F.lit("NONE")
    for warehouse, (quota, _) in BUDGETS.items():
        budget = F.when(name == warehouse, quota).otherwise(budget)
    share = F.col("CREDITS_USED") / F.col("BUDGET") * 100
    for warehouse, (_, steps) in BUDGETS.items():
        label = F.when(name == warehouse, bucket_at_least(F.col("PERCENT_USED"), steps, "OK")).otherwise(label)
    return spent.withColumn("BUDGET", budget).withColumn("PERCENT_USED", F.round(share, 4)).withColumn("ACTION", label)


def lag_status(history: DataFrame, alert: bool = False) -> DataFrame:
    """Seconds each refresh took, with the report's or the alert's thresholds."""
    lag = seconds_between(F.col("REFRESH_START"), F.col("REFRESH_END"))
    label = bucket_at_least(F.coalesce(lag, F.lit(0)), config.LAG_ALERT_SECONDS, "HEALTHY") if alert else bucket_at_most(lag, config.LAG_SECONDS, "CRITICAL")
    return history.select("GROUP_NAME", "REFRESH_START", "REFRESH_END", lag.alias("LAG_SECONDS"), "BYTES_TRANSFERRED", "OBJECT_COUNT", label.alias("SLA_STATUS"))


def refresh_health(state: DataFrame, now: str) -> DataFrame:
    """Newest refresh per table: running, stale after an hour, or fine."""
    age = minutes_between(F.col("LAST_REFRESH"), at(now))
    return state.select(
        "NAME", "SCHEDULING_STATE", "LAST_REFRESH", age.alias("MINUTES_SINCE_REFRESH"),
        F.when(F.col("SCHEDULING_STATE") == "RUNNING", "HEALTHY").when(age > config.STALE_MINUTES, "STALE").otherwise("OK").alias("HEALTH_STATUS"),
    )


# fixed values: the published data products
PRODUCTS = (
    ("Customer 360", "CUSTOMER", "data-platform-team", "GOLD", "SECURE_VIEW", "ANALYTICS", "SECURE_VIEWS", "DP_CUSTOMER_360",
     "Unified customer profile with demographics, order history, and lifetime value", 12),
    ("Product Performance", "PRODUCT", "data-platform-team", "GOLD", "SECURE_VIEW", "ANALYTICS", "SECURE_VIEWS", "DP_PRODUCT_PERFORMANCE",
     "Product sales metrics, margin analysis, and pricing trends", 24),
    ("Customer Feature Store", "CUSTOMER", "ml-engineering-team", "PLATINUM", "DYNAMIC_TABLE", "ANALYTICS", "SEMANTIC_VIEWS", "DYN_FEATURE_STORE_CUSTOMER",
     "ML feature store with predicted CLV and behavioral features", 1),
    ("Revenue by Segment", "FINANCIAL", "data-analytics-team", "GOLD", "DYNAMIC_TABLE", "ANALYTICS", "AGGREGATES", "DYN_AGG_REVENUE_BY_SEGMENT",
     "Real-time revenue aggregation by customer segment and loyalty tier", 1),
)


def register_products(spark: SparkSession, registry: DataFrame | None, now: str, products=PRODUCTS) -> DataFrame:
    """The registry with every listed product once; known names stay as they are."""
    columns = ("PRODUCT_NAME string, PRODUCT_DOMAIN string, PRODUCT_OWNER string, PRODUCT_TIER string, PRODUCT_TYPE string, DATABASE_NAME string, "
               "SCHEMA_NAME string, OBJECT_NAME string, DESCRIPTION string, SLA_FRESHNESS_HOURS int")
    listed = spark.createDataFrame(list(products), columns)
    given = {
        "PRODUCT_ID": row_id(F.col("PRODUCT_NAME")), "PRODUCT_VERSION": F.lit("1.0.0"), "SLA_UPTIME_PERCENT": F.lit(99.5),
        "IS_ACTIVE": F.lit(True), "PUBLISHED_AT": at(now), "CREATED_AT": at(now),
    }
    rows = listed.select(*[
        (F.col(f.name) if f.name in listed.columns else given.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in DATA_PRODUCT_REGISTRY
    ])
    if registry is None:
        return rows
    return registry.unionByName(rows.join(registry.select("PRODUCT_NAME"), "PRODUCT_NAME", "left_anti").select(*registry.columns))


def product_quality(results: DataFrame, models: DataFrame) -> DataFrame:
    """Share of passed tests, 0 to 100, per product; ``models`` maps MODEL_NAME to PRODUCT_NAME."""
    return results.join(models, "MODEL_NAME").groupBy("PRODUCT_NAME").agg(
        (F.count_if(F.col("STATUS") == "PASS") * 100.0 / F.count("*")).cast("decimal(5,2)").alias("QUALITY_SCORE"))


def product_catalog(registry: DataFrame) -> DataFrame:
    """Active products with a readable service level."""
    level = F.concat(F.lit("SLA: "), F.col("SLA_FRESHNESS_HOURS").cast("string"), F.lit("h freshness, "),
                     F.col("SLA_UPTIME_PERCENT").cast("string"), F.lit("% uptime"))
    full_name = F.concat("DATABASE_NAME", F.lit("."), "SCHEMA_NAME", F.lit("."), "OBJECT_NAME")
    return registry.where("IS_ACTIVE").select(
        "PRODUCT_NAME", "PRODUCT_DOMAIN", "PRODUCT_TIER", "PRODUCT_TYPE", full_name.alias("FULLY_QUALIFIED_NAME"), "DESCRIPTION", "PRODUCT_OWNER",
        level.alias("SLA_SUMMARY"), "QUALITY_SCORE", "PRODUCT_VERSION", "IS_ACTIVE", "PUBLISHED_AT", "LAST_REFRESHED_AT",
    ).orderBy("PRODUCT_DOMAIN", F.desc("PRODUCT_TIER"), "PRODUCT_NAME")


def audit_retention(log: DataFrame, column: str, now: str, days: int = config.LOG_RETENTION_DAYS) -> DataFrame:
    """Log rows that stay; rows without a time stay too."""
    limit = F.date_sub(F.to_date(at(now)), days).cast("timestamp_ntz")
    return log.where(F.col(column).isNull() | (F.col(column) >= limit))
