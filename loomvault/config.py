"""Fixed values shared by the whole warehouse."""

# ---- fixed values: keys and open-ended dates ------------------------------------------
HASH_BITS = 256
KEY_SEPARATOR = "||"
KEY_NULL_TOKEN = ""
DIFF_NULL_TOKEN = "^^"
GHOST_KEY = "0" * 64
GHOST_TIME = "1900-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"

# ---- fixed values: order states -------------------------------------------------------
INACTIVE_STATUSES = ("CANCELLED", "RETURNED", "REFUNDED")
UNCOUNTED_STATUSES = ("CANCELLED", "REFUNDED")
TERMINAL_STATUSES = ("DELIVERED", "CANCELLED", "RETURNED", "REFUNDED")
STAGE_BY_STATUS = {
    "DELIVERED": "COMPLETE",
    "SHIPPED": "IN_TRANSIT",
    "CONFIRMED": "PROCESSING",
    "PENDING": "AWAITING_CONFIRMATION",
    "CANCELLED": "CANCELLED",
    "RETURNED": "RETURNED",
    "REFUNDED": "REFUNDED",
}
SLA_HOURS = {"EXPRESS": 24, "STANDARD": 72}

# ---- fixed values: customer scoring ---------------------------------------------------
LTV_TIERS = ((10000, "PLATINUM"), (5000, "GOLD"), (1000, "SILVER"))
CHURN_DAYS = ((365, "HIGH"), (180, "MEDIUM"), (90, "LOW"))
NEVER_ORDERED_DAYS = 9999
FEATURE_NEVER_ORDERED_DAYS = 999
CLV_TIER_FACTOR = {"PLATINUM": 1.5, "GOLD": 1.3, "SILVER": 1.1, "BRONZE": 1.0}
FISCAL_START_MONTH = 4

# ---- fixed values: service levels -----------------------------------------------------
LAYER_SLA_HOURS = ((6, "GREEN"), (12, "YELLOW"), (24, "ORANGE"))
FRESHNESS_WARN_HOURS = 12
FRESHNESS_ERROR_HOURS = 24
LAG_SECONDS = ((300, "HEALTHY"), (3600, "WARNING"))
LAG_ALERT_SECONDS = ((7200, "CRITICAL"), (3600, "WARNING"))
STALE_MINUTES = 60
LOOKBACK_DAYS = 3
LOG_RETENTION_DAYS = 90
ARCHIVE_YEARS = 2
MIN_ROWS = {
    "hub_customer": 100,
    "hub_order": 100,
    "hub_product": 10,
    "sat_customer_details": 100,
    "sat_order_details": 100,
    "fct_orders": 100,
    "dim_customer": 100,
}

# ---- scale guards (performance only: results never depend on them) ---------------------
BROADCAST_BYTES = 64 << 20        # largest side that is ever hinted for broadcast
