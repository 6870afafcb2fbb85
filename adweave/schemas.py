"""Column registries, payload schemas and table layouts.

Everything here is plain data: the names are the contract between landed
payloads, the wide extract and the warehouse tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- metrics (fixed values) -------------------------------------------------
# Requested per (ad, day) and per ad lifetime.
STATS_METRICS = [
    "impressions", "swipes", "swipe_up_percent", "view_time_millis", "screen_time_millis",
    "quartile_1", "quartile_2", "quartile_3", "view_completion", "spend", "video_views",
    "shares", "saves", "frequency", "total_installs", "uniques",
]
# Ratios are stored as 32-bit floats, every other metric as bigint.
RATIO_METRICS = ["swipe_up_percent", "frequency"]
COUNT_METRICS = [m for m in STATS_METRICS if m not in RATIO_METRICS]
# The trial lifetime load knows 12 metrics.
TRIAL_METRICS = [
    "impressions", "swipes", "quartile_1", "quartile_2", "quartile_3", "view_completion",
    "spend", "view_time_millis", "video_views", "screen_time_millis", "shares", "saves",
]
# Summed into MONTH rows. frequency and uniques are not additive over days; the
# sums are kept because reports are built on them.
ROLLUP_METRICS = [
    "impressions", "swipes", "quartile_1", "quartile_2", "quartile_3", "view_completion",
    "spend", "video_views", "shares", "saves", "frequency", "uniques",
]
# A row with all three at zero carries no activity.
GATE_METRICS = ["impressions", "spend", "video_views"]
CONVERSION_METRICS = [
    "conversion_sign_ups", "conversion_searches", "conversion_level_completes",
    "conversion_app_opens", "conversion_page_views", "conversion_purchases", "conversion_save",
    "conversion_start_checkout", "conversion_add_cart", "conversion_view_content",
    "conversion_add_billing",
]
GEO_DIMENSIONS = ["country", "region", "dma"]
GEO_METRICS = [
    "impressions", "impression_composition", "uniques", "unique_composition", "spend", "swipes",
]
GEO_RATIOS = ["geo_impression_composition", "geo_unique_composition"]
GEO_COUNTS = ["geo_impressions", "geo_swipes", "geo_uniques", "geo_spend"]

DAY, MONTH, LIFETIME = "DAY", "MONTH", "LIFETIME"

# --- entities ---------------------------------------------------------------
# Payload keys of each entity, in payload spelling.
CAMPAIGN_FIELDS = [
    "id", "name", "ad_account_id", "status", "objective", "buy_model", "created_at", "updated_at",
    "start_time", "end_time", "daily_budget_micro", "lifetime_spend_cap_micro",
]
SQUAD_FIELDS = [
    "id", "campaign_id", "name", "status", "type", "created_at", "updated_at", "start_time",
    "end_time", "daily_budget_micro", "lifetime_budget_micro", "bid_micro", "auto_bid",
    "target_bid", "targeting_reach_status", "placement", "billing_event", "optimization_goal",
    "delivery_constraint", "pacing_type", "impression_goal", "reach_goal",
    "reach_and_frequency_status", "reach_and_frequency_rate_micro",
    "reach_and_frequency_debug_message", "reserved_status", "reserved_rate_micro",
    "reserved_debug_message",
]
AD_FIELDS = [
    "id", "ad_squad_id", "name", "creative_id", "status", "type", "render_type", "review_status",
    "created_at", "updated_at", "container_chain_ids", "unlockable_id", "review_status_reasons",
]
# Payload keys that get the entity's prefix; the rest keep their spelling.
PREFIXED = {
    "campaign": ["id", "updated_at", "name", "start_time", "end_time", "status",
                 "daily_budget_micro", "created_at"],
    "ad_squad": ["id", "updated_at", "name", "start_time", "end_time", "type", "status",
                 "daily_budget_micro", "created_at"],
    "ad": ["id", "updated_at", "name", "type", "status", "created_at"],
}
ENTITY_FIELDS = {"campaign": CAMPAIGN_FIELDS, "ad_squad": SQUAD_FIELDS, "ad": AD_FIELDS}
# Outer array and inner object of each payload.
ENTITY_WRAPPERS = {
    "campaign": ("campaigns", "campaign"),
    "ad_squad": ("adsquads", "adsquad"),
    "ad": ("ads", "ad"),
}
# Entity dates (payload spelling): cut to the day.
ENTITY_DATES = ["created_at", "updated_at", "start_time", "end_time"]


def entity_renames(entity: str) -> dict[str, str]:
    return {c: f"{entity}_{c}" for c in PREFIXED[entity]}


def entity_columns(entity: str) -> list[str]:
    """Columns of an entity after the prefix rename."""
    names = entity_renames(entity)
    return [names.get(c, c) for c in ENTITY_FIELDS[entity]]


# The wide extract: one CSV column each, alphabetical like the files it replaces.
WIDE_DAY_COLUMNS = sorted(
    set(entity_columns("campaign")) | set(entity_columns("ad_squad")) | set(entity_columns("ad"))
    | {"timezone", "adstats_date"} | set(STATS_METRICS)
)
WIDE_LIFETIME_COLUMNS = [c for c in WIDE_DAY_COLUMNS if c not in ("timezone", "adstats_date")]
WIDE_GEO_COLUMNS = sorted(
    set(WIDE_LIFETIME_COLUMNS) | set(GEO_DIMENSIONS) | {f"geo_{m}" for m in GEO_METRICS}
    | set(CONVERSION_METRICS)
)


# Columns of the extract that can hold any text; the others are numbers, dates and flags.
TEXT_COLUMNS = sorted(
    set(entity_columns("campaign")) | set(entity_columns("ad_squad")) | set(entity_columns("ad"))
    | {"timezone", *GEO_DIMENSIONS})


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# --- landed payloads --------------------------------------------------------
LANDING = "account_id string, ad_id string, window_start date, status int, body string"


def entity_body(entity: str) -> str:
    outer, inner = ENTITY_WRAPPERS[entity]
    fields = ", ".join(f"{c}: string" for c in ENTITY_FIELDS[entity])
    return f"{outer} array<struct<{inner}: struct<{fields}>>>"


def _bag(metrics: list[str]) -> str:
    """Values by metric. A VARIANT tells a null that was sent from a key that was not."""
    return f"struct<{', '.join(f'{m}: variant' for m in metrics)}>"


def day_body(metrics: list[str]) -> str:
    return ("timeseries_stats array<struct<timeseries_stat: struct<timeseries: "
            f"array<struct<start_time: string, stats: {_bag(metrics)}>>>>>")


def lifetime_body(metrics: list[str]) -> str:
    return f"lifetime_stats array<struct<lifetime_stat: struct<stats: {_bag(metrics)}>>>"


GEO_BODY = ("lifetime_stats array<struct<lifetime_stat: struct<dimension_stats: "
            f"array<{_bag(GEO_DIMENSIONS + GEO_METRICS)}>>>>")

# --- warehouse tables -------------------------------------------------------
AD_ACCOUNT = ("ad_account_id string, ad_account_name string, ad_account_client string, "
              "ad_account_brand string, ad_account_timezone string, "
              "ad_account_include_ind string, created_on date, updated_on date")
CAMPAIGN = ("campaign_id string, campaign_name string, ad_account_id string, "
            "campaign_status string, objective string, buy_model string, "
            "campaign_created_at date, campaign_updated_at date, campaign_start_time date, "
            "campaign_end_time date, lifetime_spend_cap_micro bigint, "
            "campaign_daily_budget_micro bigint, created_on date, updated_on date")
AD_SQUAD = ("ad_squad_id string, campaign_id string, ad_squad_name string, "
            "ad_squad_status string, ad_squad_type string, targeting_reach_status string, "
            "placement string, billing_event string, optimization_goal string, "
            "delivery_constraint string, pacing_type string, auto_bid string, "
            "target_bid string, reach_and_frequency_status string, "
            "reach_and_frequency_debug_message string, reserved_status string, "
            "reserved_debug_message string, ad_squad_created_at date, "
            "ad_squad_updated_at date, ad_squad_start_time date, ad_squad_end_time date, "
            "bid_micro bigint, ad_squad_daily_budget_micro bigint, "
            "lifetime_budget_micro bigint, impression_goal bigint, reach_goal bigint, "
            "reach_and_frequency_rate_micro bigint, reserved_rate_micro bigint, "
            "created_on date, updated_on date")
AD = ("ad_id string, ad_squad_id string, ad_name string, creative_id string, ad_status string, "
      "ad_type string, render_type string, review_status string, ad_created_at date, "
      "ad_updated_at date, created_on date, updated_on date")
AD_STATS = ("ad_id_date_granul string, ad_id string, stats_date date, "
            + ", ".join(f"{m} {'float' if m in RATIO_METRICS else 'bigint'}"
                        for m in STATS_METRICS)
            + ", granularity string, stats_month string")
AD_GEO = ("ad_id_dma_granul_date string, ad_id string, dma string, country string, "
          "region string, geo_date date, geo_impressions bigint, geo_swipes bigint, "
          "geo_uniques bigint, geo_spend bigint, geo_impression_composition double, "
          "geo_unique_composition double, granularity string")

TABLES = {
    "ad_account": AD_ACCOUNT, "campaign": CAMPAIGN, "ad_squad": AD_SQUAD, "ad": AD,
    "ad_stats": AD_STATS, "ad_geo": AD_GEO,
}
# Facts are laid out so that a load touches only the months it restates.
# LIFETIME rows keep one constant month, so a moving stats_date never moves a row.
PARTITIONS = {"ad_stats": ["granularity", "stats_month"], "ad_geo": ["granularity"]}
FILE_ORDER = {"ad_stats": ["ad_id", "stats_date"], "ad_geo": ["ad_id", "dma"]}
NO_MONTH = "all"


_TYPES = {"string": T.StringType(), "date": T.DateType(), "bigint": T.LongType(),
          "float": T.FloatType(), "double": T.DoubleType()}


def table_schema(table: str) -> T.StructType:
    """Spark schema of a table (buildable without a session)."""
    pairs = [f.split() for f in TABLES[table].split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def columns_of(table: str) -> list[str]:
    return table_schema(table).names


# Dimension columns a DAY load knows for a new ad squad (the full load knows all).
DAY_SQUAD_COLUMNS = [
    "ad_squad_id", "ad_squad_updated_at", "ad_squad_created_at", "ad_squad_name",
    "ad_squad_status", "ad_squad_type", "campaign_id", "targeting_reach_status", "placement",
    "billing_event", "bid_micro", "auto_bid", "target_bid", "ad_squad_start_time",
    "ad_squad_end_time", "optimization_goal", "delivery_constraint", "pacing_type",
    "lifetime_budget_micro",
]
FLAG_COLUMNS = ["auto_bid", "target_bid"]
