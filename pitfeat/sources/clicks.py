"""Click sources brought to one shape: visitor, category, action, time, source, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.functions.columns import dimension_value
from pitfeat.operators.joins import union_sources
from pitfeat.operators.reduce import dedup_ignoring

COLUMNS = ["ga_id", "category", "action", "timestamp", "date", "traffic_sourcemedium", "order_id"]


def web_clicks(df: DataFrame, dimension: int = 49) -> DataFrame:
    """Web clicks keep the visitor and the order inside JSON text."""
    return df.select(
        F.get_json_object("customDimensions", f"$.dimension{dimension}").alias("ga_id"),
        "category", "action", "timestamp", "date", "traffic_sourcemedium",
        F.get_json_object("event_label", "$.orderId").alias("order_id"),
    )


def app_clicks(df: DataFrame) -> DataFrame:
    """App clicks are flat."""
    return df.select(
        F.col("uid").alias("ga_id"), "category", "action", "timestamp", "date",
        F.col("sourcemedium").alias("traffic_sourcemedium"),
        F.col("order_id").cast("string").alias("order_id"),
    )


def all_clicks(web: DataFrame, app: DataFrame) -> DataFrame:
    return union_sources({"app": app_clicks(app), "web": web_clicks(web)})


def session_hits(df: DataFrame, dimension: int) -> DataFrame:
    """Hits of nested analytics sessions, one flat row each."""
    start = F.timestamp_seconds("visitStartTime")
    return df.select(
        dimension_value(F.col("`hits-customDimensions`"), dimension).alias("ga_id"),
        F.concat_ws("-", "fullVisitorId", "visitId").alias("session_id"),
        "date",
        F.col("`hits-eventInfo`.eventCategory").alias("category"),
        F.col("`hits-eventInfo`.eventAction").alias("action"),
        start.alias("time_stamp"),
        start.alias("session_start"),
        F.col("device.mobileDeviceMarketingName").alias("marketing_name"),
        F.col("device.mobileDeviceBranding").alias("brand"),
        F.col("geoNetwork.region").alias("region"),
        F.col("geoNetwork.city").alias("city"),
        F.col("geoNetwork.latitude").alias("lat"),
        F.col("geoNetwork.longitude").alias("long"),
        F.col("totals.hits").alias("no_hits"),
        F.col("totals.screenviews").alias("screen_views"),
        F.col("totals.uniqueScreenviews").alias("unique_screen_views"),
        F.col("totals.pageviews").alias("page_views"),
        F.col("totals.bounces").alias("bounces"),
        F.col("totals.timeOnScreen").alias("time_on_screen"),
        F.col("totals.timeOnSite").alias("time_on_site"),
        F.col("trafficSource.source").alias("traffic_source"),
        F.col("trafficSource.campaign").alias("traffic_campaign"),
        F.concat_ws("-", "trafficSource.source", "trafficSource.medium").alias(
            "traffic_source_medium"
        ),
        F.col("`hits-referer`").alias("hits_referer"),
        F.col("`hits-hitNumber`").alias("hit_number"),
    )


def distinct_hits(hits: DataFrame) -> DataFrame:
    """One hit of those that differ in their number or session only: the first by number, then session."""
    return dedup_ignoring(
        hits, ["hit_number", "session_id", "session_start"], ["hit_number", "session_id", "session_start"])
