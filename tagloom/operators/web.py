"""Web and app analytics sessions to per-client facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import codes as C
from tagloom.functions.columns import any_of, base24_to_long, contains_any, zero_if_null
from tagloom.operators.facts import with_calendar


def _tenant_hit(sessions: DataFrame, hall_id, domain_id) -> Column:
    """Both tenant dimensions on the same ``hit``."""
    dimension = sessions.schema["hits"].dataType.elementType["customDimensions"].dataType.elementType

    def carried(index: int, value) -> Column:
        wanted = F.struct(F.lit(index).alias("index"), F.lit(str(value)).alias("value")).cast(dimension)
        return F.array_contains("hit.customDimensions", wanted)

    return F.coalesce(
        carried(C.HALL_DIMENSION, hall_id) & carried(C.DOMAIN_DIMENSION, domain_id), F.lit(False))


def _known_client() -> Column:
    return (F.length("clientId") < 10) & (F.col("clientId") != "undefined")


def _session_date() -> Column:
    return F.to_date("date", "yyyyMMdd")


def ga_data_set(sessions: DataFrame, hall_id, domain_id) -> DataFrame:
    """Page views, sessions, bounces, time and four click counts per client and day.

    The totals cover all of the day's sessions of a client that hit the tenant
    that day, the clicks only tenant hits. One pass over the hits feeds both: a
    session's totals are taken with its first hit (or none).
    """
    hits = (
        sessions.filter(_known_client())
        .select("clientId", "date", "visitNumber", "totals", F.posexplode_outer("hits").alias("place", "hit"))
        .withColumn("tenant", _tenant_hit(sessions, hall_id, domain_id))
    )

    def clicks(name, category, label, action=None, kind=None):
        info = F.col("hit.eventInfo")
        test = F.col("tenant") & (info["eventCategory"] == category) & (info["eventLabel"] == label)
        if action:
            test = test & (info["eventAction"] == action)
        if kind:
            test = test & (F.col("hit.type") == kind)
        return F.count_if(test).alias(name)

    first = F.coalesce(F.col("place") == 0, F.lit(True))
    total = lambda name, value: F.sum(F.when(first, value)).alias(name)
    per_day = hits.groupBy("clientId", "date").agg(
        F.bool_or("tenant").alias("seen"),
        clicks("product_clicks", "enhanced_ecommerce", "productClick", "click", "EVENT"),
        clicks("promotion_clicks", "enhanced_ecommerce", "promotionClick", "click", "EVENT"),
        clicks("service_contact", "online_service", "online_service_contact"),
        clicks("service_contact_mobile", "online_service", "online_service_contact_mobile"),
        total("page_views", F.col("totals.pageviews")),
        F.count_if(first & F.col("visitNumber").isNotNull()).alias("total_sessions"),
        total("total_bounces", F.col("totals.bounces")),
        total("time_on_site", F.col("totals.timeOnSite")),
    )
    return per_day.filter("seen").select(
        F.col("clientId").alias("user_id"), _session_date().alias("data_date"), "product_clicks", "promotion_clicks",
        "service_contact", "service_contact_mobile",
        *[zero_if_null(c) for c in ("page_views", "total_sessions", "total_bounces", "time_on_site")])


def _listed_path(path: Column) -> Column:
    return any_of([
        path.isin(C.PATHS),
        contains_any(F.lower(path), C.PATH_WORDS_ANY_CASE),
        contains_any(path, C.PATH_WORDS),
        path.startswith(C.PATH_PREFIX),
    ])


def ga_page_path(sessions: DataFrame, hall_id, domain_id) -> DataFrame:
    """Tenant hits on the listed paths, counted per client, page and day."""
    hits = sessions.filter(_known_client()).select("clientId", "date", F.explode_outer("hits").alias("hit"))
    page = F.col("hit.page")
    return (
        hits.filter(_tenant_hit(sessions, hall_id, domain_id) & page["pagePath"].isNotNull()
                    & _listed_path(page["pagePath"]))
        .groupBy("clientId", page["hostname"].alias("host"), page["pagePath"].alias("path"),
                 page["pageTitle"].alias("title"), "date")
        .agg(F.count(F.lit(1)).alias("hits_count"))
        .select(
            F.col("clientId").alias("user_id"), F.substring("host", 1, 50).alias("hostname"),
            F.substring("path", 1, 300).alias("page_path"), F.substring("title", 1, 150).alias("page_title"),
            "hits_count", _session_date().alias("data_date"))
    )


def ga_firebase_page(events: DataFrame) -> DataFrame:
    """Distinct app screens per numeric user and day."""
    user = F.expr("try_cast(user_id AS BIGINT)")
    return (
        events.filter(user.isNotNull())
        .select(user.alias("user_id"), F.explode("event_params").alias("param"), "event_date")
        .filter(F.col("param.key") == "firebase_screen_class")
        .select("user_id", F.substring("param.value.string_value", 1, 150).alias("page_title"),
                F.to_date("event_date", "yyyyMMdd").alias("data_date"))
        .distinct()
    )


def ga_user_id_decode(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Client id text to the member id; undecodable ids are dropped."""
    decoded = df.withColumn("user_id", base24_to_long(F.col("user_id"))).filter(F.col("user_id") != 0)
    return with_calendar(decoded, calendar)
