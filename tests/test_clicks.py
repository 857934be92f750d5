from pyspark.sql import functions as F

from pitfeat.plans import click_rules as rules
from pitfeat.plans import clickstream as plan
from pitfeat.sources import clicks as src


def test_rules():
    sizes = {job: len(rules.kept_pairs(job)) for job in rules.KEPT_EVENTS}
    assert sizes == {
        "research_web": 18, "research_app": 20, "deployed_web": 26, "deployed_app": 29,
        # the live lists name one pair twice each: 22 and 24 lines
        "live_web": 21, "live_app": 23, "sessions_web": 17, "sessions_app": 19,
    }
    for job in sizes:
        assert len(set(rules.kept_pairs(job))) == sizes[job]


def test_one_rules_table(spark):
    found = rules.all_rules(spark)
    assert {r.job: r["count"] for r in found.groupBy("job").count().collect()} == {
        job: len(rules.kept_pairs(job)) for job in rules.KEPT_EVENTS}
    one = found.where("job = 'live_app'").drop("job")
    assert one.exceptAll(rules.rules_table(spark, "live_app")).count() == 0


def test_payment_sessions(spark):
    web = spark.createDataFrame(
        [
            ('{"dimension49":"v1"}', "page", "landing", 0, None),
            ('{"dimension49":"v1"}', "poc_flow", "pay_cta_clicked", 60, '{"orderId":"7"}'),
            ('{"dimension49":"v1"}', "other", "scroll", 70, None),
            ('{"dimension49":"v1"}', "transaction_success_page", "payment_success", 90, None),
            ('{"dimension49":"v2"}', "page", "landing", 0, None),
            ('{"dimension49":"v1"}', "poc_home_page", "offer_clicked", 90_000, None),
        ],
        "customDimensions string, category string, action string, s long, event_label string",
    ).select("*", F.timestamp_seconds("s").alias("timestamp"), F.lit(None).cast("date").alias("date"),
             F.lit("x").alias("traffic_sourcemedium"))
    app = spark.createDataFrame(
        [], "uid string, category string, action string, timestamp timestamp, date date, "
        "sourcemedium string, order_id long",
    )
    both = src.all_clicks(web, app)
    assert both.columns == [*src.COLUMNS, "source"]
    c = rules.payment_clicks(spark, "deployed_web")
    got = plan.click_features(both, c).orderBy("timestamp").collect()
    # v2 never reached a payment page; the scroll counts as a hit but is not kept
    assert [r.action for r in got] == [
        "landing", "pay_cta_clicked", "payment_success", "offer_clicked",
    ]
    pay = got[1]
    assert (pay.number_of_hits, pay.hit_number, pay.order_id) == (4, 2, "7")
    assert (pay.seconds_after_transaction, pay.seconds_on_payment_gateway) == (30, 30)
    assert (pay.reached_homepage_first, pay.checked_offers, pay.already_logged_in) == (1, 0, 0)
    assert (got[3].number_of_sessions, got[3].mean_session_time) == (1, 90.0)
    assert (got[3].number_of_non_anchor_actions, got[3].number_of_non_anchor_sessions) == (1, 1)
    latest = plan.latest_features(both, c).collect()
    assert [(r.ga_id, r.action) for r in latest] == [("v1", "offer_clicked")]


def test_nested_hits(spark):
    schema = (
        "`hits-customDimensions` array<struct<index:int,value:string>>, fullVisitorId string, "
        "visitId string, date date, `hits-eventInfo` struct<eventCategory:string,eventAction:string>, "
        "visitStartTime long, device struct<mobileDeviceBranding:string,mobileDeviceMarketingName:string>, "
        "geoNetwork struct<city:string,region:string,latitude:string,longitude:string>, "
        "totals struct<hits:int,screenviews:int,pageviews:int,timeOnSite:int,uniqueScreenviews:int,bounces:int,"
        "timeOnScreen:int>, trafficSource struct<source:string,medium:string,campaign:string>, "
        "`hits-referer` string, `hits-hitNumber` int"
    )

    def hit(visitor, session, start, brand, hits, views, number):
        return ([(1, visitor)], "f", session, None, ("c", "a"), start, (brand, "name"), ("x", "r", "1.5", "2.5"),
                (hits, views, views, 10 * views, views, 0, 5), ("s", "m", "spring"), "/from", number)

    d = spark.createDataFrame(
        [hit("v", "1", 10, "p", 4, 2, 1), hit("v", "1", 20, "q", 0, 3, 2), hit("v", "2", 30, "p", 5, 1, 5)],
        schema,
    )
    hits = src.session_hits(d, 1)
    twice = d.unionByName(d.withColumn("hits-hitNumber", F.lit(9)))
    kept = src.distinct_hits(src.session_hits(twice, 1))
    assert sorted(r.hit_number for r in kept.collect()) == [1, 2, 5]
    one = hits.orderBy("time_stamp").first()
    assert (one.marketing_name, one.region, one.lat, one.long, one.bounces, one.unique_screen_views) == (
        "name", "r", "1.5", "2.5", 0, 2)
    assert (one.traffic_source, one.traffic_campaign, one.hits_referer, one.time_on_screen) == ("s", "spring", "/from", 5)
    got = plan.hit_history(hits, ["ga_id"], "time_stamp")
    got = got.orderBy("time_stamp").collect()
    assert [r.number_of_sessions for r in got] == [0, 1, 1]
    assert [r.number_of_page_views for r in got] == [None, 2, 5]
    assert [r.number_of_devices_used for r in got] == [0, 1, 2]
    assert [r.hit_occurence_wrt_total_hits for r in got] == [0.25, None, 1.0]
    assert got[2].mean_session_time == 25.0 and got[2].median_number_of_sessions == 0.5
    assert got[0].session_id == "f-1" and got[0].traffic_source_medium == "s-m"
