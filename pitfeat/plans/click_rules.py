"""Event lists of the payment clickstream, one per job, and the roles of its events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitfeat.plans.clickstream import Clicks

# Fixed values: (category, action) pairs that each job keeps.
KEPT_EVENTS = {
    "research_web": """
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_home_page total_pay_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page go_to_transactions_cta
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        srp_card_clicked details_page
        auto_suggestion select
    """,
    "research_app": """
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_home_page total_pay_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page refer_save_cta
        transaction_success_page gift_cta
        transaction_success_page coupon_copied
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        srp_card_clicked details_page
        auto_suggestion select
    """,
    "deployed_web": """
        page landing
        poc_home_page open
        poc_home_page opened
        poc_landing_page opened
        login_screen login_screen
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_home_page total_pay_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page go_to_transactions_cta
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        srp_card_clicked details_page
        auto_suggestion select
        poc_edit_flow total_pay_clicked
        final_screen total_pay_clicked
        pay_new_flow total_pay_clicked
    """,
    "deployed_app": """
        app_open app_opened
        poc_landing_page open
        poc_home_page open
        poc_home_page opened
        login login_completed
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_home_page total_pay_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page refer_save_cta
        transaction_success_page gift_cta
        transaction_success_page coupon_copied
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        details_page open
        search search
        poc_edit_flow total_pay_clicked
        final_screen total_pay_clicked
        pay_new_flow total_pay_clicked
        log_out clicked
    """,
    "live_web": """
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_home_page total_pay_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page go_to_transactions_cta
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        srp_card_clicked details_page
        auto_suggestion select
        poc_edit_flow total_pay_clicked
        final_screen total_pay_clicked
        pay_new_flow total_pay_clicked
    """,
    "live_app": """
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_home_page total_pay_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page refer_save_cta
        transaction_success_page gift_cta
        transaction_success_page coupon_copied
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        details_page open
        search search
        poc_edit_flow total_pay_clicked
        final_screen total_pay_clicked
        pay_new_flow total_pay_clicked
    """,
    "sessions_web": """
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page go_to_transactions_cta
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        srp_card_clicked details_page
        auto_suggestion select
    """,
    "sessions_app": """
        poc_flow pay_cta_clicked
        poc_home_page pay_again_clicked
        poc_flow pay_cta_click
        poc_landing_page see_all_offers_clicked
        poc_home_page offer_clicked
        poc_home_page refer_now_clicked
        poc_home_page refer_and_earn_clicked
        poc_landing_page cta_clicked
        poc_home_page edit_clicked
        transaction_success_page payment_success
        transaction_success_page go_to_home_cta
        transaction_success_page refer_save_cta
        transaction_success_page gift_cta
        transaction_success_page coupon_copied
        conversion open_crf
        conversion filled_crf
        conversion submitted_crf
        srp_card_clicked details_page
        auto_suggestion select
    """,
}

# Categories of a payment session, and actions that mark its steps.
ANCHOR_CATEGORIES = ["poc_flow", "poc_home_page", "poc_landing_page", "transaction_success_page"]
INTENT_ACTIONS = ["pay_cta_clicked", "pay_again_clicked", "pay_cta_click", "total_pay_clicked"]
SUCCESS_ACTION = "payment_success"
LOGIN_CATEGORIES, LOGIN_ACTIONS = ["login_screen", "login"], ["login_screen", "login_completed"]
OFFER_ACTIONS = [
    "refer_and_earn_clicked", "refer_now_clicked", "offer_clicked", "see_all_offers_clicked",
]
HOME_CATEGORIES, HOME_ACTIONS = ["page", "app_open"], ["landing", "app_opened"]


def kept_pairs(job: str) -> list[tuple[str, str]]:
    """Pairs that a job keeps."""
    lines = KEPT_EVENTS[job].split("\n")
    return [tuple(line.split()) for line in lines if line.strip()]


def all_rules(spark: SparkSession) -> DataFrame:
    """One rules table for all jobs: job, category, action."""
    rows = [(job, *pair) for job in KEPT_EVENTS for pair in kept_pairs(job)]
    return spark.createDataFrame(rows, "job string, category string, action string")


def rules_table(spark: SparkSession, job: str) -> DataFrame:
    return spark.createDataFrame(kept_pairs(job), "category string, action string")


def is_anchor() -> Column:
    return F.col("category").isin(ANCHOR_CATEGORIES)


def is_intent() -> Column:
    return F.col("action").isin(INTENT_ACTIONS)


def payment_clicks(spark: SparkSession, job: str, visitor: str = "ga_id", time: str = "timestamp"):
    """Roles of the payment clickstream for one job."""
    category, action = F.col("category"), F.col("action")
    flags = {
        "already_logged_in": category.isin(LOGIN_CATEGORIES) & action.isin(LOGIN_ACTIONS),
        "checked_offers": action.isin(OFFER_ACTIONS),
        "reached_homepage_first": category.isin(HOME_CATEGORIES) & action.isin(HOME_ACTIONS),
    }
    return Clicks(
        visitor=visitor, time=time, tie=["category", "action"], anchor=is_anchor(),
        intent=is_intent(), success=action == SUCCESS_ACTION, flags=flags,
        rules=rules_table(spark, job), rule_columns=["category", "action"],
    )
