"""Point-in-time feature table of transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.operators import history as h
from pitfeat.operators.slices import run_placed


@dataclass(frozen=True)
class Transactions:
    """Column roles of a transaction table; ``account`` and ``location`` may be absent."""

    entity: str
    time: str
    id: str
    amount: str
    success: Column
    failure: Column
    account: str | None = None
    location: str | None = None


def transaction_history(df: DataFrame, c: Transactions) -> DataFrame:
    """Add every history feature of the entity as of each transaction.

    Nothing is joined to itself. `run_placed` lets all of it share one shuffle.
    """
    by, t = [c.entity], c.time
    aggs = {
        "total_number_of_transactions": h.count(),
        "number_of_failed_transactions": h.count(c.failure),
        "total_transaction_amount": h.total(c.amount),
        "mean_amount": h.mean(c.amount),
        "median_amount": h.median(c.amount),
    }
    if c.account:
        aggs["number_of_banks"] = h.distinct(c.account)
    if c.location:
        aggs["number_of_different_locations"] = h.distinct(c.location)
    d = h.prior_agg(df, by, t, aggs)
    d = h.gap_seconds(d, by, t, [c.id], "seconds_since_last_transaction")
    d = h.prior_agg(
        d, by, t,
        {
            "average_number_of_transactions": h.mean("total_number_of_transactions"),
            "average_seconds_between_two_transactions": h.mean(
                "seconds_since_last_transaction"
            ),
        },
    )
    d = h.last_n(d, by, t, [c.id], 3, [c.amount], "_recent")
    d = h.recent_stats(d, c.amount, "last_3", "_recent").drop("_recent")
    return h.user_flag(d, by, t, c.success)


def transaction_features(df: DataFrame, c: Transactions, utc_offset=(5, 30)) -> DataFrame:
    """History, then rows up to the first success, with local time and hours."""
    def chain(d):
        d = transaction_history(d, c)
        return h.until_first(d, [c.entity], c.time, c.success, cutoff="cutoff_time")

    d = run_placed(df, [c.entity], c.time, chain)
    local = F.col(c.time) + F.make_dt_interval(
        hours=F.lit(utc_offset[0]), mins=F.lit(utc_offset[1])
    )
    return d.withColumns(
        {
            "local_time": local,
            "time_hour_utc": F.hour(c.time),
            "time_hour_local": F.hour(local),
        }
    )
