"""Fixture tables with the roles they play."""

from pyspark.sql import functions as F

from pitfeat.sources.tables import read_table


def table(spark, sf_dir, name):
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def us(*names):
    """Times as microseconds, which both engines print alike."""
    return [F.unix_micros(n).alias(f"{n}_us") for n in names]


def rounded(places, *names):
    return [F.round(F.col(n).cast("double"), places).alias(n) for n in names]


def parity():
    return F.get_json_object("props", "$.k").cast("int") % 2


def source():
    """Platform of an event: even numbers stand for web, odd ones for app."""
    return F.when(parity() == 0, "web").otherwise("app")
