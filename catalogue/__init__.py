"""Every registered query: a binding of the operators to the fixture tables, and its SQL."""

from catalogue import clicks, evaluation, joins, labels, models, profiles, storage, transactions

MODULES = (clicks, transactions, joins, labels, profiles, evaluation, models, storage)


def queries():
    return {name: run for m in MODULES for name, (run, _) in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
