"""Registered queries over the shared tables, each with equivalent SQL where SQL can say it."""

from farelens.plans import (
    closed_form, deliveries, evaluation, features, insights, models, profile, quality, reports, sampling, sources,
    stability)

MODULES = (sources, quality, features, reports, profile, insights, sampling, evaluation, stability,
           models, closed_form, deliveries)


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
