"""Registered queries with their SQL oracles."""

from hitlens.catalog import (  # noqa: F401
    generic_queries,
    insight_queries,
    reports,
    rollup_queries,
    rows,
    source_queries,
    variant_queries,
)
from hitlens.catalog.base import ORACLES, QUERIES, parts, table
from hitlens.catalog.generic_queries import flagship  # noqa: F401
from hitlens.session import tune


def queries():
    """The registered queries; a session is tuned when one of them is called, not by building its plan."""

    def tuned(build):
        return lambda spark, sf_dir: build(tune(spark, parts(table(spark, sf_dir, "events"))), sf_dir)

    return {name: tuned(build) for name, build in QUERIES.items()}


def oracles():
    return dict(ORACLES)
