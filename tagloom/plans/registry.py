"""Named queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.plans.oracle import with_views
from tagloom.session import configure
from tagloom.sources.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a function of :class:`Views` as a query; ``views`` names the views its SQL builds on."""

    def register(function: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Views(configure(spark), folder))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return function

    return register
