"""Row filters in front of the aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_views(behaviour: DataFrame) -> DataFrame:
    return behaviour.filter(F.col("behavior") == "pv")


def get_requests(access: DataFrame) -> DataFrame:
    return access.filter(F.col("method") == "GET")
