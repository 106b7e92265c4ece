"""The queries by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import Views
from replaystats.session import pin_session, staging_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Views(pin_session(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


def scratch(v: Views, name: str) -> str:
    return f"{staging_root(v.spark)}/{name}-{uuid.uuid4().hex}"
