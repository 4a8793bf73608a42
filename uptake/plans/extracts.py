"""The stored extracts that the KPIs read.

A daily run extracts from the facts once and stores the small results; every KPI table is then
built from what is stored. The registered KPI queries share one such run per application and
data folder, written to the folder all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from uptake.operators.tur import tur_formulation
from uptake.plans import lens
from uptake.sources.files import scratch_path

MONTH = ("strmonth",)

_runs: dict[tuple[str, str], Extracts] = {}


class Extracts:
    """Tables of one run. Each is computed and written when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def _table(
        self, name: str, build: Callable[[], DataFrame], partitions: tuple[str, ...] = MONTH
    ) -> DataFrame:
        """Partitioned by month, which the KPIs select, and sorted by extract date within it.

        All months of the lens are written at once, so a folder per extract date as well would
        be hundreds of tiny files. Rows are brought together by month with a rebalance, which
        puts several small months into one task and splits a large one over many.
        """
        if name not in self._stored:
            rows = build()
            path = scratch_path(self._spark, name)
            dealt = rows.hint("rebalance", *partitions) if partitions else rows
            if "extract_date" in rows.columns:
                dealt = dealt.sortWithinPartitions(*partitions, "extract_date")
            dealt.write.partitionBy(*partitions).parquet(path)
            table = self._spark.read.schema(rows.schema).parquet(path)
            self._stored[name] = table.select(*rows.columns)
        return self._stored[name]

    # The facts are joined once; all extracts follow from one row per subscriber, offer and day.

    @property
    def _facts(self) -> DataFrame:
        return self._table("facts", lambda: lens.daily_facts(self._spark, self._sf_dir), ())

    @property
    def _target_days(self) -> DataFrame:
        return self._table("target_days", lambda: lens.target_days(self._facts), ())

    @property
    def _taker_days(self) -> DataFrame:
        return self._table("taker_days", lambda: lens.taker_days(self._facts), ())

    @property
    def _subscribers(self) -> DataFrame:
        return lens.subscribers(self._spark, self._sf_dir)

    @property
    def summary(self) -> DataFrame:
        return self._table("summary", lambda: lens.campaign_snapshots(self._spark, self._sf_dir))

    @property
    def wl_offer(self) -> DataFrame:
        return self._table("wl_offer", lambda: lens.wl_offer_snapshots(self._target_days))

    @property
    def taker_offer(self) -> DataFrame:
        return self._table("taker_offer", lambda: lens.taker_offer_snapshots(self._taker_days))

    @property
    def wl_border(self) -> DataFrame:
        return self._table(
            "wl_border", lambda: lens.wl_border_snapshots(self._target_days, self._subscribers)
        )

    @property
    def taker_border(self) -> DataFrame:
        return self._table(
            "taker_border", lambda: lens.taker_border_snapshots(self._taker_days, self._subscribers)
        )

    @property
    def tur(self) -> DataFrame:
        return self._table(
            "tur_formulation",
            lambda: tur_formulation(self.summary, self.wl_offer, self.taker_offer),
        )

    def store_all(self) -> None:
        for table in ("summary", "wl_offer", "taker_offer", "wl_border", "taker_border", "tur"):
            getattr(self, table)


def extracts(spark: SparkSession, sf_dir: str) -> Extracts:
    """The run of this application on this folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        _runs[key] = Extracts(spark, sf_dir)
    return _runs[key]
