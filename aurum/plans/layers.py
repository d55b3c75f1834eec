"""The medallion layers of one run, built once and shared.

Queries that read several layers (the gate reads silver, gold and both
dimensions; the roll-up reads every quarantine) take them from one
``Layers`` object.  With ``materialize=True`` silver and gold are cut from
their lineage by a reliable checkpoint in the shared folder, so each
consumer reads the materialized rows instead of recomputing the fact joins
and the dedup.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from aurum.plans import dims, trips
from aurum.session import materialize as _materialize
from aurum.sources import adapters as A
from aurum.sources.tables import Tables


class Layers:
    """``materialize``: True for every shared layer, or the set of layer names
    (``typed``, ``silver_tagged``, ``silver``, ``daily``, ``gold``) that have
    several consumers in the job at hand."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool | set[str] = False):
        self.t = Tables(spark, sf_dir)
        self.materialize = materialize

    def _m(self, df: DataFrame, layer: str) -> DataFrame:
        on = self.materialize is True or (isinstance(self.materialize, (set, frozenset))
                                          and layer in self.materialize)
        return _materialize(df) if on else df

    @cached_property
    def bronze(self) -> DataFrame:
        return A.raw_trips(self.t)

    @cached_property
    def typed(self) -> DataFrame:
        return self._m(trips.typed(self.bronze), "typed")

    @cached_property
    def silver_tagged(self) -> DataFrame:
        """Every bronze row with its silver verdict (NULL = accepted).

        The survivor match-back reads the typed rows twice, so they are
        materialized first; the fact joins then run once.
        """
        return self._m(trips.tag_typed(self.typed), "silver_tagged")

    @cached_property
    def silver(self) -> DataFrame:
        return self._m(trips.silver(self.bronze), "silver")

    @cached_property
    def silver_accepted(self) -> DataFrame:
        """Silver as the accepted part of ``silver_tagged`` (same rows as
        ``silver``); use it when the tagged set is needed anyway."""
        from pyspark.sql import functions as F
        return self.silver_tagged.filter(F.col("_reject_reason").isNull()).select(*trips.SILVER_COLUMNS)

    @cached_property
    def zones(self) -> DataFrame:
        return dims.zone_silver(A.raw_zone_lookup(self.t))

    @cached_property
    def daily(self) -> DataFrame:
        """One row per day, but built from the whole measurement feed: read
        by gold and by several checks, so it is materialized once too."""
        return self._m(dims.daily_wide(A.raw_daily_long(self.t)), "daily")

    @cached_property
    def gold(self) -> DataFrame:
        return self._m(trips.gold(self.silver, self.zones, self.daily), "gold")

    def gate_frames(self) -> "LazyFrames":
        """Check-table name -> layer, built (and materialized) only when a
        check actually reads it."""
        return LazyFrames({"stg_trips": lambda: self.silver, "stg_daily": lambda: self.daily,
                           "stg_zones": lambda: self.zones, "fct_trips": lambda: self.gold})


class LazyFrames(Mapping):
    def __init__(self, makers: dict):
        self._makers = makers

    def __getitem__(self, key: str) -> DataFrame:
        return self._makers[key]()

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
