"""Aggregates kept up by what each batch adds and withdraws.

An image is a record with a sign: +1 for one that counts from now on, -1 for one that does so no
longer. Two sets of partials can be added to those stored before, so that a batch costs what it
touches: signed sums per window and key, as few rows as the aggregate has, and signed counts of the
members that must be told apart there, such as rides. A largest or smallest fare cannot be withdrawn
from a maximum: the members of a city are rides and fares, and the fares left decide.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside import settings as S
from curbside.operators import gold

SIGN, HOUR = "sign", "hour"
HOUR_FORMAT = "yyyy-MM-dd-HH"
#: How many records a member has, and the measures of members.
RECORDS = "records"


def _by_hour(rows: DataFrame) -> DataFrame:
    """With the hour in which the window begins."""
    return rows.withColumn(HOUR, F.date_format("win.start", HOUR_FORMAT))


@dataclass(frozen=True)
class Partials:
    """How one aggregate is kept: which records count, by what keys and members, which sums, and how totals follow."""

    records: Callable[[DataFrame], DataFrame]
    window: Callable[[], Column]
    keys: tuple[str, ...]
    members: tuple[str, ...]
    measures: Callable[[], dict[str, Column]]
    present: Callable[[], Column]
    totals: Callable[[DataFrame], DataFrame]
    #: What members are counted by besides their records.
    counts: Callable[[], dict[str, Column]] = dict
    #: Turns members into rows that totals count once each.
    counted: Callable[[DataFrame], DataFrame] = lambda members: members

    def of_images(self, images: DataFrame) -> DataFrame:
        """Signed sums per window and key, with the hour in which the window begins."""
        signed = (F.sum(F.col(SIGN) * x).alias(name) for name, x in self.measures().items())
        return _by_hour(self._records(images).groupBy(self.window().alias("win"), *self.keys).agg(*signed))

    def added(self, before: DataFrame, more: DataFrame) -> DataFrame:
        """The sum of two sets of sums. Those that come to nothing stay, so that every hour has rows."""
        return before.unionByName(more).groupBy(HOUR, "win", *self.keys).agg(*(F.sum(x).alias(x) for x in self.measures()))

    def members_of(self, images: DataFrame) -> DataFrame:
        """Each image by window, key and member, with what it adds to the counts."""
        signed = ((F.col(SIGN) * x).cast("long").alias(name) for name, x in self._counts().items())
        return self._records(images).select(self.window().alias("win"), *self.keys, *self.members, *signed)

    def members_left(self, members: DataFrame) -> DataFrame:
        """Members added up, with their hour; those that are fully withdrawn are left out."""
        sums = members.groupBy("win", *self.keys, *self.members).agg(*(F.sum(x).alias(x) for x in self._counts()))
        return _by_hour(sums.filter(" OR ".join(f"{x} <> 0" for x in self._counts())))

    def aggregate(self, sums: DataFrame, members: DataFrame) -> DataFrame:
        """The aggregate's rows, with their hour."""
        rows = self.counted(members.filter(F.col(RECORDS) > 0).drop(HOUR))
        totals = self.totals(sums.filter(self.present()).drop(HOUR).unionByName(rows, allowMissingColumns=True))
        return totals.withColumn(HOUR, F.date_format("window_start", HOUR_FORMAT))

    def _records(self, images: DataFrame) -> DataFrame:
        return self.records(gold.usable(images))

    def _counts(self) -> dict[str, Column]:
        return {RECORDS: F.lit(1)} | self.counts()


def _rides_of_fares(members: DataFrame) -> DataFrame:
    return members.groupBy("win", "city", "ride_id").agg(F.max("fare_amount").alias("fare_hi"), F.min("fare_amount").alias("fare_lo"))


KEPT = {
    "city_ride_metrics": Partials(
        records=lambda images: images, window=lambda: F.window("event_ts", S.CITY_WINDOW), keys=("city",), members=("ride_id", "fare_amount"),
        measures=gold.city_measures, present=lambda: F.col("events") > 0, totals=gold.city_totals, counted=_rides_of_fares),
    "driver_utilization": Partials(
        records=lambda images: images.filter(F.col("driver_id").isNotNull()),
        window=lambda: F.window("event_ts", S.DRIVER_WINDOW, S.DRIVER_SLIDE), keys=("driver_id", "city"), members=("ride_id",),
        measures=gold.driver_measures, present=lambda: F.col("events") > 0, totals=gold.driver_totals),
    "surge_pricing": Partials(
        records=gold.wanted_or_supplied, window=lambda: F.window("event_ts", S.SURGE_WINDOW), keys=("city",), members=("driver_id",),
        measures=gold.surge_measures, present=lambda: (F.col("requests") > 0) | (F.col("assignments") > 0), totals=gold.surge_totals,
        counts=lambda: {"assignments": gold.surge_measures()["assignments"]}),
}
