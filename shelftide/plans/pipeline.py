"""Layered build: days, profile, tables, with the journal as the gate between layers."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelftide.checks.journal import assemble, enforce
from shelftide.checks.profile_checks import profile_checks
from shelftide.checks.series_checks import array_checks, layer_totals, series_checks
from shelftide.operators import abc, fingerprint, pivot, profile, ranking, series
from shelftide.params import Params
from shelftide.plans.population import population
from shelftide.sources.facts import in_period, normalise
from shelftide.sources.storage import read_layer, write_bucketed, write_layer

STEPS = ("days", "profile", "tables")


@dataclass(frozen=True)
class Build:
    """Where the layers live and how they are built.

    With `buckets` the day layer is bucketed by pair: the join that builds it already places
    the rows, and the arrays, the profile and the checks then read it without another shuffle
    of the days. For facts whose key contract holds, so that no pair has more rows than the
    period has days. With `classes` the profile also gets predictability classes with their decisions, as a
    layer behind a gate of its own.
    """
    spark: SparkSession
    raw: DataFrame
    params: Params
    root: str
    checks: bool = True
    buckets: int | None = None
    classes: ranking.ClassRules | None = None

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def layer(self, layer: str) -> DataFrame:
        return read_layer(self.spark, self.path(layer))

    def _write(self, layer: str, df: DataFrame, *keys: str) -> DataFrame:
        return write_layer(df, self.path(layer), keys)

    def _days_table(self) -> str:
        return f"series_days_{hashlib.sha256(self.root.encode()).hexdigest()}"

    def _write_days(self, facts: DataFrame, summary: DataFrame,
                    stores: DataFrame) -> DataFrame:
        if self.buckets is None:
            return self._write("series_days", series.days(facts, summary, stores, self.params),
                               "ItemLocationId", "TransDate")
        # Placed before the join: the pairs follow this partitioning and the write keeps it.
        placed = facts.repartition(self.buckets, "ItemLocationId")
        return write_bucketed(series.days(placed, summary, stores, self.params),
                              self._days_table(), self.path("series_days"), "ItemLocationId",
                              self.buckets, ("ItemLocationId", "TransDate"))

    def _read_days(self) -> DataFrame:
        if self.buckets is not None and self.spark.catalog.tableExists(self._days_table()):
            return self.spark.table(self._days_table())
        return self.layer("series_days")

    def _gate(self, name: str, parts: list[DataFrame]) -> None:
        path = self.path(f"{name}_checks")
        assemble(parts).coalesce(1).write.mode("overwrite").parquet(path)
        enforce(self.spark.read.parquet(path), name)

    def days(self) -> None:
        facts = normalise(self.raw, self.params)
        summary = self._write("series_summary", series.pair_summary(facts, self.params),
                              "ItemLocationId")
        stores = self._write("series_stores", series.stores(summary, self.params), "LocationId")
        self._write("series_pairs", series.pairs(summary), "ItemLocationId")
        days = self._write_days(facts, summary, stores)
        # A pair collects its days into one array: only after its key is known to be unique.
        if self.checks:
            self._gate("series_days", series_checks(self.raw, facts, days, None, self.params))
        arrays = self._write("series_arrays", series.arrays(days), "ItemLocationId", "Variant")
        if self.checks:
            self._gate("series_arrays", [array_checks(layer_totals(days, arrays, self.params))])

    def profile(self) -> None:
        days = self._read_days()
        pairs = self._write("profile_pairs", profile.profile_pairs(days, self.params),
                            "ItemLocationId", "Variant")
        classes = self._write("profile_abc", abc.abc_classes(pairs, self.params),
                              "ItemLocationId")
        base = self._write("profile_base", profile.profile_base(pairs, classes),
                           "ItemLocationId", "Variant")
        if self.checks:
            self._gate("series_profile", profile_checks(
                normalise(self.raw, self.params), base, self.layer("series_pairs"),
                self.params))
        if self.classes:
            classed = self._write("profile_classes", ranking.classified_profile(base, self.classes),
                                  "ItemLocationId", "Variant")
            if self.checks:
                self._gate("profile_classes", ranking.class_checks(classed, self.classes.min_days))

    def tables(self) -> None:
        base = self.layer("profile_base")
        built = population(base)
        for table in built:
            table.rows.write.mode("overwrite").parquet(self.path(f"tables/{table.key}"))
        listed = pivot.manifest(self.spark, built)
        listed.write.mode("overwrite").json(self.path("tables/manifest"))
        mark = fingerprint.fingerprint(self.raw.where(in_period(self.params)),
                                       self._read_days(), base)
        mark.write.mode("overwrite").json(self.path("tables/fingerprint"))
        if self.checks:
            problems = pivot.manifest_problems(listed).collect()
            if problems:
                raise ValueError(f"report tables without branch or segment: {problems}")

    def run(self, steps: Sequence[str] = STEPS) -> None:
        """Run the chosen steps in their fixed order. A step alone reads the layers before
        it from disk and fails if they are not there."""
        unknown = set(steps) - set(STEPS)
        if unknown:
            raise ValueError(f"unknown steps {sorted(unknown)}, expected some of {STEPS}")
        for step in STEPS:
            if step in steps:
                getattr(self, step)()
