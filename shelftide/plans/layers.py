"""Layers as lazy DataFrames, from raw facts to the profile."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from shelftide.operators import abc, profile, series
from shelftide.params import Params
from shelftide.session import materialise
from shelftide.sources.facts import normalise


@dataclass
class Layers:
    raw: DataFrame
    params: Params

    @cached_property
    def facts(self) -> DataFrame:
        return normalise(self.raw, self.params)

    @cached_property
    def written_facts(self) -> DataFrame:
        """The days meet the facts twice, in the pairs and in their own rows; reading them from the raw source
        would join and add up its lines twice."""
        return materialise(self.facts, "facts")

    @cached_property
    def summary(self) -> DataFrame:
        return series.pair_summary(self.facts, self.params)

    @cached_property
    def written_summary(self) -> DataFrame:
        """Pair-sized. The days need it twice, for the pairs and for the stores, and column
        pruning would otherwise turn that into two more scans of the facts."""
        return materialise(series.pair_summary(self.written_facts, self.params), "pair-summary")

    @cached_property
    def stores(self) -> DataFrame:
        return series.stores(self.summary, self.params)

    @cached_property
    def pairs(self) -> DataFrame:
        return series.pairs(self.summary)

    @cached_property
    def days(self) -> DataFrame:
        summary = self.written_summary
        return series.days(self.written_facts, summary, series.stores(summary, self.params),
                           self.params)

    @cached_property
    def arrays(self) -> DataFrame:
        return series.arrays(self.days)

    @cached_property
    def profile_pairs(self) -> DataFrame:
        return profile.profile_pairs(self.days, self.params)

    @cached_property
    def written_profile_pairs(self) -> DataFrame:
        """Pair-sized; ABC counts stores and sorts six times, so it starts from a table."""
        return materialise(self.profile_pairs, "profile-pairs")

    @cached_property
    def abc(self) -> DataFrame:
        return abc.abc_classes(self.written_profile_pairs, self.params)

    @cached_property
    def base(self) -> DataFrame:
        return profile.profile_base(self.written_profile_pairs, self.abc)
