"""Weights and switches shared by the recommendation operators."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # company trust: rating * share * scale, both terms reach 0.5 at the top rating
    company_share: float = 0.5
    company_scale: float = 0.2
    headcount_share: float = 0.5
    headcount_scale: float = 0.125
    # user trust = share * company trust + share * activity score
    trust_company_share: float = 0.5
    trust_activity_share: float = 0.5
    # total similarity = share * (course + area + activity cosine)
    similarity_share: float = 0.33
    # blended score = share * similarity + share * trust
    blend_similarity_share: float = 0.5
    blend_trust_share: float = 0.5
    # interest cascade: number of companies that is enough
    enough_companies: int = 10
    # people and items kept per query student
    neighbours: int = 10
    max_items: int = 10
    truth_items: int = 30
    # value of a feature a student has no entry for
    fill: float = -1.0
    # choices the source material leaves open
    exclude: str = "anti"  # "anti": never recommend a taken item; "multiset": cancel one copy
    include_self: bool = False  # may the query student be their own neighbour
    trust_agg: str = "max"  # "max": one trust per person; "none": one row per employer
    exact_activity: bool = False  # True: fractional activity score and participation
    duplicate_star: str = "mean"  # "mean" or "max" of several stars by one student for one item
    drop_unknown_area: bool = False
    count_activity_rows: bool = False  # True: count repeated activity rows

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)

    @staticmethod
    def as_first_run() -> "Params":
        """Switches that reproduce the original run's quirks, but for two.

        Several stars for one item stay a mean, not the first met, and the activity
        score covers everyone, not five students.
        """
        return Params(exclude="multiset", include_self=True, trust_agg="none")
