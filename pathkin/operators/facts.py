"""Compact facts of one run.

Recommendations use a few tables many times: who completed what, who gave which
stars and who did what. In a run (``gather``) each of these is grouped with its
counts and written to the run's workspace when it is first asked for, and all
operators read the groups from there. The other tables are read once or twice, by
the people or students asked for. Without a workspace the same frames stay lazy, for
a single use of one of them. Every operator takes a ``Domain`` or ``Facts``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import star_units
from pathkin.session import Workspace, stage


class Facts:
    """Grouped frames; ``n`` counts the raw rows of a group.

    taken   std_no, dept, course, n
    stars   std_no, kind, item, units, top, rated   (sum and maximum of whole units; rated: stars not null)
    acts    std_no, act_type, title, n
    All other attributes are the frames of ``domain``.
    """

    def __init__(self, domain: Domain, workspace: Workspace | None = None):
        self.domain, self.workspace = domain, workspace
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        # only what is no attribute of this class comes here
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.domain, name)

    @property
    def taken(self) -> DataFrame:
        return self._fact("taken", lambda d: d.courses.groupBy("std_no", "dept", "course").agg(F.count("*").alias("n")))

    @property
    def stars(self) -> DataFrame:
        units = star_units(F.col("star"))
        return self._fact(
            "stars",
            lambda d: d.ratings.groupBy("std_no", "kind", "item").agg(
                F.sum(units).alias("units"), F.max(units).alias("top"), F.count(units).alias("rated")
            ),
        )

    @property
    def acts(self) -> DataFrame:
        return self._fact(
            "acts", lambda d: d.activities.groupBy("std_no", "act_type", "title").agg(F.count("*").alias("n"))
        )

    def _fact(self, name: str, make) -> DataFrame:
        if name not in self._known:
            self._known[name] = self.keep_in_run(make(self.domain), name)
        return self._known[name]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame that a plan uses several times; with the run's other tables if there is a run."""
        return self.workspace.stage(df, name) if self.workspace else stage(df, name)

    def keep_in_run(self, df: DataFrame, name: str) -> DataFrame:
        """As ``keep`` in a run; left lazy outside one."""
        return self.workspace.stage(df, name) if self.workspace else df


def facts_of(domain: Domain | Facts) -> Facts:
    """The same frames, grouped lazily."""
    return domain if isinstance(domain, Facts) else _lazy(domain)


@lru_cache(maxsize=8)
def _lazy(domain: Domain) -> Facts:
    return Facts(domain)


def gather(domain: Domain, workspace: Workspace) -> Facts:
    """Facts that are written to the workspace, each when it is first used."""
    return Facts(domain, workspace)
