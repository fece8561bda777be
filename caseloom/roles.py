"""Column roles: operators are told which columns play which part, so they run on any table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Names the columns of a table by the part they play.

    ``key`` identifies a row, ``label`` is the 0/1 outcome, ``flags`` are 0/1 attributes, ``measures`` are
    numeric, ``categories`` are strings with a small domain.
    """

    key: str = "patient_id"
    label: str = "label"
    flags: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()

    @property
    def features(self) -> list[str]:
        return [*self.flags, *self.measures]
