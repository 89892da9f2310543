"""One spelling of every pattern for two engines: Java's (Spark) and RE2 (SQL checks)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """A regular expression and its flags: i ignores case, m lets ^ and $ match at lines."""

    body: str
    flags: str = ""

    @property
    def java(self) -> str:
        """UNIX lines and Unicode classes, so that Java agrees with Python on line ends, white space and letters."""
        return f"(?dUu{self.flags}){self.body}"

    @property
    def re2(self) -> str:
        body = self.body.replace("*+", "*").replace("++", "+")
        return f"(?{self.flags}){body}" if self.flags else body

    def found(self, text: Column) -> Column:
        return text.rlike(self.java)

    def sql(self, text: str) -> str:
        return f"regexp_matches({text}, {quoted(self.re2)})"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def first_of(cases: list[tuple[Column, Column]]) -> Column:
    """CASE over the conditions in order; null when none holds."""
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out
