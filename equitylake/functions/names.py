"""Header renaming: the vendor's camelCase names to stored snake_case.

Acronyms stay whole (``netIncomePerEBT`` -> ``net_income_per_ebt``). This is
metadata only: applied with ``toDF`` it never touches a row.
"""

from __future__ import annotations

import re

_ACRONYM_THEN_WORD = re.compile(r"([A-Z]+)([A-Z][a-z])")
_LOWER_THEN_UPPER = re.compile(r"([a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    name = _ACRONYM_THEN_WORD.sub(r"\1_\2", name)
    name = _LOWER_THEN_UPPER.sub(r"\1_\2", name)
    return name.lower()


def snake_columns(df):
    """Rename every column of ``df`` to snake_case (a projection, no data work)."""
    return df.toDF(*[snake_case(c) for c in df.columns])
