"""Security classification from ticker shape, name and fund flags (one CASE).

First match wins:

1. ETF flag -> ``etf``; 2. fund flag -> ``fund``;
3. split the upper-cased, stripped symbol at its *first* dash; a non-empty
   suffix decides: ``P...`` preferred, UN/U unit, WT/WS warrant, RT/R right,
   anything else (a share class such as ``BF-A``) common;
4. no suffix and a five-character root: the fifth letter decides; ``Z`` is
   preferred when the name reads like a preferred line, else warrant;
5. common.

The name is consulted only for a trailing ``Z``: the feed copies the operating
company's name onto derivative lines, so it cannot tell them apart otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitylake.functions.text import strip

# Suffix and fifth-letter codes, and the preferred-name pattern.
DASH_SUFFIX_TYPES = {"UN": "unit", "U": "unit", "WT": "warrant", "WS": "warrant", "RT": "right", "R": "right"}
FIFTH_LETTER_TYPES = {"W": "warrant", "R": "right", "U": "unit"}
PREFERRED_NAME_PATTERN = r"(?i)%|\bseries\b|\bcumulative\b|\bpreferred\b|\bdepositary\b"



def _lookup(value: Column, table: dict[str, str], default: Column | str | None) -> Column:
    out = None
    for code, kind in table.items():
        out = (F.when(value == code, kind) if out is None else out.when(value == code, kind))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(fallback)


def _kind(root: Column, suffix: Column, name: Column, is_etf: Column, is_fund: Column) -> Column:
    fifth = F.substring(root, 5, 1)
    name = F.coalesce(name, F.lit(""))

    by_suffix = F.when(suffix.startswith("P"), "preferred").otherwise(
        _lookup(suffix, DASH_SUFFIX_TYPES, "common"))
    by_fifth = F.when(fifth == "Z", F.when(name.rlike(PREFERRED_NAME_PATTERN), "preferred").otherwise("warrant")
                      ).otherwise(_lookup(fifth, FIFTH_LETTER_TYPES, "common"))

    return (
        F.when(F.coalesce(is_etf, F.lit(False)), "etf")
        .when(F.coalesce(is_fund, F.lit(False)), "fund")
        .when(suffix != "", by_suffix)
        .when(F.length(root) == 5, by_fifth)
        .otherwise("common")
    )


def _split(sym: Column) -> tuple[Column, Column]:
    """Root before the first dash, and the suffix after it ('' when none)."""
    dash = F.instr(sym, "-")
    root = F.when(dash > 0, F.substring_index(sym, "-", 1)).otherwise(sym)
    suffix = F.when(dash > 0, sym.substr(dash + 1, F.length(sym))).otherwise(F.lit(""))
    return root, suffix


def classify_security(symbol: Column, company_name: Column, is_etf: Column, is_fund: Column) -> Column:
    """One-expression form, for a single classification in a projection."""
    root, suffix = _split(F.upper(strip(symbol)))
    return _kind(root, suffix, company_name, is_etf, is_fund)


def with_security_type(df: DataFrame, symbol: str, company_name: str, is_etf: str, is_fund: str,
                       out: str = "security_type") -> DataFrame:
    """Frame form: the symbol is normalised and split once into helper
    columns, so the CASE refers to columns instead of repeating the string
    work in every branch (a small plan that stays inside codegen limits)."""
    sym = "__cls_sym"
    staged = df.withColumn(sym, F.upper(strip(F.col(symbol))))
    root, suffix = _split(F.col(sym))
    staged = staged.withColumns({"__cls_root": root, "__cls_suffix": suffix})
    kind = _kind(F.col("__cls_root"), F.col("__cls_suffix"), F.col(company_name), F.col(is_etf), F.col(is_fund))
    return staged.withColumn(out, kind).drop(sym, "__cls_root", "__cls_suffix")
