"""Schema conformance (PRJ2) and column subsets (PRJ1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equitylake.specs import TableSpec


# Fixed value: the text that rejects unknown columns.
UNKNOWN_COLUMNS_MESSAGE = "has no column(s):"


def _nan_to_null(c: Column, dtype: T.DataType) -> Column:
    # NaN compares greater than every number in Spark, so a NaN market cap
    # would pass ``>= min``. Stored doubles never hold NaN.
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nullif(c, F.lit(float("nan")).cast(dtype))
    return c


def conform(frame: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns in declared order, each of its declared type.

    Present columns of another type are cast leniently (``try_cast``: a value
    that does not fit becomes null, nothing raises); missing columns become
    typed nulls; extra columns are dropped. Same-typed columns are untouched,
    so the projection costs nothing on a schema-exact frame. ``keep`` names
    extra columns (e.g. an order) carried through unchanged after them.
    """
    present = {f.name: f.dataType for f in frame.schema.fields}
    out = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f"`{f.name}`")
            if present[f.name] != f.dataType:
                c = c.try_cast(f.dataType)
            c = _nan_to_null(c, f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name))
    out += [F.col(f"`{k}`") for k in keep]
    return frame.select(*out)


def resolve_columns(spec: TableSpec, columns: Sequence[str] | None) -> list[str]:
    """Columns to return: key columns always, declared order, unknown names rejected."""
    if columns is None:
        return spec.columns
    unknown = [c for c in columns if c not in spec.columns]
    if unknown:
        raise ValueError(f"{spec.name} {UNKNOWN_COLUMNS_MESSAGE} {sorted(unknown)}")
    wanted = set(columns) | set(spec.key)
    return [c for c in spec.columns if c in wanted]
