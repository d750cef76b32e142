"""Column selection, naming and row-wise expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesworks import config


def rename_series_columns(df: DataFrame, names: dict[str, str] = config.SERIES_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(names)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns except the named ones."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def feature_columns(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
) -> list[str]:
    return numeric_columns(df, exclude=[*keys, date, target])


def feature_family(name: str) -> str:
    """Family of a feature, read off its name."""
    if "_lag_" in name:
        return "lag"
    if "_rolling_" in name:
        return "rolling"
    if "_diff_" in name:
        return "diff"
    if name.endswith(("_cumsum", "_cummean", "_cumstd")):
        return "cumulative"
    if name in config.DATE_FEATURES or name.endswith(("_sin", "_cos")):
        return "date"
    return "other"


def valid_key(c: Column) -> Column:
    """Not NULL, not blank and not the text ``None``."""
    return c.isNotNull() & (F.trim(c) != "") & (F.trim(c) != "None")


def safe_name(c: Column) -> Column:
    """First 20 characters with path separators replaced."""
    return F.regexp_replace(F.substring(c, 1, 20), "/", "_")


def add_interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Product and ratio of each pair; a pair with a missing column is left out."""
    new = {}
    for a, b in pairs:
        if a in df.columns and b in df.columns:
            new[f"{a}_x_{b}"] = F.col(a) * F.col(b)
            new[f"{a}_div_{b}"] = F.try_divide(F.col(a), F.col(b) + F.lit(config.RATIO_EPSILON))
    return df.withColumns(new) if new else df


def add_forecast_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Error, absolute error and percentage error (NULL where the actual is 0)."""
    error = F.col(actual) - F.col(predicted)
    return df.withColumns(
        {
            "error": error,
            "abs_error": F.abs(error),
            "percentage_error": F.try_divide(F.abs(error), F.col(actual)) * 100,
        }
    )


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL; its type stays."""
    kind = dict(df.dtypes)[name]
    return F.nanvl(F.col(name), F.lit(None).cast(kind)) if kind in ("double", "float") else F.col(name)


def nan_to_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with NaN as NULL in the named columns."""
    return df.withColumns({n: known(df, n) for n in names if dict(df.dtypes)[n] in ("double", "float")})
