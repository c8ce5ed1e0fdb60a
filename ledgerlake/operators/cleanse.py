"""Projection and cleaning operators.

All are narrow (no shuffle) projections except ``drop_blank_columns`` which
needs one global aggregate pass to learn which columns hold any value.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StringType, StructType


def normalize_name(name: str) -> str:
    """Strip, whitespace runs → '_', lower case."""
    return re.sub(r"\s+", "_", name.strip()).lower()


def normalize_names(df: DataFrame) -> DataFrame:
    """P1 applied to every column (a metadata-only rename)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def dedupe_columns(df: DataFrame) -> DataFrame:
    """When several columns share a name, keep the first one."""
    names = df.columns
    tmp = [f"__c{i}" for i in range(len(names))]
    renamed = df.toDF(*tmp)
    seen: set[str] = set()
    keep = []
    for t, n in zip(tmp, names):
        if n not in seen:
            seen.add(n)
            keep.append(F.col(t).alias(n))
    return renamed.select(*keep)


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename only the columns that exist."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def enforce_contract(df: DataFrame, contract: Sequence[str] | StructType) -> DataFrame:
    """Output exactly the contract columns, in order; missing → NULL (typed
    when the contract is a StructType), extras dropped."""
    cols = []
    if isinstance(contract, StructType):
        for f in contract.fields:
            src = F.col(f.name) if f.name in df.columns else F.lit(None)
            cols.append(src.cast(f.dataType).alias(f.name))
    else:
        for name in contract:
            cols.append(F.col(name) if name in df.columns else F.lit(None).cast(StringType()).alias(name))
    return df.select(*cols)


def tag_columns(df: DataFrame, tags: Mapping[str, object]) -> DataFrame:
    """P5: constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def blank_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Empty or whitespace-only strings → NULL (string columns only)."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    targets = [c for c in (columns or df.columns) if c in string_cols]
    return df.withColumns({c: F.when(F.trim(F.col(c)) != "", F.col(c)) for c in targets})


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose every column is NULL/blank (after P8)."""
    return blank_to_null(df).na.drop(how="all")


def drop_blank_columns(df: DataFrame) -> DataFrame:
    """Drop ``Unnamed*`` headers and columns with no non-blank value.

    One distributed aggregate (partial counts per task, merged on the driver)
    decides which columns survive; the data itself is never collected."""
    cleaned = blank_to_null(df)
    named = [c for c in cleaned.columns if not c.startswith("Unnamed")]
    if not named:
        return cleaned.select()
    counts = cleaned.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(named)]).first()
    keep = [c for i, c in enumerate(named) if counts[f"n{i}"] > 0]
    return cleaned.select(*keep)


def require_key(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose key is present and not blank."""
    return df.where(F.length(F.trim(F.col(column))) > 0)


def project(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Arithmetic / renamed projection to contract names."""
    return df.select(*[e.alias(n) for n, e in exprs.items()])


def write_typing(df: DataFrame, force_string: Iterable[str] = (), force_unicode: Iterable[str] = (),
                 money_type: DataType = DecimalType(38, 15)) -> DataFrame:
    """K8: forced-string columns win, then forced-unicode (also strings in Spark),
    then every remaining float column becomes DECIMAL(38,15)."""
    fs, fu = set(force_string), set(force_unicode)
    cols = []
    for f in df.schema.fields:
        if f.name in fs or f.name in fu:
            cols.append(F.col(f.name).cast(StringType()).alias(f.name))
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.col(f.name).cast(money_type).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def stringify_contract(df: DataFrame, contract: Sequence[str]) -> DataFrame:
    """K9: every contract column as text, in contract order (missing → NULL)."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(StringType()).alias(c)
                       for c in contract])
