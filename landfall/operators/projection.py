"""Projections over DataFrames: rename (P1), closed (P2) and open
projection, in-place replace (P4), load stamp (P5), file lineage (P6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.paths import base_name, url_unquote


def qcol(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename in place; no error when absent. Names compare exactly,
    where ``withColumnRenamed`` would ignore case."""
    if old not in df.columns:
        return df
    return df.select(*[qcol(c).alias(new) if c == old else qcol(c) for c in df.columns])


def closed_projection(df: DataFrame, names) -> DataFrame:
    """Exactly these columns, in this order."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[qcol(n) for n in names])


def open_projection(df: DataFrame, replace: Mapping[str, Column] | None = None,
                    add: Mapping[str, Column] | None = None) -> DataFrame:
    """P3 + P4: every column kept in input order, ``replace`` in place, ``add`` last."""
    replace = dict(replace or {})
    add = dict(add or {})
    cols = [replace[c].alias(c) if c in replace else qcol(c) for c in df.columns]
    cols += [v.alias(k) for k, v in add.items()]
    return df.select(*cols)


def replace_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """New value, same position."""
    return open_projection(df, replace={name: expr})


def with_load_stamp(df: DataFrame, stamp: str, name: str = "Load Timestamp") -> DataFrame:
    """P5: one literal stamp for every row of the run."""
    return open_projection(df, add={name: F.lit(stamp)})


def with_file_name(df: DataFrame, file_name: str, name: str = "File Name") -> DataFrame:
    """P6 for one landed object: its base name as a literal."""
    return open_projection(df, add={name: F.lit(file_name)})


def with_source_file(df: DataFrame, name: str = "File Name") -> DataFrame:
    """P6 when one read spans many files: each row's own file, from the scan's
    metadata (which arrives percent-encoded, so it is decoded once)."""
    return open_projection(df, add={name: base_name(url_unquote(F.col("_metadata.file_path")))})
