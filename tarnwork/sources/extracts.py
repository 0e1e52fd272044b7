"""Extracts from a source table: full, by high-water mark, capped; and the mark's advance."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import lit_like


def clean_filter(text: str | None) -> str | None:
    """A user filter without a leading WHERE or AND; literals keep their case."""
    if not text or not text.strip():
        return None
    return re.sub(r"^\s*(where|and)\b\s*", "", text, flags=re.IGNORECASE).strip() or None


def full_extract(df: DataFrame, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """All rows, or those of a fixed filter, projected."""
    cond = clean_filter(where)
    out = df.filter(cond) if cond else df
    return out.selectExpr(*columns) if columns else out


def start_mark(state: dict | None, identifier: str, initial):
    """The saved mark if it was saved for the same identifier and is not empty, else the initial one."""
    if state and state.get("identifier") == identifier and state.get("value") not in (None, ""):
        return state["value"]
    return initial


def watermark_extract(df: DataFrame, mark: str, last, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Rows whose mark expression is strictly greater than ``last``, with the mark as ``dl_watermark``."""
    out = df.filter(F.expr(mark) > lit_like(df, mark, last))
    cond = clean_filter(where)
    out = out.filter(cond) if cond else out
    return out.selectExpr(*(columns or ["*"]), f"{mark} AS dl_watermark")


def limit_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows in ``order`` (TOP n)."""
    return df.orderBy(*order).limit(n)


def advance_watermark(df: DataFrame, mark: str, previous) -> DataFrame:
    """One row with the next mark: the largest value, or the previous mark when there is none."""
    return df.agg(F.coalesce(F.max(F.expr(mark)), lit_like(df, mark, previous)).alias("watermark"))


def incremental_source(df: DataFrame, ts: str, since) -> DataFrame:
    """Rows modified at or after the last successful run; everything on the first run."""
    return df if since is None else df.filter(F.col(ts) >= lit_like(df, ts, since))
