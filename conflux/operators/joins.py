"""Joins (D1-D7).

Physical strategy is left to Catalyst + AQE: a side is broadcast when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` or when AQE
sees the shuffled size at run time; otherwise sort-merge, with AQE splitting
skewed partitions. An explicit ``broadcast`` hint is only given to sides
whose size is bounded by definition (``bounded=True``: region, nation,
metadata tables), never to data that grows with the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _side(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def join_runs(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column,
              how: str = "inner", right_bounded: bool = False) -> DataFrame:
    """Inner equi-join (run x job, log detail x header, ...)."""
    return left.join(_side(right, right_bounded), on, how)


@dataclass
class Dim:
    """One dimension of a task catalog: ``df`` joined on ``on`` (column
    names shared with the chain, or a Column condition)."""
    df: DataFrame
    on: str | Sequence[str] | Column
    bounded: bool = False


def task_catalog(base: DataFrame, dims: Sequence[Dim]) -> DataFrame:
    """Chain of left outer joins, one output row per base row (each
    dimension is unique on its key)."""
    out = base
    for d in dims:
        out = out.join(_side(d.df, d.bounded), d.on, "left")
    return out


def with_table_roles(df: DataFrame, dim: DataFrame, key: str,
                     roles: Mapping[str, str], columns: Sequence[str],
                     bounded: bool = False) -> DataFrame:
    """D3: the same dimension joined once per role. ``roles`` maps a column
    prefix (the role) to the fact column holding the dimension key; the
    dimension's ``columns`` come back as ``<prefix>_<column>``."""
    out = df
    for prefix, fk in roles.items():
        d = dim.select(F.col(key).alias(f"{prefix}__key"),
                       *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
        out = out.join(_side(d, bounded), out[fk] == d[f"{prefix}__key"], "left").drop(f"{prefix}__key")
    return out


def active_tasks(tasks: DataFrame, steps: DataFrame, on: str, bypass: bool = False) -> DataFrame:
    """``WHERE (is_etl AND step IN (SELECT ...)) OR NOT is_etl`` -- a left
    semi join, skipped on the driver when the bypass flag is set."""
    return tasks if bypass else tasks.join(steps, on, "left_semi")


def with_parent(df: DataFrame, key: str, parent_key: str, columns: Sequence[str],
                prefix: str = "parent_") -> DataFrame:
    """Correlated scalar lookup of the parent row's columns: a left
    self-join on ``parent_key = key`` (keys unique)."""
    p = df.select(F.col(key).alias(f"{prefix}_k"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return df.join(p, df[parent_key] == p[f"{prefix}_k"], "left").drop(f"{prefix}_k")


def with_scalar(df: DataFrame, scalar: DataFrame, name: str) -> DataFrame:
    """An uncorrelated scalar subquery as a column value. ``scalar``
    must produce one row and one column; it runs once as a subquery (no
    join)."""
    return df.withColumn(name, scalar.scalar())


def flatten_envelope(df: DataFrame, body_col: str, schema: T.StructType | str,
                     data_field: str = "data", side_fields: Sequence[str] = ("support",),
                     scalar_fields: Sequence[str] = (), keep: Sequence[str] = (),
                     prefix_side: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """``OPENJSON(data) CROSS APPLY OPENJSON(support)``. ``data`` (an
    object or an array of objects) is expanded, each side object is joined
    to every data row; an absent or empty side yields no rows. Scalar
    envelope fields (``page``, ``total``...) repeat on every row. Malformed
    text or a value not of its type is an error; to keep such documents
    apart, take them through :func:`conflux.sources.responses.split_documents`
    first."""
    doc = F.from_json(F.col(body_col), schema, {"mode": mode})
    out = df.select(*keep, doc.alias("_doc"))
    dtype = out.schema["_doc"].dataType[data_field].dataType
    data = F.col(f"_doc.{data_field}")
    if isinstance(dtype, T.StructType):
        data = F.array(data)
    data = F.filter(data, lambda x: x.isNotNull())
    scal = [F.col(f"_doc.{s}").alias(s) for s in scalar_fields]
    out = out.select(*keep, *scal, *[F.col(f"_doc.{s}").alias(f"_side_{s}") for s in side_fields],
                     F.inline(data))
    for s in side_fields:
        fields = out.schema[f"_side_{s}"].dataType.fieldNames()
        alias = {f: (f"{s}_{f}" if prefix_side else f) for f in fields}
        # one-element array when present, empty when absent -> no row
        side = F.filter(F.array(F.col(f"_side_{s}")), lambda x: x.isNotNull())
        other = [c for c in out.columns if c != f"_side_{s}"]
        out = out.select(*other, F.inline(side))
        out = out.select(*other, *[F.col(f).alias(a) for f, a in alias.items()])
    return out


def with_correlated(df: DataFrame, lookup: DataFrame, key: str, agg: Column, name: str) -> DataFrame:
    """``(SELECT agg FROM lookup l WHERE l.key = df.key)`` per row --
    decorrelated into a grouped aggregate (partial aggregation) and a left
    join, which is what Catalyst does with the SQL form."""
    return df.join(lookup.groupBy(key).agg(agg.alias(name)), key, "left")
