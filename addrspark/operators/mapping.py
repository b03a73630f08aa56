"""Fit documents to the schema of the target index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark.functions.once import evaluate_once
from addrspark.functions.text import keyword, real_number, whole_number


def _member(source: T.DataType, name: str) -> T.DataType | None:
    if isinstance(source, T.StructType) and name in source.fieldNames():
        return source[name].dataType
    return None


def _fitted(value: Column, kind: T.DataType, source: T.DataType) -> Column:
    """``value`` cast to ``kind``; what does not fit becomes null."""
    if source == kind:
        return value
    if isinstance(kind, T.ArrayType):
        item_type = source.elementType if isinstance(source, T.ArrayType) else T.NullType()
        return F.transform(value, lambda item: _fitted(item, kind.elementType, item_type))
    if isinstance(kind, T.StructType):
        members = []
        for f in kind.fields:
            inner = _member(source, f.name)
            fit = F.lit(None).cast(f.dataType) if inner is None else _fitted(value.getField(f.name), f.dataType, inner)
            members.append(fit.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(kind, T.LongType):
        return whole_number(value)
    if isinstance(kind, T.StringType):
        return value.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return real_number(value, kind)
    return value.try_cast(kind)


def _lost(value: Column, kind: T.DataType, source: T.DataType) -> Column | None:
    """True when some leaf has a value that does not fit its type; None when that cannot happen."""
    if source == kind or isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.ArrayType):
        item_type = source.elementType
        if _lost(F.lit(None), kind.elementType, item_type) is None:
            return None
        return F.coalesce(F.exists(value, lambda item: _lost(item, kind.elementType, item_type)), F.lit(False))
    if isinstance(kind, T.StructType):
        inner = [(f, _member(source, f.name)) for f in kind.fields]
        lost = [_lost(value.getField(f.name), f.dataType, t) for f, t in inner if t is not None]
        known = [term for term in lost if term is not None]
        return reduce(Column.__or__, known) if known else None
    return value.isNotNull() & _fitted(value, kind, source).isNull()


def apply_mapping(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows cast to the schema, rows where a value does not fit, with the field names in ``reason``).

    A field the frame lacks becomes null; columns outside the schema are left out of the good rows.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType) and not isinstance(have.get(f.name, f.dataType), T.ArrayType):
            raise ValueError(f"{f.name!r} is {have[f.name].simpleString()}, the mapping wants an array")
    lost = {f.name: _lost(F.col(f.name), f.dataType, have[f.name]) for f in schema.fields if f.name in have}
    terms = [F.when(term, F.lit(name)) for name, term in lost.items() if term is not None]
    made = {
        f"fitted_{f.name}": _fitted(F.col(f.name), f.dataType, have[f.name])
        if f.name in have
        else F.lit(None).cast(f.dataType)
        for f in schema.fields
    }
    made["misfits"] = F.concat_ws(",", *terms) if terms else F.lit("")
    tried = evaluate_once(df, made)
    good = tried.filter(F.col("misfits") == "").select(
        *[F.col(f"fitted_{f.name}").alias(f.name) for f in schema.fields]
    )
    reason = F.concat(F.lit("does not fit: "), F.col("misfits"))
    rejects = tried.filter(F.col("misfits") != "").select(*df.columns, reason.alias("reason"))
    return good, rejects


def with_keywords(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Add ``<field>_keyword`` for exact matching; values longer than the limit are not kept there.

    ``outer.inner`` names a field of a struct or of the structs of an array; the keyword is added beside it.
    """
    for name, limit in limits.items():
        outer, *inner = name.split(".")
        if outer not in df.columns:
            continue
        if inner:
            df = df.withColumn(outer, _beside(F.col(outer), df.schema[outer].dataType, inner, limit))
        else:
            df = df.withColumn(f"{outer}_keyword", keyword(F.col(outer), limit))
    return df


def _beside(value: Column, kind: T.DataType, path: list[str], limit: int) -> Column:
    """``value`` with the keyword of the field at ``path``."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _beside(item, kind.elementType, path, limit))
    field = value.getField(path[0])
    if len(path) == 1:
        return value.withField(f"{path[0]}_keyword", keyword(field, limit))
    return value.withField(path[0], _beside(field, kind[path[0]].dataType, path[1:], limit))
