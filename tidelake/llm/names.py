"""Column names of the caller beside those of an operator."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(label: str, taken: Iterable[str]) -> str:
    """A name like ``label`` that no column in ``taken`` has, whatever its case."""
    low, n, name = {t.lower() for t in taken}, 0, label
    while name.lower() in low:
        n += 1
        name = f"{label}{n}"
    return name


def own_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators whose columns of their own begin with an underscore and which return the
    columns of ``docs``, their first argument: columns of ``docs`` with such names have others
    while the operator works, unless an argument names them."""
    signature = inspect.signature(operator)

    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        bound = signature.bind(docs, *args, **options)
        bound.apply_defaults()
        named = {v for v in bound.arguments.values() if isinstance(v, str)}
        there, taken = {}, list(docs.columns)
        for c in docs.columns:
            if c.startswith("_") and c not in named:
                there[c] = fresh("kept", taken)
                taken.append(there[c])
        if not there:
            return operator(docs, *args, **options)
        back = {new: old for old, new in there.items()}
        out = operator(docs.withColumnsRenamed(there), *args, **options)
        return out.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in out.columns])

    return run


def row_mark(df: DataFrame) -> Column:
    """A bigint that differs where any column of ``df`` does: 64 bits of XXH64 stand for a row."""
    def plain(field):
        column = F.col(f"`{field.name}`")
        simple = "map<" not in field.dataType.simpleString()
        return column if simple else F.to_json(F.struct(column))

    columns = [F.col(f"`{name}`") for name in df.columns]
    # a NULL leaves the hash as it was, so that it stands there is hashed too
    return F.xxhash64(*map(plain, df.schema.fields), *[c.isNull() for c in columns])


def join_marked(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` with the row of ``rows`` (_key, _mark, further columns) that has their
    key and mark. Always a join by sorting, which spills where it must and costs the same share
    of any input."""
    marked = df.withColumn("_at", row_mark(df))
    listed = rows.hint("merge")
    return marked.join(
        listed, (F.col("_at") == F.col("_mark")) & F.col(f"`{key}`").eqNullSafe(F.col("_key"))
    ).drop("_at")
