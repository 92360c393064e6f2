"""The symbol dimension and joins with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import base_asset, quote_asset
from tidelake.operators.filters import strangers
from tidelake.operators.ranks import SINGLE_TASK_ROWS, row_numbers
from tidelake.operators.skew import broadcast_checked
from tidelake.schemas import DIM_SYMBOLS
from tidelake.session import materialize


def distinct_codes(df: DataFrame, column: str = "symbol") -> DataFrame:
    code = F.col(column)
    return df.filter(code.isNotNull() & (code != "")).select(code.alias("symbol_code")).distinct()


def split_codes(codes: DataFrame) -> DataFrame:
    return codes.select(
        "symbol_code",
        base_asset("symbol_code").alias("base_asset"),
        quote_asset("symbol_code").alias("quote_asset"),
    )


def assign_ids(
    existing: DataFrame, codes: DataFrame, single_task_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """(symbol_id, symbol_code): known codes keep their id, new ones follow the highest.

    Only new codes are numbered, in code order, so ids never move between runs.
    """
    known = existing.select("symbol_id", "symbol_code")
    new = materialize(strangers(codes.select("symbol_code"), known, "symbol_code"), "new-codes")
    top = known.agg(F.coalesce(F.max("symbol_id"), F.lit(0).cast("long"))).first()[0]
    numbered = row_numbers(
        new, [F.col("symbol_code")], name="_n", single_task=new.count() <= single_task_rows
    )
    fresh = numbered.select((F.col("_n") + F.lit(top)).alias("symbol_id"), "symbol_code")
    return known.unionByName(fresh)


def build_dim(
    existing: DataFrame,
    codes: DataFrame,
    now: Column | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Upsert discovered codes into the dimension.

    Found codes get fresh base and quote assets and a new ``updated_at``; ``created_at``
    and the id stay. Codes not found this time are left as they are.
    """
    now = F.current_timestamp() if now is None else now
    found = split_codes(codes).withColumn("_seen", F.lit(True))
    ids = assign_ids(existing, codes, single_task_rows)
    old = existing.select(
        "symbol_code",
        F.col("base_asset").alias("_base"),
        F.col("quote_asset").alias("_quote"),
        F.col("created_at").alias("_created"),
        F.col("updated_at").alias("_updated"),
    )
    seen = F.coalesce(F.col("_seen"), F.lit(False))
    return (
        ids.join(found, "symbol_code", "left")
        .join(old, "symbol_code", "left")
        .select(
            "symbol_id",
            "symbol_code",
            F.when(seen, F.col("base_asset")).otherwise(F.col("_base")).alias("base_asset"),
            F.when(seen, F.col("quote_asset")).otherwise(F.col("_quote")).alias("quote_asset"),
            F.coalesce("_created", now).alias("created_at"),
            F.when(seen, now).otherwise(F.col("_updated")).alias("updated_at"),
        )
        .select(*[F.col(f.name).cast(f.dataType) for f in DIM_SYMBOLS])
    )


def with_symbol_id(fact: DataFrame, dim: DataFrame, code: str = "symbol") -> DataFrame:
    """Replace the code of ``fact`` by its id; rows of unknown symbols are left out.

    The dimension goes to every executor only if its counted size allows it.
    """
    lookup = broadcast_checked(dim.select("symbol_id", F.col("symbol_code").alias(code)))
    return fact.join(lookup, code, "inner").drop(code)


def unknown_symbols(fact: DataFrame, dim: DataFrame, code: str = "symbol") -> DataFrame:
    """Reject table: rows :func:`with_symbol_id` leaves out."""
    return strangers(fact, dim, code, "symbol_code")
