"""Types of text columns, found by looking at every value once.

Each value has the narrowest type that can hold it. Types form a lattice, and a column has the
join of its values' types, an aggregate that combines before it moves: integers widen to bigint
and to double, dates to timestamps, and whatever does not meet otherwise meets as text.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: One bit per type a value can have.
BITS = {"int": 1, "bigint": 2, "double": 4, "boolean": 8, "date": 16, "timestamp_ntz": 32,
        "string": 64}
WHOLE_NUMBER, NUMBER = r"^[+-]?\d+$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DAY = r"^\d{4}-\d\d-\d\d$"
MOMENT = r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d(:\d\d(\.\d{1,6})?)?$"


def value_bit(name: str) -> Column:
    """Bit of the narrowest type of a text; 0 for a missing or empty one."""
    c = F.col(name)
    fits = lambda kind: c.try_cast(kind).isNotNull()
    bit = lambda kind: F.lit(BITS[kind])
    return (
        F.when(c.isNull() | (c == ""), F.lit(0))
        .when(c.rlike(WHOLE_NUMBER),
              F.when(fits("int"), bit("int")).when(fits("bigint"), bit("bigint"))
              .otherwise(bit("double")))
        .when(c.rlike(NUMBER), bit("double"))
        .when(c.rlike(DAY) & fits("date"), bit("date"))
        .when(c.rlike(MOMENT) & fits("timestamp_ntz"), bit("timestamp_ntz"))
        .when(F.lower(c).isin("true", "false"), bit("boolean"))
        .otherwise(bit("string"))
    )


def joined_type(bits: Column) -> Column:
    """Name of the join of all types whose bits are set; ``void`` if there are none."""
    within = lambda *kinds: bits.bitwiseAND(F.lit(127 - sum(BITS[k] for k in kinds))) == 0
    return (
        F.when(bits == 0, "void").when(within("int"), "int").when(within("int", "bigint"), "bigint")
        .when(within("int", "bigint", "double"), "double").when(within("boolean"), "boolean")
        .when(within("date"), "date").when(within("date", "timestamp_ntz"), "timestamp_ntz")
        .otherwise("string")
    )


def column_types(texts: Mapping[str, DataFrame]) -> DataFrame:
    """source, position, column_name, data_type for the columns of several text tables.

    One job: every table is scanned once, and sends one number per column and task.
    """
    parts = []
    for source, df in texts.items():
        bits = df.agg(*[F.bit_or(value_bit(c)).alias(f"b{i}") for i, c in enumerate(df.columns)])
        listed = F.array(*[
            F.struct(F.lit(source).alias("source"), F.lit(i).alias("position"),
                     F.lit(c).alias("column_name"),
                     joined_type(F.coalesce(f"b{i}", F.lit(0))).alias("data_type"))
            for i, c in enumerate(df.columns)
        ])
        parts.append(bits.select(F.inline(listed)))
    return reduce(DataFrame.unionByName, parts)


def header_schema(spark: SparkSession, path: str) -> StructType:
    """Columns as the header names them, all text; reads the first line of a file."""
    return spark.read.options(header=True, quote='"', escape='"').csv(path).schema


def schema_of(types: DataFrame) -> StructType:
    """Schema from the types of one source (one row per column); columns without values are text."""
    listed = types.orderBy("position").collect()
    return StructType.fromDDL(", ".join(
        f"`{r.column_name}` {'string' if r.data_type == 'void' else r.data_type}" for r in listed
    ))
