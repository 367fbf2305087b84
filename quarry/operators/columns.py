"""Projections, casts, filters and schema contracts (all plain expressions)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixed import MIN_TOKENS


def parse_columns(spec: str) -> list[str]:
    """Comma list of column names, split as given (no trimming)."""
    return spec.split(",")


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns in the given order; an unknown name raises ``AnalysisException``."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def cast_float(df: DataFrame, cols: list[str], safe: bool = False) -> DataFrame:
    """Cast the listed columns (label included) to float32 in one projection.

    With ANSI on, malformed text raises; ``safe=True`` turns it into NULL.
    """
    cast = (lambda c: F.col(c).try_cast("float")) if safe else (lambda c: F.col(c).cast("float"))
    return df.withColumns({c: cast(c) for c in cols})


def drop_if_present(df: DataFrame, names=("uuid", "datestr")) -> DataFrame:
    return df.drop(*names)


def infer_label(df: DataFrame) -> tuple[list[str], str]:
    """Label = last column, features = all others in order."""
    cols = df.columns
    return cols[:-1], cols[-1]


def normalise(df: DataFrame, col: str, lo: float, hi: float, name: str | None = None) -> DataFrame:
    """Affine map ``(x - lo) / (hi - lo)`` computed in float32 like the source.

    The input is first cast to float; Spark promotes the division to double,
    so the result is cast back to float at the end.
    """
    x = F.col(col).cast("float")
    val = ((x - F.lit(lo).cast("float")) / F.lit(hi - lo).cast("float")).cast("float")
    return df.withColumn(name or f"{col}_norm", val)


def project_only(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Map rows and drop every input column."""
    return df.select(*[e.alias(n) for n, e in exprs.items()])


def keep_inputs(df: DataFrame, cols=("input_ids", "attention_mask")) -> DataFrame:
    return df.select(*cols)


def assemble(df: DataFrame, feature_cols: list[str], name: str = "features") -> DataFrame:
    """Stack feature columns into one ``array<float>`` column."""
    return df.withColumn(name, F.array(*[F.col(c) for c in feature_cols]).cast("array<float>"))


def filter_length(df: DataFrame, col: str = "input_ids", lo: int = MIN_TOKENS, hi: int = 2048) -> DataFrame:
    """Keep rows with ``lo <= size(col) <= hi`` (both ends inclusive)."""
    return df.where(F.size(col).between(lo, hi))


@dataclass(frozen=True)
class ColumnSpec:
    """One declared model input/output: name, element type, fixed length (or None)."""

    name: str
    element_type: T.DataType
    length: int | None = None


def check_contract(df: DataFrame, contract: list[ColumnSpec]) -> DataFrame:
    """Violations of a declared schema contract as rows ``(column, problem, n_rows)``.

    Names and types are compared on the driver from the schema; fixed
    lengths are counted in one distributed aggregate over all columns.
    """
    spark = df.sparkSession
    fields = {f.name: f.dataType for f in df.schema.fields}
    static, counted = [], []
    for spec in contract:
        dt = fields.get(spec.name)
        if dt is None:
            static.append((spec.name, "missing", None))
            continue
        elem = dt.elementType if isinstance(dt, T.ArrayType) else dt
        if elem != spec.element_type:
            static.append((spec.name, f"type {elem.simpleString()} != {spec.element_type.simpleString()}", None))
        if spec.length is not None:
            if not isinstance(dt, T.ArrayType):
                static.append((spec.name, "not an array", None))
            else:
                counted.append(spec)
    schema = "column string, problem string, n_rows bigint"
    out = spark.createDataFrame(static, schema)
    if counted:
        agg = df.agg(
            *[F.count_if(F.coalesce(F.size(s.name), F.lit(-1)) != s.length).alias(s.name) for s in counted]
        )
        stacked = agg.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(s.name).alias("column"), F.lit(f"length != {s.length}").alias("problem"), F.col(s.name).alias("n_rows"))
                        for s in counted
                    ]
                )
            ).alias("v")
        ).select("v.*")
        out = out.unionByName(stacked.where(F.col("n_rows") > 0))
    return out


def describe(df: DataFrame) -> tuple[str, list]:
    """Schema string and the first row (one-row job)."""
    return df.schema.simpleString(), df.limit(1).collect()
