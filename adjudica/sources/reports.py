"""JSON reports with keys in sorted order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType, StructType
from pyspark.sql.types import BooleanType, MapType


def _sorted(c: Column, dtype: DataType) -> Column:
    """Struct fields in name order at every level; types JSON lacks become text."""
    if isinstance(dtype, StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        inner = F.struct(*[_sorted(c.getField(f.name), f.dataType).alias(f.name) for f in fields])
        return F.when(c.isNotNull(), inner)
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda x: _sorted(x, dtype.elementType))
    if isinstance(dtype, MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(c)))
    if isinstance(dtype, (NumericType, BooleanType, StringType)):
        return c
    return c.cast("string")


def sorted_keys(df: DataFrame) -> DataFrame:
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return df.select(*[_sorted(F.col(f.name), f.dataType).alias(f.name) for f in fields])


def report_json(df: DataFrame, pretty: bool = True) -> DataFrame:
    """(value): one JSON document per row, nulls kept."""
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    ordered = sorted_keys(df)
    return ordered.select(F.to_json(F.struct(*ordered.columns), options).alias("value"))


def write_report(df: DataFrame, path: str, lines: bool = False) -> None:
    """Replace the folder by the report. A one-row frame is an indented document;
    ``lines`` writes a table as one compact document per line, in parallel."""
    if lines:
        report_json(df, pretty=False).write.mode("overwrite").text(path)
    else:
        documents = report_json(df).limit(2).collect()
        if len(documents) > 1:
            raise ValueError("a frame of several rows is not one document: write it with lines=True")
        df.sparkSession.createDataFrame(documents, "value string").coalesce(1).write.mode("overwrite").text(path)


def read_report(
    spark: SparkSession, path: str, schema: StructType | str, lines: bool = False
) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=not lines)
