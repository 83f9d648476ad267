"""Result tables as Parquet, CSV or JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def write_artifacts(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """CSV has a header, UTF-8 and nested columns as JSON text; JSON is one object per line."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    elif fmt == "json":
        df.write.mode(mode).option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        flat = [
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
            for f in df.schema.fields
        ]
        df.select(flat).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
