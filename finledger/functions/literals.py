"""Small literal tables (charts, specifications) as DataFrames the planner sees as local data."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """``rows`` written in the program as a DataFrame. Its size is fixed by the source text."""
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow))
