"""CSV scans with an explicit missing-marker mode (A1-A4).

The token ``NA`` means both "missing" and "no such feature" in the housing
files. Spark's CSV reader keeps it as the literal string (and then infers a
string type for numeric columns); pandas and R read it as null. Both modes
are offered:

* ``na_mode="literal"`` keeps ``"NA"`` as a value (the Spark job's view),
* ``na_mode="null"`` maps ``"NA"`` to null (the notebook/R view).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

NA_TOKEN = "NA"


def read_csv(spark: SparkSession, path: str | list[str], *,
             na_mode: str = "literal", schema: StructType | str | None = None,
             sep: str = ",", header: bool = True) -> DataFrame:
    """Read CSV files (local, ``s3a://``, ``hdfs://`` ... any Hadoop path).

    With ``schema`` given no inference job runs; at scale pass one.
    """
    if na_mode not in ("literal", "null"):
        raise ValueError("na_mode must be 'literal' or 'null'")
    reader = spark.read.option("header", header).option("sep", sep)
    if na_mode == "null":
        reader = reader.option("nullValue", NA_TOKEN)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)
