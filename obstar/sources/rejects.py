"""What loads refused, kept below the warehouse.

    <root>/rejects/records/<batch>/…        fields of records, with the record's text
    <root>/rejects/observations/<batch>/…   staged observations without one of their keys

A batch that is loaded again writes its folder anew, so nothing is told twice.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obstar.schemas import DONNEES_METEO

RECORDS, OBSERVATIONS = "records", "observations"
_LOAD = [T.StructField("batch", T.StringType()), T.StructField("commit", T.LongType())]
_TEXTS = [T.StructField(c, T.StringType()) for c in ("source", "text", "field", "reason")]
SCHEMAS = {
    RECORDS: T.StructType([*_TEXTS, *_LOAD]),
    OBSERVATIONS: T.StructType(
        [*DONNEES_METEO.fields, T.StructField("failed_keys", T.StringType()), *_LOAD]
    ),
}


def write(rows: DataFrame, root: str, kind: str, batch: str, commit: int | None) -> DataFrame:
    """Store what a batch refused; `commit` is the one that has the rest of it, if any."""
    schema = SCHEMAS[kind]
    path = f"{root}/rejects/{kind}/{re.sub('[^A-Za-z0-9-]', '_', batch)}"
    told = rows.withColumns({"batch": F.lit(batch), "commit": F.lit(commit).cast("bigint")})
    told.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode(
        "overwrite"
    ).parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def read(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All that was refused so far."""
    stored = spark.read.schema(SCHEMAS[kind]).option("recursiveFileLookup", "true")
    try:
        return stored.parquet(f"{root}/rejects/{kind}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMAS[kind])
