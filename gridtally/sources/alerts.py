"""Alert records: JSON rows of nine text fields.

Written as JSON lines these split across tasks; a file holding one JSON array
(``multiline=True``) is read whole by one task, so keep such files small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: alert record fields, all text in the file --------------
ALERT_FIELDS = ["enodeb", "site", "region", "alert_day", "event_day",
                "abnormal_kpi_count", "nrb_ticket_counts", "w360_ticket_counts", "vendor"]
ALERT_DAYS = ["alert_day", "event_day"]
ALERT_COUNTS = ["abnormal_kpi_count", "nrb_ticket_counts", "w360_ticket_counts"]
# ---------------------------------------------------------------------------

# Text of a line that is no JSON record.
CORRUPT = "corrupt_record"

ALERT_TEXT_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in ALERT_FIELDS])


def typed_alerts(df: DataFrame) -> DataFrame:
    """Days to ``date`` and counts to ``int``; bad text becomes NULL."""
    return df.select(*[
        F.try_to_date(F.col(f), "yyyy-MM-dd").alias(f) if f in ALERT_DAYS
        else F.col(f).try_cast("int").alias(f) if f in ALERT_COUNTS
        else F.col(f)
        for f in ALERT_FIELDS], *[c for c in df.columns if c == CORRUPT])


def read_alerts(spark: SparkSession, path: str, multiline: bool = False,
                keep_corrupt: bool = False) -> DataFrame:
    """Alert records with the declared schema (no inference), typed.

    A broken line is an error, unless ``keep_corrupt`` asks for its text in the
    column ``corrupt_record`` (NULL on good rows) beside NULL fields; then the
    caller decides.
    """
    reader = spark.read.option("multiLine", multiline)
    if not keep_corrupt:
        return typed_alerts(reader.schema(ALERT_TEXT_SCHEMA).option("mode", "FAILFAST").json(path))
    schema = T.StructType([*ALERT_TEXT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return typed_alerts(reader.schema(schema).option("mode", "PERMISSIVE")
                        .option("columnNameOfCorruptRecord", CORRUPT).json(path))
