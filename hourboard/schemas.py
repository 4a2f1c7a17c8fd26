"""Table shapes: request log, signage dimension, target table, run log."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("httpRequest", T.StructType([T.StructField("requestUrl", T.StringType())])),
    ]
)

SIGNAGE_SCHEMA = T.StructType(
    [
        T.StructField("fully_device_id", T.StringType()),
        T.StructField("opening_time", T.StringType()),
        T.StructField("closing_time", T.StringType()),
    ]
)

# Group keys of the target, in table order. All but the hour come from the URL.
INT_PARAMS = ("mediumId", "storeId", "programId", "sequence", "creativeId", "deliveryId")
KEYS = (
    "timestamp_hourly",
    "mediumId",
    "storeId",
    "device_id",
    "programId",
    "sequence",
    "creativeId",
    "deliveryId",
)
MEASURES = ("imp", "cnt")
CLUSTER_KEYS = ("mediumId", "storeId", "creativeId")
TARGET_COLUMNS = (*KEYS, *MEASURES, "dt")


def target_schema(timestamp_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Target columns in table order, the partition column ``dt`` last."""
    kinds = {"timestamp_hourly": timestamp_type, "device_id": T.StringType(), "dt": T.DateType()}
    return T.StructType(
        [T.StructField(name, kinds.get(name, T.LongType())) for name in TARGET_COLUMNS]
    )


RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("process_date", T.DateType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def is_ntz(frame: DataFrame, column: str) -> bool:
    """Whether a timestamp column is zone-less (taken as UTC wall clock) or an instant."""
    kind = frame.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return True
    if isinstance(kind, T.TimestampType):
        return False
    raise TypeError(f"{column} must be a timestamp, found {kind.simpleString()}")
