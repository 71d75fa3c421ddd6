"""Explicit schemas; nothing is inferred from the data."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


RAW_CALL = T.StructType(
    _strings("phone_out", "phone_in", "cell_tower") + [T.StructField("time", T.TimestampType())]
)
RAW_BROWSE = T.StructType(
    _strings("phone_number", "cell_tower", "host_name", "site_name")
    + [T.StructField("time", T.TimestampType())]
)
RAW = {"cdr": RAW_CALL, "seq": RAW_BROWSE}

BRONZE_CALL_COLUMNS = ["phone_hash_out", "phone_hash_in", "cell_tower", "time", "par_day", "par_hour"]
BRONZE_BROWSE_COLUMNS = [
    "phone_hash", "cell_tower", "host_name", "site_name", "time", "par_day", "par_hour",
]

PHONE_DIMENSION = T.StructType(_strings("phone", "hash") + [T.StructField("created_at", T.TimestampNTZType())])

EVENT = T.StructType(
    _strings("pipelineId", "eventType")
    + [T.StructField("timestamp", T.LongType())]
    + _strings("message", "date", "scheduleId")
)
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
MACHINE_READING = T.StructType(
    _strings("machine_id", "timestamp")
    + [T.StructField(n, T.DoubleType()) for n in ("temperature", "vibration", "pressure")]
    + _strings("environment")
)
WEATHER_READING = T.StructType(
    _strings("station_id")
    + [T.StructField(n, T.DoubleType()) for n in ("temperature_c", "humidity_pct", "quality")]
    + _strings("timestamp")
)
# metrics stay text until the quality gate has looked at them
MODEL_ARTIFACT = T.StructType(
    _strings("model_version", "accuracy", "loss", "epochs", "training_rows", "weights_hash", "trained_at")
)
FEATURE_COLUMNS = [
    "age", "income", "credit_score", "employment_years", "debt_ratio", "num_accounts", "label",
]
FEATURE_ROW = T.StructType(_strings(*FEATURE_COLUMNS))
