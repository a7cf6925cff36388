"""Row shapes shared by all operators, and the fixed names of the message model."""

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())

MESSAGE = T.StructType([
    T.StructField("msg_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("channel", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("metadata", STRING_MAP),
])

# Where a trigger can come from.
SOURCE_EVENTBRIDGE = "eventbridge"
SOURCE_POLLING = "s3-polling"
SOURCE_GENERATE = "generate"
SOURCE_SQS = "sqs"
SOURCE_FILE = "file"

# Header names a publisher must not forward.
RESERVED_HEADERS = [
    "jetstream_stream",
    "jetstream_consumer",
    "jetstream_sequence_stream",
    "jetstream_sequence_consumer",
    "jetstream_pending",
    "jetstream_delivered",
    "jetstream_timestamp",
]

# Message-descriptor defaults and limits.
DESCRIPTOR_FORMAT = "MQSTR"
DESCRIPTOR_CCSID = 1208
DESCRIPTOR_ENCODING = 546
CORRELATION_ID_BYTES = 24
MAX_PRIORITY = 9

DEFAULT_TRIGGER_BATCH = 10
DEFAULT_BATCH_WAIT_MS = 100
