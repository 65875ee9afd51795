"""Schemas shared by sources, operators and sinks (DDL strings)."""

# One message of a partitioned log: the column set of Spark's Kafka source with
# key and value cast to string, so the same operators run on Kafka and parquet.
# (The parquet log keeps its source's timestamp type, timestamp_ntz here.)
MESSAGE = (
    "topic string, partition int, offset bigint, key string, value string, "
    "timestamp timestamp"
)

# Half-open consumed range [from_offset, until_offset) of one log partition.
OFFSET_RANGE = "topic string, partition int, from_offset bigint, until_offset bigint"

# Next offset to read, per consumer group and log partition.
OFFSETS = "group_id string, topic string, partition int, offset bigint"

# Append-only history of committed offsets; the current view is its latest row.
OFFSETS_LOG = OFFSETS + ", batch_id bigint"

# Keyed upsert target (key ``order_id``).
UPSERT_ROW = "order_id string, name string"

# Appended rows carry their log coordinates so offsets derive from them.
APPEND_ROW = "name string, id bigint, topic string, partition int, offset bigint"

WORD_COUNT = "word string, n bigint"

MESSAGE_COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp"]
PARTITION_KEY = ["topic", "partition"]
