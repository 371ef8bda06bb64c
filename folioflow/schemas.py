"""Fixed schemas of the feed, the papers, the vectors, the results and the run log."""

from pyspark.sql import types as T

FEED_ENTRY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("category", T.ArrayType(T.StructType([T.StructField("_term", T.StringType())]))),
    T.StructField("link", T.ArrayType(T.StructType([
        T.StructField("_href", T.StringType()),
        T.StructField("_rel", T.StringType()),
        T.StructField("_type", T.StringType()),
    ]))),
])

COLLECTED_PAPER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("published_date", T.TimestampType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("raw_xml", T.StringType()),
    T.StructField("url", T.StringType()),
])

# Columns of the binary file source; a stream has to state them.
BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# One row per record of a landing file, or one row with file_error for a file that failed.
LANDED_RECORD = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("file_time", T.TimestampType()),
    T.StructField("block_start", T.LongType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("element_no", T.LongType()),
    T.StructField("record_key", T.StringType()),
    T.StructField("record", T.StringType()),
    T.StructField("record_error", T.StringType()),
    T.StructField("file_error", T.StringType()),
])

PAPER = T.StructType([
    T.StructField("paper_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("published_date", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("raw_xml", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("batch_timestamp", T.TimestampType()),
    T.StructField("processing_status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

EMBEDDING_RESULT = T.StructType([
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("model_version", T.StringType()),
    T.StructField("dimension", T.IntegerType()),
    T.StructField("processing_time_ms", T.LongType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

VECTOR_RECORD = T.StructType([
    T.StructField("paper_id", T.StringType()),
    T.StructField("vector_type", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("embedding_metadata", T.StructType([
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("dimension", T.IntegerType()),
        T.StructField("text_length", T.IntegerType()),
        T.StructField("preprocessing", T.StringType()),
    ])),
    T.StructField("source_text", T.StructType([
        T.StructField("content", T.StringType()),
        T.StructField("source_fields", T.ArrayType(T.StringType())),
        T.StructField("language", T.StringType()),
    ])),
    T.StructField("processing_info", T.StructType([
        T.StructField("created_at", T.TimestampType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("processing_time_ms", T.LongType()),
    ])),
])

RUN_LOG_LINE = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("data_count", T.IntegerType()),
    T.StructField("error", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("code", T.StringType()),
    ])),
    T.StructField("metadata", T.StringType()),
    T.StructField("corrupt_line", T.StringType()),
])
