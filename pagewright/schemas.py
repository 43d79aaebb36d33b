"""Schemas of the engine's tables."""

from pyspark.sql import types as T

BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("width", "height", "left", "top", "right", "bottom")])
RAW_BOX = T.StructType([T.StructField(n, T.DoubleType()) for n in ("Width", "Height", "Left", "Top")])
BLOCK = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("BlockType", T.StringType()),
        T.StructField("Text", T.StringType()),
        T.StructField("TextType", T.StringType()),
        T.StructField("Confidence", T.DoubleType()),
        T.StructField("Page", T.IntegerType()),
        T.StructField("RowIndex", T.IntegerType()),
        T.StructField("ColumnIndex", T.IntegerType()),
        T.StructField("Geometry", T.StructType([T.StructField("BoundingBox", RAW_BOX)])),
        T.StructField("Relationships", T.ArrayType(T.StructType([T.StructField("Type", T.StringType()), T.StructField("Ids", T.ArrayType(T.StringType()))]))),
    ]
)
OCR = T.StructType(
    [
        T.StructField("JobStatus", T.StringType()),
        T.StructField("DocumentMetadata", T.StructType([T.StructField("Pages", T.IntegerType())])),
        T.StructField("Blocks", T.ArrayType(BLOCK)),
    ]
)
CHUNK = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("source_doc_id", T.StringType()),
        T.StructField("chunk_text", T.StringType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("source_file_s3_uri", T.StringType()),
        T.StructField("chunk_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("bounding_box", BOX),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("case_ref", T.StringType()),
        T.StructField("received_date", T.TimestampNTZType()),
        T.StructField("correspondence_type", T.StringType()),
        T.StructField("page_contains_handwriting", T.BooleanType()),
    ]
)
PAGE = T.StructType(
    [
        T.StructField("source_doc_id", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("s3_page_image_s3_uri", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("page_width", T.DoubleType()),
        T.StructField("page_height", T.DoubleType()),
        T.StructField("received_date", T.TimestampNTZType()),
        T.StructField("correspondence_type", T.StringType()),
    ]
)
SEARCH_TERM = T.StructType([T.StructField(n, T.StringType()) for n in ("search_term", "acceptable_terms", "expected_page_number", "expected_chunk_id", "manual_identifications")])
