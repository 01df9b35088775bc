"""Declared schemas and fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T

CITATION = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
    ]
)

AUDIT_RECORD = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("confidence_band", T.StringType()),
        T.StructField("top_score", T.DoubleType()),
        T.StructField("escalated", T.BooleanType()),
        T.StructField("citations", T.ArrayType(CITATION)),
    ]
)

EVAL_CASE = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("expected_source", T.StringType()),
        T.StructField("expected_answer_contains", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("should_escalate", T.BooleanType()),
        T.StructField("is_out_of_scope", T.BooleanType()),
    ]
)

INCIDENT_LABEL = T.StructType(
    [
        T.StructField("severity", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("regulatory_flag", T.BooleanType()),
        T.StructField("urgency_note", T.StringType()),
    ]
)

# Fixed values.
SEVERITIES = ["critical", "high", "standard"]
CATEGORIES = [
    "fall",
    "medication_error",
    "behaviour",
    "pressure_injury",
    "choking",
    "infection",
    "missing_resident",
    "near_miss",
    "other",
]
URGENCY_NOTE_WORDS = 20
BANDS = ["High", "Medium", "Escalated"]
