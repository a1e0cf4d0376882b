"""Fixed schemas of the tables that pass between operators."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


WARC_FIELDS = (
    "warc_filename", "warc_date", "warc_record_id", "warc_ip_address", "warc_payload_digest",
    "warc_block_digest", "content_length", "http_date", "http_server", "http_last_modified",
)
PROVENANCE = _strings(*WARC_FIELDS)

BLOCK = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        *[T.StructField(n, _S) for n in ("tag", "text", "own_text", "src", "alt", "xpath")],
        T.StructField("in_nav", T.BooleanType()),
    ]
)

ENTITY = _strings("name", "type")
ENTITY_SOURCE_FIELDS = ("url", "warc_filename", "warc_date", "warc_record_id", "extracted_at")
ENTITY_LINE = T.StructType(
    [T.StructField("entity", ENTITY), T.StructField("source", _strings(*ENTITY_SOURCE_FIELDS))]
)

# ``payload`` keeps the whole annotation as JSON text without ``id`` and ``created``.
COLLECTION = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("label", _S),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType([T.StructField("id", _S), T.StructField("items", T.ArrayType(_S))])
            ),
        ),
    ]
)

CHECKPOINT = T.StructType(
    [
        T.StructField("url", _S),
        T.StructField("html", _S),
        T.StructField("heuristic_decision", T.BooleanType()),
        *[T.StructField(n, _S) for n in ("llm_decision", "processed_html", "generated_annotation")],
    ]
)
