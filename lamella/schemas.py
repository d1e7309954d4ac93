"""Schemas of the records the engine reads and writes; nothing is ever inferred."""

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


DOCUMENT = _struct(doc_id=_S, source_file=_S, text=_S, lang=_S, char_count=_I)
CHUNK = _struct(chunk_id=_S, doc_id=_S, source_file=_S, text=_S, page_start=_I, page_end=_I)
METADATA = _struct(
    chunk_id=_S, doc_id=_S, source_file=_S, page_start=_I, page_end=_I, pii_redacted=_B, regulatory_tagged=_B, regulatory_keywords_found=T.ArrayType(_S), regulatory_density_score=_D, quality_classifier_label=_S
)
CURATED = _struct(text=_S, metadata=METADATA)
STAGE_RECORD = _struct(stage=_S, docs_in=_L, docs_out=_L, removed=_L, reason_counts=T.MapType(_S, _L))
