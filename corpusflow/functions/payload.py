"""Payload column builders (P12, P13) and the record parser spec."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_SCHEMA = "chunk_id string, item_sequence string, name string, contents string, meta map<string,string>"
PAYLOAD_SCHEMA = "docId string, itemSequence string, name string, contents string, meta map<string,string>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def index_payload(doc_id, dataset_type: str, version: int, chunk_count, chunk_size: int, overlap: int) -> Column:
    """Payload stored with an indexed point."""
    cc = chunk_count if isinstance(chunk_count, Column) else F.lit(int(chunk_count))
    return F.struct(F.lit(dataset_type).alias("type"), _col(doc_id).cast("string").alias("docId"),
                    F.lit(int(version)).alias("embeddingVersion"), cc.cast("int").alias("chunkCount"),
                    F.lit(int(chunk_size)).alias("chunkSize"), F.lit(int(overlap)).alias("overlap"))


def chunk_payload(chunk_id, item_sequence, name, contents, meta) -> Column:
    """JSON payload of a chunk (P13, build side)."""
    return F.to_json(F.struct(_col(chunk_id).alias("docId"), _col(item_sequence).alias("itemSequence"),
                              _col(name).alias("name"), _col(contents).alias("contents"),
                              _col(meta).alias("meta")))


def resolve_chunk(payload_json) -> Column:
    """Chunk struct back from a payload (P13, V8): contents defaults to '',
    meta to {}; ``_missing`` lists the absent required fields."""
    p = F.from_json(_col(payload_json), PAYLOAD_SCHEMA)
    missing = F.filter(F.array(*[F.when(p[k].isNull(), F.lit(k)) for k in ("docId", "itemSequence", "name")]),
                       lambda x: x.isNotNull())
    return F.struct(p["docId"].alias("chunk_id"), p["itemSequence"].alias("item_sequence"),
                    p["name"].alias("name"), F.coalesce(p["contents"], F.lit("")).alias("contents"),
                    F.coalesce(p["meta"], F.create_map().cast("map<string,string>")).alias("meta"),
                    F.when(p.isNull(), F.array(F.lit("payload"))).otherwise(missing).alias("_missing"))


@dataclass(frozen=True)
class FieldSpec:
    """One output field of a record parser: accepted under ``alias`` or ``name``."""
    name: str
    alias: str | None = None
    required: bool = False


@dataclass(frozen=True)
class RecordSpec:
    """Declarative record parser (the reference's item model)."""
    fields: tuple = field(default_factory=tuple)
    hash_field: str = "row_hash"


# The default item model (fixed values): required id (alias ITEM_SEQ),
# optional name (ITEM_NAME) and vendor (ENTP_NAME).
DEFAULT_SPEC = RecordSpec(fields=(FieldSpec("id", "ITEM_SEQ", True), FieldSpec("name", "ITEM_NAME"),
                                  FieldSpec("vendor", "ENTP_NAME")))
