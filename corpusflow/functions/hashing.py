"""Hash and identifier column functions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 4122 URL namespace (fixed value) used for point ids.
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"
# Keys never part of a record hash (fixed values).
HASH_EXCLUDE = ("content_hash", "contentHash")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(m, exclude=HASH_EXCLUDE) -> Column:
    """md5 of a record's values ordered by key name.

    ``m`` is a MAP<STRING,STRING> of the raw record (unknown fields kept). Null
    values count as ''. ``concat_ws`` is not used: it would skip nulls.
    """
    excl = F.array(*[F.lit(x) for x in exclude])
    kept = F.map_filter(_col(m), lambda k, v: ~F.array_contains(excl, k))
    vals = F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.coalesce(e["value"], F.lit("")))
    return F.md5(F.array_join(vals, "|"))


def chunk_id(doc_id, chunk) -> Column:
    """First 24 hex digits of sha256('{doc_id}|{chunk}')."""
    return F.substring(F.sha2(F.concat(_col(doc_id).cast("string"), F.lit("|"), _col(chunk)), 256), 1, 24)


def text_hash(normalized) -> Column:
    """sha1 hex of already-normalized text."""
    return F.sha1(_col(normalized))


def uuid5(name) -> Column:
    """RFC 4122 version-5 UUID of a string in the URL namespace, natively."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL_HEX)), F.encode(_col(name), "UTF-8")))
    variant = F.lower(F.lpad(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int")
                                     .bitwiseAND(63).bitwiseOR(128)), 2, "0"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.concat(F.lit("5"), F.substring(h, 14, 3)),
                       F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


def point_id(doc_id, version) -> Column:
    """Vector point id (P10): uuid5(URL, 'doc:{doc_id}|v{version}')."""
    v = version if isinstance(version, Column) else F.lit(str(version))
    return uuid5(F.concat(F.lit("doc:"), _col(doc_id).cast("string"), F.lit("|v"), v.cast("string")))


def item_hash_id(item_sequence, name) -> Column:
    """md5 of '{item_sequence}-{name}' (P11); a missing part reads 'None' as in
    Python string formatting."""
    return F.md5(F.concat(F.coalesce(_col(item_sequence).cast("string"), F.lit("None")), F.lit("-"),
                          F.coalesce(_col(name).cast("string"), F.lit("None"))))
