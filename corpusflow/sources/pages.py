"""Paged API envelopes: JSON and XML page explode (S1, S2), page plan (S3),
record parsing with quarantine (P1)."""
from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.hashing import HASH_EXCLUDE, row_hash
from ..functions.payload import DEFAULT_SPEC, RecordSpec

RAW_PAGES_SCHEMA = "api_name string, run_date string, page_no int, format string, body string"


def _json_path(path) -> str:
    return "$" + "".join(f"['{p}']" for p in path)


def explode_json_pages(pages: DataFrame, records_path=("body", "items"),
                       total_path=("body", "totalCount"), body_col: str = "body",
                       keep_empty: bool = False) -> DataFrame:
    """One row per record of JSON pages (S1); with ``keep_empty`` also one for a page without records.

    Records at ``records_path``: missing/null -> none; a list -> its elements;
    an object whose ``item`` is a list -> that list; any other shape -> none,
    reported in ``shape_status``. Malformed JSON -> none, status 'malformed'.
    Output keeps the page columns plus ``record_idx``, ``record`` (VARIANT),
    ``total_count`` (string as sent).
    """
    v = F.try_parse_json(F.col(body_col))
    items = F.try_variant_get(v, _json_path(records_path), "variant")
    as_list = F.try_variant_get(items, "$", "array<variant>")
    item_list = F.try_variant_get(items, "$.item", "array<variant>")
    status = (F.when(v.isNull(), "malformed")
              .when(items.isNull() | F.is_variant_null(items), "missing")
              .when(as_list.isNotNull(), "list")
              .when(item_list.isNotNull(), "item_list")
              .otherwise("unexpected"))
    out = pages.select(
        *[c for c in pages.columns if c != body_col],
        F.try_variant_get(v, _json_path(total_path), "string").alias("total_count"),
        status.alias("shape_status"),
        F.coalesce(as_list, item_list, F.array().cast("array<variant>")).alias("_records"),
    )
    rows = out.select(*[c for c in out.columns if c != "_records"],
                      F.posexplode_outer("_records").alias("record_idx", "record"))
    return rows if keep_empty else rows \
        .where(F.col("record").isNotNull() | F.col("shape_status").isin("malformed", "unexpected"))


def _xml_pages(records_path: tuple[str, ...], total_path: tuple[str, ...]):
    """Column function: an XML page -> (total, records), read as a tree.

    A row is a page of many records, so the worker gets the 100 pages of a
    pickled batch at a time, not the thousands of an Arrow batch."""
    def read(body: str | None) -> dict:
        try:
            root = ElementTree.fromstring(body or "")
        except (ElementTree.ParseError, ValueError):
            return {"total": None, "records": []}
        total, holder = root.find("/".join(total_path)), root.find("/".join(records_path[:-1])) if len(records_path) > 1 else root
        items = [] if holder is None else holder.findall(records_path[-1])
        # The text before an element's first child: null where it holds elements only; of equal tags the last counts.
        return {"total": None if total is None else total.text, "records": [{c.tag: c.text for c in item} for item in items]}

    return F.udf(read, "struct<total: string, records: array<map<string, string>>>", useArrow=False)


def explode_xml_pages(pages: DataFrame, records_path=("body", "items", "item"),
                      total_path=("body", "totalCount"), body_col: str = "body", keep_empty: bool = False) -> DataFrame:
    """One row per record element of XML pages (S2): each record is a map of
    child tag -> text. A child that holds elements has the text before them,
    null if there is none: nested content is dropped. Paths start below the
    root, whatever its name. Bad XML -> no records, null total.
    """
    parsed = _xml_pages(tuple(records_path), tuple(total_path))(F.col(body_col))
    out = pages.withColumn("_page", parsed)
    total = F.trim(F.col("_page.total"))
    out = out.select(*[c for c in pages.columns if c != body_col], F.when(total != "", total).alias("total_count"),
                     F.col("_page.records").alias("_records"))
    return out.select(*[c for c in out.columns if c != "_records"],
                      (F.posexplode_outer if keep_empty else F.posexplode)("_records").alias("record_idx", "record_map"))


def plan_pages(totals: DataFrame, page_size: int = 100, batch_size: int = 100,
               total_col: str = "total_count") -> DataFrame:
    """Page plan (S3): pages 1..ceil(total/size) per API, grouped in batches.

    A digit string total is accepted; total <= 0 gives no pages. A total that
    is neither a number nor a digit string makes the plan fail (raise_error).
    """
    raw = F.col(total_col).cast("string")
    total = F.when(raw.rlike(r"^-?[0-9]+$"), raw.cast("long")) \
        .otherwise(F.raise_error(F.concat(F.lit("invalid total count: "), F.coalesce(raw, F.lit("null")))))
    n = F.when((total <= 0) | F.lit(page_size <= 0), F.lit(0)) \
        .otherwise(F.floor((total + page_size - 1) / page_size)).cast("int")
    keys = [c for c in totals.columns if c != total_col]
    return (totals.select(*keys, n.alias("page_count"))
            .where(F.col("page_count") > 0)
            .select(*keys, "page_count", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page_no"))
            .withColumn("batch_no", F.floor((F.col("page_no") - 1) / batch_size).cast("int")))


def page_batches(plan: DataFrame, keys=("api_name",)) -> DataFrame:
    """Batches as sorted page lists; a batch holds at most ``batch_size`` pages,
    so the group is bounded."""
    return plan.groupBy(*keys, "batch_no").agg(F.array_sort(F.collect_list("page_no")).alias("page_batch"))


def _field(rec: Column, name: str, alias: str | None) -> Column:
    a = F.try_variant_get(rec, f"$['{alias}']", "variant") if alias else None
    n = F.try_variant_get(rec, f"$['{name}']", "variant")
    return F.coalesce(a, n) if a is not None else n


@dataclass(frozen=True)
class ColumnParser:
    """A user's parser as column expressions of the record (VARIANT).

    ``fields`` gives each output column; a record for which ``skip`` is true is
    left out; one for which ``error`` is a text is quarantined with it, before
    ``skip`` is asked. Expressions run in Spark and must not raise (``try_*``).
    """
    fields: dict[str, Callable[[Column], Column]]
    skip: Callable[[Column], Column] | None = None
    error: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class FunctionParser:
    """A user's parser as a Python function from a record (dict) to a dict of
    the columns of ``schema`` (DDL), run over Arrow batches.

    An empty result (None, {}) skips the record. An exception, or a value that
    does not fit its column, quarantines the record with the error's text.
    """
    function: Callable[[dict], dict | None]
    schema: str


def _fitted(docs: list[dict], schema: pa.Schema) -> tuple[list[pa.Array], dict[int, str]]:
    """The documents as columns, and why some do not fit (their values are null)."""
    def columns(rows: list[dict]) -> list[pa.Array]:
        return [pa.array([d.get(f.name) for d in rows], f.type) for f in schema]
    try:
        return columns(docs), {}
    except (pa.ArrowException, TypeError, OverflowError):
        bad = {}
        for i, d in enumerate(docs):
            try:
                columns([d])
            except (pa.ArrowException, TypeError, OverflowError) as e:
                bad[i] = f"{type(e).__name__}: {e}"
        return columns([{} if i in bad else d for i, d in enumerate(docs)]), bad


def parse_with(records: DataFrame, parser: ColumnParser | FunctionParser, record_col: str = "record", keep=()) -> DataFrame:
    """Records by a user's parser (P1): the ``keep`` columns, the parser's
    columns and ``reason``, null where the record parsed. Skipped records are left out."""
    rec = F.col(record_col)
    if isinstance(parser, ColumnParser):
        reason = parser.error(rec) if parser.error else F.lit(None).cast("string")
        skip = F.coalesce(parser.skip(rec), F.lit(False)) if parser.skip else F.lit(False)
        staged = records.withColumn("_reason", reason).where(F.col("_reason").isNotNull() | ~skip)
        ok = F.col("_reason").isNull()
        return staged.select(*keep, *[F.when(ok, make(rec)).alias(name) for name, make in parser.fields.items()], F.col("_reason").alias("reason"))
    fields = to_arrow_schema(records.sparkSession.createDataFrame([], parser.schema).schema)
    rows = records.select(*keep, F.to_json(rec).alias("_record"))
    function, width = parser.function, len(rows.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, docs, reasons = [], [], []
            for i, text in enumerate(b.column(width).to_pylist()):
                doc, reason = {}, None
                try:
                    doc = function(json.loads(text) if text is not None else None)
                except Exception as e:  # the user's code may raise anything: the record is set aside
                    reason = f"{type(e).__name__}: {e}"
                if doc or reason is not None:
                    at.append(i)
                    docs.append(doc or {})
                    reasons.append(reason)
            columns, bad = _fitted(docs, fields)
            reasons = [bad.get(i, r) for i, r in enumerate(reasons)]
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(take) for c in b.columns[:width]), *columns, pa.array(reasons, pa.string())],
                                             [*b.schema.names[:width], *fields.names, "reason"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, parser.schema, "reason string"]))


def parse_records(records: DataFrame, spec: RecordSpec | ColumnParser | FunctionParser = DEFAULT_SPEC, record_col: str = "record",
                  keep=()) -> tuple[DataFrame, DataFrame]:
    """Parse records (P1) by a :class:`RecordSpec`, or by the user's own
    :class:`ColumnParser` or :class:`FunctionParser`. Returns (good, quarantine);
    the quarantine has the ``keep`` columns and the reason. A record that fails
    never stops the others.

    With a spec, a field is read under its alias or its own name (alias first). Required
    fields must be present, non-null strings; optional fields may be absent or
    null but otherwise must be strings (no number -> string coercion). The row
    hash covers all raw values, unknown fields included.
    """
    if isinstance(spec, ColumnParser | FunctionParser):
        staged = parse_with(records, spec, record_col, keep)
        return staged.where("reason is null").drop("reason"), staged.where("reason is not null").select(*keep, "reason")
    rec = F.col(record_col)
    checks, cols = [], []
    for f in spec.fields:
        v = _field(rec, f.name, f.alias)
        is_null = v.isNull() | F.is_variant_null(v)
        not_str = ~is_null & (F.schema_of_variant(v) != "STRING")
        if f.required:
            checks.append(F.when(is_null, F.lit(f"{f.name}:missing")))
        checks.append(F.when(not_str, F.lit(f"{f.name}:not_string")))
        cols.append(F.when(~is_null, F.variant_get(v, "$", "string")).alias(f.name))
    as_map = F.try_variant_get(rec, "$", "map<string,string>")
    errors = F.filter(F.array(*checks), lambda x: x.isNotNull())
    errors = F.when(as_map.isNull(), F.array(F.lit("record:not_object"))).otherwise(errors)
    staged = records.select(*keep, *cols, row_hash(as_map, HASH_EXCLUDE).alias(spec.hash_field),
                            errors.alias("_errors"))
    good = staged.where(F.size("_errors") == 0).drop("_errors")
    bad = staged.where(F.size("_errors") > 0).select(*keep, F.array_join("_errors", ";").alias("reason"))
    return good, bad


def map_to_variant(m) -> Column:
    """XML records (maps) to VARIANT so that :func:`parse_records` serves both."""
    return F.parse_json(F.to_json(F.col(m) if isinstance(m, str) else m))
