"""Collection scan with filter, projection and paging by a page directory.

A page directory is the anchors of W1 kept as a table: (page_no, start_id,
end_id) of a collection (under its filter). Reading a page looks its row up and
scans ``start_id <= id < end_id``: both bounds are pushed to the row groups'
statistics, nothing is shuffled, and the depth of the page does not matter.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import in_range
from ..operators.ranking import page_anchors, page_ranges, total_pages  # noqa: F401  (re-export)


def page_directory(df: DataFrame, order_col: str, size: int, where=None) -> DataFrame:
    """(page_no, start_id, end_id) of the pages of ``size`` rows in the order of
    the unique ``order_col``. Only that column is ranked; the caller stores the
    table and makes it anew when the collection has changed."""
    src = df if where is None else df.where(where)
    return page_ranges(page_anchors(src.select(order_col).where(F.col(order_col).isNotNull()), order_col, size))


def read_page(df: DataFrame, directory: DataFrame, order_col: str, page: int, size: int, where=None, cols=None) -> DataFrame:
    """Rows of page ``page`` with their ``position`` in the collection; a page
    that the directory does not have is empty. The ids of the one page (at most
    ``size``) give the positions."""
    cols = list(cols or df.columns)
    src = df if where is None else df.where(where)
    found = directory.where(F.col("page_no") == page).select("start_id", "end_id").first() if page >= 1 else None
    if found is None:
        return src.select(*cols, F.lit(0).cast("long").alias("position")).limit(0)
    rows = src.where(in_range(order_col, found["start_id"], found["end_id"]))
    ids = sorted(r[0] for r in rows.select(order_col).collect())
    place = F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(order_col))
    return rows.select(*cols, (place + (page - 1) * size).alias("position"))


def scan_page(df: DataFrame, order_col: str, page: int, size: int, where=None, cols=None, directory: DataFrame | None = None) -> DataFrame:
    """Rows ``(page-1)*size+1 .. page*size`` of ``df`` filtered by ``where``,
    ordered by the unique ``order_col``, projected to ``cols`` (S9).

    An order is required (an unordered skip/limit is not deterministic).
    ``directory`` is the stored :func:`page_directory` of the collection;
    without one it is made here, which ranks the whole collection.
    """
    if page < 1 or size <= 0:
        return df.select(*(cols or df.columns), F.lit(0).cast("long").alias("position")).limit(0)
    directory = directory if directory is not None else page_directory(df, order_col, size, where)
    return read_page(df, directory, order_col, page, size, where, cols)


def scan_count(df: DataFrame, where=None) -> DataFrame:
    """count_data: rows matching ``where`` (one aggregate row)."""
    src = df if where is None else df.where(where)
    return src.agg(F.count(F.lit(1)).alias("n"))
