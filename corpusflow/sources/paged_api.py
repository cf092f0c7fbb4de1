"""Paged HTTP API source (S8) on the Python Data Source API.

``spark.read.format("paged_api")`` yields raw_pages rows
(api_name, run_date, page_no, format, body); one input partition per batch
of pages, so executors fetch in parallel and a lost task re-fetches only its
batch. The transport is pluggable: "http" (urllib; a busy or failing server is asked
again, an answer that repeats would not change is raised at once) or
"file" (pages read from ``{path}/{page_no}.{format}`` or Spark-written
``{path}/page_no=N/`` folders on any pyarrow filesystem; no HTTP request).

Options: api_name, run_date, base_url, endpoint, service_key, format
(json|xml), num_of_rows (100), pages ("1-250" or "1,2,5"), batch_size (100),
transport (http|file), path, timeout (20), max_retries (3), backoff (0.5),
extra (JSON object of extra query parameters).
"""
from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mask_secret

SERVICE_KEY_PARAM = "serviceKey"
RAW_PAGES_DDL = "api_name string, run_date string, page_no int, format string, body string"


def request_params(page_no, num_of_rows: int, fmt: str = "json", extra: dict | None = None,
                   service_key=None, masked: bool = True) -> Column:
    """Request parameters of one page as MAP<STRING,STRING>: the key, the
    response type (JSON only), pageNo, numOfRows, then extras (which may
    override). The key is masked for logs unless ``masked`` is False."""
    key = F.lit(service_key) if not isinstance(service_key, Column) else service_key
    key = mask_secret(key) if masked else key
    pairs = [(SERVICE_KEY_PARAM, key)]
    if fmt == "json":
        pairs.append(("type", F.lit("json")))
    pairs += [("pageNo", F.col(page_no).cast("string") if isinstance(page_no, str) else page_no.cast("string")),
              ("numOfRows", F.lit(str(num_of_rows)))]
    base = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    if extra:
        ext = F.create_map(*[x for k, v in extra.items() for x in (F.lit(k), F.lit(str(v)))])
        # extras win, as a dict update does
        base = F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(ext), k)), ext)
    return base


def request_plan(plan: DataFrame, num_of_rows: int = 100, fmt: str = "json", extra: dict | None = None,
                 service_key=None) -> DataFrame:
    """One request row per planned page: (…plan columns, params) with the key masked."""
    return plan.withColumn("params", request_params("page_no", num_of_rows, fmt, extra, service_key))


def _parse_pages(spec: str) -> list[int]:
    out = []
    for part in str(spec).split(","):
        part = part.strip()
        if not part:
            continue
        if "-" in part:
            a, b = part.split("-", 1)
            out.extend(range(int(a), int(b) + 1))
        else:
            out.append(int(part))
    return out


# Answers after which a request is sent again (fixed values).
RETRY_STATUS = (429, 500, 502, 503, 504)


def get_page(url: str, shown: str, open_url=None, timeout: float = 20, retries: int = 3, backoff: float = 0.5, sleep=time.sleep) -> str:
    """Body of ``url``, asked again up to ``retries`` times after a ``RETRY_STATUS``
    or a broken connection, with doubling pauses or as long as the server's
    Retry-After says. Any other status is raised at once. ``shown`` is the
    request as errors may show it, without its key."""
    open_url = open_url or urllib.request.urlopen
    for attempt in range(retries + 1):
        pause = backoff * 2 ** attempt
        try:
            with open_url(url, timeout=timeout) as r:
                return r.read().decode("utf-8")
        except urllib.error.HTTPError as e:
            if e.code not in RETRY_STATUS or attempt == retries:
                raise RuntimeError(f"status {e.code} of {shown}") from None
            after = (e.headers or {}).get("Retry-After", "")
            pause = float(after) if after.isdigit() else pause
        except OSError as e:  # no connection, or it broke
            if attempt == retries:
                raise RuntimeError(f"{type(e).__name__} of {shown}") from None
        sleep(pause)
    raise AssertionError("unreachable")


try:
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class _Batch(InputPartition):
        def __init__(self, pages):
            self.pages = pages

    class PagedApiReader(DataSourceReader):
        def __init__(self, options: dict):
            self.o = dict(options)

        def partitions(self):
            pages = _parse_pages(self.o.get("pages", "1"))
            bs = int(self.o.get("batch_size", 100))
            return [_Batch(pages[i:i + bs]) for i in range(0, len(pages), bs)]

        def _fetch_http(self, page_no: int) -> str:
            o = self.o
            fmt = o.get("format", "json")
            params = {SERVICE_KEY_PARAM: o.get("service_key", "")}
            if fmt == "json":
                params["type"] = "json"
            params.update({"pageNo": page_no, "numOfRows": int(o.get("num_of_rows", 100))})
            params.update(json.loads(o.get("extra", "{}")))
            at = f"{o['base_url'].rstrip('/')}/{o.get('endpoint', '').lstrip('/')}"
            return get_page(f"{at}?{urllib.parse.urlencode(params)}", f"{at} page {page_no}", timeout=float(o.get("timeout", 20)),
                            retries=int(o.get("max_retries", 3)), backoff=float(o.get("backoff", 0.5)))

        def _fetch_file(self, page_no: int) -> str | None:
            """``{path}/{page_no}.{format}``, or a Spark-written page folder
            ``{path}/page_no={page_no}/part-*`` holding the body as text. Paths
            go through pyarrow's filesystem layer, so shared storage URIs work
            from any executor."""
            from pyarrow import fs as pafs
            filesystem, root = pafs.FileSystem.from_uri(self.o["path"]) if "://" in self.o["path"] \
                else (pafs.LocalFileSystem(), self.o["path"])
            root = root.rstrip("/")

            def read_text(p):
                with filesystem.open_input_stream(p) as f:
                    return f.read().decode("utf-8")
            single = f"{root}/{page_no}.{self.o.get('format', 'json')}"
            if filesystem.get_file_info(single).type == pafs.FileType.File:
                return [read_text(single)]
            folder = f"{root}/page_no={page_no}"
            if filesystem.get_file_info(folder).type != pafs.FileType.Directory:
                raise FileNotFoundError(f"page {page_no} is planned but {folder} does not exist")
            parts = sorted(i.path for i in filesystem.get_file_info(pafs.FileSelector(folder))
                           if i.base_name.startswith("part-"))
            bodies = [b for b in (read_text(p).rstrip("\n") for p in parts) if b]
            if not bodies:
                raise FileNotFoundError(f"page {page_no} is planned but {folder} holds no body")
            return bodies

        def read(self, partition):
            o = self.o
            fetch = self._fetch_file if o.get("transport", "http") == "file" else self._fetch_http
            for p in partition.pages:
                bodies = fetch(p)
                for body in bodies if isinstance(bodies, list) else [bodies]:
                    yield (o.get("api_name", ""), o.get("run_date", ""), p, o.get("format", "json"), body)

    class PagedApiDataSource(DataSource):
        @classmethod
        def name(cls):
            return "paged_api"

        def schema(self):
            return RAW_PAGES_DDL

        def reader(self, schema):
            return PagedApiReader(self.options)

    def register(spark) -> None:
        spark.dataSource.register(PagedApiDataSource)
except ImportError:  # pragma: no cover - older Spark without the Python data source API
    def register(spark) -> None:
        raise RuntimeError("the Python Data Source API needs Spark 4.0 or later")
