"""Text column functions: normalization, HTML stripping, chunking.

All work is JVM-side: regular expressions, and ICU4J for NFKC. Only decoding
of HTML entities outside a fixed common set goes through a small
Arrow-batched helper, and only for the rows that hold one.
"""
from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Java regex class equal to Python's ``str.isspace`` set: (?U)\s is Unicode
# White_Space; Python also counts the separators U+001C-U+001F.
WS = r"(?U)[\s\x1c-\x1f]"
WS_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
# Characters removed after NFKC (fixed values): ZWSP, ZWNJ, ZWJ, BOM.
ZERO_WIDTH = "[\u200b-\u200d\ufeff]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nfkc(c) -> Column:
    """Unicode NFKC on the JVM: ICU4J (shipped with Spark) through the built-in
    ``reflect`` function; ICU's quick check makes already-normal text cheap.
    ICU follows a newer Unicode version than some Pythons; the two agree on
    every code point assigned in both."""
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), _col(c), F.lit(True))


def normalize_text(c, is_list: bool = False) -> Column:
    """One normalization pass (P4): null/'' -> '', NFKC, drop zero-width
    characters, CR/CRLF -> LF, collapse whitespace runs to one space, strip.

    With ``is_list`` the value is an array: its elements as text, joined by a
    space (a null element reads 'None').

    Not idempotent (removing a zero-width character can put a combining mark
    next to its base); pipelines apply it twice, see :func:`normalize_twice`.
    """
    v = _col(c)
    if is_list:
        v = F.array_join(F.transform(v, lambda x: F.coalesce(x.cast("string"), F.lit("None"))), " ")
    t = nfkc(F.coalesce(v.cast("string"), F.lit("")))
    t = F.regexp_replace(t, ZERO_WIDTH, "")
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, WS + "+", " ")
    return F.trim(t)


def normalize_again(p) -> Column:
    """A further pass over text that is already the output of a pass.

    Such text has no zero-width character, no CR, no whitespace other than
    single inner spaces, so another pass can only change it when NFKC does:
    the regex chain runs only for those rows."""
    # ``reflect`` is non-deterministic to Catalyst, so a repeated operand would
    # be evaluated again; a one-element lambda binds the pass once.
    return F.element_at(F.transform(F.array(_col(p)), lambda x: F.when(nfkc(x) == x, x)
                                    .otherwise(normalize_text(x))), 1)


def normalize_twice(c) -> Column:
    """Two passes, as the pipelines apply them (the second is usually a no-op check)."""
    return normalize_again(normalize_text(c))


def collapse_ws(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), WS + "+", " "))


# Named entities decoded on the JVM side (fixed values). Rows holding any
# other entity or a numeric reference go to Python's html.unescape instead.
# '&amp;' must stay last so that '&amp;copy;' decodes once, to '&copy;'.
COMMON_ENTITIES = [
    ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
    ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"),
]
_OTHER_ENTITY = r"&(?!(?:quot|apos|#39|lt|gt|nbsp|copy|middot|amp);)[A-Za-z#]"


@F.pandas_udf(StringType())
def _unescape_batch(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def decode_entities(c) -> Column:
    c = _col(c)
    jvm = c
    for ent, ch in COMMON_ENTITIES:
        jvm = F.replace(jvm, F.lit(ent), F.lit(ch))
    return F.coalesce(_unescape_batch(F.when(c.rlike(_OTHER_ENTITY), c)), jvm)


# One pass over the markup, whatever comes first at each place. A tag starts with a letter, its quoted
# attribute values may hold '>'; the content of a raw-text element ends at its own end tag only; what is
# never closed runs to the end of the text. '<' before anything else is text.
_TAG_REST = r"""(?:[^>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)"""
_MARKUP = ("(?is)<!--(?:-?>|.*?(?:--!?>|\\z))"
           rf"|<(script|style|noscript)(?=[\s/>]){_TAG_REST}.*?(?:</\1(?=[\s/>]){_TAG_REST}|\z)"
           rf"|</?[a-z]{_TAG_REST}"
           r"|<[!?/][^>]*+(?:>|\z)")


def strip_html(c) -> Column:
    """Visible text of an HTML fragment (P5): comments and script/style/noscript
    blocks removed, every tag (img included) becomes a separator, entities are
    decoded once, whitespace collapsed."""
    h = F.coalesce(_col(c), F.lit(""))
    return collapse_ws(decode_entities(F.regexp_replace(h, _MARKUP, " ")))


def extract_text(fields: list[str], fallback_cols: list[str] | None = None) -> Column:
    """Canonical text of a document (P3): each configured string field
    normalized, joined by newline; when that is blank and ``fallback_cols``
    are given, the JSON of those content columns (never index or lease state)
    normalized. Without a fallback a blank document stays blank (F6)."""
    parts = [normalize_text(F.col(f).cast("string")) for f in fields]
    joined = F.concat_ws("\n", *parts) if parts else F.lit("")
    if not fallback_cols:
        return joined
    fallback = normalize_text(F.to_json(F.struct(*[F.col(x) for x in fallback_cols])))
    return F.when(F.trim(F.regexp_replace(joined, WS + "+", " ")) == "", fallback).otherwise(joined)


def embedding_input(name, contents, is_html=None, sep: str = " | ") -> Column:
    """Text sent to the embedder for a chunk (P6): name and contents, contents
    stripped of HTML when the chunk is typed html, each trimmed, empties
    dropped, joined with ``sep``."""
    body = F.coalesce(_col(contents), F.lit(""))
    if is_html is not None:
        html_ = F.coalesce(_col(is_html), F.lit(False))
        # The helper's input is worked out for every row: none of it where there is no HTML.
        body = F.when(html_, strip_html(F.when(html_, body))).otherwise(body)
    parts = F.array(_py_strip(F.coalesce(_col(name), F.lit(""))), _py_strip(body))
    return _py_strip(F.array_join(F.filter(parts, lambda x: x != ""), sep))


def _py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.btrim(c, F.lit(WS_CHARS))


def chunk_text(c, max_chars: int = 1000, overlap: int = 100) -> Column:
    """Overlapping character windows (P7) as an array column.

    Window i starts at i*(max_chars-overlap); the last window reaches the end.
    ``max_chars <= 0`` keeps the whole text; an empty text has no window.
    """
    t = _col(c)
    if max_chars <= 0:
        return F.array(t)
    if overlap >= max_chars or overlap < 0:
        raise ValueError("overlap must be in [0, max_chars)")
    step = max_chars - overlap
    n = F.char_length(t)
    k = F.when(n == 0, 0).when(n <= max_chars, 1) \
        .otherwise(1 + F.floor((n - max_chars + step - 1) / step).cast("int"))
    # The text is cut into steps once; a window is the steps it spans (a substring of
    # the whole text would walk from its start for each window).
    steps = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    span = -(-max_chars // step)
    windows = F.transform(F.array(steps), lambda p: F.transform(
        F.sequence(F.lit(0), k - 1), lambda i: F.substring(F.array_join(F.slice(p, i + 1, span), ""), 1, max_chars)))[0]
    return F.when(t.isNull(), F.lit(None)).when(k > 0, windows).otherwise(F.array().cast("array<string>"))


def chunk_count(n_chars, max_chars: int = 1000, overlap: int = 100) -> Column:
    """Number of windows :func:`chunk_text` makes for a text of ``n_chars``."""
    n = _col(n_chars)
    if max_chars <= 0:
        return F.lit(1)
    step = max_chars - overlap
    return F.when(n == 0, 0).when(n <= max_chars, 1) \
        .otherwise(1 + F.floor((n - max_chars + step - 1) / step).cast("int"))


def mask_secret(c) -> Column:
    """Log-safe form of a key (P16): first 5, '...', last 3; non-string -> mark."""
    c = _col(c)
    # Python slicing: key[-3:] of a string shorter than 3 is the whole string.
    tail = F.when(F.char_length(c) >= 3, F.substring(c, -3, 3)).otherwise(c)
    return F.when(c.isNull(), F.lit("***MASKED***")).otherwise(F.concat(F.substring(c, 1, 5), F.lit("..."), tail))
