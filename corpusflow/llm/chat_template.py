"""Chat formatting by a template compiler (operator 3).

``compile_template`` parses a small template language into a syntax tree,
folds constants and turns the tree into Python closures; nothing is ever
handed to ``eval``. A closure is a generator, so a conversation of any length
streams through. The language: ``{{ expr }}``, ``{% for x in expr %}`` (with
``loop.first``, ``loop.index``), ``{% if %}/{% elif %}/{% else %}``, ``{% set x = expr %}``,
``{% generation %}`` around what the model is to learn, ``-`` to trim white
space; literals, names, ``a.b``, ``a['b']``, ``+ ~ == != < <= > >= in and or not``
and the filters of ``FILTERS``. Sandbox: attributes are keys of mappings,
names are those given, and there are no calls.

``format_conversations`` renders rows by turn. The template marks turns, and
the filter ``escape`` puts a backslash inside every control string of a text,
so that texts cannot forge turns; ``unescape`` takes it out again.

Defined cases: null texts and roles count as empty; rows of a null conv_id are
one conversation; rows with the same turn are ordered by role and text, null
turns come first, repeated rows stay; other columns are ignored; an empty
table gives no rows. Only one conversation's current turn is held in memory;
its digest makes the turns of one conversation a sequence, so one task reads
a whole conversation, as a stream.
"""
from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import saved

# Fixed by this module's default template: its control strings begin and end with these.
_CONTROL = r"([<\[|])(\\{n})(?=/?s>|/?INST\]|\||>)"
_ESCAPE, _UNESCAPE = re.compile(_CONTROL.replace("{n}", "*")), re.compile(_CONTROL.replace("{n}", "+"))
TEMPLATE = """{%- for m in messages -%}
{%- if m.role == 'user' -%}<s>[INST] {{ m.text | escape }} [/INST]
{%- elif m.role == 'assistant' %} {% generation %}{{ m.text | escape }}{% endgeneration %}</s>
{%- else -%}<s><|{{ m.role | escape }}|>{{ m.text | escape }}<|end|>
{%- endif -%}
{%- endfor -%}"""
PART_CHARS = 1_000_000


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1] + m[2][1:], text)


FILTERS: dict[str, Callable] = {"escape": lambda v: escape(_text(v)), "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(),
                                "lower": lambda v: _text(v).lower(), "length": len, "default": lambda v, d: d if v is None else v}
START, END = object(), object()  # generation markers in the stream of pieces


MAX_NESTED, MAX_SYMBOLS = 40, 400  # brackets or blocks inside one another, and symbols of an expression


class TemplateError(ValueError):
    pass


def _text(v) -> str:
    return "" if v is None else "true" if v is True else "false" if v is False else str(v)


# ---- expressions: ("const", v) | ("name", n) | ("get", e, e) | ("op", f, [e]) | ("and"/"or", e, e)
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>|.,()\[\]=]))")
_OPS = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
        "in": lambda a, b: a in b, "+": lambda a, b: a + b, "~": lambda a, b: _text(a) + _text(b)}
_WORDS = {"true": True, "false": False, "none": None}


def _const(e):
    return e[0] == "const"


def _op(f, *args):
    """An operation; of constants, its value."""
    return ("const", f(*(a[1] for a in args))) if all(map(_const, args)) else ("op", f, args)


class _Expr:
    def __init__(self, source: str):
        self.toks, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.toks.append(next((k, v) for k, v in zip(("int", "str", "name", "sym"), m.groups()) if v is not None))
            at = m.end()
        self.at, depth = 0, 0
        for kind, v in self.toks:
            depth += (kind == "sym") * ((v in "([") - (v in ")]"))
            if depth > MAX_NESTED:
                raise TemplateError(f"an expression is nested more than {MAX_NESTED} deep")
        if len(self.toks) > MAX_SYMBOLS:
            raise TemplateError(f"an expression has more than {MAX_SYMBOLS} symbols")

    def peek(self, *values):
        return self.at < len(self.toks) and self.toks[self.at][1] in values and self.toks[self.at][0] != "str"

    def take(self, *values):
        if self.peek(*values):
            self.at += 1
            return self.toks[self.at - 1][1]
        return None

    def need(self, value):
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def whole(self):
        e = self.either()
        if self.at < len(self.toks):
            raise TemplateError(f"unexpected {self.toks[self.at][1]!r}")
        return e

    def either(self):
        e = self.both()
        while self.take("or"):
            r = self.both()
            e = (e if e[1] else r) if _const(e) else ("or", e, r)
        return e

    def both(self):
        e = self.negated()
        while self.take("and"):
            r = self.negated()
            e = (r if e[1] else e) if _const(e) else ("and", e, r)
        return e

    def negated(self):
        return _op(lambda v: not v, self.negated()) if self.take("not") else self.compared()

    def compared(self):
        e = self.added()
        while s := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            e = _op(_OPS[s], e, self.added())
        return e

    def added(self):
        e = self.filtered()
        while s := self.take("+", "~"):
            e = _op(_OPS[s], e, self.filtered())
        return e

    def filtered(self):
        e = self.reached()
        while self.take("|"):
            kind, name = self.toks[self.at] if self.at < len(self.toks) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            args = [e]
            if self.take("("):
                while not self.take(")"):
                    args.append(self.either())
                    self.take(",")
            e = _op(FILTERS[name], *args)
        return e

    def reached(self):
        e = self.atom()
        while s := self.take(".", "["):
            if s == "[":
                key = self.either()
                self.need("]")
            else:
                kind, name = self.toks[self.at] if self.at < len(self.toks) else ("", "")
                if kind != "name":
                    raise TemplateError("a name is expected after '.'")
                self.at += 1
                key = ("const", name)
            e = ("get", e, key)
        return e

    def atom(self):
        if self.at >= len(self.toks):
            raise TemplateError("an expression is expected")
        kind, v = self.toks[self.at]
        self.at += 1
        if kind == "int":
            return ("const", int(v))
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), v[1:-1]))
        if kind == "name":
            return ("const", _WORDS[v]) if v in _WORDS else ("name", v)
        if v == "(":
            e = self.either()
            self.need(")")
            return e
        raise TemplateError(f"unexpected {v!r}")


def _lookup(of, key):
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"{type(of).__name__} has no keys")


def _value(e) -> Callable[[dict], object]:
    """The closure of an expression."""
    kind = e[0]
    if kind == "const":
        return lambda env, v=e[1]: v
    if kind == "name":
        def name(env, n=e[1]):
            if n not in env:
                raise TemplateError(f"no value named {n!r}")
            return env[n]
        return name
    if kind == "get":
        of, key = _value(e[1]), _value(e[2])
        return lambda env: _lookup(of(env), key(env))
    if kind in ("and", "or"):
        a, b = _value(e[1]), _value(e[2])
        return (lambda env: a(env) and b(env)) if kind == "and" else (lambda env: a(env) or b(env))
    f, args = e[1], [_value(a) for a in e[2]]
    if len(args) == 1:
        return lambda env, a=args[0]: f(a(env))
    return lambda env: f(*(a(env) for a in args))


# ---- statements: ("text", s) | ("show", e) | ("for", name, e, body) | ("if", [(e, body)]) | ("set", name, e) | ("gen", body)
_TAGS = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\})", re.S)


def parse(source: str) -> list:
    """The syntax tree, with constants folded."""
    pieces = _TAGS.split(source)
    for k in range(1, len(pieces), 2):
        if pieces[k][2] == "-":
            pieces[k - 1] = pieces[k - 1].rstrip()
        if pieces[k][-3] == "-":
            pieces[k + 1] = pieces[k + 1].lstrip()
    items = [("text", p) if k % 2 == 0 else (p[:2], p[2:-2].strip("-").strip()) for k, p in enumerate(pieces) if k % 2 or p]
    body, at = _body(items, 0, ())
    if at < len(items):
        raise TemplateError(f"unexpected {items[at][1]!r}")
    return fold(body)


def _body(items, at, until, depth=0):
    if depth > MAX_NESTED:
        raise TemplateError(f"blocks are nested more than {MAX_NESTED} deep")
    out = []
    while at < len(items):
        kind, s = items[at]
        if kind == "text":
            out.append(("text", s))
        elif kind == "{{":
            out.append(("show", _Expr(s).whole()))
        else:
            word, _, rest = s.partition(" ")
            if word in until:
                return out, at
            if word == "for":
                m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {s!r}")
                body, at = _body(items, at + 1, ("endfor",), depth + 1)
                out.append(("for", m[1], _Expr(m[2]).whole(), body))
            elif word == "if":
                cases, test = [], _Expr(rest).whole()
                while True:
                    body, at = _body(items, at + 1, ("elif", "else", "endif"), depth + 1)
                    cases.append((test, body))
                    if at >= len(items):
                        raise TemplateError("'endif' is missing")
                    word, _, rest = items[at][1].partition(" ")
                    if word == "endif":
                        break
                    test = ("const", True) if word == "else" else _Expr(rest).whole()
                out.append(("if", cases))
            elif word == "set":
                name, _, e = rest.partition("=")
                out.append(("set", name.strip(), _Expr(e).whole()))
            elif word == "generation":
                body, at = _body(items, at + 1, ("endgeneration",), depth + 1)
                out.append(("gen", body))
            else:
                raise TemplateError(f"unknown tag {word!r}")
            if at >= len(items):
                raise TemplateError("a block is not closed")
        at += 1
    if until:
        raise TemplateError(f"{until[-1]!r} is missing")
    return out, at


def fold(body: list) -> list:
    """Constants become text, neighbouring texts one, and branches that cannot run go."""
    out: list = []
    for node in body:
        kind = node[0]
        if kind == "show" and _const(node[1]):
            node = ("text", _text(node[1][1]))
        elif kind == "for":
            node = ("for", node[1], node[2], fold(node[3]))
        elif kind == "gen":
            node = ("gen", fold(node[1]))
        elif kind == "if":
            cases = []
            for test, inner in node[1]:
                if _const(test) and not test[1]:
                    continue
                cases.append((test, fold(inner)))
                if _const(test):
                    break
            if not cases:
                continue
            if _const(cases[0][0]):
                for n in cases[0][1]:
                    out.append(("text", out.pop()[1] + n[1]) if n[0] == "text" and out and out[-1][0] == "text" else n)
                continue
            node = ("if", cases)
        if node[0] == "text" and out and out[-1][0] == "text":
            node = ("text", out.pop()[1] + node[1])
        if node != ("text", ""):
            out.append(node)
    return out


def _closure(body: list) -> Callable[[dict], Iterator]:
    steps = [_step(n) for n in body]

    def run(env):
        for s in steps:
            yield from s(env)
    return run


def _step(node) -> Callable[[dict], Iterator]:
    kind = node[0]
    if kind == "text":
        return lambda env, t=(node[1],): iter(t)
    if kind == "show":
        v = _value(node[1])
        return lambda env: iter((_text(v(env)),))
    if kind == "set":
        v = _value(node[2])

        def assign(env, name=node[1]):
            env[name] = v(env)
            return iter(())
        return assign
    if kind == "gen":
        inner = _closure(node[1])

        def marked(env):
            yield START
            yield from inner(env)
            yield END
        return marked
    if kind == "if":
        cases = [(_value(t), _closure(b)) for t, b in node[1]]

        def choose(env):
            for test, inner in cases:
                if test(env):
                    yield from inner(env)
                    return
        return choose
    values, inner = _value(node[2]), _closure(node[3])

    def loop(env, name=node[1]):
        for k, v in enumerate(values(env)):
            yield from inner(env | {name: v, "loop": {"first": k == 0, "index": k + 1, "index0": k}})
    return loop


def compile_template(source: str) -> Callable[..., Iterator]:
    """``render(name=value, ...)``: a stream of texts with START and END around what is generated."""
    run = _closure(parse(source))
    return lambda **env: run(env)


# ---- conversations ---------------------------------------------------------------------------
PARTS = "conv_id long, part int, text string, starts array<int>, ends array<int>"
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
TURNS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_TURNS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _rows(batches: Iterator[pa.RecordBatch], step: int = 512) -> Iterator[dict]:
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            yield from batch.slice(lo, step).to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, n: int = 512) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += len(r.get("text") or "")
        if len(held) >= n or chars >= 4 * PART_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _parts(conv_id, pieces: Iterator) -> Iterator[dict]:
    """Pieces to rows of about PART_CHARS; a marked span is never cut."""
    held, n, part, starts, ends = [], 0, 0, [], []
    for p in pieces:
        if p is START:
            starts.append(n)
        elif p is END:
            ends.append(n)
        else:
            held.append(p)
            n += len(p)
        if n >= PART_CHARS and len(starts) == len(ends):
            yield {"conv_id": conv_id, "part": part, "text": "".join(held), "starts": starts, "ends": ends}
            held, n, part, starts, ends = [], 0, part + 1, [], []
    if n or starts or not part:
        yield {"conv_id": conv_id, "part": part, "text": "".join(held), "starts": starts, "ends": ends}


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, text, starts, ends: the formatted conversations with the spans that are generated."""
    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)
        convs = itertools.groupby(_rows(batches), lambda r: r["conv_id"])
        return _batched(itertools.chain.from_iterable(_parts(c, run(messages=turns)) for c, turns in convs), _PARTS)

    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(render, PARTS)


_ENDS = (("<s>[INST] ", " [/INST]", "user"), ("<s><|", "<|end|>", None), (" ", "</s>", "assistant"))


def read_turns(texts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a conversation formatted with TEMPLATE, from its parts in order."""
    held, at = "", 0
    for more in texts:
        held, at = held[at:] + more, 0
        while at < len(held):
            # Longest opening is 10 characters; wait for them unless the text is complete.
            found = next(((o, e, r) for o, e, r in _ENDS if held.startswith(o, at)), None)
            end = held.find(found[1], at + len(found[0])) if found else -1
            if end < 0:
                break
            inner = held[at + len(found[0]):end]
            role = found[2]
            if role is None:
                role, _, inner = inner.partition("|>")
                role = unescape(role)
            yield role, unescape(inner)
            at = end + len(found[1])
    if at < len(held):
        raise ValueError(f"no turn at {held[at:at + 40]!r}")


def read_conversations(parts: DataFrame) -> DataFrame:
    """What formatted conversations hold: turns and loss text, unescaped, as counts and digests."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(conv_id, rows):
            loss, n_loss, n_chars = hashlib.sha256(), 0, 0

            def texts():
                nonlocal n_loss, n_chars
                for r in rows:
                    n_chars += len(r["text"])
                    for a, b in zip(r["starts"], r["ends"]):
                        t = unescape(r["text"][a:b])
                        loss.update(t.encode())
                        n_loss += len(t)
                    yield r["text"]

            sha, n = hashlib.sha256(), 0
            for role, text in read_turns(texts()):
                sha.update(f"{role}\n{text}\n".encode())
                n += 1
            return {"conv_id": conv_id, "n_turns": n, "turns_sha256": sha.hexdigest(), "loss_chars": n_loss, "loss_sha256": loss.hexdigest(), "formatted_chars": n_chars}

        return _batched((one(c, rows) for c, rows in itertools.groupby(_rows(batches, 64), lambda r: r["conv_id"])), _TURNS)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(read, TURNS)


def round_trip(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format, write, read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    return read_conversations(saved(format_conversations(rows, template), "chat"))
