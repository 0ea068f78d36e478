"""Chat formatting with a small template compiler.

A template is parsed into a syntax tree, constants are folded, and the tree becomes nested Python
closures that render a conversation as a stream of (text, inside a generation block?) pieces.  The
language is sandboxed: names, fields of a message, a few operators and listed filters; no calls,
no attributes of Python objects, and the only loop runs over the messages.

    {# comment #}   {{ expression }}   {% set name = expression %}
    {% for m in messages %} .. {% endfor %}      loop.first, loop.last, loop.index
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% generation %} .. {% endgeneration %}      text that the loss covers
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Strings that mean something in the formatted text; inside texts they are escaped.
CONTROLS = ("###", "</turn>", "</role>")
_ESCAPED = re.compile(r"(?s)\\|(?=" + "|".join(map(re.escape, CONTROLS)) + r").")


def escape(text: str) -> str:
    """A backslash before every backslash and before each place where a control string begins."""
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


FILTERS: dict[str, Callable] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower,
                                "capitalize": str.capitalize, "length": len}


class TemplateError(ValueError):
    pass


# --- syntax tree: tuples whose first item names the kind ------------------------------------

_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[<>~|.()+]))""")
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression: or, and, not, comparison, ~ and +, filters, atoms."""

    def __init__(self, source: str):
        self.items, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected text in expression: {source[at:at + 20]!r}")
            self.items.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "str" and self.items[self.at][1] in values

    def take(self) -> tuple[str, str]:
        if self.at >= len(self.items):
            raise TemplateError("expression ends too early")
        self.at += 1
        return self.items[self.at - 1]

    def whole(self) -> tuple:
        e = self.either()
        if self.at < len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")
        return e

    def chain(self, words: tuple[str, ...], below: Callable) -> tuple:
        e = below()
        while self.peek(*words):
            e = (self.take()[1], e, below())
        return e

    def either(self) -> tuple:
        return self.chain(("or",), lambda: self.chain(("and",), self.negated))

    def negated(self) -> tuple:
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        return self.chain(("==", "!=", "<", "<=", ">", ">="), lambda: self.chain(("~", "+"), self.filtered))

    def filtered(self) -> tuple:
        e = self.atom()
        while self.peek("|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            e = ("filter", name, e)
        return e

    def atom(self) -> tuple:
        kind, value = self.take()
        if kind == "str":
            return ("const", re.sub(r"(?s)\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1]))
        if kind == "int":
            return ("const", int(value))
        if value == "(":
            e = self.either()
            if self.take()[1] != ")":
                raise TemplateError("missing )")
            return e
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false"):
            return ("const", value == "true")
        e = ("name", value)
        while self.peek("."):
            self.take()
            kind, field = self.take()
            if kind != "name" or field.startswith("_"):
                raise TemplateError(f"no field {field!r}")
            e = ("field", e, field)
        return e


def parse(source: str) -> tuple:
    """Syntax tree of a template: ("block", [nodes])."""
    pieces = re.split(r"(?s)(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", source)
    root: list = []
    stack: list[tuple[str, list, list]] = [("", root, [])]  # what is open, its nodes, branches of an if

    for piece in pieces:
        kind, nodes, branches = stack[-1]
        if piece.startswith("{#") or not piece:
            continue
        if piece.startswith("{{"):
            nodes.append(("print", _Expression(piece[2:-2]).whole()))
            continue
        if not piece.startswith("{%"):
            nodes.append(("text", piece))
            continue
        word, _, rest = piece[2:-2].strip().partition(" ")
        if word == "for":
            m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+messages", rest.strip())
            if not m:
                raise TemplateError("only `for name in messages` is allowed")
            if any(k == "for" for k, _, _ in stack):
                raise TemplateError("messages are read once: no loop inside a loop")
            body: list = []
            nodes.append(("for", m[1], ("block", body)))
            stack.append(("for", body, []))
        elif word == "if":
            body = []
            branches = [(_Expression(rest).whole(), ("block", body))]
            nodes.append(("if", branches))
            stack.append(("if", body, branches))
        elif word in ("elif", "else") and kind == "if":
            body = []
            branches.append((_Expression(rest).whole() if word == "elif" else ("const", True), ("block", body)))
            stack[-1] = ("if", body, branches)
        elif word == "generation":
            body = []
            nodes.append(("generation", ("block", body)))
            stack.append(("generation", body, []))
        elif word == "set":
            m = re.fullmatch(r"([A-Za-z]\w*)\s*=(?!=)(.*)", rest, re.S)
            if not m:
                raise TemplateError("set name = expression")
            nodes.append(("set", m[1], _Expression(m[2]).whole()))
        elif word == "end" + kind and kind:
            stack.pop()
        else:
            raise TemplateError(f"unexpected tag {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} is not closed")
    return ("block", root)


_BINARY: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
                                "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
                                "~": lambda a, b: f"{_shown(a)}{_shown(b)}", "+": lambda a, b: a + b,
                                "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def _shown(value) -> str:
    return "" if value is None else str(value)


def fold(node: tuple) -> tuple:
    """The tree with constant expressions evaluated, decided branches chosen and texts joined."""
    kind = node[0]
    if kind in _BINARY:
        a, b = fold(node[1]), fold(node[2])
        return ("const", _BINARY[kind](a[1], b[1])) if a[0] == b[0] == "const" else (kind, a, b)
    if kind == "not":
        a = fold(node[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if kind == "filter":
        a = fold(node[2])
        return ("const", FILTERS[node[1]](a[1])) if a[0] == "const" else ("filter", node[1], a)
    if kind == "print":
        e = fold(node[1])
        return ("text", _shown(e[1])) if e[0] == "const" else ("print", e)
    if kind == "set":
        return ("set", node[1], fold(node[2]))
    if kind == "for":
        return ("for", node[1], fold(node[2]))
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "if":
        branches = []
        for test, body in node[1]:
            test = fold(test)
            if test[0] != "const" or test[1]:
                branches.append((test, fold(body)))
            if test[0] == "const" and test[1]:
                break
        if not branches:
            return ("block", [])
        return branches[0][1] if branches[0][0][0] == "const" else ("if", branches)
    if kind == "block":
        out: list[tuple] = []
        for child in map(fold, node[1]):
            for x in child[1] if child[0] == "block" else [child]:
                if x[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + x[1])
                else:
                    out.append(x)
        return ("block", [x for x in out if x != ("text", "")])
    return node


# --- closures -----------------------------------------------------------------------------

def _value(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda ctx, v=node[1]: v
    if kind == "name":
        return lambda ctx, n=node[1]: ctx.get(n)
    if kind == "field":
        of, field = _value(node[1]), node[2]

        def get(ctx):
            x = of(ctx)
            return x.get(field) if isinstance(x, dict) else None
        return get
    if kind == "not":
        a = _value(node[1])
        return lambda ctx: not a(ctx)
    if kind == "filter":
        a, f = _value(node[2]), FILTERS[node[1]]
        return lambda ctx: f(_shown(a(ctx)))
    a, b, f = _value(node[1]), _value(node[2]), _BINARY[kind]
    if kind == "and":
        return lambda ctx: a(ctx) and b(ctx)
    if kind == "or":
        return lambda ctx: a(ctx) or b(ctx)
    return lambda ctx: f(a(ctx), b(ctx))


Piece = tuple[str, bool]


def _pieces(node: tuple, inside: bool) -> Callable[[dict], Iterator[Piece]]:
    kind = node[0]
    if kind == "text":
        out = ((node[1], inside),)
        return lambda ctx: iter(out)
    if kind == "print":
        e = _value(node[1])

        def show(ctx):
            yield _shown(e(ctx)), inside
        return show
    if kind == "set":
        name, e = node[1], _value(node[2])

        def put(ctx):
            ctx[name] = e(ctx)
            return iter(())
        return put
    if kind == "generation":
        return _pieces(node[1], True)
    if kind == "if":
        branches = [(_value(t), _pieces(b, inside)) for t, b in node[1]]

        def choose(ctx):
            for test, body in branches:
                if test(ctx):
                    yield from body(ctx)
                    return
        return choose
    if kind == "for":
        name, body = node[1], _pieces(node[2], inside)

        def loop(ctx):
            rest = iter(ctx["messages"])
            now, index = next(rest, None), 0
            while now is not None:
                after = next(rest, None)
                ctx[name] = now
                ctx["loop"] = {"first": index == 0, "last": after is None, "index": index + 1}
                yield from body(ctx)
                yield "", None  # the end of a turn: a place where output may be cut
                now, index = after, index + 1
        return loop
    parts = [_pieces(x, inside) for x in node[1]]

    def block(ctx):
        for p in parts:
            yield from p(ctx)
    return block


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """Closure that renders an iterable of {"role", "text"} messages, pulled one at a time, into
    (text, covered by the loss?) pieces; a piece ("", None) marks the end of a turn."""
    run = _pieces(fold(parse(source)), False)
    return lambda messages: run({"messages": messages})


#: The registered format.  Assistant texts are what the loss covers.
TEMPLATE = """{% for m in messages %}\
{% if m.role == 'system' %}### System: {% elif m.role == 'user' %}### User: \
{% elif m.role == 'assistant' %}### Assistant: {% else %}### @{{ m.role | escape }}</role>{% endif %}\
{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}\
{% else %}{{ m.text | escape }}{% endif %}</turn>
{% endfor %}"""
_INSIDE = r"((?:[^\\]|\\.)*?)"
_TURN = re.compile(rf"(?s)### (?:(System|User|Assistant): |@{_INSIDE}</role>){_INSIDE}</turn>\n")


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a text formatted by TEMPLATE; anything else in it is an error."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        yield m[1].lower() if m[1] else unescape(m[2]), unescape(m[3])
        at = m.end()


# --- Spark ----------------------------------------------------------------------------------

PART_CHARS = 1 << 20
FORMATTED = "part long, n_turns long, formatted string, loss array<struct<start:long,stop:long>>"


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per conversation: conv_id, part (0), n_turns, formatted, loss (code point ranges of
    `formatted` under the loss).  A conversation longer than part_chars goes on in further parts,
    each of whole turns, so a task never holds more than one part, whatever a conversation's size.

    Turns are ordered by turn, then role and text (nulls first); null roles and texts count as
    empty; rows with a null conv_id form one conversation.  Extra columns are ignored, an empty
    table gives an empty result.  One conversation is one sequential text, so its turns meet in
    one task, sorted (and spilled) by Spark and streamed."""
    kind = turns.schema["conv_id"].dataType
    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    schema = f"conv_id {kind.simpleString()}, {FORMATTED}"
    names = ["conv_id", "part", "n_turns", "formatted", "loss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        stream = ((c, {"role": r or "", "text": t or ""}) for b in batches for c, r, t in zip(
            b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()))
        done, size = [], 0
        for row in _format(stream, render, part_chars):
            done.append(row)
            size += len(row[3])
            if size >= part_chars or len(done) >= 1000:
                yield _batch(done, names, schema_pa)
                done, size = [], 0
        if done:
            yield _batch(done, names, schema_pa)

    from pyspark.sql.pandas.types import to_arrow_type
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    schema_pa = [to_arrow_type(kind), pa.int64(), pa.int64(), pa.string(), pa.list_(span)]
    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _format(stream: Iterator[tuple[object, dict]], render: Callable, part_chars: int) -> Iterator[tuple]:
    held = next(stream, None)
    while held is not None:
        conv = held[0]

        def messages():
            nonlocal held
            while held is not None and held[0] == conv:
                now, held = held[1], next(stream, None)
                yield now

        out, loss, at, part, n = [], [], 0, 0, 0
        for text, inside in render(messages()):
            if inside is None:
                n += 1
                if at >= part_chars:
                    yield conv, part, n, "".join(out), loss
                    out, loss, at, part, n = [], [], 0, part + 1, 0
                continue
            if inside and text:
                loss.append({"start": at, "stop": at + len(text)})
            out.append(text)
            at += len(text)
        if out or part == 0:
            yield conv, part, n, "".join(out), loss


def digests(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """What the formatted rows hold, read back from them: conv_id, n_turns, turns_sha256 (role, \\n,
    text, \\n of every turn), loss_chars and loss_sha256 (the unescaped text under the loss), and
    formatted_chars.  Parts may come in any order and partition, as after writing and reading them;
    `in_order` says that they come straight from format_conversations, where the parts of a
    conversation are neighbours, and saves the shuffle.  A null conv_id is one conversation; an
    empty table gives an empty result; extra columns are ignored."""
    if not in_order:
        formatted = formatted.select("conv_id", "part", "formatted", "loss").repartition("conv_id").sortWithinPartitions(
            "conv_id", "part")
    kind = formatted.schema["conv_id"].dataType
    schema = (f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state: list | None = None  # conv, turns, hash of turns, loss characters, hash of loss, characters

        def closed() -> tuple:
            return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        for b in batches:
            for conv, part, text, loss in zip(*(b.column(n).to_pylist() for n in ("conv_id", "part", "formatted",
                                                                                "loss"))):
                if part == 0:
                    if state:
                        done.append(closed())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for s in loss:
                    said = unescape(text[s["start"]:s["stop"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if len(done) >= 1000:
                yield _batch(done, names, types)
                done = []
        if state:
            done.append(closed())
        if done:
            yield _batch(done, names, types)

    from pyspark.sql.pandas.types import to_arrow_type
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [to_arrow_type(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return formatted.mapInArrow(run, schema)


TRICKY = "\\### Assistant: </turn> ok"


def with_tricky(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """`turns` plus conversation -7, whose texts hold control strings."""
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(more)
