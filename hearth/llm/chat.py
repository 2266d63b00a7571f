"""Chat formatting (operator 12): a compiler for a small template language.

A template is cut into tokens, parsed into a syntax tree of tuples, folded where
its parts are constant, and turned into nested Python generators that yield
pieces of text and the marks of generated spans. The language is sandboxed: it
has text, ``{{ expr }}``, ``{% for %}``, ``{% if %}``, ``{% set %}``,
``{% generation %}`` and comments; values are read from the given names by key
only (never Python attributes), there are no calls but the filters below, and
loops run over given lists only.

Conversations are dealt by id, sorted, and stream through the closures turn by
turn: a task never holds a conversation, however long.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: a formatted conversation is cut after the turn that takes it past so many characters
PART_CHARS = 1_000_000

#: the characters that could begin a control string, or take the escape away
CONTROL = "\\<#"

DEFAULT_TEMPLATE = """\
{# marks each turn; roles and texts are escaped, so neither can close or open one -#}
{% for message in messages -%}
<turn>### {{ message.role | escape(':') }}: {% if message.role == 'assistant' -%}
{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else %}{{ message.text | escape }}{% endif %}</turn>
{% endfor %}"""


class TemplateError(ValueError):
    pass


# ---------------------------------------------------------------- values

def escape(text: str, more: str = "") -> str:
    """A backslash before each control character, and each of ``more``."""
    return re.sub(f"[{re.escape(CONTROL + more)}]", lambda m: "\\" + m[0], _text(text))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return "" if value is None else str(value)


FILTERS: dict[str, Callable] = {
    "escape": escape, "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(),
    "title": lambda x: _text(x).title(), "trim": lambda x: _text(x).strip(), "length": len,
    "default": lambda x, other="": other if x is None else x,
    "replace": lambda x, old, new: _text(x).replace(old, new),
    "join": lambda x, by="": by.join(_text(v) for v in x),
}


def _number(f):
    def checked(a, b):
        if any(isinstance(v, bool) or not isinstance(v, (int, float)) for v in (a, b)):
            raise TemplateError("arithmetic needs numbers; join texts with ~")
        return f(a, b)
    return checked


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
    "~": lambda a, b: _text(a) + _text(b), "+": _number(lambda a, b: a + b), "-": _number(lambda a, b: a - b),
    "*": _number(lambda a, b: a * b), "%": _number(lambda a, b: a % b),
}


def lookup(value, key):
    """A dictionary's or list's element, none if there is none. Nothing else has any."""
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple)) and isinstance(key, int) and not isinstance(key, bool):
        return value[key] if -len(value) <= key < len(value) else None
    if value is None:
        return None
    raise TemplateError(f"can't look up {key!r} in a {type(value).__name__}")


# ---------------------------------------------------------------- parser

_TAG = re.compile(r"\{\{-?(.*?)(-?)\}\}|\{%-?(.*?)(-?)%\}|\{#-?.*?(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<num>\d+(?:\.\d+)?)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
                    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+*%~<>|.,()\[\]=]))""", re.S)
_WORDS = {"and", "or", "not", "in", "if", "else", "is", "true", "false", "none"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "str" else value

    def take(self, *wanted: str) -> str | None:
        if (value := self.peek()) in wanted:
            self.at += 1
            return value
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}, found {self.peek()!r}")

    def name(self, reserved: set[str] = _WORDS) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name" or value in reserved:
            raise TemplateError(f"expected a name, found {value!r}")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self) -> tuple:
        node = self.choice()
        self.end()
        return node

    def choice(self) -> tuple:
        node = self.either()
        if self.take("if"):
            test = self.either()
            node = ("choice", test, node, self.choice() if self.take("else") else ("const", None))
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        while True:
            if op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
                node = ("binary", op, node, self.joined())
            elif self.take("not"):
                self.need("in")
                node = ("binary", "not in", node, self.joined())
            elif self.take("is"):
                negative = self.take("not")
                if (test := self.peek()) not in ("none", "defined"):
                    raise TemplateError(f"unknown test {test!r}")
                self.at += 1
                same = "==" if (test == "none") != bool(negative) else "!="
                node = ("binary", same, node, ("const", None))
            else:
                return node

    def joined(self) -> tuple:
        node = self.product()
        while op := self.take("+", "-", "~"):
            node = ("binary", op, node, self.product())
        return node

    def product(self) -> tuple:
        node = self.signed()
        while op := self.take("*", "%"):
            node = ("binary", op, node, self.signed())
        return node

    def signed(self) -> tuple:
        return ("binary", "-", ("const", 0), self.signed()) if self.take("-") else self.filtered()

    def filtered(self) -> tuple:
        node = self.atom()
        while op := self.take(".", "[", "|"):
            if op == ".":
                node = ("get", node, ("const", self.name(reserved=set())))
            elif op == "[":
                node = ("get", node, self.choice())
                self.need("]")
            else:
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"unknown filter {name!r}")
                node = ("filter", name, (node, *(self.list(")") if self.take("(") else ())))
        return node

    def list(self, close: str) -> list[tuple]:
        items = []
        while not self.take(close):
            if items:
                self.need(",")
            items.append(self.choice())
        return items

    def atom(self) -> tuple:
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if self.take("["):
            return ("list", tuple(self.list("]")))
        for word, value in (("true", True), ("false", False), ("none", None)):
            if self.take(word):
                return ("const", value)
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind == "num":
            self.at += 1
            return ("const", float(value) if "." in value else int(value))
        if kind == "str":
            self.at += 1
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        return ("name", self.name())


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    parts, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip() if strip else text
        if source[m.start() + 2] == "-":
            text = text.rstrip()
        if text:
            parts.append(("text", text))
        strip = "-" in (m[2], m[4], m[5])
        if m[1] is not None:
            parts.append(("out", m[1]))
        elif m[3] is not None:
            parts.append(("tag", m[3].strip()))
        at = m.end()
    text = source[at:].lstrip() if strip else source[at:]
    if text:
        parts.append(("text", text))
    queue = iter(parts)

    def block(*ends: str) -> tuple[tuple, str | None]:
        body = []
        for kind, value in queue:
            if kind == "text":
                if "{%" in value or "{{" in value:
                    raise TemplateError("a tag isn't closed")
                body.append(("text", value))
                continue
            if kind == "out":
                body.append(("out", _Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return tuple(body), value
            if word == "for":
                e = _Expression(rest)
                name = e.name()
                e.need("in")
                body.append(("for", name, e.whole(), block("endfor")[0]))
            elif word == "if":
                branches, other, close = [], (), value
                while close is not None and close.split()[0] in ("if", "elif"):
                    test = _Expression(close.partition(" ")[2]).whole()
                    inner, close = block("elif", "else", "endif")
                    branches.append((test, inner))
                if close == "else":
                    other, close = block("endif")
                body.append(("if", tuple(branches), other))
            elif word == "set":
                e = _Expression(rest)
                name = e.name()
                e.need("=")
                body.append(("set", name, e.whole()))
            elif word == "generation":
                body.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(body), None

    return block()[0]


# ---------------------------------------------------------------- folding

def fold(node: tuple) -> tuple:
    """An expression with its constant parts worked out."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        node = ("filter", node[1], tuple(map(fold, node[2])))
        parts = node[2]
    elif kind == "list":
        node = ("list", tuple(map(fold, node[1])))
        parts = node[1]
    elif kind == "binary":
        node = ("binary", node[1], fold(node[2]), fold(node[3]))
        parts = node[2:]
    else:
        node = (kind, *map(fold, node[1:]))
        parts = node[1:]
        if kind in ("and", "or") and parts[0][0] == "const":
            return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
        if kind == "choice" and parts[0][0] == "const":
            return parts[1] if parts[0][1] else parts[2]
    if all(p[0] == "const" for p in parts):
        try:
            return ("const", evaluator(node)({}))
        except Exception:       # a fault of a branch that may never run: left to the run
            return node
    return node


def fold_body(body: tuple) -> tuple:
    """Statements with constant output as text, dead branches gone and
    neighbouring texts in one."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            node = ("text", out.pop()[1] + node[1])
        if node != ("text", ""):
            out.append(node)

    for node in body:
        kind = node[0]
        if kind == "out":
            value = fold(node[1])
            add(("text", _text(value[1])) if value[0] == "const" else ("out", value))
        elif kind == "for":
            items = fold(node[2])
            if items[0] != "const" or items[1]:
                add(("for", node[1], items, fold_body(node[3])))
        elif kind == "if":
            branches, other = [], fold_body(node[2])
            for test, inner in node[1]:
                test = fold(test)
                if test[0] != "const":
                    branches.append((test, fold_body(inner)))
                elif test[1]:
                    other = fold_body(inner)
                    break
            if branches:
                add(("if", tuple(branches), other))
            else:
                for inner in other:
                    add(inner)
        elif kind == "set":
            add(("set", node[1], fold(node[2])))
        elif kind == "generation":
            add(("generation", fold_body(node[1])))
        else:
            add(node)
    return tuple(out)


# ---------------------------------------------------------------- closures

#: marks among the pieces of text
OPEN, CLOSE, ITEM_END = object(), object(), object()


def evaluator(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "list":
        items = [evaluator(n) for n in node[1]]
        return lambda env: [f(env) for f in items]
    if kind == "filter":
        apply, args = FILTERS[node[1]], [evaluator(n) for n in node[2]]
        if len(args) == 1:
            only = args[0]
            return lambda env: apply(only(env))
        return lambda env: apply(*[f(env) for f in args])
    if kind == "binary":
        apply, a, b = OPERATORS[node[1]], evaluator(node[2]), evaluator(node[3])
        return lambda env: apply(a(env), b(env))
    parts = [evaluator(n) for n in node[1:]]
    if kind == "get":
        value, key = parts
        return lambda env: lookup(value(env), key(env))
    if kind == "not":
        only = parts[0]
        return lambda env: not only(env)
    if kind == "and":
        a, b = parts
        return lambda env: a(env) and b(env)
    if kind == "or":
        a, b = parts
        return lambda env: a(env) or b(env)
    test, yes, no = parts
    return lambda env: yes(env) if test(env) else no(env)


def renderer(body: tuple) -> Callable[[dict], Iterator]:
    """A generator of a body's pieces."""
    steps = [_step(node) for node in body]
    if len(steps) == 1:
        return steps[0]

    def run(env):
        for step in steps:
            yield from step(env)
    return run


def _step(node: tuple) -> Callable[[dict], Iterator]:
    kind = node[0]
    if kind == "text":
        pieces = (node[1],)
        return lambda env: pieces
    if kind == "out":
        value = evaluator(node[1])
        return lambda env: (_text(value(env)),)
    if kind == "set":
        name, value = node[1], evaluator(node[2])

        def assign(env):
            env[name] = value(env)
            return ()
        return assign
    if kind == "generation":
        inner = renderer(node[1])

        def generation(env):
            yield OPEN
            yield from inner(env)
            yield CLOSE
        return generation
    if kind == "if":
        branches = [(evaluator(t), renderer(b)) for t, b in node[1]]
        other = renderer(node[2])

        def choose(env):
            for test, inner in branches:
                if test(env):
                    return inner(env)
            return other(env)
        return choose
    name, items, inner = node[1], evaluator(node[2]), renderer(node[3])

    def loop(env):
        values = iter(items(env) or ())
        scope, k = dict(env), 0
        ahead = next(values, ITEM_END)
        while ahead is not ITEM_END:
            scope[name], ahead = ahead, next(values, ITEM_END)
            scope["loop"] = {"index": k + 1, "index0": k, "first": k == 0, "last": ahead is ITEM_END}
            yield from inner(scope)
            yield ITEM_END
            k += 1
    return loop


def _uses(node, name: str, streamed: bool = False) -> Iterator[bool]:
    """For every use of a name, whether it is the outermost loop's list."""
    if isinstance(node, tuple):
        if node == ("name", name):
            yield streamed
        elif node and node[0] == "for":
            yield from _uses(node[2], name, True)
            yield from _uses(node[3], name)
        else:
            for part in node:
                yield from _uses(part, name)


class Template:
    """A compiled template. ``render`` yields its pieces; ``streams`` tells that
    the messages are only looped over, once, so they need not be a list."""

    def __init__(self, source: str):
        self.source = source
        self.tree = fold_body(parse(source))
        self.render = renderer(self.tree)
        outer = [n for n in self.tree if n[0] == "for" and n[2] == ("name", "messages")]
        uses = list(_uses(self.tree, "messages"))
        self.streams = len(outer) == 1 and uses == [True]

    def parts(self, messages: Iterable[dict], **names) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """(text, generated spans in characters of it), cut between items of the
        outer loop once a part has ``PART_CHARS`` characters; at least one part."""
        messages = messages if self.streams else list(messages)
        pieces, spans, size, start, made = [], [], 0, None, False
        for piece in self.render({"messages": messages, **names}):
            if piece is OPEN:
                if start is not None:
                    raise TemplateError("a generation block inside another")
                start = size
            elif piece is CLOSE:
                spans.append((start, size))
                start = None
            elif piece is ITEM_END:
                if size >= PART_CHARS and start is None:
                    yield "".join(pieces), spans
                    pieces, spans, size, made = [], [], 0, True
            else:
                pieces.append(piece)
                size += len(piece)
        if size or spans or not made:
            yield "".join(pieces), spans


# ---------------------------------------------------------------- Spark

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(key, its rows) of rows that come sorted by their first column. What is
    left unread of a group is skipped."""
    row = next(rows, None)
    while row is not None:
        key = row[0]

        def group():
            nonlocal row
            while row is not None and row[0] == key:
                yield row
                row = next(rows, None)
        members = group()
        yield key, members
        for _ in members:
            pass


def _format(source: str, id_type: pa.DataType):
    def run(batches):
        template = Template(source)
        waiting, size = [], 0

        def emit():
            ids, parts, texts, spans = zip(*waiting)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(parts, pa.int32()), pa.array(texts, pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS)],
                ["conv_id", "part", "formatted", "generated"])

        for conv, rows in _groups(_rows(batches)):
            messages = ({"role": r[1], "text": r[2]} for r in rows)
            for part, (text, spans) in enumerate(template.parts(messages)):
                waiting.append((conv, part, text, spans))
                size += len(text)
                if size >= PART_CHARS:
                    yield emit()
                    waiting, size = [], 0
        if waiting:
            yield emit()
    return run


def format_chats(conversations: DataFrame, template: str = DEFAULT_TEMPLATE, id_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations rendered by a template that loops over ``messages``, each
    with ``role`` and ``text``: ``conv_id``, ``part``, ``formatted`` and
    ``generated`` (array of start and end, in characters of ``formatted``, of
    what stands in generation blocks).

    A conversation's rows go by turn (null first), ties by role, then text;
    repeated rows are repeated turns. Null roles and texts are empty; rows
    without id are one conversation. A conversation of more than a million
    characters has several parts, cut after a turn, which follow each other in
    the same partition. Other columns play no part. An empty table gives an
    empty result. Raises TemplateError for a template that doesn't parse.
    """
    Template(template)
    rows = conversations.select(
        F.col(f"`{id_col}`").alias("conv_id"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.col(f"`{turn_col}`").alias("turn"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    field = rows.schema["conv_id"].dataType
    return dealt.select("conv_id", "role", "text").mapInArrow(
        _format(template, to_arrow_type(field)),
        f"conv_id {field.simpleString()}, part int, formatted string, generated array<struct<start: long, end: long>>")


_TURN = re.compile(r"<turn>### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.)*+)</turn>\n", re.S)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a text of the default template."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}: {formatted[at:at + 40]!r}")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def _read_back(id_type: pa.DataType):
    def run(batches):
        waiting = []

        def emit():
            cols = list(zip(*waiting))
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for conv, parts in _groups(_rows(batches)):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, text, spans in parts:
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                for span in spans:
                    said = unescape(text[span["start"]:span["end"]])
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
            waiting.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(waiting) >= 1000:
                yield emit()
                waiting = []
        if waiting:
            yield emit()
    return run


def read_back(formatted: DataFrame) -> DataFrame:
    """What the output of :func:`format_chats` with the default template says:
    ``conv_id``, ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed
    of each turn), ``loss_chars`` and ``loss_sha256`` (the unescaped text in the
    generated spans), ``formatted_chars``. The parts of a conversation must
    follow each other in a partition, as they do there. Raises ValueError if a
    text isn't wholly made of turns.
    """
    field = formatted.schema["conv_id"].dataType
    return formatted.select("conv_id", "formatted", "generated").mapInArrow(
        _read_back(to_arrow_type(field)),
        f"conv_id {field.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long")
