"""Chat formatting by templates in a small sandboxed language, compiled to Python closures.

The language has text, ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %}``/``{% elif %}``/
``{% else %}``, ``{% set name = expression %}`` and ``{% generation %}``; a dash inside a tag trims white space
next to it. Expressions have strings, whole numbers, names, fields of a message, ``loop.index``, ``loop.first``,
``loop.last``, ``==``, ``!=``, ``+``, ``and``, ``or``, ``not``, ``in`` over strings, parentheses and the filters
named in ``FILTERS``. Nothing else can be named or called, so a template reaches only its inputs.

A template is parsed to a syntax tree, constants are folded, and the tree becomes closures that yield pieces of
text with a flag that is set inside ``generation``. Messages are consumed one by one, so a conversation of any
length renders in bounded memory.

Control strings inside texts are escaped reversibly: a backslash goes before every backslash, ``[`` and ``<``,
and every control string of the template starts with a bare ``[`` or ``<``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import col, small_batches

INSTRUCT = (
    "{% for m in messages %}"
    "{% if m.role == 'assistant' %}{{ '[ASST]' }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ '</s>' }}"
    "{% elif m.role == 'user' %}{% if loop.first %}<s>{% endif %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]"
    "{% else %}{{ '[ROLE ' + (m.role | escape) + ' [TEXT] ' + (m.text | escape) + ' [/ROLE]' }}{% endif %}"
    "{% endfor %}"
)


def escape(text: str) -> str:
    return re.sub(r"[\\\[<]", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper}

# ---- syntax tree -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: str | int | bool


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: str
    name: str


@dataclass(frozen=True)
class Apply:
    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    pass


_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<word>[A-Za-z_]\w*)|(?P<sign>==|!=|[+().|]))""")
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"and", "or", "not", "in", "true", "false"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return wanted[0] if len(wanted) == 1 else self.tokens[self.at - 1][1]
        return None

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def chain(self, part, *ops: str):
        tree = part()
        while op := self.take(*ops):
            tree = Apply(op, (tree, part()))
        return tree

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.negation, "and")

    def negation(self):
        return Apply("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        return self.chain(self.total, "==", "!=", "in")

    def total(self):
        return self.chain(self.filtered, "+")

    def filtered(self):
        tree = self.atom()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "word" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = Apply(f"|{name}", (tree,))
        return tree

    def atom(self):
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(text))
        if text == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket stays open")
            return tree
        if kind != "word" or text in _WORDS - {"true", "false"} or text.startswith("_"):
            raise TemplateError(f"unexpected {text!r}")
        if text in ("true", "false"):
            return Const(text == "true")
        if self.take("."):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "word" or name.startswith("_"):
                raise TemplateError(f"no field {name!r}")
            self.at += 1
            return Field(text, name)
        return Name(text)


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    pieces = _TAG.split(source)
    for i in range(1, len(pieces), 2):
        if pieces[i][2] == "-":
            pieces[i - 1] = pieces[i - 1].rstrip()
        if pieces[i][-3] == "-":
            pieces[i + 1] = pieces[i + 1].lstrip()
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        out: list = []
        while at < len(pieces):
            piece, is_tag = pieces[at], at % 2 == 1
            at += 1
            if not is_tag:
                if piece:
                    out.append(Output(Const(piece)))
                continue
            inside = piece[2:-2].strip("-").strip()
            if piece.startswith("{{"):
                out.append(Output(_Expression(inside).whole()))
                continue
            word, _, rest = inside.partition(" ")
            if word in ends:
                return tuple(out), inside
            if word == "for":
                m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+messages", rest.strip())
                if not m:
                    raise TemplateError("a loop runs over messages")
                out.append(For(m[1], block("endfor")[0]))
            elif word == "if":
                branches, test = [], rest
                while True:
                    body, end = block("elif", "else", "endif")
                    branches.append((_Expression(test).whole() if test is not None else Const(True), body))
                    if end == "endif":
                        break
                    test = end[4:] if end.startswith("elif") else None
                out.append(If(tuple(branches)))
            elif word == "set":
                m = re.fullmatch(r"([A-Za-z]\w*)\s*=(.*)", rest.strip(), re.S)
                if not m:
                    raise TemplateError("set needs a name and a value")
                out.append(Set(m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                out.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected {inside!r}")
        if ends:
            raise TemplateError(f"no {' or '.join(ends)}")
        return tuple(out), ""

    return block()[0]


_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: a + b if isinstance(a, str) == isinstance(b, str) else str(a) + str(b),
    "in": lambda a, b: str(a) in str(b),
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
    **{f"|{name}": (lambda f: lambda a: f(str(a)))(f) for name, f in FILTERS.items()},
}


def fold(tree):
    """Expressions of constants become constants; tests that are constant leave one branch; texts in a row join."""
    if isinstance(tree, tuple):
        out: list = []
        for node in map(fold, tree):
            if isinstance(node, tuple):
                new = list(node)
            else:
                new = [node]
            for n in new:
                if out and isinstance(n, Output) and isinstance(out[-1], Output) and isinstance(n.value, Const) and isinstance(out[-1].value, Const):
                    out[-1] = Output(Const(_text(out[-1].value.value) + _text(n.value.value)))
                else:
                    out.append(n)
        return tuple(out)
    if isinstance(tree, Apply):
        args = tuple(map(fold, tree.args))
        return Const(_OPS[tree.op](*[a.value for a in args])) if all(isinstance(a, Const) for a in args) else Apply(tree.op, args)
    if isinstance(tree, Output):
        return Output(fold(tree.value))
    if isinstance(tree, Set):
        return Set(tree.name, fold(tree.value))
    if isinstance(tree, For):
        return For(tree.name, fold(tree.body))
    if isinstance(tree, Generation):
        return Generation(fold(tree.body))
    if isinstance(tree, If):
        kept: list = []
        for test, body in tree.branches:
            test = fold(test)
            if isinstance(test, Const) and not test.value:
                continue
            kept.append((test, fold(body)))
            if isinstance(test, Const):
                break
        if not kept:
            return ()
        return kept[0][1] if isinstance(kept[0][0], Const) else If(tuple(kept))
    return tree


def _text(value) -> str:
    return value if isinstance(value, str) else ("true" if value else "false") if isinstance(value, bool) else str(value)


Pieces = Iterator[tuple[str, bool]]


def _value(tree) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        return lambda scope: tree.value
    if isinstance(tree, Name):

        def named(scope: dict):
            if tree.name not in scope or tree.name == "messages":
                raise TemplateError(f"no value {tree.name!r}")
            return scope[tree.name]

        return named
    if isinstance(tree, Field):

        def field(scope: dict):
            owner = scope.get(tree.of)
            if not isinstance(owner, dict) or tree.name not in owner:
                raise TemplateError(f"no field {tree.of}.{tree.name}")
            return owner[tree.name]

        return field
    args = [_value(a) for a in tree.args]
    if tree.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if tree.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    op = _OPS[tree.op]
    return lambda scope: op(*[a(scope) for a in args])


def _body(tree: tuple) -> Callable[[dict, bool], Pieces]:
    parts = [_statement(node) for node in tree]

    def run(scope: dict, marked: bool) -> Pieces:
        for part in parts:
            yield from part(scope, marked)

    return run


def _statement(node) -> Callable[[dict, bool], Pieces]:
    if isinstance(node, Output):
        value = _value(node.value)

        def output(scope: dict, marked: bool) -> Pieces:
            yield _text(value(scope)), marked

        return output
    if isinstance(node, Set):
        value = _value(node.value)

        def assign(scope: dict, marked: bool) -> Pieces:
            scope[node.name] = value(scope)
            yield from ()

        return assign
    if isinstance(node, Generation):
        body = _body(node.body)
        return lambda scope, marked: body(scope, True)
    if isinstance(node, If):
        branches = [(_value(test), _body(body)) for test, body in node.branches]

        def choose(scope: dict, marked: bool) -> Pieces:
            for test, body in branches:
                if test(scope):
                    yield from body(scope, marked)
                    return

        return choose
    body = _body(node.body)

    def loop(scope: dict, marked: bool) -> Pieces:
        messages = iter(scope["messages"])
        index, now = 0, next(messages, None)
        while now is not None:
            after = next(messages, None)
            index += 1
            scope[node.name] = now
            scope["loop"] = {"index": index, "first": index == 1, "last": after is None}
            yield from body(scope, marked)
            now = after

    return loop


class Template:
    """A compiled template; ``render`` yields text with a flag for what lies under the loss mask."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self._run = _body(self.tree)

    def render(self, messages: Iterable[dict], **values) -> Pieces:
        return self._run({"messages": messages, **values}, False)


# ---- reading the format back -------------------------------------------------------------------------------

_MARK = re.compile(r"\\.|<s>|</s>| \[/(?:INST|SYS|ROLE)\]|\[(?:INST|SYS)\] |\[ROLE | \[TEXT\] |\[ASST\]", re.S)
_OPEN = {"[INST] ": "user", "[SYS] ": "system", "[ASST]": "assistant"}
_CLOSE = {" [/INST]", " [/SYS]", " [/ROLE]", "</s>"}


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of what :data:`INSTRUCT` has rendered."""
    turns: list[tuple[str, str]] = []
    role, start = None, 0
    for m in _MARK.finditer(formatted):
        mark = m[0]
        if mark.startswith("\\") or mark == "<s>":
            continue
        if mark in _OPEN:
            role, start = _OPEN[mark], m.end()
        elif mark == "[ROLE ":
            start = m.end()
        elif mark == " [TEXT] ":
            role, start = unescape(formatted[start : m.start()]), m.end()
        elif mark in _CLOSE:
            turns.append((role, unescape(formatted[start : m.start()])))
    return turns


# ---- Spark -------------------------------------------------------------------------------------------------

PART = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("mask", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("last", T.BooleanType()),
    ]
)
# Characters of formatted text in one row; a longer conversation continues in the next row.
PART_CHARS = 1 << 20


def _ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns of a conversation behind one another, in one task and streamed, not gathered."""
    small_batches(df)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return (
        df.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), text(col(role_col)).alias("role"), text(col(text_col)).alias("text"))
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
    )


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, Iterator[dict]]]:
    """Each conversation as its id and a lazy run of messages; the run must be used up before the next."""
    rows = ((b.column(0).slice(i, 1), c, r, t) for b in batches for i, (c, r, t) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())))
    held = next(rows, None)
    while held is not None:
        cell, conv = held[0], held[1]

        def messages() -> Iterator[dict]:
            nonlocal held
            while held is not None and held[1] == conv:
                message = {"role": held[2], "text": held[3]}
                held = next(rows, None)
                yield message

        run = messages()
        yield cell, run
        for _ in run:
            pass


def format_conversations(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, source: str = INSTRUCT, part_chars: int = PART_CHARS) -> DataFrame:
    """Rows ``conv``, ``part``, ``formatted``, ``mask``, ``last``: each conversation rendered by the template.

    A conversation of over ``part_chars`` characters continues in further rows, numbered from 0, cut between
    pieces of the template; ``mask`` has the ranges under the loss mask, counted in code points from the start of
    the conversation. Turns are ordered by turn, then role and text, so ties and repeated rows have one result;
    a null turn comes first; a null role or text counts as empty; null ids form one conversation; an empty table
    gives no rows. Other columns play no part. Memory is bounded by one part and one message.
    """
    ordered = _ordered(df, conv_col, turn_col, role_col, text_col)
    kind = ordered.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *PART.fields])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        for cell, messages in _conversations(batches):
            pieces, mask, held, at, part = [], [], 0, 0, 0

            def row(last: bool) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [cell, pa.array([part], pa.int64()), pa.array(["".join(pieces)]), pa.array([mask], span), pa.array([last])], names=["conv", "part", "formatted", "mask", "last"]
                )

            for piece, marked in template.render(messages):
                if held and held + len(piece) > part_chars:
                    yield row(False)
                    pieces, mask, held, part = [], [], 0, part + 1
                if marked and piece:
                    if mask and mask[-1]["end"] == at:
                        mask[-1]["end"] = at + len(piece)
                    else:
                        mask.append({"start": at, "end": at + len(piece)})
                pieces.append(piece)
                held += len(piece)
                at += len(piece)
            yield row(True)

    return ordered.mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation of :func:`format_conversations`, what reading it back gives, as counts and digests.

    The parts of a conversation pass through one task in order; a turn that continues in the next part is
    carried over.
    """
    kind = formatted.schema["conv"].dataType
    schema = T.StructType(
        [
            T.StructField("conv", kind),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    ordered = formatted.repartition("conv").sortWithinPartitions("conv", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def close() -> pa.RecordBatch:
            cell, n, turns, chars, loss, total, rest = state
            assert not rest, "a turn stays open"
            values = [pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([chars], pa.int64()), pa.array([loss.hexdigest()]), pa.array([total], pa.int64())]
            return pa.RecordBatch.from_arrays([cell, *values], names=schema.names)

        for batch in batches:
            for i in range(batch.num_rows):
                cell, part, text, mask = batch.column(0).slice(i, 1), *(batch.column(k)[i].as_py() for k in (1, 2, 3))
                if part == 0:
                    if state is not None:
                        yield close()
                    state = [cell, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, ""]
                for span in mask:
                    plain = unescape(text[span["start"] - state[5] : span["end"] - state[5]])
                    state[3] += len(plain)
                    state[4].update(plain.encode())
                state[5] += len(text)
                # A part ends between pieces: the open turn, if any, goes on in the next.
                whole = state[6] + text
                last = max((m.end() for m in _MARK.finditer(whole) if m[0] in _CLOSE), default=0)
                for role, said in read_back(whole[:last]):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                state[6] = whole[last:]
        if state is not None:
            yield close()

    return ordered.mapInArrow(run, schema)
