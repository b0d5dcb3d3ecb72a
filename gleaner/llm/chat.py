"""Conversations rendered by compiled templates, with the spans a model is trained on.

A template is parsed into a syntax tree, constants are folded, and every node
becomes a Python closure. The language has text, ``{{ expression }}``,
``{% for x in y %}``, ``{% if %}/{% elif %}/{% else %}``, ``{% set %}`` and
``{% generation %}``, which marks what the model is to learn. It is sandboxed:
names, literals, fields of mappings, comparisons, ``and or not``, ``~`` and a
fixed set of filters; no calls, no attributes of objects.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strings with which chat formats steer a model.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]",
)
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL)
# A control string, its first character followed by any number of backslashes.
ESCAPE = rf"([<\[])(\\*)({_RESTS})"
UNESCAPE = rf"([<\[])\\(\\*)({_RESTS})"

CHATML = (
    "{% for message in messages %}<|im_start|>{{ message.role | escape_line }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
# Characters of output after which a part of a long conversation is handed on.
PART_CHARS = 32_768


def escape(text: str) -> str:
    """Control strings made harmless by one more backslash behind their first character."""
    return re.sub(ESCAPE, r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return re.sub(UNESCAPE, r"\1\2\3", text)


def escape_line(text: str) -> str:
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


FILTERS: dict[str, Callable] = {
    "escape": escape, "escape_line": escape_line, "trim": str.strip, "lower": str.lower, "upper": str.upper, "length": len,
}


class TemplateError(ValueError):
    pass


# Expressions: a syntax tree of tuples, ("lit", value), ("name", n), ("field", tree, key) ...
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>~+|.\[\]()-]))")
_WORDS = {"true": True, "false": False, "none": None}


def _tokens(source: str) -> list[tuple[str, object]]:
    found, at, source = [], 0, source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected text in expression: {source[at:]!r}")
        number, string, name, sign = m.groups()
        if number is not None:
            found.append(("lit", int(number)))
        elif string is not None:
            found.append(("lit", re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), string[1:-1])))
        elif name is not None:
            found.append(("lit", _WORDS[name.lower()]) if name.lower() in _WORDS else ("name", name))
        else:
            found.append(("sign", sign))
        at = m.end()
    return found


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.rest = _tokens(source)[::-1]
        self.tree = self.binary(0)
        if self.rest:
            raise TemplateError(f"unexpected {self.rest[-1][1]!r} in expression {source!r}")

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">="), ("~", "+", "-"))

    def take(self, *wanted: str):
        if self.rest and self.rest[-1][0] != "lit" and self.rest[-1][1] in wanted:
            return self.rest.pop()[1]
        return None

    def binary(self, level: int):
        if level == len(self.LEVELS):
            return self.postfix()
        if level == 2 and self.take("not"):
            return fold(("not", self.binary(level)))
        tree = self.binary(level + 1)
        while sign := self.take(*self.LEVELS[level]):
            tree = fold((sign, tree, self.binary(level + 1)))
        return tree

    def postfix(self):
        if self.take("("):
            tree = self.binary(0)
            self.need(")")
        elif self.rest and self.rest[-1][0] in ("lit", "name"):
            tree = self.rest.pop()
        else:
            raise TemplateError("an expression is missing a value")
        while sign := self.take(".", "[", "|"):
            if sign == "[":
                tree = fold(("field", tree, self.binary(0)))
                self.need("]")
                continue
            if not self.rest or self.rest[-1][0] != "name":
                raise TemplateError(f"a name must follow {sign!r}")
            name = self.rest.pop()[1]
            if sign == "|" and name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            tree = fold(("filter", tree, name) if sign == "|" else ("field", tree, ("lit", name)))
        return tree

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise TemplateError(f"{sign!r} is missing")


def _text(value) -> str:
    return "" if value is None else str(value)


_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "+": lambda a, b: a + b, "-": lambda a, b: a - b,
    "~": lambda a, b: _text(a) + _text(b),
}


def fold(tree: tuple) -> tuple:
    """A node whose parts are all constant becomes its value."""
    kind = tree[0]
    parts = [p for p in tree[1:] if isinstance(p, tuple)]
    if kind in ("lit", "name") or any(p[0] != "lit" for p in parts):
        return tree
    try:
        return ("lit", expression(tree)({}))
    except TypeError as error:
        raise TemplateError(f"constants do not fit: {error}") from error


def _field(value, key):
    """A field of a mapping or an item of a list; anything else, and what is missing, is none."""
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, list) and isinstance(key, int) and -len(value) <= key < len(value):
        return value[key]
    return None


def expression(tree: tuple) -> Callable[[dict], object]:
    """The closure that evaluates an expression in a scope of names."""
    kind = tree[0]
    if kind == "lit":
        return lambda scope, value=tree[1]: value
    if kind == "name":
        return lambda scope, name=tree[1]: scope.get(name)
    if kind == "filter":
        inner, apply = expression(tree[1]), FILTERS[tree[2]]
        return lambda scope: apply(_text(inner(scope)))
    if kind == "not":
        inner = expression(tree[1])
        return lambda scope: not inner(scope)
    left, right = expression(tree[1]), expression(tree[2])
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    if kind == "field":
        return lambda scope: _field(left(scope), right(scope))
    return lambda scope, apply=_BINARY[kind]: apply(left(scope), right(scope))


# Statements: parsed into nodes, then compiled into generators of (text, learnt) pieces.
_PIECES = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)


def parse(template: str) -> list[tuple]:
    """The syntax tree of a template, with adjacent constant texts joined."""
    pieces = [p for p in _PIECES.split(template) if p][::-1]

    def block(*ends: str) -> tuple[list[tuple], str]:
        nodes: list[tuple] = []
        while pieces:
            piece = pieces.pop()
            if piece.startswith("{{"):
                tree = _Expression(piece[2:-2]).tree
                nodes.append(("text", _text(tree[1])) if tree[0] == "lit" else ("out", tree))
            elif piece.startswith("{%"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in ends:
                    return joined(nodes), word + " " + rest
                nodes.extend(statement(word, rest.strip()))
            else:
                nodes.append(("text", piece))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return joined(nodes), ""

    def statement(word: str, rest: str) -> list[tuple]:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return [("for", m[1], _Expression(m[2]).tree, block("endfor")[0])]
        if word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError(f"cannot read set {rest!r}")
            return [("set", name.strip(), _Expression(value).tree)]
        if word == "generation":
            return [("generation", block("endgeneration")[0])]
        if word == "if":
            branches, end = [], "if " + rest
            while not end.startswith("endif"):
                word, _, rest = end.partition(" ")
                test = ("lit", True) if word == "else" else _Expression(rest).tree
                body, end = block(*(("endif",) if word == "else" else ("elif", "else", "endif")))
                if test[0] != "lit" or test[1]:
                    branches.append((test, body))
            if branches and branches[0][0][0] == "lit":
                return branches[0][1]
            return [("if", branches)] if branches else []
        raise TemplateError(f"unknown statement {word!r}")

    return block()[0]


def joined(nodes: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        else:
            out.append(node)
    return out


def compile_nodes(nodes: list[tuple]) -> Callable[[dict, bool], Iterator[tuple[str, bool]]]:
    runs = [_statement(n) for n in nodes]

    def run(scope: dict, learnt: bool) -> Iterator[tuple[str, bool]]:
        for step in runs:
            yield from step(scope, learnt)

    return run


def _statement(node: tuple):
    kind = node[0]
    if kind == "text":
        return lambda scope, learnt, text=node[1]: ((text, learnt),)
    if kind == "out":
        value = expression(node[1])
        return lambda scope, learnt: ((_text(value(scope)), learnt),)
    if kind == "set":
        value = expression(node[2])

        def assign(scope, learnt):
            scope[node[1]] = value(scope)
            return ()

        return assign
    if kind == "generation":
        body = compile_nodes(node[1])
        return lambda scope, learnt: body(scope, True)
    if kind == "if":
        branches = [(expression(t), compile_nodes(b)) for t, b in node[1]]

        def choose(scope, learnt):
            return next((body(scope, learnt) for test, body in branches if test(scope)), ())

        return choose
    items, body = expression(node[2]), compile_nodes(node[3])

    def loop(scope, learnt):
        # One item ahead, so that an unbounded iterator of turns is never held whole.
        ahead, done, index = iter(items(scope) or ()), object(), 0
        item = next(ahead, done)
        while item is not done:
            follow = next(ahead, done)
            inner = scope | {node[1]: item, "loop": {"index0": index, "index": index + 1, "first": not index, "last": follow is done}}
            yield from body(inner, learnt)
            item, index = follow, index + 1

    return loop


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """A function from messages to pieces of output, each with whether the model learns it."""
    run = compile_nodes(parse(template))
    return lambda messages: run({"messages": messages}, False)


PARTS = "conv_id string, part long, text string, spans array<struct<start:int,end:int>>"


def format_conversations(turns: DataFrame, template: str = CHATML) -> DataFrame:
    """Rendered conversations in parts: conv_id, part, text, spans.

    A conversation's parts, in order, are its whole text; spans are offsets in
    code points of the part's text that lie under ``{% generation %}``. Turns
    are ordered by turn, role and text, nulls first; null roles and texts are
    empty; a null conv_id is a conversation of its own; repeated rows are
    repeated turns; other columns are not read. Turns of a conversation stream
    through one task in sorted order, a part at a time, so even a conversation
    with a third of all rows is never held in memory.
    """
    compile_template(template)  # an error in it is the caller's, not the tasks'
    ordered = (
        turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text")
    )

    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = compile_template(template)
        rows = (r for f in frames for r in zip(f["conv_id"], f["role"], f["text"]))
        row = next(rows, None)
        ready: list[tuple] = []
        while row is not None:
            conv = row[0]

            def messages(conv=conv):
                nonlocal row
                while row is not None and row[0] == conv:
                    yield {"role": row[1], "text": row[2]}
                    row = next(rows, None)

            part, size, texts, spans = 0, 0, [], []
            for text, learnt in run(messages()):
                if learnt and text:
                    spans.append({"start": size, "end": size + len(text)})
                texts.append(text)
                size += len(text)
                if size >= PART_CHARS:
                    ready.append((conv, part, "".join(texts), spans))
                    part, size, texts, spans = part + 1, 0, [], []
                    if len(ready) >= 64:
                        yield _frame(ready)
                        ready = []
            for _ in messages():  # turns that the template has left unread
                pass
            ready.append((conv, part, "".join(texts), spans))
            if len(ready) >= 512:
                yield _frame(ready)
                ready = []
        if ready:
            yield _frame(ready)

    kind = turns.schema["conv_id"].dataType
    return ordered.mapInPandas(render, PARTS).withColumn("conv_id", F.col("conv_id").cast(kind))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "part", "text", "spans"])


DIGESTS = (
    "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
START, END = "<|im_start|>", "<|im_end|>\n"


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation, read from the rendered parts alone.

    Turns are found by their marks and unescaped; the loss text is what the
    spans cover, unescaped. Expects the parts of ``format_conversations`` with
    the built-in template, still in their order. No parts give no rows.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for frame in frames:
            done = []
            for conv, part, text, spans in zip(frame["conv_id"], frame["part"], frame["text"], frame["spans"]):
                if part == 0:
                    if state:
                        done.append(state.row())
                    state = _Reader(conv)
                state.add(text, spans)
            if done:
                yield _digests(done)
        if state:
            yield _digests([state.row()])

    kind = parts.schema["conv_id"].dataType
    digests = parts.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(read, DIGESTS)
    return digests.withColumn("conv_id", F.col("conv_id").cast(kind))


def _digests(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


class _Reader:
    """Digests of one conversation; holds no more than one turn."""

    def __init__(self, conv):
        self.conv, self.turns, self.rest = conv, 0, ""
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0

    def add(self, text: str, spans) -> None:
        self.chars += len(text)
        for span in spans:
            learnt = unescape(text[span["start"]:span["end"]])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode("utf-8", "surrogatepass"))
        self.rest += text
        while (end := self.rest.find(END)) >= 0:
            turn, self.rest = self.rest[:end], self.rest[end + len(END):]
            if not turn.startswith(START):
                raise ValueError("a turn does not begin with its mark")
            role, _, said = turn[len(START):].partition("\n")
            self.said.update(f"{unescape_line(role)}\n{unescape(said)}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1

    def row(self) -> tuple:
        return self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests_sql() -> str:
    """SQL of the digests, with conversation -7 added."""
    pattern = ESCAPE.replace("'", "''")
    esc = lambda x: f"regexp_replace({x}, '{pattern}', '\\1\\\\\\2\\3', 'g')"
    line = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
    marks = len(START) + 1 + len(END)
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({marks} + length({esc(line)}) + length({esc("text")}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def template_tree(template: str) -> str:
    """The folded syntax tree as JSON, for looking at a template."""
    return json.dumps(parse(template))
