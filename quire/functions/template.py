"""A model's chat template as one ``concat``.

Model folders carry the template as text in a small template language.  Here
it is worked out on the driver for a fixed list of messages: loops are
unrolled, tests on roles and loop positions are decided, and message contents
stay columns, so what is left is literals and columns in a row.

Understood: ``for`` over the messages (or a name or slice of them), ``if`` /
``elif`` / ``else``, ``set``, output of expressions; in expressions strings, numbers, names,
``message['role']`` and ``message.role``, ``loop.first``, ``.last``, ``.index``,
``.index0``, ``+``, ``==``, ``!=``, ``<`` and the like, ``%``, ``and``, ``or``, ``not``, ``in``,
``is defined``, the filter ``trim`` and the method ``strip``, and
``raise_exception(...)``.  White space around blocks goes as model libraries have it: a line end
behind a block and blanks before it are dropped, and ``-`` drops all on its side.  Anything
else, and any test on a content, is an error that names it.
"""

from __future__ import annotations

import ast
import json
import operator
import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import strip

_BLOCK = re.compile(r"([ \t]*)(\{%-?|\{\{-?|\{#-?)(.*?)(-?%\}|-?\}\}|-?#\})", re.S)
_STRING = re.compile(r"('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")", re.S)
_COMPARE = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge}


class TemplateError(ValueError):
    """The template asks for something that is not understood, or raises an error itself."""


class Text:
    """A text that holds columns: literals and columns in a row."""

    def __init__(self, parts: list[str | Column]):
        self.parts = parts

    def trimmed(self) -> Text:
        if len(self.parts) == 1 and isinstance(self.parts[0], Column):
            return Text([strip(self.parts[0])])
        return Text([strip(self.column())])

    def column(self) -> Column:
        joined: list[str | Column] = []
        for p in self.parts:
            if isinstance(p, str) and joined and isinstance(joined[-1], str):
                joined[-1] += p
            else:
                joined.append(p)
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in joined if not isinstance(p, str) or p] or [F.lit("")])


def _parts(value) -> list[str | Column]:
    return value.parts if isinstance(value, Text) else [str(value)]


def _pieces(source: str) -> list[tuple[str, str]]:
    """(kind, text) in order: ``text``, ``%`` statements and ``{`` outputs; comments are gone."""
    out, at, eat_line, eat_all = [], 0, False, False

    def text(chunk: str, keep_end: bool) -> str:
        if eat_all:
            chunk = chunk.lstrip()
        elif eat_line and chunk.startswith("\n"):
            chunk = chunk[1:]
        return chunk if keep_end else chunk.rstrip()

    for m in _BLOCK.finditer(source):
        blanks, opens, body, closes = m.groups()
        before = source[at:m.start()]
        output = opens.startswith("{{")
        alone = not (before or at) or before.endswith("\n") or (not before and eat_line)
        plain = before + ("" if alone and not output else blanks)
        out.append(("text", text(plain, not opens.endswith("-"))))
        if not opens.startswith("{#"):
            out.append(("{" if output else "%", body.strip()))
        at, eat_line, eat_all = m.end(), not output, closes.startswith("-")
    out.append(("text", text(source[at:], True)))
    return [p for p in out if p != ("text", "")]


def _tree(pieces: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[list, int]:
    """Nested statements up to one of ``ends``, and where that stands."""
    out = []
    while at < len(pieces):
        kind, body = pieces[at]
        word = body.split(None, 1)[0] if kind == "%" and body else ""
        if kind != "%":
            out.append((kind, body))
        elif word in ends:
            return out, at
        elif word == "for":
            inner, at = _tree(pieces, at + 1, ("endfor",))
            out.append(("for", body, inner))
        elif word == "if":
            cases, test = [], body[2:]
            while True:
                inner, at = _tree(pieces, at + 1, ("elif", "else", "endif"))
                cases.append((test, inner))
                word, _, rest = pieces[at][1].partition(" ")
                if word == "endif":
                    break
                test = rest if word == "elif" else "true"
            out.append(("if", cases))
        elif word == "set":
            out.append(("set", body[3:]))
        else:
            raise TemplateError(f"statement not understood: {body}")
        at += 1
    if ends:
        raise TemplateError(f"no {' or '.join(ends)}")
    return out, at


def _python(expression: str) -> ast.expr:
    """The expression as a Python tree; filters bind closer than operators, so ``x | trim`` becomes ``x.trim``."""
    outside = _STRING.split(expression)
    for i in range(0, len(outside), 2):
        part = re.sub(r"\s*\|\s*trim\b", ".trim", outside[i])
        part = re.sub(r"\bis\s+not\s+defined\b", ".undefined_", part)
        outside[i] = re.sub(r"\s+\.undefined_", ".undefined_", re.sub(r"\s*\bis\s+defined\b", ".defined_", part))
    try:
        return ast.parse("".join(outside).strip(), mode="eval").body
    except SyntaxError as e:
        raise TemplateError(f"expression not understood: {expression}") from e


_ABSENT = object()


class _Run:
    def __init__(self, names: dict):
        self.names = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None, **names}
        self.out: list[str | Column] = []

    def error(self, node: ast.AST) -> TemplateError:
        return TemplateError(f"not understood: {ast.unparse(node)}")

    def value(self, node: ast.expr):
        match node:
            case ast.Constant():
                return node.value
            case ast.Name():
                return self.names.get(node.id, _ABSENT)
            case ast.Attribute(value=of, attr="defined_"):
                return self.value(of) is not _ABSENT
            case ast.Attribute(value=of, attr="undefined_"):
                return self.value(of) is _ABSENT
            case ast.Attribute(value=of, attr="trim"):
                of = self.value(of)
                return of.trimmed() if isinstance(of, Text) else str(of).strip()
            case ast.Attribute(value=of, attr=key):
                return self.item(self.value(of), key, node)
            case ast.Subscript(value=of, slice=ast.Slice(lower=low, upper=high, step=None)):
                of = self.value(of)
                if not isinstance(of, list):
                    raise self.error(node)
                return of[slice(*(None if x is None else self.value(x) for x in (low, high)))]
            case ast.Subscript(value=of, slice=key):
                return self.item(self.value(of), self.value(key), node)
            case ast.BinOp(left=a, op=ast.Add(), right=b):
                a, b = self.known(a), self.known(b)
                if isinstance(a, Text) or isinstance(b, Text):
                    return Text([*_parts(a), *_parts(b)])
                return a + b
            case ast.BinOp(left=a, op=ast.Mod(), right=b):
                return self.decided(a) % self.decided(b)
            case ast.BoolOp(op=op, values=values):
                for v in values:
                    result = self.decided(v)
                    if bool(result) != isinstance(op, ast.And):
                        break
                return result
            case ast.UnaryOp(op=ast.Not(), operand=v):
                return not self.decided(v)
            case ast.UnaryOp(op=ast.USub(), operand=v):
                return -self.decided(v)
            case ast.Compare(left=a, ops=[op], comparators=[b]) if type(op) in _COMPARE:
                return _COMPARE[type(op)](self.decided(a), self.decided(b))
            case ast.Compare(left=a, ops=[ast.In() | ast.NotIn() as op], comparators=[b]):
                return (self.decided(a) in self.decided(b)) == isinstance(op, ast.In)
            case ast.List(elts=values) | ast.Tuple(elts=values):
                return [self.value(v) for v in values]
            case ast.Call(func=ast.Name(id="raise_exception"), args=args):
                raise TemplateError("the template raises: " + " ".join(str(self.value(a)) for a in args))
            case ast.Call(func=ast.Attribute(value=of, attr="strip"), args=[]):
                return self.value(ast.Attribute(value=of, attr="trim", ctx=ast.Load()))
        raise self.error(node)

    def item(self, of, key, node):
        if isinstance(of, dict):
            return of.get(key, _ABSENT)
        if isinstance(of, list) and isinstance(key, int) and -len(of) <= key < len(of):
            return of[key]
        raise self.error(node)

    def known(self, node: ast.expr):
        value = self.value(node)
        if value is _ABSENT:
            raise TemplateError(f"no value for {ast.unparse(node)}")
        return value

    def decided(self, node: ast.expr):
        value = self.value(node)
        if isinstance(value, Text):
            raise TemplateError(f"a test on a content: {ast.unparse(node)}")
        return False if value is _ABSENT else value

    def run(self, tree: list) -> None:
        for statement in tree:
            match statement:
                case ("text", body):
                    self.out.append(body)
                case ("{", body):
                    value = self.known(_python(body))
                    self.out += _parts("" if value is None else value)
                case ("set", body):
                    name, sign, value = body.partition("=")
                    if not sign or not name.strip().isidentifier():
                        raise TemplateError(f"statement not understood: set{body}")
                    self.names[name.strip()] = self.known(_python(value))
                case ("if", cases):
                    for test, inner in cases:
                        if self.decided(_python(test)):
                            self.run(inner)
                            break
                case ("for", body, inner):
                    self.loop(body, inner)

    def loop(self, body: str, inner: list) -> None:
        m = re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", body, re.S)
        items = self.known(_python(m[2])) if m else None
        if not isinstance(items, list):
            raise TemplateError(f"statement not understood: {body}")
        before = dict(self.names)
        for i, item in enumerate(items):
            self.names = {**before, m[1]: item, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(items) - 1, "length": len(items)}}
            self.run(inner)
        self.names = before


@dataclass(frozen=True)
class ModelTemplate:
    """A chat template as text, with the values of its names (``bos_token``, ``eos_token``); used like ``prompts.ChatTemplate``."""

    source: str
    names: dict = field(default_factory=dict)

    @classmethod
    def from_config(cls, text: str) -> ModelTemplate:
        """From the JSON text of a tokenizer configuration: its ``chat_template`` and special tokens."""
        config = json.loads(text)
        if not isinstance(config.get("chat_template"), str):
            raise TemplateError("the configuration has no chat_template")
        tokens = {k: v["content"] if isinstance(v, dict) else v for k, v in config.items() if k.endswith("_token")}
        return cls(config["chat_template"], {k: v for k, v in tokens.items() if isinstance(v, str)})

    def render_parts(self, parts: list[tuple[str, Column]], add_generation_prompt: bool = False) -> Column:
        """The template over fixed (role, content) messages: one flat ``concat``."""
        run = _Run({**self.names, "messages": [{"role": role, "content": Text([content])} for role, content in parts],
                    "add_generation_prompt": add_generation_prompt})
        tree, _ = _tree(_pieces(self.source), 0, ())
        run.run(tree)
        return Text(run.out).column()
