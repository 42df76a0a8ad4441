"""A compiler for chat templates: text to syntax tree, constants folded, tree to Python closures.

    {{ expression }}   {% set name = expression %}   {% if e %} {% elif e %} {% else %} {% endif %}
    {% for name in e %} {% endfor %}   {% generation %} {% endgeneration %}   {# comment #}

Expressions know strings, whole numbers, true, false, none, names, a.b and a['b'], + - == != < > <= >= and or not, parentheses
and filters (value | name).  There are no calls, no Python attributes and no statements with effects: a.b
reads a mapping's key, and filters are a fixed table.  Rendering is lazy, so a conversation of any length passes
through one message at a time, as (text, whether it is under a generation marker) pieces.
"""

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any, NamedTuple

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKENS = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+<>|.()\[\]=]))")
_OPERATIONS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "+": lambda a, b: a + b if type(a) is type(b) else _text(a) + _text(b),
    "-": lambda a, b: a - b,
}
_LEVELS = (("==", "!=", "<", ">", "<=", ">="), ("+", "-"))
_CONSTANTS = {"true": True, "false": False, "none": None}

Piece = tuple[str, bool]


class TemplateError(ValueError):
    """The template is not in the language."""


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Apply(NamedTuple):
    """An operation on expressions; folded where all of them are constants."""

    function: Callable[..., Any]
    parts: tuple


class Choice(NamedTuple):
    """and / or, which evaluate their right side only where needed."""

    stop: bool
    left: Any
    right: Any


class Output(NamedTuple):
    value: Any


class Assign(NamedTuple):
    name: str
    value: Any


class Branch(NamedTuple):
    test: Any
    yes: list
    no: list


class Loop(NamedTuple):
    name: str
    values: Any
    body: list


class Generation(NamedTuple):
    body: list


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _key(value: Any, key: Any) -> Any:
    return value.get(key) if isinstance(value, Mapping) else None


def apply(function: Callable[..., Any], *parts: Any) -> Any:
    if all(isinstance(p, Const) for p in parts):
        return Const(function(*(p.value for p in parts)))
    return Apply(function, parts)


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable[[str], str]]):
        self.tokens, self.filters, at = [], filters, 0
        source = source.strip()
        while at < len(source):
            found = _TOKENS.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(found.groups())
            at = found.end()
        self.at = 0

    def peek(self, *wanted: str) -> str | None:
        """The next token if it is one of the wanted words or signs."""
        if self.at < len(self.tokens):
            _, _, name, sign = self.tokens[self.at]
            if (name or sign) in wanted:
                return name or sign
        return None

    def take(self, *wanted: str) -> str | None:
        found = self.peek(*wanted)
        self.at += found is not None
        return found

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise TemplateError(f"{sign} expected")

    def whole(self) -> Any:
        value = self.either()
        if self.at != len(self.tokens):
            raise TemplateError("an expression ends early")
        return value

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = self.choice(True, left, self.both())
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = self.choice(False, left, self.negated())
        return left

    def choice(self, stop: bool, left: Any, right: Any) -> Any:
        if isinstance(left, Const):
            return left if bool(left.value) is stop else right
        return Choice(stop, left, right)

    def negated(self) -> Any:
        if self.take("not"):
            return apply(lambda a: not a, self.negated())
        return self.level(0)

    def level(self, depth: int) -> Any:
        if depth == len(_LEVELS):
            return self.filtered()
        left = self.level(depth + 1)
        while sign := self.take(*_LEVELS[depth]):
            left = apply(_OPERATIONS[sign], left, self.level(depth + 1))
        return left

    def filtered(self) -> Any:
        value = self.member()
        while self.take("|"):
            name = self.word()
            if name not in self.filters:
                raise TemplateError(f"no filter {name}")
            value = apply(lambda a, f=self.filters[name]: f(_text(a)), value)
        return value

    def word(self) -> str:
        if self.at == len(self.tokens) or not self.tokens[self.at][2]:
            raise TemplateError("a name is expected")
        self.at += 1
        return self.tokens[self.at - 1][2]

    def member(self) -> Any:
        value = self.atom()
        while sign := self.take(".", "["):
            if sign == ".":
                value = apply(_key, value, Const(self.word()))
            else:
                value = apply(_key, value, self.either())
                self.need("]")
        return value

    def atom(self) -> Any:
        if self.take("("):
            value = self.either()
            self.need(")")
            return value
        if self.at == len(self.tokens):
            raise TemplateError("a value is expected")
        quoted, number, name, sign = self.tokens[self.at]
        self.at += 1
        if quoted:
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), quoted[1:-1]))
        if number:
            return Const(int(number))
        if name and name not in ("and", "or", "not", "in"):
            return Const(_CONSTANTS[name]) if name in _CONSTANTS else Name(name)
        raise TemplateError(f"unexpected {name or sign}")


def parse(source: str, filters: Mapping[str, Callable[[str], str]]) -> list:
    """The syntax tree of a template, with constant expressions folded and dead branches gone."""
    parts: list[tuple[str, str]] = []
    at = 0
    for found in _PARTS.finditer(source):
        parts.append(("text", source[at : found.start()]))
        kind = "value" if found[1] is not None else "statement" if found[2] is not None else "comment"
        parts.append((kind, (found[1] or found[2] or "").strip()))
        at = found.end()
    parts.append(("text", source[at:]))
    reader = iter(parts)

    def expression(text: str) -> Any:
        return _Expression(text, filters).whole()

    def block(*ends: str) -> tuple[list, str]:
        nodes: list = []
        for kind, text in reader:
            if kind == "text" and text:
                nodes.append(Output(Const(text)))
            elif kind == "value":
                nodes.append(Output(expression(text)))
            elif kind == "statement":
                word, _, rest = text.partition(" ")
                if word in ends:
                    return folded(nodes), text
                nodes += statement(word, rest.strip())
        if ends:
            raise TemplateError(f"{ends[0]} is missing")
        return folded(nodes), ""

    def branch(test: Any) -> list:
        yes, end = block("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        no = branch(expression(rest)) if word == "elif" else block("endif")[0] if word == "else" else []
        if isinstance(test, Const):
            return yes if test.value else no
        return [Branch(test, yes, no)]

    def statement(word: str, rest: str) -> list:
        if word == "if":
            return branch(expression(rest))
        if word == "generation":
            return [Generation(block("endgeneration")[0])]
        if word == "for" and (found := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)):
            return [Loop(found[1], expression(found[2]), block("endfor")[0])]
        if word == "set" and (found := re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)\s*(.+)", rest, re.S)):
            return [Assign(found[1], expression(found[2]))]
        raise TemplateError(f"unknown statement {word} {rest}")

    return block()[0]


def folded(nodes: list) -> list:
    """Neighbouring constant outputs as one text."""
    out: list = []
    for node in nodes:
        constant = isinstance(node, Output) and isinstance(node.value, Const)
        if constant and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
            out[-1] = Output(Const(_text(out[-1].value.value) + _text(node.value.value)))
        elif not constant or _text(node.value.value):
            out.append(node)
    return out


def _evaluator(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda names, value=node.value: value
    if isinstance(node, Name):
        return lambda names, name=node.name: names.get(name)
    if isinstance(node, Choice):
        left, right = _evaluator(node.left), _evaluator(node.right)
        return lambda names, stop=node.stop: value if bool(value := left(names)) is stop else right(names)
    parts, function = [_evaluator(p) for p in node.parts], node.function
    if len(parts) == 1:
        return lambda names, one=parts[0]: function(one(names))
    return lambda names, one=parts[0], two=parts[1]: function(one(names), two(names))


def _looped(values: Iterable) -> Iterator[tuple[Any, dict]]:
    """Each value with what `loop` knows; one value is read ahead for loop.last."""
    reader = iter(values or ())
    missing = object()
    value, index = next(reader, missing), 0
    while value is not missing:
        ahead = next(reader, missing)
        yield value, {"index": index + 1, "index0": index, "first": index == 0, "last": ahead is missing}
        value, index = ahead, index + 1


def _renderer(nodes: list, marked: bool = False) -> Callable[[dict], Iterator[Piece]]:
    steps = []
    for node in nodes:
        if isinstance(node, Output):
            steps.append(lambda names, value=_evaluator(node.value): ((_text(value(names)), marked),))
        elif isinstance(node, Assign):
            steps.append(lambda names, n=node.name, value=_evaluator(node.value): names.update({n: value(names)}) or ())
        elif isinstance(node, Branch):
            test, yes, no = _evaluator(node.test), _renderer(node.yes, marked), _renderer(node.no, marked)
            steps.append(lambda names, test=test, yes=yes, no=no: yes(names) if test(names) else no(names))
        elif isinstance(node, Generation):
            steps.append(_renderer(node.body, True))
        else:
            values, body = _evaluator(node.values), _renderer(node.body, marked)

            def loop(names: dict, name: str = node.name, values=values, body=body) -> Iterator[Piece]:
                for value, state in _looped(values(names)):
                    yield from body({**names, name: value, "loop": state})

            steps.append(loop)

    def render(names: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(names)

    return render


def compile_template(
    source: str, filters: Mapping[str, Callable[[str], str]] | None = None
) -> Callable[[dict], Iterator[Piece]]:
    """A function from names to (text, under a generation marker) pieces."""
    known = {"trim": str.strip, "upper": str.upper, "lower": str.lower, **(filters or {})}
    return _renderer(parse(source, known))
