"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                          output
    {% for x in messages %} .. {% endfor %}   loop; loop.index, loop.first, loop.last
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = e %}
    {% generation %} .. {% endgeneration %}   output under the loss mask

Expressions: strings, whole numbers, true, false, none, names, ``x.field`` and
``x['field']``, ``a | filter``, ``~`` (join as text), ``+``, comparisons,
``in``, ``not``, ``and``, ``or``, parentheses.

Sandbox: ``x.field`` looks a key up in a mapping and nothing else; names and
filters must be known when the template is compiled; there are no calls, no
Python attributes and no unbounded loops.  A template is parsed into a syntax
tree, constant parts are folded (also branches never taken), and the tree is
turned into closures; a loop takes its items one by one from any iterator, so
a conversation is rendered in constant memory.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator


class TemplateError(ValueError):
    """The template can't be compiled, or an expression can't be evaluated."""


_TAG = re.compile(r"\{\{(?P<out>.*?)\}\}|\{%-?(?P<stmt>.*?)-?%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[<>+~|().\[\]=,]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None}
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le,
            ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b}
_WORDS = {"and", "or", "not", "in"}


def _text(v) -> str:
    if v is None:
        return ""
    return str(v).lower() if isinstance(v, bool) else str(v)


# -- syntax tree -------------------------------------------------------------
# Expressions: ("const", v) ("name", n) ("get", e, key) ("filter", name, e)
#   ("op", fn, a, b) ("not", e) ("and" | "or", a, b)
# Statements: ("text", s) ("out", e) ("for", name, e, body) ("if", [(e, body)], else)
#   ("set", name, e) ("generation", body)

class _Expression:
    def __init__(self, source: str, filters):
        self.tokens, self.at, self.filters = [], 0, filters
        pos, end = 0, len(source.rstrip())
        while pos < end:
            m = _TOKEN.match(source, pos)
            if not m:
                raise TemplateError(f"bad character in {source!r} at {pos}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            pos = m.end()

    def peek(self, *values: str) -> bool:
        return (self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name")
                and self.tokens[self.at][1] in values)

    def take(self, *values: str):
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def whole(self):
        tree = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negation()
        while self.take("and"):
            tree = ("and", tree, self.negation())
        return tree

    def negation(self):
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self):
        tree = self.sum()
        while op := self.take(*_COMPARE):
            tree = ("op", _COMPARE[op], tree, self.sum())
        return tree

    def sum(self):
        tree = self.filtered()
        while op := self.take("+", "~"):
            fn = operator.add if op == "+" else (lambda a, b: _text(a) + _text(b))
            tree = ("op", fn, tree, self.filtered())
        return tree

    def filtered(self):
        tree = self.primary()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("name expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def primary(self):
        if self.take("("):
            tree = self.either()
            self.expect(")")
        elif self.at >= len(self.tokens):
            raise TemplateError("expression expected")
        else:
            kind, value = self.tokens[self.at]
            self.at += 1
            if kind == "str":
                tree = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
            elif kind == "int":
                tree = ("const", int(value))
            elif kind == "name" and value not in _WORDS:
                tree = ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)
            else:
                raise TemplateError(f"unexpected {value!r}")
        while True:
            if self.take("."):
                tree = ("get", tree, ("const", self.name()))
            elif self.take("["):
                tree = ("get", tree, self.either())
                self.expect("]")
            else:
                return tree


def parse(source: str, filters: dict[str, Callable]) -> list:
    """The syntax tree of a template."""
    stack: list[tuple[str, list, list]] = [("", [], [])]     # (what is open, its body, its branches)

    def expression(s: str):
        return _Expression(s, filters).whole()

    pos = 0
    for m in _TAG.finditer(source):
        body = stack[-1][1]
        if m.start() > pos:
            body.append(("text", source[pos:m.start()]))
        pos = m.end()
        if m["out"] is not None:
            body.append(("out", expression(m["out"])))
            continue
        word, _, rest = m["stmt"].strip().partition(" ")
        what = stack[-1][0].partition(" ")[0]
        if word == "for" and (f := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)):
            stack.append((f"for {f[1]}", [], [expression(f[2])]))
        elif word == "if":
            stack.append(("if", [], [[expression(rest)]]))
        elif word == "elif" and what == "if":
            _, done, branches = stack.pop()
            branches[-1].append(done)
            stack.append(("if", [], [*branches, [expression(rest)]]))
        elif word == "else" and what == "if":
            _, done, branches = stack.pop()
            branches[-1].append(done)
            stack.append(("else", [], branches))
        elif word == "endif" and what in ("if", "else"):
            _, done, branches = stack.pop()
            other = done if what == "else" else []
            if what == "if":
                branches[-1].append(done)
            stack[-1][1].append(("if", [tuple(b) for b in branches], other))
        elif word == "endfor" and what == "for":
            opened, done, (items,) = stack.pop()
            stack[-1][1].append(("for", opened.partition(" ")[2], items, done))
        elif word == "generation" and not any(o[0] == "generation" for o in stack):
            stack.append(("generation", [], []))
        elif word == "endgeneration" and what == "generation":
            done = stack.pop()[1]
            stack[-1][1].append(("generation", done))
        elif word == "set" and (f := re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)):
            body.append(("set", f[1], expression(f[2])))
        else:
            raise TemplateError(f"unexpected statement {m['stmt'].strip()!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0].partition(' ')[0]!r} is not closed")
    if pos < len(source):
        stack[0][1].append(("text", source[pos:]))
    return stack[0][1]


# -- constant folding --------------------------------------------------------

def _fold_expression(e, filters):
    kind = e[0]
    if kind in ("const", "name"):
        return e
    parts = [_fold_expression(x, filters) if isinstance(x, tuple) else x for x in e[1:]]
    e = (kind, *parts)
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(x[0] == "const" for x in parts if isinstance(x, tuple)):
        return ("const", _closure(e, filters)({}))
    return e


def fold(body: list, filters: dict[str, Callable]) -> list:
    """The tree with constant expressions, branches and neighbouring texts merged."""
    out: list = []

    def add(node) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        kind = node[0]
        if kind == "out":
            e = _fold_expression(node[1], filters)
            add(("text", _text(e[1])) if e[0] == "const" else ("out", e))
        elif kind == "if":
            branches, other = [], fold(node[2], filters)
            for test, inner in node[1]:
                test = _fold_expression(test, filters)
                if test[0] != "const":
                    branches.append((test, fold(inner, filters)))
                elif test[1]:
                    other = fold(inner, filters)
                    break
            for n in [("if", branches, other)] if branches else other:
                add(n)
        elif kind == "for":
            add(("for", node[1], _fold_expression(node[2], filters), fold(node[3], filters)))
        elif kind == "set":
            add(("set", node[1], _fold_expression(node[2], filters)))
        elif kind == "generation":
            add(("generation", fold(node[1], filters)))
        else:
            add(node)
    return out


# -- closures ----------------------------------------------------------------

def _get(value, key):
    if isinstance(value, dict):
        return value.get(key)
    raise TemplateError(f"no field {key!r}: not a mapping")


def _closure(e, filters) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        value = e[1]
        return lambda env: value
    if kind == "name":
        name = e[1]

        def look_up(env):
            try:
                return env[name]
            except KeyError:
                raise TemplateError(f"{name!r} has no value here") from None
        return look_up
    if kind == "filter":
        fn, inner = filters[e[1]], _closure(e[2], filters)
        return lambda env: fn(inner(env))
    if kind == "not":
        inner = _closure(e[1], filters)
        return lambda env: not inner(env)
    if kind == "op":
        fn, a, b = e[1], _closure(e[2], filters), _closure(e[3], filters)

        def apply(env):
            try:
                return fn(a(env), b(env))
            except TypeError as x:
                raise TemplateError(str(x)) from None
        return apply
    a, b = _closure(e[1], filters), _closure(e[2], filters)
    if kind == "get":
        return lambda env: _get(a(env), b(env))
    if kind == "and":
        return lambda env: a(env) and b(env)
    return lambda env: a(env) or b(env)


def _check_names(body: list, known: set[str]) -> None:
    def names(e):
        if e[0] == "name":
            yield e[1]
        for x in e[1:]:
            if isinstance(x, tuple):
                yield from names(x)

    def check(e):
        for n in names(e):
            if n not in known:
                raise TemplateError(f"unknown name {n!r}")

    for node in body:
        if node[0] == "out":
            check(node[1])
        elif node[0] == "set":
            check(node[2])
            known.add(node[1])
        elif node[0] == "for":
            check(node[2])
            _check_names(node[3], known | {node[1], "loop"})
        elif node[0] == "if":
            for test, inner in node[1]:
                check(test)
                _check_names(inner, known)
            _check_names(node[2], known)
        elif node[0] == "generation":
            _check_names(node[1], known)


def _ahead(items: Iterable) -> Iterator[tuple[int, object, bool]]:
    """``(number from 1, item, is last)``, reading one item ahead."""
    it = iter(items)
    try:
        held = next(it)
    except StopIteration:
        return
    n = 1
    for following in it:
        yield n, held, False
        held, n = following, n + 1
    yield n, held, True


def _block(body: list, filters, masked: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    steps = []
    for node in body:
        kind = node[0]
        if kind == "text":
            piece = (node[1], masked)
            steps.append(lambda env, piece=piece: (piece,))
        elif kind == "out":
            value = _closure(node[1], filters)
            steps.append(lambda env, value=value: ((_text(value(env)), masked),))
        elif kind == "set":
            value = _closure(node[2], filters)
            steps.append(lambda env, name=node[1], value=value: env.__setitem__(name, value(env)) or ())
        elif kind == "generation":
            steps.append(_block(node[1], filters, True))
        elif kind == "if":
            tests = [(_closure(t, filters), _block(b, filters, masked)) for t, b in node[1]]
            other = _block(node[2], filters, masked)
            steps.append(lambda env, tests=tests, other=other: next(
                (b for t, b in tests if t(env)), other)(env))
        else:
            items, inner = _closure(node[2], filters), _block(node[3], filters, masked)

            def loop(env, name=node[1], items=items, inner=inner):
                for n, item, last in _ahead(items(env)):
                    yield from inner(env | {name: item, "loop": {"index": n, "first": n == 1, "last": last}})
            steps.append(loop)

    def run(env):
        for step in steps:
            yield from step(env)
    return run


FILTERS: dict[str, Callable] = {
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(),
    "title": lambda v: _text(v).title(), "text": _text,
}


def compile_template(source: str, names: Iterable[str] = ("messages",),
                     filters: dict[str, Callable] | None = None) -> Callable[..., Iterator[tuple[str, bool]]]:
    """A function of the named values that yields ``(text, under the loss mask)`` pieces."""
    filters = FILTERS | (filters or {})
    names = set(names)
    tree = fold(parse(source, filters), filters)
    _check_names(tree, set(names))
    run = _block(tree, filters, False)

    def render(**values):
        if missing := names - set(values):
            raise TemplateError(f"no value for {sorted(missing)}")
        return run(dict(values))
    return render
