"""A template language for conversations, compiled to closures.

Text stands as it is; ``{{ value }}`` prints, ``{% ... %}`` controls: ``for x in value``, ``if / elif /
else``, ``generation`` (its output is what a model learns to produce).  Values are literals, names,
attributes of a message, ``==``, ``!=``, ``in``, ``and``, ``or``, ``not``, ``+`` and filters after ``|``.  Nothing
else exists: no calls, no indexing, no access to Python objects.

``compile_template`` parses to a tree, folds what is constant (joined literals, decided branches, filters of
literals, neighbouring text), and turns the tree into closures that yield (text, learned) pieces.  They
take messages from any iterator, so a conversation is never held whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

Piece = tuple[str, bool]
Node = tuple[Any, ...]
Render = Callable[[dict[str, Any], bool], Iterator[Piece]]

# Strings that mean something to the reader of the formatted text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "␛"

DEFAULT_TEMPLATE = (
    "<s>{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}<<SYS>>{{ m.role | escape | one_line }}\n{{ m.text | escape }}<</SYS>>{% endif %}"
    "{% endfor %}"
)

_CONTROL = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROLS))))
_ESCAPED = re.compile(f"{ESCAPE}(.?)", re.S)


def escape(text: str) -> str:
    """No control string is left: each gets the escape sign behind its first character, and the sign is doubled."""
    return _CONTROL.sub(lambda m: ESCAPE * 2 if m[0] == ESCAPE else m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"n": "\n"}.get(m[1], m[1]), text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "one_line": lambda s: s.replace("\n", ESCAPE + "n"),
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


class TemplateError(ValueError):
    """The template is not in the language."""


_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_WORDS = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|(==|!=|[()|.+])|([A-Za-z_]\w*))""", re.S)
_KEYWORDS = {"and", "or", "not", "in", "true", "false"}


def _tokens(source: str) -> list[tuple[str, str]]:
    found, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _WORDS.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:at + 20]!r}")
        at = m.end()
        if m[1]:
            body = re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), m[1][1:-1], flags=re.S)
            found.append(("literal", body))
        elif m[2]:
            found.append(("number", m[2]))
        elif m[3] or m[4] in _KEYWORDS:
            found.append(("sign", m[3] or m[4]))
        else:
            found.append(("name", m[4]))
    return found


class _Values:
    """Recursive descent over the tokens of one value."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def sign(self, *signs: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "sign" and self.tokens[self.at][1] in signs:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def whole(self) -> Node:
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.sign("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.sign("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        return ("not", self.negated()) if self.sign("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        if op := self.sign("==", "!=", "in"):
            node = (op, node, self.joined())
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while self.sign("+"):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.single()
        while self.sign("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def single(self) -> Node:
        if self.sign("("):
            node = self.either()
            if not self.sign(")"):
                raise TemplateError("a bracket is open")
            return node
        if word := self.sign("true", "false"):
            return ("const", word == "true")
        kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind == "literal" or kind == "number":
            self.at += 1
            return ("const", word if kind == "literal" else int(word))
        node: Node = ("name", self.name())
        while self.sign("."):
            node = ("field", node, self.name())
        return node


def parse(source: str) -> Node:
    """The syntax tree of a template."""
    stack: list[list[Any]] = [["block", []]]
    at = 0
    for m in _PARTS.finditer(source):
        body = stack[-1][-1]
        if m.start() > at:
            body.append(("text", source[at:m.start()]))
        at = m.end()
        if m[1] is not None:
            body.append(("print", _Values(m[1]).whole()))
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for":
            values = _Values(rest)
            name = values.name()
            if not values.sign("in"):
                raise TemplateError("for needs in")
            stack.append(["for", name, values.whole(), []])
        elif word == "if":
            stack.append(["if", [], _Values(rest).whole(), []])
        elif word in ("elif", "else") and stack[-1][0] == "if" and stack[-1][2] is not None:
            _, branches, test, done = stack[-1]
            test_next = _Values(rest).whole() if word == "elif" else None
            stack[-1] = ["if", [*branches, (test, ("block", done))], test_next, []]
        elif word == "generation":
            stack.append(["generation", []])
        elif word == f"end{stack[-1][0]}" and len(stack) > 1:
            kind, *own, done = stack.pop()
            if kind == "if":
                own = [[*own[0], (own[1] if own[1] is not None else ("const", True), ("block", done))]]
                stack[-1][-1].append(("if", own[0]))
            else:
                stack[-1][-1].append((kind, *own, ("block", done)))
        else:
            raise TemplateError(f"unexpected {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not ended")
    if at < len(source):
        stack[-1][-1].append(("text", source[at:]))
    return ("block", stack[0][1])


def _const(node: Node) -> bool:
    return node[0] == "const"


def fold(node: Node) -> Node:
    """The same tree with everything constant worked out."""
    kind = node[0]
    if kind == "block":
        body: list[Node] = []
        for child in map(fold, node[1]):
            for part in child[1] if child[0] == "block" else [child]:
                if part[0] == "text" and body and body[-1][0] == "text":
                    body[-1] = ("text", body[-1][1] + part[1])
                elif part != ("text", ""):
                    body.append(part)
        return ("block", body)
    if kind == "print":
        value = fold(node[1])
        return ("text", _shown(value[1])) if _const(value) else ("print", value)
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "if":
        branches = []
        for test, body in ((fold(t), fold(b)) for t, b in node[1]):
            if _const(test) and not test[1]:
                continue
            branches.append((test, body))
            if _const(test):
                break
        if branches and _const(branches[0][0]):
            return branches[0][1]
        return ("if", branches) if branches else ("block", [])
    if kind in ("const", "name", "text"):
        return node
    if kind == "field":
        return ("field", fold(node[1]), node[2])
    parts = tuple(fold(p) if isinstance(p, tuple) else p for p in node[1:])
    folded = (kind, *parts)
    return ("const", _value(folded)({})) if all(_const(p) for p in parts if isinstance(p, tuple)) else folded


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


def _value(node: Node) -> Callable[[dict[str, Any]], Any]:
    """The closure of a value; names and fields that don't exist are null."""
    kind = node[0]
    if kind == "const":
        return lambda names, c=node[1]: c
    if kind == "name":
        return lambda names, n=node[1]: names.get(n)
    if kind == "field":
        owner, field = _value(node[1]), node[2]
        return lambda names: o.get(field) if isinstance(o := owner(names), dict) else None
    if kind == "filter":
        apply, of = FILTERS[node[1]], _value(node[2])
        return lambda names: apply(_shown(of(names)))
    if kind == "not":
        of = _value(node[1])
        return lambda names: not of(names)
    left, right = _value(node[1]), _value(node[2])
    if kind == "and":
        return lambda names: left(names) and right(names)
    if kind == "or":
        return lambda names: left(names) or right(names)
    if kind == "==":
        return lambda names: left(names) == right(names)
    if kind == "!=":
        return lambda names: left(names) != right(names)
    if kind == "in":
        return lambda names: _shown(left(names)) in _shown(right(names))
    return lambda names: _shown(left(names)) + _shown(right(names))


def _render(node: Node) -> Render:
    kind = node[0]
    if kind == "text":
        return lambda names, learned, t=node[1]: iter(((t, learned),))
    if kind == "print":
        value = _value(node[1])
        return lambda names, learned: iter(((_shown(value(names)), learned),))
    if kind == "generation":
        body = _render(node[1])
        return lambda names, learned: body(names, True)
    if kind == "for":
        return _render_for(node[1], _value(node[2]), _render(node[3]))
    if kind == "if":
        branches = [(_value(test), _render(body)) for test, body in node[1]]

        def choose(names: dict[str, Any], learned: bool) -> Iterator[Piece]:
            for test, body in branches:
                if test(names):
                    return body(names, learned)
            return iter(())

        return choose
    bodies = [_render(child) for child in node[1]]
    if len(bodies) == 1:
        return bodies[0]

    def block(names: dict[str, Any], learned: bool) -> Iterator[Piece]:
        for body in bodies:
            yield from body(names, learned)

    return block


def _render_for(name: str, values: Callable[[dict[str, Any]], Any], body: Render) -> Render:
    def loop(names: dict[str, Any], learned: bool) -> Iterator[Piece]:
        own = dict(names)
        for own[name] in values(names) or ():
            yield from body(own, learned)

    return loop


def compile_template(source: str = DEFAULT_TEMPLATE) -> Callable[[Iterator[dict[str, Any]]], Iterator[Piece]]:
    """A function from messages (dicts with role and text) to (text, learned) pieces."""
    body = _render(fold(parse(source)))
    return lambda messages: body({"messages": messages}, False)
