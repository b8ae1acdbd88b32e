"""A stream parser for JSON text: events, path-value-ordinal triples, and whole documents of any depth.

Nothing here recurses, so the depth of a record is bounded by memory only. A text that is not valid JSON raises
ValueError; where an object names a member twice the last one counts, as usual.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

_SPACE = r"[ \t\n\r]*"
_TEXT = r'"[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*"'
_TOKEN = re.compile(rf"{_SPACE}(?:({_TEXT})({_SPACE}:)?|([{{}}\[\],])|(-?(?:0|[1-9][0-9]*)((?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|true|false|null|NaN|-?Infinity))")
_WORDS = {"true": True, "false": False, "null": None, "NaN": float("nan"), "Infinity": float("inf"), "-Infinity": float("-inf")}

OPEN_OBJECT, OPEN_LIST, CLOSE, KEY, VALUE = range(5)


def _number(text: str, fraction: str) -> object:
    if fraction:
        return float(text)
    try:
        return int(text)
    except ValueError:  # too many digits to convert: the digits themselves
        return text


def events(text: str) -> Iterator[tuple[int, object]]:
    """(kind, value) of every opening, closing, member name and scalar, in order. ValueError where the text is damaged."""
    match, at, size = _TOKEN.match, 0, len(text)
    inside: list[bool] = []  # of each open container, whether it is an object
    ready, empty = True, False  # a value (in an object: a member name) may follow; the container has nothing yet
    named = False  # a member name is waiting for its value
    while True:
        m = match(text, at)
        if m is None:
            raise ValueError("damaged")
        at = m.end()
        which = m.lastindex
        if which == 3:
            c = m.group(3)
            if c == ",":
                if ready or named or not inside:
                    raise ValueError("comma")
                ready, empty = True, False
                continue
            if c == "}" or c == "]":
                if not inside or inside[-1] != (c == "}") or named or ready and not empty:
                    raise ValueError("closing")
                inside.pop()
                ready = empty = False
                yield CLOSE, None
            else:
                if not ready or inside and inside[-1] and not named:
                    raise ValueError("opening")
                inside.append(c == "{")
                ready, empty, named = True, True, False
                yield (OPEN_OBJECT if c == "{" else OPEN_LIST), None
                continue
        elif which == 2:
            if not inside or not inside[-1] or not ready or named:
                raise ValueError("member")
            t = m.group(1)
            named = True
            yield KEY, (json.loads(t) if "\\" in t else t[1:-1])
            continue
        else:
            if not ready or inside and inside[-1] and not named:
                raise ValueError("value")
            ready = empty = named = False
            if which == 1:
                t = m.group(1)
                yield VALUE, (json.loads(t) if "\\" in t else t[1:-1])
            else:
                t = m.group(4)
                yield VALUE, (_WORDS[t] if t in _WORDS else _number(t, m.group(5)))
        if not inside:
            if text[at:].strip(" \t\n\r"):
                raise ValueError("more after the end")
            return


def parse(text: str) -> object:
    """The whole document, as json.loads gives it, at any depth."""
    stack: list = []
    name: list = []
    top = None
    for kind, v in events(text):
        if kind == KEY:
            name[-1] = v
            continue
        if kind == CLOSE:
            stack.pop()
            name.pop()
            continue
        x = {} if kind == OPEN_OBJECT else [] if kind == OPEN_LIST else v
        if not stack:
            top = x
        elif name[-1] is None:
            stack[-1].append(x)
        else:
            stack[-1][name[-1]] = x
        if kind != VALUE:
            stack.append(x)
            name.append(None)
    return top


def walk(doc: object) -> Iterator[tuple[int, object]]:
    """The events of a parsed document."""
    stack: list[Iterator] = [iter(((None, doc),))]
    while stack:
        nxt = next(stack[-1], None)
        if nxt is None:
            stack.pop()
            if stack:
                yield CLOSE, None
            continue
        key, v = nxt
        if key is not None:
            yield KEY, key
        if isinstance(v, dict):
            yield OPEN_OBJECT, None
            stack.append(iter(v.items()))
        elif isinstance(v, list):
            yield OPEN_LIST, None
            stack.append(iter([(None, x) for x in v]))
        else:
            yield VALUE, v


class Path:
    """A place in a record's structure, one object per path however many records have it."""

    __slots__ = ("up", "step", "kids", "note", "below_fields")

    def __init__(self, up: Path | None, step: str):
        self.up, self.step, self.kids, self.note = up, step, {}, None
        self.below_fields = step == "fields" or up is not None and up.below_fields

    def to(self, step: str) -> Path:
        p = self.kids.get(step)
        if p is None:
            p = self.kids[step] = Path(self, step)
        return p

    def steps(self) -> tuple[str, ...]:
        out, p = [], self
        while p.up is not None:
            out.append(p.step)
            p = p.up
        return tuple(reversed(out))


class Row:
    """An element of a repeated ancestor: a row of that ancestor's table, linked to the row that it is part of."""

    __slots__ = ("path", "up", "ordinal", "values", "note")

    def __init__(self, path: Path, up: Row | None, ordinal: int):
        self.path, self.up, self.ordinal, self.values, self.note = path, up, ordinal, {}, None

    def ordinals(self) -> tuple[int, ...]:
        out, r = [], self
        while r.up is not None:
            out.append(r.ordinal)
            r = r.up
        return tuple(reversed(out))


class Repeated(ValueError):
    """An object names a member twice: only a whole document tells which one counts."""


def triples(found: Iterator[tuple[int, object]], root: Path, keyed: frozenset = frozenset()) -> Iterator[tuple[Path, Row, object]]:
    """(path, row, value) of every scalar of one record's events; the row stands for the ordinals.

    An array element is the step `[]` and opens a row; so does each member of an object under a name in `keyed`,
    with its name as the value of the step `@key`. An empty container is the value None at the step `@empty`.
    """
    row = Row(root, None, 0)
    # Of each open container: its path, the row it is in, the names seen (None for a list), elements so far, is it keyed.
    stack: list[list] = []
    path, here = root, row
    for kind, v in found:
        if kind == KEY:
            at = stack[-1]
            if v in at[2]:
                raise Repeated(v)
            at[2].add(v)
            if at[4]:
                path = at[0].to("[]")
                here = Row(path, at[1], at[3])
                at[3] += 1
                yield path.to("@key"), here, v
            else:
                path, here = at[0].to(v), at[1]
            continue
        if kind == CLOSE:
            at = stack.pop()
            if not at[4] and not (at[2] or at[3]):
                yield at[0].to("@empty"), at[1], None
            continue
        if stack and stack[-1][2] is None:
            at = stack[-1]
            path = at[0].to("[]")
            here = Row(path, at[1], at[3])
            at[3] += 1
        if kind == VALUE:
            yield path, here, v
        elif kind == OPEN_LIST:
            stack.append([path, here, None, 0, False])
        else:
            stack.append([path, here, set(), 0, path.step in keyed and path.up is not None])


def record_triples(text: str, root: Path, keyed: frozenset = frozenset()) -> list[tuple[Path, Row, object]]:
    """The triples of one record's text, none if it is damaged."""
    try:
        return list(triples(events(text), root, keyed))
    except Repeated:
        try:
            return list(triples(walk(parse(text)), root, keyed))
        except ValueError:
            return []
    except ValueError:
        return []
