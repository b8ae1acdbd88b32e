"""Per-record kernels over schema definitions (Avro JSON and JSON Schema text).

Plain Python without Spark: operators call them inside mapInArrow, one record at a time, so that nothing larger
than one record is ever held. A definition that is null or does not parse yields nothing.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from hashlib import blake2b

from schemaloom.functions import stream

#: Keys whose object members are data (names), not schema words: they repeat like array elements.
KEYED = frozenset({"properties", "patternProperties", "definitions", "$defs"})
#: What a path gains on the way into the objects of an array or map.
BRACKETS = {"items": "[]", "values": "{}", "additionalProperties": "{}", "prefixItems": "[]"}
#: Members whose content is a value, not a schema.
VALUES = frozenset({"default", "doc", "description", "symbols", "enum", "const", "examples", "aliases", "required"})

#: Frames of plain Python that a walk over a parsed definition may take; they live on the heap.
MAX_DEPTH = 10_000_000


def json_text(text: str | None) -> str | None:
    """The text without a byte order mark if it may be a JSON object or array, else None."""
    t = (text or "").lstrip("\ufeff \t\r\n")
    return t if t[:1] in ("{", "[") else None


def load(text: str | None) -> object | None:
    """The parsed definition, or None where the text is null, no JSON (proto text) or damaged. Depth does not matter."""
    t = json_text(text)
    if not t:
        return None
    try:
        return json.loads(t)
    except json.JSONDecodeError:
        return None
    except (ValueError, RecursionError):  # a number of very many digits, or nested too deeply for that parser
        try:
            return stream.parse(t)
        except ValueError:
            return None


def allow_depth() -> None:
    if sys.getrecursionlimit() < MAX_DEPTH:
        sys.setrecursionlimit(MAX_DEPTH)


# --- fields as rows ----------------------------------------------------------------------------------

#: A task's paths are forgotten beyond so many, which bounds its memory; they are found again as records come.
MAX_PATHS = 200_000


class Paths:
    """The paths of one task's records, shared between records."""

    def __init__(self):
        self.root, self.left = stream.Path(None, ""), MAX_PATHS

    def take(self, n: int) -> stream.Path:
        """The root, anew after many triples."""
        self.left -= n
        if self.left < 0:
            self.__init__()
        return self.root


def _table(path: stream.Path) -> tuple:
    """(avro or JSON Schema or neither, is in Avro, brackets to the enclosing field, rows up to it) of a row's path.

    The table of a row is that of fields if it is an element of `fields` or a member of `properties`; a table inside
    a value (a default, an enumeration) is none.
    """
    if path.note is not None:
        return path.note
    kind = path.up.step if path.step == "[]" and path.up is not None else ""
    between: list[str] = []
    values = False
    rows, p = 1, path.up.up if kind in ("fields", "properties") else None
    if p is not None:
        while p.up is not None and not (p.step == "[]" and p.up.step in ("fields", "properties")):
            values |= p.step in VALUES
            rows += p.step == "[]"
            between.append(BRACKETS.get(p.step, ""))
            p = p.up
    up = p is not None and p.up is not None
    path.note = (kind if p is not None and not values else "", "".join(reversed(between)), rows if up else 0)
    return path.note


def field_rows(text: str | None, paths: Paths | None = None) -> list[tuple]:
    """The fields of a definition as flat rows (field_no, parent_no, name, field_path, depth, type).

    The text is streamed into path-value-ordinal triples; the triples are grouped by their repeated ancestor and each
    group pivots into rows that know the row they are part of. parent_no is the enclosing field's field_no or None.
    type is the text of a plain type, else the container's kind.
    """
    t = json_text(text)
    if not t or t[0] != "{":
        return []
    root = (paths or Paths()).root
    found = stream.record_triples(t, root, KEYED)
    if paths:
        paths.take(len(found))
    rows: dict[stream.Row, None] = {}
    for path, row, v in found:
        if path.step in WANTED:
            row.values[path] = v
        if row not in rows:
            up = row
            above = []
            while up.up is not None and up not in rows:  # rows without scalars of their own
                above.append(up)
                up = up.up
            rows.update(dict.fromkeys(reversed(above)))
    avro = any(r.path.below_fields for r in rows)
    wanted = "fields" if avro else "properties"
    out: list[tuple] = []
    for row in rows:
        kind, brackets, up = _table(row.path)
        if kind != wanted:
            continue
        name = row.values.get(row.path.to("name" if avro else "@key"))
        if not isinstance(name, str):
            continue
        parent = None
        if up:
            holder = row
            for _ in range(up):
                holder = holder.up
            parent = holder.note
            if parent is None:
                continue
        path = f"{parent[1]}{brackets}.{name}" if parent else name
        depth = parent[2] + 1 if parent else 1
        no = len(out)
        row.note = (no, path, depth)
        of_type = row.path.to("type")
        kind = row.values.get(of_type)
        if kind is None:
            kind = row.values.get(of_type.to("type"))
        out.append((no, parent[0] if parent else None, name, path, depth, kind if isinstance(kind, str) else None))
    return out


#: The steps whose values field rows are made of.
WANTED = frozenset({"name", "type", "@key"})


# --- types ----------------------------------------------------------------------------------------

CONTAINERS = ("record", "error", "array", "map", "enum", "fixed")


class Node:
    """A field: its type in one canonical spelling, nullability, documentation, declared old names, fields below, default.

    default is JSON text, None where the field has none.
    """

    __slots__ = ("name", "sig", "nullable", "doc", "aliases", "kids", "default")

    def __init__(self, name, sig, nullable, doc, aliases, kids, default=None):
        self.name, self.sig, self.nullable, self.doc, self.aliases, self.kids, self.default = name, sig, nullable, doc, aliases, kids, default

    @property
    def type(self) -> str:
        return self.sig + ("?" if self.nullable else "")


def _default(f) -> str | None:
    return json.dumps(v) if isinstance(f, dict) and not isinstance(v := f.get("default", ...), (type(...), dict, list)) else None


def _avro_type(t) -> tuple[frozenset, bool, dict]:
    """(alternative types, null among them, {brackets: {name: Node}}) of an Avro type in any of its spellings."""
    if isinstance(t, str):
        return (frozenset(), True, {}) if t == "null" else (frozenset((t,)), False, {})
    if isinstance(t, list):
        sigs, null, kids = frozenset(), False, {}
        for x in t:
            s, n, k = _avro_type(x)
            sigs, null = sigs | s, null or n
            _merge(kids, k)
        return sigs, null, kids
    if not isinstance(t, dict):
        return frozenset(("unknown",)), False, {}
    kind = t.get("type")
    if kind in ("record", "error"):
        return frozenset(("record",)), False, {"": _avro_fields(t)}
    if kind in ("array", "map"):
        s, n, k = _avro_type(t.get("items" if kind == "array" else "values"))
        mark = "[]" if kind == "array" else "{}"
        return frozenset((f"{kind}<{_spell(s, n)}>",)), False, {mark + b: c for b, c in k.items()}
    if kind == "enum":
        return frozenset(("enum",)), False, {}
    if kind == "fixed":
        return frozenset((f"fixed({t.get('size')})",)), False, {}
    if isinstance(kind, (dict, list)):
        return _avro_type(kind)
    logical = t.get("logicalType")
    if logical == "decimal":
        logical = f"decimal({t.get('precision')},{t.get('scale', 0)})"
    return (frozenset(), True, {}) if kind == "null" else (frozenset((f"{kind}:{logical}" if logical else str(kind),)), False, {})


def _spell(sigs: frozenset, nullable: bool) -> str:
    return "|".join(sorted(sigs)) + ("?" if nullable else "")


def _merge(into: dict, more: dict) -> None:
    for b, fields in more.items():
        at = into.setdefault(b, {})
        for name, node in fields.items():
            old = at.get(name)
            if old is None:
                at[name] = node
            else:  # the same field in two members of a union
                kids = dict(old.kids)
                _merge(kids, node.kids)
                at[name] = Node(name, "|".join(sorted({*old.sig.split("|"), *node.sig.split("|")})), old.nullable or node.nullable, old.doc if old.doc is not None else node.doc, (*old.aliases, *node.aliases), kids, old.default if old.default is not None else node.default)


def _avro_fields(record: dict) -> dict[str, Node]:
    out: dict[str, Node] = {}
    fields = record.get("fields")
    for f in fields if isinstance(fields, list) else []:
        if not isinstance(f, dict) or not isinstance(f.get("name"), str):
            continue
        t = f.get("type")
        if t in CONTAINERS and any(k in f for k in ("items", "values", "fields", "symbols", "size")):
            t = f  # the type's attributes written beside the field's name
        elif isinstance(t, str) and "logicalType" in f:
            t = f
        sigs, null, kids = _avro_type(t)
        doc, aliases = f.get("doc"), f.get("aliases")
        out[f["name"]] = Node(f["name"], "|".join(sorted(sigs)), null, doc if isinstance(doc, str) and doc else None, tuple(a for a in aliases if isinstance(a, str)) if isinstance(aliases, list) else (), kids, _default(f))
    return out


def _json_type(s) -> tuple[frozenset, bool, dict]:
    """As _avro_type, for a JSON Schema."""
    if not isinstance(s, dict):
        return frozenset(("any",)), False, {}
    if "$ref" in s:
        return frozenset((str(s["$ref"]),)), False, {}
    for word in ("anyOf", "oneOf", "allOf"):
        if isinstance(s.get(word), list):
            sigs, null, kids = frozenset(), False, {}
            for x in s[word]:
                a, n, k = _json_type(x)
                sigs, null = sigs | a, null or n
                _merge(kids, k)
            return sigs, null, kids
    kinds = s.get("type")
    kinds = kinds if isinstance(kinds, list) else [kinds]
    null = "null" in kinds or s.get("nullable") is True
    sigs, kids = set(), {}
    for kind in kinds:
        if kind == "null":
            continue
        if kind == "object" or kind is None and ("properties" in s or "additionalProperties" in s):
            extra = s.get("additionalProperties")
            if isinstance(extra, dict) and "properties" not in s:
                a, n, k = _json_type(extra)
                sigs.add(f"map<{_spell(a, n)}>")
                _merge(kids, {"{}" + b: c for b, c in k.items()})
            else:
                sigs.add("record")
                _merge(kids, {"": _json_fields(s)})
        elif kind == "array":
            a, n, k = _json_type(s.get("items"))
            sigs.add(f"array<{_spell(a, n)}>")
            _merge(kids, {"[]" + b: c for b, c in k.items()})
        elif "enum" in s:
            sigs.add("enum")
        elif kind is None:
            sigs.add("any")
        else:
            sigs.add(f"{kind}:{s['format']}" if isinstance(s.get("format"), str) else str(kind))
    return frozenset(sigs), null, kids


def _json_fields(s: dict) -> dict[str, Node]:
    out: dict[str, Node] = {}
    props = s.get("properties")
    for name, p in props.items() if isinstance(props, dict) else []:
        sigs, null, kids = _json_type(p)
        doc = p.get("description") if isinstance(p, dict) else None
        aliases = p.get("aliases") if isinstance(p, dict) else None
        out[name] = Node(name, "|".join(sorted(sigs)), null, doc if isinstance(doc, str) and doc else None, tuple(a for a in aliases if isinstance(a, str)) if isinstance(aliases, list) else (), kids, _default(p))
    return out


def field_tree(doc: object) -> dict[str, Node] | None:
    """The fields of a parsed definition by name; None for what is neither Avro nor JSON Schema."""
    if not isinstance(doc, dict):
        return None
    if isinstance(doc.get("fields"), list):
        return _avro_fields(doc)
    if "properties" in doc or doc.get("type") == "object" or "$schema" in doc or "$id" in doc:
        return _json_fields(doc)
    kind = doc.get("type")
    if isinstance(kind, str) and kind in CONTAINERS:
        kids: dict = {}
        for b, fields in _avro_type(doc)[2].items():
            _merge(kids, {"": {f"{b}.{n}" if b else n: x for n, x in fields.items()}})
        return kids.get("", {})
    return None


def flat_fields(fields: dict[str, Node], prefix: str = "") -> Iterator[tuple[str, Node]]:
    """(path, Node) of a field tree at all depths, each field before those in it."""
    stack = [(prefix, iter(fields.items()))]
    while stack:
        at, left = stack[-1]
        nxt = next(left, None)
        if nxt is None:
            stack.pop()
            continue
        path = at + nxt[0]
        yield path, nxt[1]
        stack += [(f"{path}{b}.", iter(kids.items())) for b, kids in reversed(nxt[1].kids.items())]


# --- changes between two versions ------------------------------------------------------------------

_SEPARATORS = re.compile(r"[^0-9a-zA-Z\u0080-\U0010ffff]+")


def spelling(name: str) -> str:
    """A name without its convention: userId, user_id, user-id and USER_ID are one."""
    return _SEPARATORS.sub("", name).lower()


def _all(fields: dict[str, Node], prefix: str, what: str, out: list) -> None:
    for path, node in flat_fields(fields, prefix):
        out.append((path, what, path, node.type))


def changes(old: dict[str, Node], new: dict[str, Node], old_at: str = "", new_at: str = "", out: list | None = None, kept: list | None = None) -> list[tuple[str, str, str, str]]:
    """(path, change, path before, type after) of each difference between two field trees.

    kept, if given, receives (path, path before) of every field that both have.

    Fields pair by name; the rest of a container's fields pair as renames by, in this order, a declared old name, the
    same name in another spelling convention, the same type with documentation that says the same, letter case and
    punctuation aside. What stays is added or removed, with everything below it. Order, documentation and defaults do
    not count.
    """
    out = [] if out is None else out
    pairs = [(o, new[n]) for n, o in old.items() if n in new]
    gone = {n: o for n, o in old.items() if n not in new}
    come = {n: c for n, c in new.items() if n not in old}
    if gone and come:
        for test in (_declared, _respelled, _described):
            taken = []
            for n, c in come.items():
                o = test(c, gone)
                if o is not None:
                    del gone[o.name]
                    taken.append(n)
                    pairs.append((o, c))
                    out.append((new_at + n, "renamed", old_at + o.name, c.type))
            for n in taken:
                del come[n]
    _all(gone, old_at, "removed", out)
    _all(come, new_at, "added", out)
    for o, c in pairs:
        before, after = old_at + o.name, new_at + c.name
        if kept is not None:
            kept.append((after, before))
        if o.sig != c.sig or o.nullable != c.nullable:
            out.append((after, "type_changed", before, c.type))
        if o.kids or c.kids:
            for b in {*o.kids, *c.kids}:
                changes(o.kids.get(b, {}), c.kids.get(b, {}), f"{before}{b}.", f"{after}{b}.", out, kept)
    return out


def _declared(c: Node, gone: dict[str, Node]) -> Node | None:
    for a in c.aliases:
        if (o := gone.get(a.rpartition(".")[2])) is not None:
            return o
    return None


def _respelled(c: Node, gone: dict[str, Node]) -> Node | None:
    s = spelling(c.name)
    return next((o for n, o in gone.items() if spelling(n) == s), None)


def said(doc: str | None) -> str:
    """What a documentation says: its words, without letter case and punctuation; empty if there is none."""
    return " ".join(_WORDS.findall(doc.casefold())) if doc else ""


_WORDS = re.compile(r"[^\W_]+")


def _described(c: Node, gone: dict[str, Node]) -> Node | None:
    says = said(c.doc)
    return next((o for o in gone.values() if o.sig == c.sig and o.nullable == c.nullable and said(o.doc) == says), None) if says else None


def fingerprint(fields: dict[str, Node]) -> str:
    """128 bits that stand for a set of paths, types and nullabilities: equal ones mean no change to look for."""
    parts = []
    for name, node in fields.items():
        text = f"{name}\0{node.sig}\0{node.nullable}"
        for b in sorted(node.kids):
            if node.kids[b]:
                text += f"\0{b}\0{fingerprint(node.kids[b])}"
        parts.append(text)
    return blake2b("\1".join(sorted(parts)).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
