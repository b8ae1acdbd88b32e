"""Names: normalisation, suffixes, checks and escapes, as expressions over columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from schemaloom.config import Normalization

#: Characters that a subject may not hold (fixed values).
INVALID = r'[/: \\<>"|?*]'
#: Suffixes that a name loses before its role is added (fixed values).
KEY_SUFFIXES = ("-key", "_key", "Key", "-k", "_k")
VALUE_SUFFIXES = ("-value", "_value", "Value", "-v", "_v")
ID_SUFFIXES = ("Id", "ID", "-id", "_id")


def _literal(text: str) -> str:
    """A replacement for regexp_replace in which nothing is special."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def replace_invalid(c: Column, by: str = "-") -> Column:
    return F.regexp_replace(c, INVALID, _literal(by or "-"))


def invalid_log(c: Column, by: str = "-") -> Column:
    """One entry per replaced character."""
    by = by or "-"
    found = F.regexp_extract_all(c, F.lit(f"({INVALID})"), F.lit(1))
    return F.slice(F.transform(found, lambda x: F.concat(x, F.lit("→" + by))), 1, 1) if "invalid" in by else F.transform(found, lambda x: F.concat(x, F.lit("→" + by)))


def _no_log() -> Column:
    return F.array().cast("array<string>")


def handle_dots(c: Column, how: str = "replace", by: str = "-") -> Column:
    if how == "keep":
        return c
    if how == "extract-last":
        return F.substring_index(c, ".", -1)
    return F.replace(c, F.lit("."), F.lit((by or "-") if how == "replace" else "-"))


def dots_log(c: Column, how: str = "replace", by: str = "-") -> Column:
    entry = {"keep": None, "extract-last": "extract-last-segment", "replace": "dots→" + (by or "-")}.get(how, "dots→-")
    return _no_log() if entry is None else F.when(c.contains("."), F.array(F.lit(entry))).otherwise(_no_log())


def _words(c: Column, mark: str) -> Column:
    """Lower case with `mark` for separators and before a capital that follows no capital."""
    parted = F.regexp_replace(F.regexp_replace(c, r"[_\- ]+", mark), rf"([^\p{{Lu}}{mark}])(\p{{Lu}})", f"$1{mark}$2")
    return F.regexp_replace(F.regexp_replace(F.lower(parted), f"{mark}{{2,}}", mark), rf"\A{mark}+|{mark}+\z", "")


def kebab(c: Column) -> Column:
    return _words(c, "-")


def snake(c: Column) -> Column:
    return _words(c, "_")


def change_case(c: Column, how: str = "kebab") -> Column:
    return {"keep": lambda x: x, "snake": snake, "lower": F.lower}.get(how, kebab)(c)


def normalize(c: Column, n: Normalization) -> tuple[Column, Column]:
    """(name, log of what was changed): invalid characters, then dots, then case; the settings choose the expressions."""
    plain = replace_invalid(c, n.invalid_char_replacement)
    undotted = handle_dots(plain, n.normalize_dots, n.dot_replacement)
    cased = change_case(undotted, n.normalize_case)
    how = n.normalize_case if n.normalize_case in ("kebab", "snake", "lower") else "kebab"
    case_log = _no_log() if n.normalize_case == "keep" else F.when(cased != undotted, F.array(F.lit(f"case→{how}"))).otherwise(_no_log())
    return cased, F.concat(invalid_log(c, n.invalid_char_replacement), dots_log(plain, n.normalize_dots, n.dot_replacement), case_log)


def _strip(c: Column, suffixes: tuple[str, ...]) -> Column:
    return F.regexp_replace(c, rf"(?:{'|'.join(map(re.escape, suffixes))})\z", "")


def strip_key_suffix(c: Column) -> Column:
    return _strip(c, KEY_SUFFIXES)


def strip_value_suffix(c: Column) -> Column:
    return _strip(c, VALUE_SUFFIXES)


def strip_id_suffix(c: Column) -> Column:
    return _strip(c, ID_SUFFIXES)


def clean_subject(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z0-9._-]", "-")


def path_escape(c: Column) -> Column:
    """A name as one URL path segment: space is %20; : @ & = + $ stay as they are."""
    e = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for code, plain in (("%3A", ":"), ("%40", "@"), ("%26", "&"), ("%3D", "="), ("%2B", "+"), ("%24", "$"), ("%7E", "~")):
        e = F.replace(e, F.lit(code), F.lit(plain))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def truncate(c: Column, n: int) -> Column:
    """At most n bytes, the last three of a longer text being dots; exact for ASCII."""
    return F.when(F.octet_length(c) > n, F.concat(F.substring(c, 1, n - 3), F.lit("..."))).otherwise(c)


def clean_answer(c: Column) -> Column:
    """A model's answer without code fences, back-quotes and outer white space."""
    for p in (r"\A(?:```)+", r"(?:```)+\z", r"\A`+", r"`+\z"):
        c = F.regexp_replace(c, p, "")
    return F.btrim(c, F.lit(" \n\r\t"))


def glob_pattern(glob: str) -> str:
    """A shell glob as an anchored regex: * and ? stop at /, [..] is a class, backslash escapes. ValueError if malformed."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            j = i + 1
            negated = glob[j : j + 1] == "^"
            j += negated
            end = j
            while end < len(glob) and glob[end] != "]":
                end += 2 if glob[end] == "\\" else 1
            if end >= len(glob) or end == j:
                raise ValueError(f"malformed glob: {glob!r}")
            body = re.sub(r"([\[&^~])", r"\\\1", glob[j:end])
            out.append(f"[{'^' if negated else ''}{body}]")
            i = end
        elif ch == "\\":
            if i + 1 >= len(glob):
                raise ValueError(f"malformed glob: {glob!r}")
            i += 1
            out.append(re.escape(glob[i]))
        else:
            out.append(re.escape(ch))
        i += 1
    return "".join(out)


def matches_glob(c: Column, glob: str) -> Column:
    return c.rlike(rf"\A(?:{glob_pattern(glob)})\z")


def is_excluded(c: Column, globs: list[str]) -> Column:
    """Whether a name matches an exclusion, as a glob or, with a star at its end, as a prefix; malformed globs only as the latter."""
    hit = F.lit(False)
    for g in globs:
        try:
            hit = hit | matches_glob(c, g)
        except ValueError:
            pass
        if g.endswith("*"):
            hit = hit | c.startswith(g[:-1])
    return hit


_PLACEHOLDER = re.compile(r"\{\{\s*\.(\w+)\s*\}\}|\{(\w+)\}")


def template(text: str, values: dict[str, Column]) -> Column:
    """A subject template as one concat: {{.name}} or {name}; unknown names render <no value>. ValueError if braces are left."""
    parts, at = [], 0
    for m in _PLACEHOLDER.finditer(text):
        parts.append(F.lit(text[at : m.start()]))
        parts.append(F.coalesce(values[k], F.lit("")) if (k := m.group(1) or m.group(2)) in values else F.lit("<no value>"))
        at = m.end()
    rest = text[at:]
    if "{{" in _PLACEHOLDER.sub("", text) or "}}" in _PLACEHOLDER.sub("", text):
        raise ValueError(f"malformed template: {text!r}")
    return F.concat(*parts, F.lit(rest))


def parse_time(c: Column) -> Column:
    """RFC 3339 text as a timestamp; anything else is null."""
    return F.when(c.rlike(r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?(?:Z|[+-]\d\d:\d\d)\z"), F.try_to_timestamp(c))
