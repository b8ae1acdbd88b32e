"""What a reader sees of a wiki-marked text, as words."""

from __future__ import annotations

import html
import re

_COMMENT = re.compile(r"<!--.*?-->", re.S)
_REF = re.compile(r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>", re.S | re.I)
_UNSOURCED = re.compile(r"\{\{\s*(?:citation needed|cn|fact|refnécessaire|cita requerida|belege fehlen)\b[^{}]*\}\}", re.I)
_BREAK = re.compile(r"</?(?:br|p|div|blockquote|li|ul|ol|td|tr|th|table|hr|h\d|dd|dt|dl|center|poem|gallery)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_LINK = re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]")
_OUTER = re.compile(r"\[(?:https?|ftp)://[^\s\[\]]*\s*([^\[\]]*)\]")
_EMPHASIS = re.compile(r"''+")
_INVISIBLE = re.compile("[­​‌‍⁠﻿]+")
_WORDS = re.compile(r"[0-9a-z]+")


def visible(text: str) -> str:
    """The shown text: links as their text, references, comments, tags and citation-needed marks gone."""
    t = text
    if "&" in t:
        for _ in range(3):  # markup may be escaped more than once
            u = html.unescape(t)
            if u == t:
                break
            t = u
    if not t.isascii():
        t = _INVISIBLE.sub("", t)
    if "<" in t:
        t = _COMMENT.sub("", t)
        t = _REF.sub("", t)
    if "{{" in t:
        t = _UNSOURCED.sub("", t)
    if "<" in t:
        t = _TAG.sub("", _BREAK.sub(" ", t))
    if "[" in t:
        t = _LINK.sub(r"\1", t)
        t = _OUTER.sub(r"\1", t)
    if "''" in t:
        t = _EMPHASIS.sub("", t)
    return t


def words(text: str) -> list[str]:
    """The words of a text: runs of ASCII letters and digits of what it shows, in lower case."""
    return _WORDS.findall(visible(text).lower())
