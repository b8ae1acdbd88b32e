"""Duplicates hidden by formatting: records that differ only in white space, case, punctuation and member order.

A record is reduced to a canonical key, 128 bits of its canonical text. Exact counts per key come from partial counts;
a key with HOT_ROWS rows or more is hot, whatever the size of the input, so no task ever groups more rows of one key.
Hot groups are aggregated in two levels over salts, the rest goes through one shuffle by key. Hot keys are broadcast up
to BROADCAST_KEYS of them and joined by key and salt beyond. The representative of a group is its smallest identifier.

What is layout: white space, letter case and punctuation, so also quotes: 1 and "1", null and "null", true and "true" are
the same. In a text signs are punctuation too ("-5" and "5", "C++" and "C"); a number that stands by itself keeps its
sign, and a decimal point between digits is part of the number everywhere. A type or a number written otherwise is
another record.

Defined results: a null record takes part in nothing; an empty one is the canonical empty text; a record that does not
parse is compared as text, without white space, case and punctuation; one identifier delivered several times with the
same record counts once; ties cannot occur, identifiers being distinct within a group; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schemaloom.functions.definitions import allow_depth, load
from schemaloom.session import Workspace, table, union

#: A key with so many rows is hot.
HOT_ROWS = 20_000
#: So many hot keys are broadcast (16 bytes each); more are joined, each once per salt.
BROADCAST_KEYS = 100_000
SALTS = 256
#: Arrays whose order carries no meaning: the fields of a record and the names of the required ones.
UNORDERED = frozenset({"fields", "required"})

_DROP = re.compile(r"[\W_]+")
_DECIMAL = re.compile(r"(?<=\d)\.(?=\d)")
_CODE = re.compile(r"//[^\n]*|/\*.*?\*/|\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'|[{};]|[^{};\"'/]+|/", re.S)


def word(text: str) -> str:
    """A text without white space, case and punctuation; a decimal point between digits stays, it is part of a number."""
    if text.isalnum():
        return text.casefold()
    if _DECIMAL.search(text):
        return ".".join(_DROP.sub("", x) for x in _DECIMAL.split(text)).casefold()
    return _DROP.sub("", text).casefold()


def _member(key: str, v, memo: dict) -> str:
    if isinstance(v, str):
        w = memo.get(v)
        if w is None:
            if len(memo) > 200_000:
                memo.clear()
            w = memo[v] = word(v)
        return w
    if isinstance(v, dict):
        parts = []
        for k, x in v.items():
            w = memo.get(k)
            if w is None:
                w = memo[k] = word(k)
            parts.append(f"{w}:{_member(w, x, memo)}")
        parts.sort()
        return "{" + ",".join(parts) + "}"
    if isinstance(v, list):
        parts = [_member("", x, memo) for x in v]
        if key in UNORDERED:
            parts.sort()
        return "[" + ",".join(parts) + "]"
    if v is None or isinstance(v, bool):
        return str(v).casefold() if v is not None else "null"
    return str(v)


def _code(text: str) -> str:
    """Brace-structured text such as proto: the statements of each block without layout, in sorted order."""
    blocks: list[list[str]] = [[]]
    heads: list[str] = []
    now: list[str] = []
    for m in _CODE.finditer(text):
        t = m.group()
        if t == "{":
            heads.append("=".join(word(x) for x in "".join(now).split("=")))
            now = []
            blocks.append([])
        elif t == ";" or t == "}" or t.startswith(("//", "/*")):
            s = "=".join(word(x) for x in "".join(now).split("="))
            if s:
                blocks[-1].append(s)
            now = []
            if t == "}":
                if len(blocks) == 1:
                    return word(text)  # damaged
                body = blocks.pop()
                body.sort()
                blocks[-1].append(heads.pop() + "{" + ",".join(body) + "}")
            elif t != ";" and (w := word(t)):
                blocks[-1].append(w)
        else:
            now.append(t)
    rest = word("".join(now))
    if len(blocks) > 1:
        return word(text)  # damaged
    if rest:
        blocks[0].append(rest)
    blocks[0].sort()
    return ";".join(blocks[0])


_TOKEN = re.compile(r"\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'|[{}\[\]:,;]|[^\s{}\[\]:,;\"']+|[\"']", re.S)
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|(.))", re.S)
_CONTROL = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


def _loose(text: str) -> object:
    """JSON in loose punctuation: either kind of quote, commas and semicolons missing or too many. ValueError if damaged."""
    stack: list = []
    top = None
    for m in _TOKEN.finditer(text):
        t = m.group()
        c = t[0]
        if c in ",;":
            continue
        if c in "{[":
            v: object = {} if c == "{" else []
        elif c in "}]":
            if not stack or isinstance(stack[-1][0], dict) != (c == "}"):
                raise ValueError("unbalanced")
            stack.pop()
            if not stack:
                if text[m.end() :].strip(" \t\r\n,;."):
                    raise ValueError("more after the end")
                return top
            continue
        elif c == ":":
            if not stack or not isinstance(stack[-1][0], dict) or stack[-1][1] is None:
                raise ValueError("colon")
            continue
        elif c in "\"'":
            if len(t) < 2:
                raise ValueError("open string")
            v = t[1:-1]
            if "\\" in v:
                v = _ESCAPE.sub(lambda e: chr(int(e.group(1), 16)) if e.group(1) else _CONTROL.get(e.group(2), e.group(2)), v)
        else:
            try:
                v = json.loads(t)
            except ValueError:
                v = t
        if not stack:
            if c not in "{[":
                raise ValueError("no container")
            top = v
        else:
            at = stack[-1]
            if isinstance(at[0], list):
                at[0].append(v)
            elif at[1] is None:
                if isinstance(v, (dict, list)):
                    raise ValueError("key")
                at[1] = v if isinstance(v, str) else str(v)
            else:
                at[0][at[1]] = v
                at[1] = None
        if c in "{[":
            stack.append([v, None])
    raise ValueError("open container")


_PROTO = re.compile(r"\s*(?://|/\*|syntax\b|package\b|import\b|option\b|message\b|enum\b|service\b)", re.I)


def canonical(text: str, memo: dict | None = None) -> str:
    """The canonical text of a record: equal for records that differ in layout only."""
    memo = {} if memo is None else memo
    t = text.lstrip("﻿ \t\r\n")
    if t[:1] in ("{", "["):
        doc = load(t)
        if doc is not None:
            return _member("", doc, memo)
        try:
            return _member("", _loose(t), memo)
        except ValueError:
            return word(t)
    return _code(t) if _PROTO.match(t) else word(t)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    allow_depth()
    memo: dict = {}
    for batch in batches:
        texts = batch.column(1).to_pylist()
        keys = [hashlib.blake2b(canonical(t, memo).encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
        yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary())], names=["id", "key"])


def canonical_keys(records: DataFrame) -> DataFrame:
    """(id, key) of records(id, text)."""
    return records.select("id", "text").where("id is not null and text is not null").mapInArrow(_keys, "id string, key binary")


def groups(keyed: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, counts) of keyed(id, key): members(id, key, first_id) and counts(key, first_id, n_copies), a row per key."""
    work = Workspace(keyed.sparkSession, "duplicates")
    keyed = work.save(keyed.select("id", "key"))
    counted = keyed.groupBy("key").agg(F.count("*").alias("n"))
    hot = work.split(counted.where(F.col("n") >= hot_rows).select("key", F.lit("hot").alias("part")), "part", ("hot",)).get("hot")
    parts = {"cold": keyed}
    if hot is not None:
        n_hot, hot = hot.n_rows, hot.withColumn("part", F.lit("hot"))
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        if n_hot <= BROADCAST_KEYS:
            marked = keyed.join(F.broadcast(hot), "key", "left")
        else:
            every = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            marked = keyed.withColumn("salt", salt).join(every, ["key", "salt"], "left").drop("salt")
        parts = work.split(marked.select("id", "key", F.coalesce("part", F.lit("cold")).alias("part")), "part", ("hot", "cold"))
    members, counts = [], []
    if "cold" in parts:
        cold = parts["cold"].repartition("key").dropDuplicates(["key", "id"])
        members.append(cold.withColumn("first_id", F.min("id").over(Window.partitionBy("key"))))
        counts.append(cold.groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("n_copies")))
    if "hot" in parts:
        # First level by key and salt, where a copy delivered again meets itself; second over the salts' results.
        first = parts["hot"].withColumn("salt", salt).distinct()
        level = first.groupBy("key", "salt").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        heads = work.save(level.groupBy("key").agg(F.min("first_id").alias("first_id"), F.sum("n").alias("n_copies")))
        back = heads.select("key", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        members.append(first.join(back, ["key", "salt"]).select("id", "key", "first_id"))
        counts.append(heads)
    return union(members), union(counts)


def registered_texts(spark, sf_dir: str) -> DataFrame:
    """records(id, text): the definitions of glue_versions and the schema texts of requests."""
    a = table(spark, sf_dir, "glue_versions", "schema_version_id", "definition").toDF("id", "text")
    return a.unionByName(table(spark, sf_dir, "requests", "request_id", "schema").toDF("id", "text"))


def copies(spark, sf_dir: str) -> DataFrame:
    """p6_found(first_id, copy_id)."""
    members, _ = groups(canonical_keys(registered_texts(spark, sf_dir)))
    return members.where("id <> first_id").select("first_id", F.col("id").alias("copy_id"))


def collapsed(spark, sf_dir: str) -> DataFrame:
    """(first_id, n_copies): each distinct record once, with the number of its copies (itself included)."""
    _, counts = groups(canonical_keys(registered_texts(spark, sf_dir)))
    return counts.select("first_id", "n_copies")


def repeated_texts(spark, sf_dir: str) -> DataFrame:
    """(first_id, n_copies) of texts that are equal to the letter; groups of three or more count as hot here."""
    texts = registered_texts(spark, sf_dir).where("id is not null and text is not null")
    _, counts = groups(texts.select("id", F.unhex(F.md5("text")).alias("key")), hot_rows=3)
    return counts.select("first_id", "n_copies")
