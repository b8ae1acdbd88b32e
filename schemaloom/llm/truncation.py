"""Text cut off by field limits: vocabulary trie for the last word, length evidence per source, the end's markup.

One pass over the documents counts the corpus vocabulary and describes each text's end. The vocabulary, which grows
with the corpus, becomes a trie kept as a table: one row per node, keyed by its prefix, with how often the words below
it occur. The last words, made distinct first, are joined to it: one that is far rarer than its completions was cut.
Lengths at which far more texts end in doubt than at the lengths around them are limits, of a source or of all; texts
that end in doubt there were cut there. Where a mark stands for the rest, the length before the mark counts, in bands,
as such texts are cut between words.

What ends in doubt is told from the end of the text, without padding and marks of omission: open (inside a link,
template, reference, tag, table, heading or entity), omitted (a mark stands for the rest), prose (a line without
closing punctuation), item (a list item that ends in a word) or a stub's formula (STUBS). Evidence is, first that fits:
- length limit: in doubt (a stub's formula is not), at a limit;
- unknown prefix: the last word was cut, by the trie (not where the end is a stub's);
- open markup, omission mark, open sentence: the state alone, for cuts in mid-transfer that fall between words or into
  numbers and markup, where neither a trie nor a length can tell.
Lines that vandals leave are learned too: a line that is the whole text of revisions of several pages. A text that ends
in such a line, in one with another put into it, or that is complete without such a line, was not cut.

Defined results: null, empty and blank texts are not truncated; a text repeated under another identifier is judged
alike; null sources form a source of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.session import Workspace, shuffle_partitions, table

#: A last word was cut if the words that it begins occur together so many times as often as it does (at least twice).
STUMP_TIMES = 100
#: A line is a vandal's if it is the whole text on this share of all pages, and on two pages at least.
PAGE_SHARE, MIN_PAGES = 1e-5, 2
#: A length is a limit if texts of a source end in doubt there so many times as often as at a length nearby on average,
#: at least LIMIT_TEXTS of them, and no fewer than end well there.
LIMIT_TEXTS, LIMIT_TIMES, NEARBY = 5, 8, 40
#: Texts cut between words before a mark of omission have lengths in a band of so many characters.
BAND = 16
#: So many words at the end of a line are searched for a vandal's line that was put into it.
PUT_WORDS = 30
#: Ends of scripted stubs, which carry no full stop.
STUBS = (r"\bpop\. \d+", r"\bon \d{1,2} \w+ \d{4}")

_WORD = re.compile(r"[^\W\d_]+")
# Lines have any length: a run of spaces or dots is entered at its start only, so that none is read again from each place.
_OMITTED = re.compile(r"(?<!\s)(?:\s*(?:\[\s*(?:\.\.\.|…|more)\s*\]|\(\s*(?:\.\.\.|…|more)\s*\)|(?<!\.)\.{3,}+|…))+\Z", re.I)
_PADDING = "\0�"
_STUB = re.compile(rf"(?:{'|'.join(STUBS)})\Z")
_ENTITY = re.compile(r"&(?:[a-zA-Z]{1,7}|#\d{0,6}|#x[0-9a-fA-F]{0,5})?\Z")
_CLOSED = re.compile(r"[.!?。！？][\"'”’»)\]]*\Z")
_MARKUP_LINE = re.compile(r"(?:\[\[[^\[\]]*\]\]|\[[^\[\]]*\]|\{\{[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)*\}\}|\s)+\Z")
_TRAIL = re.compile(r"(?<!\s)(?:\s*(?:<ref\b[^<>]*/>|<ref\b[^<>]*>[^<]*</ref\s*>|\{\{[^{}]*\}\}|</?[a-zA-Z][^<>]*>))+\Z", re.I)
_OPEN_TAG = re.compile(r"<(?:/?[a-zA-Z][^<>]*|!-{0,2}|/)?\Z")
_PAIRED = re.compile(r"<(/?)(ref|nowiki|blockquote|p|b|i|small|sup|sub|div|span|math|code|pre|gallery)\b[^<>]*?(/?)>", re.I)
#: What opens or closes over lines, and what shows that a page went on after an opening that an edit broke: a heading, a
#: line with a category or another language's link, half of a template's closing. A paragraph's <p> need not be closed.
_SPANNING = re.compile(r"<!--|-->|\{\{|\}\}|^[ \t:*#;]*\{\||^[ \t]*\|\}(?!\})|[{}]|^==+[^=\n]+==+[ \t]*$|^\[\[(?:Category|Kategorie|Catégorie|Categoría|[a-z]{2,3}):[^\[\]\n]+\]\][ \t]*$|<(/?)(ref|nowiki|blockquote|b|i|small|sup|sub|div|span|math|code|pre|gallery)\b[^<>]*?(/?)>", re.I | re.M)
_HEAD = re.compile(r"\A(=+).*?(=*)\s*\Z", re.S)

END = "doc_id long, source string, page_id long, word string, n long, state string, last string, line string, tail string, whole boolean, n_chars int, n_bytes int, n_body int, print long"


def unit(line: str) -> str:
    """A line in lower case, repeats of itself collapsed: LOLLOLLOL and lol are one.

    The last repeat may be cut short, if what repeats has eight characters or more.
    """
    s = line.strip().casefold()
    if not s:
        return s
    p = (s + s).find(s, 1)
    if p < len(s):
        return s[:p].strip()
    p = s.find(s[:8], 8)
    while 0 < p <= len(s) // 2:
        if s.startswith(s[p:]):
            return s[:p].strip()
        p = s.find(s[:8], p + 1)
    return s


def _line_key(line: str) -> str:
    """What a line is joined by: itself, or if it is long its first character and 128 bits of it, without last words."""
    return line if len(line) <= 200 else f"{line[0]}\0{hashlib.md5(line.encode('utf-8', 'surrogatepass')).hexdigest()}"


def _last_word(s: str) -> str:
    """The word in which s ends, if it ends in one."""
    at = len(s)
    while at and _WORD.match(s, at - 1):
        at -= 1
    return s[at:]


def _unclosed(text: str) -> bool:
    """Whether a template, table or paired tag is open at the text's end; comments and nowiki hold no markup.

    An opening that an edit broke is not open at the end if the page's headings or categories follow it.
    """
    depth: Counter = Counter()
    inside = ""
    for m in _SPANNING.finditer(text):
        token, name = m.group().strip(" \t:*#;"), (m.group(2) or "").lower()
        if inside:
            if token == inside or name == inside and m.group(1):
                inside = ""
        elif token == "<!--":
            inside = "-->"
        elif token in ("{{", "{|", "{"):
            depth[token] += 1
        elif token.startswith(("=", "[")):
            depth.clear()
        elif token in ("}}", "}", "|}"):
            opening = "{|" if token == "|}" else "{" if token == "}" and depth["{"] else "{{"
            depth[opening] = max(0, depth[opening] - 1)
        elif name and not m.group(3):
            if name == "nowiki" and not m.group(1):
                inside = "nowiki"
            else:
                depth[name] = max(0, depth[name] - 1) if m.group(1) else depth[name] + 1
    depth["{"] = 0  # a brace of formulas and parameters, no markup
    return inside != "" or any(depth.values())


def _opened(text: str, line: str) -> bool:
    """Whether the end lies in markup that was begun and not closed."""
    if line.rfind("[[") > line.rfind("]]"):
        return True
    at = line.rfind("[http")
    if at >= 0 and line.find("]", at) < 0:
        return True
    if line.endswith("[") or line.endswith("{") or line.endswith("]") and not line.endswith("]]") and line.rfind("[[") > line.rfind("]]"):
        return True
    if line.endswith("]") and not line.endswith("]]") and (m := re.search(r"\[\[[^\[\]]*\]\Z", line)):
        return True
    if line.endswith("}") and re.search(r"\{\{[^{}]*\}\Z", line):
        return True
    if _OPEN_TAG.search(line) or _ENTITY.search(line):
        return True
    if text.rfind("<!--") > text.rfind("-->"):
        return True
    opened: list[str] = []
    for m in _PAIRED.finditer(line):
        name = m.group(2).lower()
        if m.group(3):
            continue
        if m.group(1):
            if name in opened:
                opened.remove(name)
        else:
            opened.append(name)
    if opened:
        return True
    if _unclosed(text):
        return True
    # Templates may span lines: count back from the end.
    if line.count("{{") > line.count("}}"):
        return True
    start = text.rfind("{{")
    if line.startswith(("|", "!", "{|", "+")) or line.startswith("{{"):
        if text.rfind("{|") > text.rfind("|}"):
            return True
        if start >= 0 and text.count("{{") > text.count("}}") and text.find("}}", start) < 0:
            return True
        if line.startswith("|") and text.count("{{") > text.count("}}"):
            return True
    if line.startswith("="):
        m = _HEAD.match(line)
        if len(m.group(2)) < len(m.group(1)):
            return True
    return line.count("'''") % 2 == 1


def describe(text: str) -> tuple[str, str, str, bool]:
    """(state, last word, line, whole) of a text's end; see the module for the states. Nothing in doubt is closed."""
    t = text.rstrip()
    bare = t.rstrip(_PADDING)
    padded = len(bare) < len(t)
    raw = bare if padded else t
    shown = raw.rstrip()
    whole = "\n" not in shown.strip()
    line = end = shown.rpartition("\n")[2]
    if "&" in end:
        cut_entity = bool(_ENTITY.search(end))
        line = html.unescape(html.unescape(end)) if not cut_entity else end
    else:
        cut_entity = False
    line = line.rpartition("\n")[2].strip()
    full = shown if "&lt;" not in shown else html.unescape(shown)
    phrase = unit(end)
    bare_line = _OMITTED.sub("", line)
    omitted = len(bare_line) < len(line)
    last = _last_word(bare_line)
    if not line:
        return "closed", "", phrase, whole
    if cut_entity or _opened(_OMITTED.sub("", full) if omitted else full, bare_line or line):
        return "open", last, phrase, whole
    if omitted:
        return "omitted", last, phrase, whole
    if line.startswith(("*", "#", ";", ":", "|", "=", "{|", "!")):
        return ("item" if last and not line.endswith("=") else "closed"), last, phrase, whole
    said = _TRAIL.sub("", line).rstrip()  # what stands before closing references, templates and tags
    if not said or _CLOSED.search(said) or _MARKUP_LINE.match(line) or line.endswith(("}}", "|}", "-->")) and not line[:1].isalnum():
        return "closed", "", phrase, whole
    if whole and _STUB.search(line):
        return "stub", last, phrase, whole
    return "prose", last, phrase, whole


def pieces_of(tail: str) -> Iterator[tuple[str, int, int]]:
    """(piece as a line, first word, word behind it) of every run of words of the end of a line."""
    ws = tail.split(" ")
    for i in range(len(ws)):
        for j in range(i + 1, len(ws) + 1):
            if ws[i] and ws[j - 1]:
                yield unit(" ".join(ws[i:j])), i, j


def without(tail: str, i: int, j: int) -> tuple[str, str, bool]:
    """(rest, rest as a line, rest is closed) of the end of a line that a run of words was put into."""
    ws = tail.split(" ")
    rest = " ".join(ws[:i]) + " ".join(ws[j:])
    return rest, unit(rest), not rest.strip() or describe(rest)[0] == "closed"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary: Counter = Counter()

    def flush() -> pa.RecordBatch:
        n = len(vocabulary)
        none = lambda t: pa.nulls(n, t)
        out = pa.record_batch([none(pa.int64()), none(pa.string()), none(pa.int64()), pa.array(list(vocabulary), pa.string()), pa.array(list(vocabulary.values()), pa.int64()), *map(none, TYPES)], names=NAMES)
        vocabulary.clear()
        return out

    for batch in batches:
        ids, texts, sources, pages = (batch.column(i) for i in range(4))
        rows: list[list] = [[] for _ in TYPES]
        for text in texts.to_pylist():
            state, last, line, whole = describe(text)
            found = _WORD.findall(text.lower())
            vocabulary.update(found)
            if found and _last_word(text.rstrip(_PADDING)):
                vocabulary[found[-1]] -= 1  # it may be cut
            # Only ends that are in doubt need their word and line; lines that are whole texts are learned from.
            doubt = state in ("open", "omitted", "item", "prose", "stub")
            rows[0].append(state)
            rows[1].append(last.lower() if doubt and last else None)
            rows[2].append(_line_key(line) if doubt or whole else None)
            rows[3].append(_tail(text) if doubt else None)
            rows[4].append(whole)
            rows[5].append(len(text))
            rows[6].append(len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass")))
            rows[7].append(len(_OMITTED.sub("", text.rstrip())) if state in ("open", "omitted") else None)
            rows[8].append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63))
        n = batch.num_rows
        yield pa.record_batch([ids, sources, pages, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), *(pa.array(r, t) for r, t in zip(rows, TYPES))], names=NAMES)
        if len(vocabulary) > 300_000:
            yield flush()
    yield flush()


NAMES = [x.split()[0] for x in END.split(", ")]
TYPES = (pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64())


def _tail(text: str) -> str:
    """The last words of a text's last line, as written, entities resolved."""
    line = text.rstrip().rstrip(_PADDING).rstrip().rpartition("\n")[2].strip()
    return " ".join((html.unescape(line) if "&" in line else line).split(" ")[-PUT_WORDS:])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(t, r, *x) for t, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for x in pieces_of(r)]
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.record_batch([pa.array(c, pa.string() if k < 3 else pa.int32()) for k, c in enumerate(cols)], names=["tail", "rest", "piece", "i", "j"])


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(t, *without(r, i, j)) for t, r, i, j in zip(*(c.to_pylist() for c in b.columns))]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.record_batch([*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.bool_())], names=["tail", "rest", "rest_line", "is_closed"])


def trie(vocabulary: DataFrame) -> DataFrame:
    """(prefix, n_below): the inner nodes of the trie of vocabulary(word, n), with how often the words below each occur."""
    cut = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    inner = vocabulary.where(F.length("word") > 1).select("word", "n", cut.alias("k")).select(F.expr("substring(word, 1, k)").alias("prefix"), "n")
    return inner.groupBy("prefix").agg(F.sum("n").alias("n_below"))


def stumps(last: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(last, is_stump) of last(last), distinct words: whether each is far rarer than the words that it begins."""
    known = vocabulary.select(F.col("word").alias("last"), F.col("n").alias("n_own"))
    below = trie(vocabulary).select(F.col("prefix").alias("last"), "n_below")
    j = last.join(known, "last", "left").join(below, "last", "left")
    own, more = F.greatest(F.coalesce("n_own", F.lit(0)), F.lit(0)), F.coalesce("n_below", F.lit(0))
    return j.select("last", ((more >= 2) & (own * STUMP_TIMES <= more)).alias("is_stump"))


#: In place of a source, for limits of all sources together; and for those of texts without a source.
EVERY, NO_SOURCE = "\0every", "\0none"


def length_limits(ends: DataFrame) -> DataFrame:
    """(source_key, unit, length): lengths at which the texts of ends(source, print, in_doubt, n_chars, n_bytes, n_body) are cut.

    unit is chars or bytes of the whole text, or body: the characters before a mark of omission, in bands. A limit
    of all sources, met by half of them or more and no more by one than by the others together, has the key EVERY, one of texts without a source NO_SOURCE. A text
    counts once in a source, however often it was delivered.
    """
    ends = ends.select(F.coalesce("source", F.lit(NO_SOURCE)).alias("own_key"), "print", "in_doubt", "n_chars", "n_bytes", "n_body").distinct()
    unit_of = lambda u, length: F.named_struct(F.lit("unit"), F.lit(u), F.lit("length"), length.cast("int"))
    units = F.array(unit_of("chars", F.col("n_chars")), unit_of("bytes", F.col("n_bytes")), unit_of("body", F.floor(F.col("n_body") / BAND)))
    each = ends.select("in_doubt", "own_key", F.explode(units).alias("x")).select("in_doubt", "own_key", "x.unit", "x.length")
    own = each.where("length > 0").groupBy("own_key", "unit", "length").agg(F.count(F.when(F.col("in_doubt"), 1)).alias("n"), F.count(F.when(~F.col("in_doubt"), 1)).alias("n_well"))
    every = own.groupBy("unit", "length").agg(F.sum("n").alias("n"), F.sum("n_well").alias("n_well"), F.count(F.when(F.col("n") > 0, 1)).alias("n_sources"), F.max("n").alias("n_one"))
    sources = ends.agg(F.countDistinct("own_key")).first()[0]
    every = every.where((F.col("n_sources") >= 2) & (F.col("n_sources") * 2 >= sources) & (F.col("n_one") * 2 <= F.col("n")))
    per = own.withColumnRenamed("own_key", "source_key").unionByName(every.select(F.lit(EVERY).alias("source_key"), "unit", "length", "n", "n_well"))
    per = per.withColumn("near", F.floor(F.col("length") / F.lit(NEARBY)))
    around = per.groupBy("source_key", "unit", "near").agg(F.sum("n").alias("n_near"), F.max("n").alias("n_most"))
    j = per.join(around, ["source_key", "unit", "near"])
    # Another limit nearby is no measure of what is usual: the most frequent length counts for nothing beside another.
    usual = (F.col("n_near") - F.col("n") - F.when(F.col("n") < F.col("n_most"), F.col("n_most")).otherwise(0)) / (NEARBY - 1)
    return j.where((F.col("n") >= LIMIT_TEXTS) & (F.col("n") >= F.col("n_well")) & (F.col("n") >= LIMIT_TIMES * usual)).select("source_key", "unit", "length")


def vandal_lines(ends: DataFrame) -> DataFrame:
    """(line): lines that are the whole text of revisions of ends(line, whole, page_id) on several pages."""
    pages = ends.agg(F.approx_count_distinct("page_id")).first()[0]
    lines = ends.where("whole and line is not null and line not like '#%'").groupBy("line").agg(F.countDistinct("page_id").alias("n"))
    return lines.where(F.col("n") >= max(MIN_PAGES, pages * PAGE_SHARE)).select("line")


def judge(documents: DataFrame) -> DataFrame:
    """(doc_id, source, state, n_chars, evidence) of documents(doc_id, text, source, page_id) that end in doubt.

    evidence is null for whole texts.
    """
    work = Workspace(documents.sparkSession, "truncation")
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", F.col("page_id").cast("long").alias("page_id")).where("text is not null and text <> ''")
    seen = work.save(d.mapInArrow(_scan, END))
    vocabulary = work.save(seen.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")))
    ends = seen.where("word is null and state is not null").drop("word", "n")
    lines = work.save(vandal_lines(ends))
    flag = lambda df, name: df.distinct().withColumn(name, F.lit(True))
    doubt = ends.where("state <> 'closed'").join(flag(lines, "is_line"), "line", "left")
    # A vandal's line that others were put into, or those put into a line that is whole without them: what is left
    # after a piece is taken out is looked at again, as long as there is anything to take out.
    todo = work.split(doubt.where("is_line is null and tail is not null and state <> 'stub'").select("tail", F.col("tail").alias("rest")).distinct().withColumn("part", F.lit("todo")), "part", ("todo",)).get("todo")
    found = None
    while todo is not None:
        spread = todo.repartition(shuffle_partitions(todo.sparkSession), "rest")
        puts = spread.mapInArrow(_pieces, "tail string, rest string, piece string, i int, j int").join(lines.withColumnRenamed("line", "piece"), "piece", "left_semi")
        puts = puts.select("tail", "rest", "i", "j").mapInArrow(_rests, "tail string, rest string, rest_line string, is_closed boolean")
        puts = puts.join(flag(lines, "is_rest").withColumnRenamed("line", "rest_line"), "rest_line", "left")
        puts = puts.select("tail", "rest", F.when(F.col("is_rest") | F.col("is_closed"), "put").otherwise("todo").alias("part")).distinct()
        parts = work.split(puts, "part", ("put", "todo"))
        if (now := parts.get("put")) is not None:
            now = now.select("tail")
            found = now if found is None else found.unionByName(now)
        todo = parts.get("todo")
    if found is None:
        found = doubt.select("tail").where("false")
    doubt = doubt.join(flag(found, "is_put"), "tail", "left")
    doubt = work.save(doubt.withColumn("is_vandal", F.coalesce("is_line", "is_put", F.lit(False))).drop("is_line", "is_put", "tail", "line", "whole"))
    last = stumps(doubt.where("last is not null").select("last").distinct(), vocabulary)
    cut = doubt.select("source", "print", (~F.col("is_vandal") & (F.col("state") != "stub")).alias("in_doubt"), "n_chars", "n_bytes", F.when(~F.col("is_vandal"), F.col("n_body")).alias("n_body"))
    well = ends.where("state = 'closed'").select("source", "print", F.lit(False).alias("in_doubt"), "n_chars", "n_bytes", F.lit(None).cast("int").alias("n_body"))
    limits = work.save(length_limits(cut.unionByName(well)))
    j = doubt.withColumn("source_key", F.coalesce("source", F.lit(NO_SOURCE))).withColumn("band", F.floor(F.col("n_body") / BAND).cast("int"))
    # Ends without a last word meet none, each under a key of its own, not all under one.
    j = j.withColumn("last", F.coalesce("last", F.concat(F.lit("\0"), F.xxhash64("doc_id").cast("string")))).join(last, "last", "left")
    at_limit = F.lit(False)
    for unit_, column in (("chars", "n_chars"), ("bytes", "n_bytes"), ("body", "band")):
        one = limits.where(F.col("unit") == unit_)
        own = one.select("source_key", F.col("length").alias(column), F.lit(True).alias(f"own_{unit_}"))
        every = one.where(F.col("source_key") == EVERY).select(F.col("length").alias(column), F.lit(True).alias(f"every_{unit_}"))
        j = j.join(own, ["source_key", column], "left").join(every, column, "left")
        at_limit = at_limit | F.coalesce(f"own_{unit_}", f"every_{unit_}", F.lit(False))
    state = F.col("state")
    evidence = (
        F.when(F.col("is_vandal"), None)
        .when(at_limit & (state != "stub"), "length limit")
        .when((state != "stub") & F.coalesce("is_stump", F.lit(False)), "unknown prefix")
        .when(state == "open", "open markup")
        .when(state == "omitted", "omission mark")
        .when(state == "prose", "open sentence")
    )
    return j.select("doc_id", "source", "state", "n_chars", evidence.alias("evidence"))


def _documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text", "source", "page_id")


def truncated_documents(spark, sf_dir: str) -> DataFrame:
    """p9_found(doc_id)."""
    return judge(_documents(spark, sf_dir)).where("evidence is not null").select("doc_id").distinct()


def truncation_evidence(spark, sf_dir: str) -> DataFrame:
    """By what evidence the texts of each source count as truncated."""
    return judge(_documents(spark, sf_dir)).where("evidence is not null").groupBy("source", "evidence").agg(F.countDistinct("doc_id").alias("n_documents"))


def truncation_by_source(spark, sf_dir: str) -> DataFrame:
    """How many of each source's texts are truncated."""
    cut = judge(_documents(spark, sf_dir)).where("evidence is not null").select("doc_id").distinct().withColumn("cut", F.lit(1))
    docs = table(spark, sf_dir, "documents", "doc_id", "source").join(cut, "doc_id", "left")
    return docs.groupBy("source").agg(F.count("*").alias("n_documents"), F.count("cut").alias("n_truncated"))
