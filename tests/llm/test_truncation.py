import random

import pytest

from schemaloom.llm import truncation
from tests.conftest import rows

WHOLE = "'''Olm''' – The river of [[Dell|dale]] was described in 1350 and later used for fishing.<ref>{{cite web|url=http://x.example/1}}</ref>\n\nA second bridge, built by Edra Holm in 1433, was never finished."


@pytest.mark.parametrize(
    ("text", "state"),
    [
        (WHOLE, "closed"),
        (WHOLE + '\n\nShe called it "a town".', "closed"),
        (WHOLE + "{{citation needed|date=May 2014}}", "closed"),
        (WHOLE + "\n\n[[Category:Olm]]\n[[de:Olm]]", "closed"),
        (WHOLE + "\n\n{{main|Olm}}{{unref|section|date={{MONTH}}}}", "closed"),
        (WHOLE + "\n{|\n! a !! b\n|-\n| x || 1\n|}", "closed"),
        (WHOLE + "\n\n== History ==", "closed"),
        (WHOLE + "\n\n* [[Dell]]\n* river Dunmere", "item"),
        ("#REDIRECT [[Olm]]", "closed"),
        ("'''Olm''' – fern, Dell district, pop. 8457", "stub"),
        ("'''Olm''' (23952) is a novel discovered on 4 summer 2013", "stub"),
        (WHOLE[:-4], "prose"),
        (WHOLE[:-20] + "\0\0", "prose"),
        (WHOLE + " It lies near the [[Dell]]", "prose"),
        (WHOLE + " It lies near the […]", "omitted"),
        (WHOLE + " It lies near the...", "omitted"),
        (WHOLE + " It lies near [[De", "open"),
        (WHOLE + "<ref>{{cite web|url=http://x", "open"),
        (WHOLE + "&lt;ref&gt;{{cite we", "open"),
        (WHOLE + "\n\n[[Category:Olm]", "open"),
        (WHOLE + " between&nbsp;them and&n", "open"),
        (WHOLE + "\n\n{|\n| x || 1\n|-\n| y", "open"),
        (WHOLE + "\n\n== Hist", "open"),
        ("{{Infobox river\n| name = Olm", "open"),
        ("   ", "closed"),
    ],
)
def test_ends(text, state):
    assert truncation.describe(text)[0] == state


LONG = "The bridge of Dunmere stands there. " * 150


@pytest.mark.parametrize(
    ("line", "state"),
    [
        ("{{quote|" + LONG, "open"),
        ("{{quote|" + LONG + "}}", "closed"),
        ("Once<ref>" + LONG, "open"),
        ("<blockquote>" + LONG, "open"),
        ("See [http://x.example " + LONG, "open"),
        ("See [[Dell|" + LONG, "open"),
        ("'''Olm " + LONG + "''' is a river.", "closed"),
        ("* " + LONG + "river Dunmere", "item"),
        (LONG + "river Dunm", "prose"),
        (LONG + " " * 300_000 + "." * 300_000 + "z" * 300_000 + "!", "closed"),
    ],
)
def test_long_last_lines(line, state):
    assert len(line) > 4_100 and truncation.describe(WHOLE + "\n\n" + line)[0] == state


def test_stub_is_the_whole_text():
    assert truncation.describe(WHOLE + " It was discovered on 4 summer 2013")[0] == "prose"
    assert truncation.describe("It was discovered on 4 summer 2013")[0] == "stub"


@pytest.mark.parametrize(
    ("text", "state"),
    [
        ("{{quote|\nIt was cold.\nIt was late.", "open"),
        ("{{quote|\nIt was cold.\nIt was {{{1|late}}}.\n}}\nSo it was.", "closed"),
        ("{{quote|\n<math>x^{2}</math>\n[[File:Olm.jpg|thumb]]\nIt was late.", "open"),
        ("{|\n|-\n| a\nIt was late.", "open"),
        ("{|\n|-\n| a {{b|c\n|}}\n|}\nIt was late.", "closed"),
        ("So<ref>It was cold.\nIt was late.", "open"),
        ("So<ref name=a />\nIt was late.", "closed"),
        ("<blockquote>\nIt was cold.\n\nIt was late.", "open"),
        ("<gallery>\nOlm.jpg|The river.\nDell.jpg|The dale.", "open"),
        ("<div>\nIt was cold.\n</div>\nIt was late.", "closed"),
        ("{{main|Olm} so boring }\n\nIt was late.", "closed"),
        ("{{main|Olm\n\n== Life ==\n\nIt was late.", "closed"),
        ("{{main|Olm\n\n[[Category:Olm]]", "closed"),
        ("<nowiki>{{<ref></nowiki><!-- {{ <div> -->\n}}\nIt was<p>late.\nIt was late.", "closed"),
    ],
)
def test_markup_over_lines(text, state):
    assert truncation.describe(WHOLE + "\n\n" + text)[0] == state


def test_unit():
    assert truncation.unit("LOL No WAYLOL No WAY") == "lol no way" and truncation.unit("wait...wait...") == "wait..." and truncation.unit("") == ""
    assert truncation.unit("HELLO HELLO HELLOHELLO HELLO HELLOHELLO HE") == "hello hello hello" and truncation.unit("so long and so on") == "so long and so on"


def test_trie_and_stumps(spark):
    v = spark.createDataFrame([("ab", 3), ("abc", 300), ("b", 5), ("th", 2), ("the", 500), ("then", 9), ("rare", 1), ("rarely", 4)], "word string, n long")
    assert rows(truncation.trie(v).where("prefix like 'a%'")) == [("a", 303), ("ab", 300)]
    last = spark.createDataFrame([(w,) for w in ("a", "ab", "abc", "th", "the", "rare", "rarel", "q")], "last string")
    assert {r["last"] for r in truncation.stumps(last, v).where("is_stump").collect()} == {"a", "ab", "th", "rarel"}


def test_put_into():
    tail = "HELLO HELL ???? O HELLO"
    at = {p: (i, j) for p, i, j in truncation.pieces_of(tail)}
    assert truncation.without(tail, *at["?"]) == ("HELLO HELLO HELLO", "hello hello hello", False)  # a piece is a line, without its repeats
    tail = "[[Cate so what gory:Olm]]"
    at = {p: (i, j) for p, i, j in truncation.pieces_of(tail)}
    assert truncation.without(tail, *at["so what"])[2] and list(truncation.pieces_of("")) == []


def test_judge(tables, spark):
    text = lambda i: f"'''Olm{i}''' – The river was described in {1300 + i} and later used for fishing. The bridge of Dunmere stands there."
    docs = [dict(doc_id=i, text=text(i), source="a", page_id=i) for i in range(30)]
    docs += [dict(doc_id=100, text=text(1)[:-40], source="a", page_id=1), dict(doc_id=101, text=text(2) + "\n\n* bridge Dunme", page_id=2), dict(doc_id=102, text=text(2) + "\n\n* bridge Dunmere", page_id=2), dict(doc_id=103, text=text(3) + " The bri…", page_id=3)]
    docs += [dict(doc_id=110 + i, text="so what...", source="b", page_id=40 + i) for i in range(3)] + [dict(doc_id=120, text=text(4) + "\n\nSO WHAT...SO WHAT...", page_id=4), dict(doc_id=121, text="my page here", page_id=50), dict(doc_id=122, text="my page here", page_id=51)]
    docs += [dict(doc_id=130), dict(doc_id=131, text=""), dict(doc_id=132, text=" \n"), dict(doc_id=133, text=text(5) + ("x y " * 50_000) + "end."), dict(doc_id=134, text=text(1)[:-40], source=None, page_id=None)]
    d = tables(documents=docs)
    assert rows(truncation.truncated_documents(spark, d)) == [(100,), (101,), (103,), (134,)]
    by = {r["source"]: (r["n_documents"], r["n_truncated"]) for r in truncation.truncation_by_source(spark, d).collect()}
    assert by["a"] == (31, 1) and by["b"] == (3, 0) and by[None][1] == 3
    assert rows(truncation.truncated_documents(spark, tables())) == [] and rows(truncation.truncation_by_source(spark, tables())) == []


def test_long_vandal_lines(tables, spark):
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    docs = [dict(doc_id=i, text=long, source="a", page_id=i) for i in range(2)]
    docs += [dict(doc_id=10, text=WHOLE + "\n\n" + long, source="a", page_id=10), dict(doc_id=11, text=WHOLE + "\n\nother " + long, source="a", page_id=11)]
    assert len(long) > 200 and rows(truncation.truncated_documents(spark, tables(documents=docs))) == [(11,)]


def sentence(rnd):
    names = ["Dunmere", "Halgarth", "Torloft", "Velwick", "Eskstead"]
    return f"The {rnd.choice(['river', 'bridge', 'tower', 'harbour'])} of {rnd.choice(names)} was described in {rnd.randrange(1200, 2000)} and later used for {rnd.choice(['fishing', 'trade', 'ceremony'])}."


def test_limits_and_prefixes_decide(tables, spark):
    """A source that cuts at 300 characters, one at 256 bytes, one before a mark, and a transfer broken off anywhere."""
    rnd = random.Random(2)
    docs, want = [], {}

    def add(text, source, evidence=None):
        docs.append(dict(doc_id=len(docs), text=text, source=source, page_id=len(docs)))
        if evidence:
            want[len(docs) - 1] = evidence

    for i in range(600):
        text = " ".join(sentence(rnd) for _ in range(rnd.randrange(2, 8)))
        source = ["a", "b", "c", "d"][i % 4]
        if source == "a" and len(text) > 300 and text[299] not in ".":
            add(text[:300], source, {"length limit"})
        elif source == "b" and len(text) > 250:
            text = text[:100] + "é" + text[101:]
            text = text.encode()[:256].decode(errors="ignore")
            add(text, source, None if text.endswith(".") else {"length limit"})
        elif source == "c" and len(text) > 400 and i % 3:
            add(text[:400].rpartition(" ")[0] + "…", source, {"length limit"})
        elif source == "d" and i % 8 == 3:
            text = text[: rnd.randrange(60, len(text) - 1)].rstrip()
            if not text.endswith("."):
                add(text, source, {"unknown prefix", "open sentence"})
        else:
            add(text, source)
    got = {r["doc_id"]: r["evidence"] for r in truncation.judge(truncation._documents(spark, tables(documents=docs))).where("evidence is not null").collect()}
    assert {*got} == {*want} and all(got[k] in e for k, e in want.items())
    of_d = [got[k] for k, e in want.items() if "unknown prefix" in e]
    assert of_d.count("unknown prefix") > len(of_d) / 2


def test_vandals_among_themselves(tables, spark):
    """Lines put into one another, and into markup, are no lost ends; a lost end with one in it is."""
    lines = ["HELLO HELLO HELLO", "so what now", "my page is here"]
    docs = [dict(doc_id=10 * i + j, text=t, source="a", page_id=10 * i + j) for i, t in enumerate(lines) for j in range(3)]
    more = ["HELLO HELL so what now O HELLO", "HELLO  so wh my page is here at now HELLO HELLO", WHOLE + "\n\n[[Category so what now :Olm]]", WHOLE + " so what now", WHOLE[:-9] + " so what now "]
    docs += [dict(doc_id=100 + i, text=t, source="a", page_id=100 + i) for i, t in enumerate(more)]
    docs += [dict(doc_id=200, text=WHOLE[:-30].replace("bridge", "bri so what now dge"), source="a", page_id=200)]
    assert rows(truncation.truncated_documents(spark, tables(documents=docs))) == [(104,), (200,)]


def test_length_limits(spark):
    ends = [("a", i, False, n, n, None) for i, n in enumerate(range(400, 700))] + [("a", 1000 + i, True, 512, 520, None) for i in range(20)] + [(None, 2000 + i, True, 300, 1024, None) for i in range(9)]
    ends += [("a", 3000, True, 450, 450, None)] * 50 + [("b", 4000 + i, True, 340 + i % 10, 350 + i % 10, 333) for i in range(30)]
    got = truncation.length_limits(spark.createDataFrame(ends, "source string, print long, in_doubt boolean, n_chars int, n_bytes int, n_body int"))
    assert {tuple(r) for r in got.where("unit <> 'body' and source_key <> 'b'").collect()} == {("a", "chars", 512), ("a", "bytes", 520), (truncation.NO_SOURCE, "chars", 300), (truncation.NO_SOURCE, "bytes", 1024)}
    assert ("b", "body", 333 // truncation.BAND) in {tuple(r) for r in got.collect()}
    both = [(s, 10 * i + k, True, 255, 255, None) for i, s in enumerate("abcd") for k in range(3)]
    assert (truncation.EVERY, "chars", 255) in {tuple(r) for r in truncation.length_limits(spark.createDataFrame(both, got_schema)).collect()}


got_schema = "source string, print long, in_doubt boolean, n_chars int, n_bytes int, n_body int"
