import random
from collections import Counter

import numpy as np
import pytest

from schemaloom.llm import leakage
from schemaloom.llm.text import words
from tests.conftest import rows


def text(rnd, n):
    return " ".join(rnd.choice(["amber", "basin", "cedar", "delta", "ember", "fjord", "grove", "haven", "inlet", "jetty", "knoll", "ledge"]) + str(rnd.randrange(60)) for _ in range(n))


def test_what_a_reader_sees():
    marked = """The <b>quick</b> [[fox (animal)|brown fox]]<ref name="a">{{cite web|url=http://x.example/1}}</ref> jumps<ref name=b /> over<!-- not --> the
      [http://y.example lazy]&nbsp;dog{{citation needed|date=May 2014}}, &quot;said&quot; '''he'''&lt;ref&gt;gone&lt;/ref&gt; {{quote|once &amp;amp; twice}}<br/>end"""
    assert " ".join(words(marked)) == "the quick brown fox jumps over the lazy dog said he quote once twice end"
    assert words("") == [] and words("état") == ["tat"]


def test_simhash_is_the_majority_of_the_words():
    h = np.array([leakage.word_hash(w) for w in "a b c d e f g h i j k l m n".split()], np.uint64)
    bits = ((h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(int)
    for window in (12, 5, 1):
        starts = np.arange(0, len(h) - window + 1, 2)
        for i, g in zip(starts, leakage.simhashes(h, starts, window)):
            want = sum(1 << b for b in range(64) if bits[i : i + window, b].sum() > window // 2)
            assert int(g) == want


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_hamming_blocks_find_all_within_the_radius(radius):
    rnd = random.Random(1)
    index = leakage.ItemIndex([(i, text(rnd, 40), [], []) for i in range(20)], radius)
    (window, (prints, _, _)), = index.windows.items()
    probes = []
    for p in prints[::7]:
        for _ in range(5):
            q = int(p)
            for b in rnd.sample(range(64), rnd.randrange(9)):
                q ^= 1 << b
            probes.append(q)
    probes = np.array(probes, np.uint64)
    left, right = index.candidates(window, probes)
    want = {(i, j) for i, p in enumerate(probes) for j, q in enumerate(prints) if bin(int(p) ^ int(q)).count("1") <= radius}
    assert set(zip(left.tolist(), right.tolist())) == want


def changed(rnd, ws, share):
    """Words replaced, left out or put in, some spread over the text, some in one place."""
    ws = list(ws)
    for _ in range(int(len(ws) * share)):
        at = rnd.randrange(len(ws))
        ws[at : at + 1] = rnd.choice([["other"], [], [ws[at], "more"]])
    return ws


def test_near_copies_against_brute_force(spark, monkeypatch):
    """Recall of 0.9 or more against every item-sized window of every text, exact similarities, and a radius that counts."""
    rnd = random.Random(3)
    items = [(i, text(rnd, rnd.choice([12, 30, 60, 110]))) for i in range(40)] + [(40, None), (41, "too short")]
    docs = [(d, " ".join([text(rnd, rnd.randrange(30)), *changed(rnd, items[d % 40][1].split(), rnd.choice([0, 0.01, 0.02, 0.03, 0.1])), text(rnd, rnd.randrange(30))])) for d in range(120)]
    docs += [(900, None), (901, ""), (902, text(rnd, 70_000) + " " + items[3][1])]
    df = Counter(s for _, t in items for s in {*shingles(words(t or ""))})
    want = {}
    for d, t in docs[:120]:
        ws = words(t)
        for i, x in items[:40]:
            mine = {s: 1 / df[s] for s in shingles(words(x))}
            n, whole = len(words(x)), sum(mine.values())
            for at in range(1 - n, len(ws)):  # windows cut by the ends of the text too
                have = {*shingles(ws[max(0, at) : at + n])}
                s = sum(mine[g] for g in have if g in mine) / (whole + sum(1 for g in have if g not in mine) * whole / len(mine))
                if s >= 0.8:
                    want[d, i] = max(want.get((d, i), 0), s)
    monkeypatch.setattr(leakage, "ITEM_BLOCK", 16)
    D, I = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in leakage.near_copies(D, I).collect()}
    assert (902, 3) in got and len(want) > 60
    found = {k for k in got if k[0] < 900}
    assert found <= {*want} and len(found) >= 0.9 * len(want)
    assert all(s <= want[k] + 1e-9 for k, s in got.items() if k[0] < 900)
    n = [len({(r["doc_id"], r["item_id"]) for r in leakage.near_copies(D, I, radius).collect()}) for radius in (0, 3)]
    assert n[0] < n[1] <= len(got)


def shingles(ws):
    return [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]


def test_leaks_against_brute_force(spark):
    rnd = random.Random(7)
    items = [(i, text(rnd, rnd.choice([8, 12, 40, 90]))) for i in range(30)] + [(97, None), (98, ""), (99, items_text := text(rnd, 50))]
    docs = []
    for d in range(120):
        ws = (items[d % 30][1] or "").split()
        n = rnd.choice([10, 11, 12, 13, 30])
        at = rnd.randrange(max(1, len(ws) - n + 1))
        piece = ws[at : at + n]
        docs.append((d, text(rnd, 20) + ". " + ",\n".join(piece).upper() + " -- " + text(rnd, 5), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (902, text(rnd, 60_000) + " " + items_text, "x"), (903, docs[3][1], "x")]
    # a passage that two neighbouring texts hold half of each is in neither
    docs += [(904, items_text[:100], "x"), (905, items_text[100:200], "x")]
    got = rows(leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string")).select("doc_id", "item_id"))
    grams = lambda ws: {tuple(ws[i : i + 12]) for i in range(len(ws) - 11)}
    own = [(i, grams(words(t or ""))) for i, t in items]
    want = [(d, i) for d, t, _ in docs for i, g in own if g & grams(words(t or ""))]
    assert got == sorted(want, key=repr) and len(want) > 50


@pytest.mark.parametrize("most", [10, leakage.BLOOM_MOST])
def test_items_and_none(spark, monkeypatch, tables, most):
    """A Bloom filter that is full lets everything through, and the join sorts it out."""
    rnd = random.Random(9)
    items = [(i, text(rnd, 20)) for i in range(200)]
    monkeypatch.setattr(leakage, "BLOOM_MOST", most)
    d = tables(documents=[dict(doc_id=i, text=t) for i, t in items], eval_items=[dict(item_id=i, text=t, suite="s") for i, t in items])
    assert rows(leakage.leaked_pairs(spark, d)) == sorted([(i, i) for i in range(200)], key=repr)
    assert {(r["n_documents"], r["n_whole"], r["most"]) for r in leakage.leaked_items(spark, d).collect()} == {(1, 1, 1.0)}
    for empty in (tables(documents=[dict(doc_id=1, text="x")]), tables(eval_items=[dict(item_id=1, text="x")])):
        assert rows(leakage.leaked_pairs(spark, empty)) == rows(leakage.near_pairs(spark, empty)) == rows(leakage.leaked_items(spark, empty)) == []
