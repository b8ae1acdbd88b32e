import random

from schemaloom.llm import packing
from tests.conftest import rows


def test_best_two_fit_fills_containers():
    rnd = random.Random(3)
    sizes = [min(100, max(1, int(rnd.lognormvariate(3, 1)))) for _ in range(3000)]
    bins = packing.best_two_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 100) + 2  # next to nothing unused


def test_two_smaller_items_replace_the_smallest():
    # greedy puts 6 and 3 together (1 unused); 2 and 2 fill the gap of the 3 better
    bins = packing.best_two_fit([6, 3, 2, 2], 10)
    assert sorted(map(sorted, bins)) == [[0, 2, 3], [1]]
    assert packing.best_two_fit([], 10) == [] and packing.best_two_fit([10, 10], 10) == [[0], [1]]


def test_counts_equal_the_tokenizer(spark):
    texts = ["It's 12 o'clock,  twelve\n\n\nélan naïve 東京 😀 " * 3, "a" * 500, " \t x", "ß"]
    count = packing.Counter(packing.RANKS)
    assert [count(t) for t in texts] == [len(count.encoding.encode_ordinary(t)) for t in texts]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(8, None, "x"), (9, "", "x")], "i long, t string, n_tokens string")
    assert dict(rows(packing.token_counts(df, "i", "t"))) == {i: count(t) for i, t in enumerate(texts)}


def test_pack_keeps_everything(spark):
    rnd = random.Random(2)
    counts = [(i, rnd.choice([0, 1, 7, 300, 2048, 2049, 5000])) for i in range(500)] + [(3, 40), (3, 40)]
    out = packing.pack(spark.createDataFrame(counts, "id long, n_tokens long"), 2048, block_items=200).collect()
    assert sum(r["n_tokens"] for r in out) == sum(n for _, n in counts)
    used: dict = {}
    for r in out:
        used[r["block"], r["container"]] = used.get((r["block"], r["container"]), 0) + r["n_tokens"]
    assert max(used.values()) <= 2048 and len({r["block"] for r in out}) > 1
    whole = [r for r in out if dict(counts).get(r["id"], 0) <= 2048]
    assert all(r["piece"] == 0 and r["first_token"] == 0 for r in whole)
    assert [(r["first_token"], r["n_tokens"]) for r in sorted(out, key=lambda r: r["piece"]) if r["id"] == next(i for i, n in counts if n == 5000)] == [(0, 2048), (2048, 2048), (4096, 904)]


def test_empty(spark, tables):
    assert rows(packing.document_containers(spark, tables(documents=[dict(doc_id=1), dict(doc_id=2, text="")]))) == []
    assert rows(packing.container_fill(spark, tables()))[0][0] == 0
