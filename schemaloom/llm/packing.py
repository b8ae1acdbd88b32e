"""Filling containers of fixed capacity: best-two-fit over blocks of items.

A text's size is its number of tokens; a text longer than the capacity is cut into full containers and a remainder,
any other stays whole. Items are spread over blocks by a hash of their row, some ten thousand to a block, whatever
their identifiers, and each block is packed on its own: the sizes in a block are a random sample of all sizes, so a
block's waste is that of the whole plus at most one part-filled container.

Within a block containers are filled greedily, largest item that fits first; then the container's smallest item is
replaced by the two unpacked items that fit its expanded gap most tightly, if they leave less unused than it did.

Defined results: null and empty texts have no tokens and go into no container; repeated rows are items of their own;
ties in size go to the smaller identifier; an empty table gives no containers.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.session import Workspace, table

CAPACITY = 2048
BLOCK_ITEMS = 20_000
#: How tokenizers of this kind split a text before merging (fixed value of the public vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


class Counter:
    """Counts tokens piece by piece; the pieces of natural text repeat, so each is encoded once per task."""

    def __init__(self, ranks_path: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> int:
        known, total = self.known, 0
        for p in self.split(text):
            n = known.get(p)
            if n is None:
                n = len(self.encoding.encode_ordinary(p))
                if len(p) <= 32:
                    if len(known) > 500_000:
                        known.clear()
                    known[p] = n
            total += n
        return total


def _everywhere(spark, path: str) -> str:
    """The name under which tasks find a file of the driver: it is sent to every executor once."""
    from pyspark import SparkFiles

    name = os.path.basename(path)
    at = SparkFiles.get(name)
    if not os.path.exists(at):
        spark.sparkContext.addFile(path)
    return name


def token_counts(df: DataFrame, id_col: str, text_col: str, ranks_path: str = RANKS) -> DataFrame:
    """(id, n_tokens) per row; the vocabulary file under ranks_path is needed on the driver only."""
    name = _everywhere(df.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        count = None
        for batch in batches:
            count = count or Counter(SparkFiles.get(name))
            yield pa.record_batch([batch.column(0), pa.array([count(t) for t in batch.column(1).to_pylist()], pa.int64())], names=["id", "n_tokens"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null and text <> ''").mapInArrow(run, "id long, n_tokens long")


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers as lists of indices into sizes; every size must be within 1..capacity."""
    pool = sorted((s, i) for i, s in enumerate(sizes))
    values = [s for s, _ in pool]
    bins: list[list[int]] = []

    def take(at: int) -> tuple[int, int]:
        values.pop(at)
        return pool.pop(at)

    while pool:
        bin_items, gap = [], capacity
        while pool:
            at = bisect_right(values, gap) - 1
            if at < 0:
                break
            at = bisect_left(values, values[at])  # of equal sizes the smallest identifier
            s, i = take(at)
            bin_items.append((s, i))
            gap -= s
        if gap and len(pool) >= 2:
            small = min(bin_items)
            room = gap + small[0]
            pair, best = None, small[0]
            lo, hi = 0, min(bisect_right(values, room) - 1, len(values) - 1)
            while lo < hi:
                total = values[lo] + values[hi]
                if total > room:
                    hi -= 1
                else:
                    if total > best:
                        pair, best = (lo, hi), total
                        if total == room:
                            break
                    lo += 1
            if pair:
                bin_items.remove(small)
                bin_items.append(take(pair[1]))
                bin_items.append(take(pair[0]))
                at = bisect_left(pool, small)
                pool.insert(at, small)
                values.insert(at, small[0])
        bins.append([i for _, i in bin_items])
    return bins


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("piece", "ascending")])
        sizes = group.column("n_tokens").to_pylist()
        where = [0] * len(sizes)
        for b, items in enumerate(best_two_fit(sizes, capacity)):
            for i in items:
                where[i] = b
        return pa.table({"block": group.column("block"), "container": pa.array(where, pa.int64()), "id": group.column("id"), "piece": group.column("piece"), "first_token": group.column("first_token"), "n_tokens": group.column("n_tokens")})

    return run


def pieces(counts: DataFrame, capacity: int) -> DataFrame:
    """(id, piece, first_token, n_tokens): whole texts, or full containers and a remainder of longer ones."""
    n = F.ceil(F.col("n_tokens") / F.lit(capacity))
    cut = counts.where("n_tokens > 0").select("id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).alias("piece"))
    first = F.col("piece") * capacity
    return cut.select("id", "piece", first.alias("first_token"), F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - first).alias("n_tokens"))


def pack(counts: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(block, container, id, piece, first_token, n_tokens): where each item of counts(id, n_tokens) went."""
    work = Workspace(counts.sparkSession, "packing")
    items = work.save(pieces(counts, capacity).withColumn("row", F.monotonically_increasing_id()))
    blocks = max(1, -(-items.count() // block_items))
    items = items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).drop("row")
    return items.groupBy("block").applyInArrow(_pack(capacity), "block long, container long, id long, piece long, first_token long, n_tokens long")


def document_containers(spark, sf_dir: str, ranks_path: str = RANKS) -> DataFrame:
    """Where each document, or each piece of a long one, is packed."""
    counts = token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", ranks_path)
    return pack(counts).withColumnRenamed("id", "doc_id")


def container_fill(spark, sf_dir: str, ranks_path: str = RANKS) -> DataFrame:
    """One row: containers, tokens, unused space and its share."""
    c = document_containers(spark, sf_dir, ranks_path).groupBy("block", "container").agg(F.sum("n_tokens").alias("used"))
    return c.agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), (F.count("*") * CAPACITY - F.sum("used")).alias("unused"), (1 - F.sum("used") / (F.count("*") * CAPACITY)).alias("unused_share"))


def what_was_kept(spark, sf_dir: str, ranks_path: str = RANKS) -> DataFrame:
    """One row: containers above capacity, texts cut that fit whole, texts with tokens missing or packed twice, texts packed."""
    counts = Workspace(spark, "kept").save(token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", ranks_path))
    packed = Workspace(spark, "kept").save(pack(counts))
    over = packed.groupBy("block", "container").agg(F.sum("n_tokens").alias("used")).agg(F.count(F.when(F.col("used") > CAPACITY, 1)).alias("n_overfull"))
    # A text's pieces follow one another from its first token to its last.
    per = packed.groupBy("id").agg(F.count("*").alias("n"), F.countDistinct("first_token").alias("n_starts"), F.sum("n_tokens").alias("packed"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"))
    j = counts.where("n_tokens > 0").groupBy("id").agg(F.sum("n_tokens").alias("n_tokens")).join(per, "id", "left")
    whole = F.col("packed").eqNullSafe(F.col("n_tokens")) & (F.col("n") == F.col("n_starts")) & (F.col("end") == F.col("n_tokens"))
    texts = j.agg(F.count(F.when((F.col("n_tokens") <= CAPACITY) & (F.col("n") > 1), 1)).alias("n_needless_cuts"), F.count(F.when(~F.coalesce(whole, F.lit(False)), 1)).alias("n_lost_or_repeated"), F.count("*").alias("n_documents"))
    one = F.lit(1).alias("one")  # one row each
    return over.withColumn("one", one).join(texts.withColumn("one", one), "one").drop("one")
