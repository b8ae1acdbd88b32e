"""Held-out test passages inside a corpus: copies of whole items, near or exact, and passages in part.

near_copies: SimHash of item-sized windows. An item is fingerprinted at every place by windows of a length from a ladder,
up to 0.8 of its own; so are the documents, at every sixteenth of a window's length. Two fingerprints within RADIUS = 7
bits of each other agree, up to one bit, in one of four 16-bit blocks at least; the items' fingerprints are entered in
each block's table under every value within that bit, so four lookups find every pair within the radius. Candidates
are laid over the item and verified by their weighted five-word shingles: a shingle of k items weighs 1 / k, counted over
all items, one that the item does not have weighs as much as the item's do on average; 0.8 or more is a near copy.

leaks: twelve consecutive words of an item, as the statement of the problem asks for passages in part. Every such run is
hashed on both sides; a Bloom filter of the items' runs, of bounded size, goes to the tasks, and what it lets through
is joined to the items' runs by hash and text. A SimHash has no part in it: equal words have equal fingerprints.

Both read and hash the corpus once, whatever the number of items, and never shuffle its texts.

Defined results: null and empty texts show nothing; items of fewer than twelve words can't be found; repeated documents
are found each; repeated items each too; an empty table on either side gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.llm.text import words
from schemaloom.session import Workspace, table

WINDOW = 12
SHINGLE = 5
RADIUS = 7
SIMILAR = 0.8
BLOCKS, BLOCK_BITS = 4, 16
#: Items to an index that a task holds at once: some 100 MB. More items make more indexes, held one after the other.
ITEM_BLOCK = 5_000
#: Bits of the Bloom filter: 16 for each run of words of the items, 2^27 (16 MB) at most. Beyond, more is let through
#: and sorted out by the join.
BLOOM_BITS, BLOOM_MOST = 16, 27
#: Words fingerprinted at a time, and documents.
CHUNK, DOCS = 60_000, 256


def word_hash(w: str) -> int:
    return int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")


class WordHashes:
    """Hashes of words; natural text repeats its words, so each is hashed once per task."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 1_000_000:
            known.clear()
        for w in set(ws).difference(known):
            known[w] = word_hash(w)
        return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive words, in order of the words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + m]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


# --- near copies ------------------------------------------------------------------------------------------


def simhashes(hashes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """The SimHash of the `window` words from each start (ascending): the majority of the words, bit by bit."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = int(np.searchsorted(starts, a + CHUNK))
        part = hashes[a : int(starts[j - 1]) + window]
        sums = np.zeros((len(part) + 1, 64), np.int32)
        np.cumsum(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1), axis=0, out=sums[1:], dtype=np.int32)
        s = starts[i:j] - a
        out[i:j] = np.packbits((sums[s + window] - sums[s]) * 2 > window, axis=1).view(np.uint64).ravel()
        i = j
    return out


def rung(n: int) -> int:
    """The window for an item of n words: the longest of a ladder that is no longer than 0.8 of it; 0 below the ladder."""
    best, w = 0, 9
    while w <= SIMILAR * n:
        best, w = w, w * 5 // 4
    return best


def stride(window: int) -> int:
    """How far apart a document's windows start: an item's windows start at every word over more than that."""
    return max(1, window // 16)


class ItemIndex:
    """The items' windows of each length behind a table per Hamming block."""

    def __init__(self, items: list[tuple[int, str, list[int], list[float]]], radius: int = RADIUS):
        """items: (id, text, hashes of its shingles, their weights)."""
        self.radius, self.near = radius, radius // BLOCKS
        if self.near > 1:
            raise ValueError(f"the radius must be below {2 * BLOCKS}")
        self.ids = [i for i, *_ in items]
        hashed = WordHashes()
        self.sizes, self.weights, by_rung = [], [], {}
        for k, (_, text, shingles, weights) in enumerate(items):
            h = hashed(words(text))
            self.sizes.append(len(h))
            self.weights.append(dict(zip(np.array(shingles, np.int64).view(np.uint64).tolist(), weights)))
            if w := rung(len(h)):
                at = np.arange(len(h) - w + 1)
                by_rung.setdefault(w, []).append((simhashes(h, at, w), np.full(len(at), k), at))
        self.windows = {w: tuple(np.concatenate([x[i] for x in found]) for i in range(3)) for w, found in by_rung.items()}
        self.tables = {w: [self.table(self.part(prints, b)) for b in range(BLOCKS)] for w, (prints, _, _) in self.windows.items()}

    @staticmethod
    def part(prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> np.uint64(BLOCK_BITS * block)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def table(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows in order of their block's values, where each value starts); with every value within `near` bits."""
        n = len(part)
        if self.near:
            part = np.concatenate([part, *(part ^ (1 << b) for b in range(BLOCK_BITS))])
        order = np.argsort(part, kind="stable")
        return (order % max(1, n)).astype(np.int32), np.searchsorted(part[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32)

    def candidates(self, window: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window of the text, window of an item): all pairs of that length within the radius, each once."""
        own = self.windows[window][0]
        here, there = [], []
        for b, (order, ends) in enumerate(self.tables[window]):
            part = self.part(prints, b)
            n = ends[part + 1] - ends[part]
            hit = np.flatnonzero(n)
            if not len(hit):
                continue
            n = n[hit]
            left = np.repeat(hit, n)
            right = order[np.repeat(ends[part[hit]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)]
            near = np.bitwise_count(prints[left] ^ own[right]) <= self.radius
            here.append(left[near])
            there.append(right[near])
        if not here:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(here) * len(own) + np.concatenate(there))
        return pairs // len(own), pairs % len(own)

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        """The weighted Jaccard similarity of an item and a text's shingles."""
        mine, have = self.weights[item], set(shingles.tolist())
        whole = sum(mine.values())
        shared = sum(w for s, w in mine.items() if s in have)
        beside = sum(1 for s in have if s not in mine) * whole / max(1, len(mine))
        return shared / (whole + beside) if whole else 0.0

    def find(self, texts: list[np.ndarray], prints: dict) -> Iterator[tuple[int, int, float]]:
        """(place of the text, item, similarity) of every near copy; prints are the texts' windows by length."""
        best: dict[tuple[int, int], float] = {}
        for w in self.windows:
            owner, starts, found = prints[w]
            left, right = self.candidates(w, found)
            _, item, offset = self.windows[w]
            # Where the item would begin in the text; windows of one copy agree on it.
            laid = np.unique(np.stack([owner[left], item[right], starts[left] - offset[right]]), axis=1) if len(left) else np.zeros((3, 0), np.int64)
            for d, k, at in laid.T.tolist():
                lo = max(0, at)
                s = self.similarity(k, runs(texts[d][lo : max(lo, at + self.sizes[k])], SHINGLE))
                if s >= SIMILAR and s > best.get((d, k), 0.0):
                    best[d, k] = s
        for (d, k), s in best.items():
            yield d, k, s


def _prints(texts: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in the text, fingerprint) of the windows of some texts; none lies across two texts."""
    owner, starts, flat, base = [], [], [], 0
    for d, h in enumerate(texts):
        at = np.arange(0, len(h) - window + 1, stride(window))
        if len(h) >= window and at[-1] != len(h) - window:
            at = np.append(at, len(h) - window)
        owner.append(np.full(len(at), d))
        starts.append(at)
        flat.append(at + base)
        base += len(h)
    all_ = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    return np.concatenate(owner).astype(np.int64), np.concatenate(starts).astype(np.int64), simhashes(all_, np.concatenate(flat).astype(np.int64), window)


def _near(indexes: list, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            parts = []
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                texts = [hashed(words(t)) for t in part.column(1).to_pylist()]
                parts.append((part.column(0).to_pylist(), texts, {w: _prints(texts, w) for w in lengths}))
            out: list[tuple] = []
            for b in indexes:  # each text is hashed once, whatever the number of indexes
                index = b.value
                for ids, texts, prints in parts:
                    out += [(ids[d], index.ids[k], s) for d, k, s in index.find(texts, prints)]
                if len(indexes) > 1:
                    b.__dict__.pop("_value", None)
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], names=["doc_id", "item_id", "similarity"])

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = WordHashes()
    for b in batches:
        found = [np.unique(runs(hashed(words(t)), SHINGLE)).view(np.int64) for t in b.column(1).to_pylist()]
        yield pa.record_batch([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int64()))], names=["item_id", "text", "shingles"])


def _pair(documents: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    return documents, items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null and item_id is not null")


def near_copies(documents: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity) of documents(doc_id, text) that hold a near copy of a whole item(item_id, text)."""
    spark = documents.sparkSession
    work = Workspace(spark, "near")
    documents, items = _pair(documents, items)
    each = work.save(items.mapInArrow(_shingles, "item_id long, text string, shingles array<long>").withColumn("row", F.monotonically_increasing_id()))
    per = each.select("row", F.explode("shingles").alias("s"))
    weight = per.groupBy("s").agg((F.lit(1.0) / F.countDistinct("row")).alias("w"))
    weighted = per.join(weight, "s").groupBy("row").agg(F.collect_list(F.struct("s", "w")).alias("sw"))  # an item's own
    ready = work.save(each.select("row", "item_id", "text").join(weighted, "row").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(1 << 20))))
    n = ready.count()
    blocks = -(-n // ITEM_BLOCK)
    indexes, lengths = [], set()
    for b in range(blocks):
        mine = ready.where(F.pmod("part", F.lit(blocks)) == b)
        index = ItemIndex([(r["item_id"], r["text"], [x["s"] for x in r["sw"]], [x["w"] for x in r["sw"]]) for r in mine.orderBy("row").toLocalIterator()], radius)
        lengths |= {*index.windows}
        indexes.append(spark.sparkContext.broadcast(index))
    if not lengths:
        return spark.createDataFrame([], "doc_id long, item_id long, similarity double")
    found = documents.mapInArrow(_near(indexes, sorted(lengths)), "doc_id long, item_id long, similarity double")
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


# --- passages in part ------------------------------------------------------------------------------------


def _grams(bloom=None, mask: int = 0):
    """A mapInArrow function: (id, hash, text) of each run of twelve words; with a Bloom filter only what it lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        bits = None if bloom is None else bloom.value
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                texts = [words(t) for t in part.column(1).to_pylist()]
                ids = part.column(0).to_pylist()
                flat = [w for ws in texts for w in ws]
                h = runs(hashed(flat), WINDOW)
                ends = np.cumsum([len(ws) for ws in texts])
                place = np.arange(len(h))
                if bits is not None:
                    for probe in range(PROBES):
                        bit = (h[place] >> np.uint64(21 * probe)) & np.uint64(mask)
                        place = place[((bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)]
                doc = np.searchsorted(ends, place, side="right")
                inside = place + WINDOW <= ends[doc] if len(place) else np.zeros(0, bool)  # not across two texts
                place, doc = place[inside], doc[inside]
                out[0].extend(ids[d] for d in doc.tolist())
                out[1].extend(h[place].view(np.int64).tolist())
                out[2].extend(" ".join(flat[p : p + WINDOW]) for p in place.tolist())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string()))], names=["id", "h", "gram"])

    return run


GRAMS = "id long, h long, gram string"
PROBES = 3


def _bloom(grams: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """A Bloom filter of the hashes, put together on the executors; the driver receives its words, a bounded number."""
    size = min(BLOOM_MOST, max(10, (BLOOM_BITS * n).bit_length()))
    mask = (1 << size) - 1
    bit = F.explode(F.array(*(F.shiftrightunsigned("h", 21 * p).bitwiseAND(F.lit(mask)) for p in range(PROBES)))).alias("bit")
    words_ = grams.select(bit).distinct().groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    t = words_.toArrow()
    out = np.zeros(1 << (size - 6), np.uint64)
    out[t.column("word").to_numpy()] = t.column("bits").to_numpy().view(np.uint64)
    return out, mask


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows): documents(doc_id, text) that share twelve words in a row or more with items(item_id, text)."""
    spark = documents.sparkSession
    work = Workspace(spark, "leakage")
    documents, items = _pair(documents, items)
    own = work.save(items.withColumnRenamed("item_id", "id").mapInArrow(_grams(), GRAMS).distinct().withColumnRenamed("id", "item_id"))
    n = own.count()
    if not n:
        return spark.createDataFrame([], "doc_id long, item_id long, n_windows long")
    bits, mask = _bloom(own, n)
    held = documents.withColumnRenamed("doc_id", "id").mapInArrow(_grams(spark.sparkContext.broadcast(bits), mask), GRAMS).withColumnRenamed("id", "doc_id")
    return held.join(own, ["h", "gram"]).groupBy("doc_id", "item_id").agg(F.countDistinct("gram").alias("n_windows"))


def _tables(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "eval_items", "item_id", "text")


def leaked_pairs(spark, sf_dir: str) -> DataFrame:
    """p8_found(doc_id, item_id)."""
    return leaks(*_tables(spark, sf_dir)).select("doc_id", "item_id")


def near_pairs(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a whole item, word for word or nearly so, with the similarity of the place most like it."""
    return near_copies(*_tables(spark, sf_dir))


def leaked_items(spark, sf_dir: str) -> DataFrame:
    """Which items leaked: documents that hold a passage of them, documents that hold them whole, the most similar one."""
    in_part = leaks(*_tables(spark, sf_dir)).groupBy("item_id").agg(F.count("*").alias("n_documents"))
    whole = near_pairs(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_whole"), F.max("similarity").alias("most"))
    suites = table(spark, sf_dir, "eval_items", "item_id", "suite")
    per = in_part.join(whole, "item_id", "full").join(suites, "item_id")
    return per.select("item_id", "suite", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_whole", F.lit(0)).alias("n_whole"), "most")
