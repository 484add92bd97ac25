"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones.

Terms are maximal runs of digits, letters and code points from 0x80 on, A-Z lower-cased. Scores are integers: a term's
weight is floor(1000 ln((2N+2)/(2df+1))), its impact in a document (10^9 tf) div (1000 tf + 8 m) with the length norm
m = 100 - b + (b n N) div L, and a document's score sums weight x impact over the terms of the item.

Items come in blocks of at most ``block_terms`` different terms (one item may hold more), read off a running sum over the
item table, and each block is searched in all documents. Only a block is ever sent to the driver and the tasks.

1. Every task reads whole texts and packs documents into shards of about ``shard_bytes`` of text: documents by ascending
   identifier, and for every term of the block its postings (place in the shard, occurrences). Shards are rows of a table
   in the shared folder; N, L and df are sums over it. The text is read once per block and never shuffled.
2. Every shard is searched for every item. The lists at most ``short`` of the shard's documents long are added up into
   accumulators, which become one more iterator with a bound of its own. The best accumulators set the first threshold.
   Then the shard is walked in spans of documents: a span whose bounds (accumulators plus long lists) stay
   below the threshold is skipped; in the others the long lists are met by descending bound, each only at the documents
   that can still reach the threshold. The threshold rises with the documents found.
3. A task keeps the best k of an item over all its shards; they are merged in two rounds, the first by task number.

The skipping loses nothing: a document is left only if a bound on its score is below the score of k documents.

Nulls: a null text has no terms and is no document of N; an item without terms gets no rows. Rows that share a document
identifier are documents of their own, rows that share an item identifier are one item with the terms of all; null is an
identifier, null documents rank last among equals. Very long texts are counted whole. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import scratch

#: Fixed value: bytes that belong to a term; all others part terms. Bytes from 0x80 on belong to code points from 0x80 on.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
K = 10
B = 90
BLOCK_TERMS = 100_000
SHARD_BYTES = 8 << 20
SHORT = 1 / 32
SPAN = 64
_NULL_LAST = np.iinfo(np.int64).max

Block = list[tuple[int, list[int]]]

_SHARD = "doc_ids array<long>, n array<int>, terms array<int>, ends array<int>, places array<int>, tfs array<int>, n_docs long, n_terms long"


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term) of every item, distinct."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            lens = [len(f) for f in found]
            yield pa.record_batch(
                {"item": batch.column(0).take(pa.array(np.repeat(np.arange(len(lens)), lens))), "term": pa.array([t for f in found for t in f], pa.binary())}
            )

    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(cut, "item long, term binary").distinct()


def blocks(pairs: DataFrame, block_terms: int) -> Iterator[tuple[list[int | None], list[bytes], Block]]:
    """Items, terms and their relation, for one block of items after the other."""
    size = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))

    def packed(first: int | None, last: int | None) -> tuple[list[int | None], list[bytes], Block]:
        chosen = F.lit(False) if last is None else F.col("item").between(first, last) if first is not None else F.col("item") <= last
        rows = pairs.filter(chosen | F.col("item").isNull() if first is None else chosen).collect()
        vocabulary = sorted({bytes(r["term"]) for r in rows})
        place = {t: k for k, t in enumerate(vocabulary)}
        by_item: dict = {}
        for r in rows:
            by_item.setdefault(r["item"], []).append(place[bytes(r["term"])])
        items = sorted(by_item, key=lambda i: (i is None, i or 0))
        return items, vocabulary, [(k, sorted(by_item[i])) for k, i in enumerate(items)]

    held, first, last = 0, None, None
    for row in size.orderBy(F.col("item").asc_nulls_first()).toLocalIterator():
        if held and held + row["n"] > block_terms:
            yield packed(first, last)
            held = 0
        first, last = row["item"] if held == 0 else first, row["item"]
        held += row["n"]
    if held:
        yield packed(first, last)


def shards(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str, shard_bytes: int) -> DataFrame:
    """Documents in shards with the postings of the terms in ``vocabulary``."""
    sent = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})

    def shard(held: list[tuple[int | None, int, dict[int, int]]]) -> pa.RecordBatch:
        held.sort(key=lambda d: _NULL_LAST if d[0] is None else d[0])
        lens = np.fromiter((len(c) for _, _, c in held), np.int64, len(held))
        term = np.fromiter((t for _, _, c in held for t in c), np.int32, int(lens.sum()))
        tf = np.fromiter((v for _, _, c in held for v in c.values()), np.int32, len(term))
        at = np.repeat(np.arange(len(held), dtype=np.int32), lens)
        by_term = np.argsort(term, kind="stable")
        term, tf, at = term[by_term], tf[by_term], at[by_term]
        names, first = np.unique(term, return_index=True)
        ends = np.append(first[1:], len(term)).astype(np.int32) if len(names) else names
        row = {
            "doc_ids": [d for d, _, _ in held], "n": [n for _, n, _ in held], "terms": names, "ends": ends, "places": at, "tfs": tf,
            "n_docs": sum(n > 0 for _, n, _ in held), "n_terms": sum(n for _, n, _ in held),
        }
        types = [pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 5 + [pa.int64()] * 2
        return pa.record_batch({k: pa.array([v], t) for (k, v), t in zip(row.items(), types)})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, size = sent.value, [], 0
        wanted = place.keys()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                found = Counter(terms(text))
                held.append((doc, found.total(), {place[t]: found[t] for t in found.keys() & wanted}))
                size += len(text or b"") + 64
                if size >= shard_bytes:
                    yield shard(held)
                    held, size = [], 0
        if held:
            yield shard(held)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(pack, _SHARD)


class Searcher:
    """One shard: impacts of its postings, bounds of spans, and the search for an item."""

    def __init__(self, row: dict, weights: np.ndarray, n: int, length: int, b: int, k: int, short: float, span: int):
        sizes = np.asarray(row["n"], np.int64)
        norm = 100 - b + (b * sizes * n) // max(length, 1)
        places, tf = np.asarray(row["places"], np.int64), np.asarray(row["tfs"], np.int64)
        self.n_docs, self.k, self.span, self.short = len(sizes), k, span, short
        self.docs = row["doc_ids"]
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * norm[places])
        ends = [0, *row["ends"].tolist()]
        self.n_spans = -(-self.n_docs // span)
        self.lists = {}
        for t, lo, hi in zip(row["terms"].tolist(), ends, ends[1:]):
            score = impact[lo:hi] * weights[t]
            if weights[t] > 0:  # other terms add nothing to any document
                self.lists[t] = (places[lo:hi], score)
        self.bounds: dict[int, np.ndarray] = {}

    def span_bounds(self, at: np.ndarray, score: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n_spans, np.int64)
        spans = at // self.span
        heads = np.flatnonzero(np.diff(spans, prepend=-1))
        out[spans[heads]] = np.maximum.reduceat(score, heads)
        return out

    def bound_of(self, t: int) -> np.ndarray:
        if t not in self.bounds:
            self.bounds[t] = self.span_bounds(*self.lists[t])
        return self.bounds[t]

    def best(self, item: list[int], floor: int) -> list[tuple[int, int]]:
        """(score, place) of the best documents of the shard with a score of at least ``floor`` and above 0."""
        found = [t for t in item if t in self.lists]
        if not found:
            return []
        cut = self.short * self.n_docs
        long = [t for t in found if len(self.lists[t][0]) > cut]
        # term at a time: short lists become accumulators, ordered by document
        short = [self.lists[t] for t in found if len(self.lists[t][0]) <= cut]
        acc_at, acc = np.empty(0, np.int64), np.empty(0, np.int64)
        if short:
            at, score = np.concatenate([a for a, _ in short]), np.concatenate([s for _, s in short])
            acc_at, back = np.unique(at, return_inverse=True)
            acc = np.zeros(len(acc_at), np.int64)
            np.add.at(acc, back, score)
        least = max(floor, 1)
        if len(acc) >= self.k:
            least = max(least, int(np.partition(acc, -self.k)[-self.k]))
        # document at a time: the accumulators are one iterator beside the long lists
        acc_bound = self.span_bounds(acc_at, acc) if len(acc) else np.zeros(self.n_spans, np.int64)
        long.sort(key=lambda t: -int(self.bound_of(t).max()))
        rest = [np.zeros(self.n_spans, np.int64)]
        for t in reversed(long):
            rest.append(rest[-1] + self.bound_of(t))
        rest.reverse()  # rest[i]: what the long lists from i on can add
        total = acc_bound + rest[0]
        heap: list[tuple[int, int]] = []  # (score, -place): among equals the first document stays
        step = 16
        k = 0
        alive = np.flatnonzero(total >= least)
        while k < len(alive):
            spans = alive[k : k + step]
            k += step
            spans = spans[total[spans] >= least]
            if not len(spans):
                continue
            at, score = self.candidates(spans, acc_at, acc, long, rest, least)
            for s, p in zip(score.tolist(), at.tolist()):
                if len(heap) < self.k:
                    heapq.heappush(heap, (s, -p))
                elif s > heap[0][0]:
                    heapq.heapreplace(heap, (s, -p))
            if len(heap) == self.k:
                least = max(least, heap[0][0])
        return [(s, -p) for s, p in heap]

    def candidates(self, spans: np.ndarray, acc_at, acc, long, rest, least) -> tuple[np.ndarray, np.ndarray]:
        """Documents of ``spans`` whose score is at least ``least``, ascending, with their scores."""
        score = np.zeros(len(spans) * self.span, np.int64)
        base = spans * self.span  # ascending; a place is found by its span's rank
        for i, (at, add) in enumerate([(acc_at, acc), *[self.lists[t] for t in long]]):
            if i > 1:
                # non-essential from here: only documents that can still reach the threshold are looked up
                left = rest[i - 1][spans]
                can = np.flatnonzero(score + np.repeat(left, self.span) >= least)
                if not len(can):
                    return can, can
                if 8 * len(can) < len(at):
                    doc = base[can // self.span] + can % self.span
                    place = np.searchsorted(at, doc)
                    hit = place < len(at)
                    hit[hit] = at[place[hit]] == doc[hit]
                    score[can[hit]] += add[place[hit]]
                    continue
            lo, hi = np.searchsorted(at, base), np.searchsorted(at, base + self.span)
            n = hi - lo
            total = int(n.sum())
            if total:
                rank = np.repeat(np.arange(len(spans)), n)
                place = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                score[at[place] - base[rank] + rank * self.span] += add[place]
        can = np.flatnonzero(score >= least)
        return base[can // self.span] + can % self.span, score[can]


def search_block(table: DataFrame, found: tuple[list[int | None], list[bytes], Block], b: int, k: int, short: float, span: int) -> DataFrame:
    """(item, doc_id, score, task): the best ``k`` of every item of a block, per task."""
    items, vocabulary, block = found
    spark = table.sparkSession
    n, length = table.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    lists = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (F.get("ends", i) - F.coalesce(F.get("ends", i - 1), F.lit(0))).cast("long").alias("n")))
    counts = table.select(F.inline(lists)).groupBy("term").agg(F.sum("n").alias("df")).collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counts:
        weights[r["term"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
    sent = spark.sparkContext.broadcast((items, block, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, block, weights = sent.value
        best: list[list[tuple]] = [[] for _ in block]  # per item a heap of (score, -id, null id last)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r].values.to_numpy() for name in ("n", "terms", "ends", "places", "tfs")}
                row["doc_ids"] = batch.column("doc_ids")[r].as_py()
                shard = Searcher(row, weights, n, length, b, k, short, span)
                for i, wanted in block:
                    heap = best[i]
                    for s, p in shard.best(wanted, heap[0][0] if len(heap) == k else 0):
                        doc = shard.docs[p]
                        entry = (s, doc is not None, 0 if doc is None else -doc)
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        rows = [(items[i], -d if known else None, s) for i, _ in block for s, known, d in best[i]]
        yield pa.record_batch({name: pa.array([r[c] for r in rows], pa.int64()) for c, name in enumerate(("item", "doc_id", "score"))})

    return table.mapInArrow(search, "item long, doc_id long, score long").withColumn("task", F.spark_partition_id())


def best_of(rows: DataFrame, keys: Iterable[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    b: int = B,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
    shard_bytes: int = SHARD_BYTES,
    short: float = SHORT,
    span: int = SPAN,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    pairs = item_terms(items, item_col, item_text_col)
    path = scratch(spark, "search-items")
    pairs.write.parquet(path)
    pairs = spark.read.parquet(path)
    out = spark.createDataFrame([], "item long, doc_id long, score long, task int")
    for found in blocks(pairs, block_terms):
        path = scratch(spark, "search-shards")
        shards(docs, found[1], id_col, text_col, shard_bytes).write.parquet(path)
        out = out.unionByName(search_block(spark.read.parquet(path), found, b, k, short, span))
    first = best_of(out.withColumn("part", F.col("task") % 64), ["item", "part"], k)
    return best_of(first, ["item"], k).select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
