"""Toxicity by compression distance.

A window is one word with its borders, written as its overlapping byte triples, so that a word of a dictionary costs
one match and every other word its bytes. Every window is compressed with zstandard twice, with a dictionary of
ordinary text and with one of toxic text. A window is toxic if the toxic dictionary makes it at most ``most`` bytes
and the ordinary one at least ``gain`` bytes more. Both thresholds are calibrated on training documents that the
dictionaries have not seen, and a logistic model turns the number of toxic windows into a score.

Training. The dictionaries are cut from a bounded sample of labelled documents (SAMPLE rows of each label, chosen by
a hash of the identifier). The ordinary one holds the most frequent words of ordinary documents. The toxic one holds
words that stand in many different contexts of toxic documents (so copies of one text count once) and are at least
RATIO times as frequent there. Counting runs on Spark; only the chosen words reach the driver, at most WORDS of each
kind. Frequent words stand last in a dictionary, where zstandard reaches them with short offsets.

Scoring is one narrow pass over whole texts. Windows repeat, so each worker keeps the result of at most CACHE
windows. Nothing but the text enters a score.

Nulls and empty texts have no window and get the score of a document without toxic windows. A null label is not
learned; of several labels of one identifier the larger counts. Without labels of both kinds every score is 0. A null
identifier is not held out. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import crc_mod, words
from shelfwise.scale import cut_lineage

SAMPLE = 6000
WORDS = 400
RATIO = 20.0
CONTEXTS = 0.008
LONGEST = 64
CACHE = 400_000
MOST = (11, 12, 13, 14)
GAIN = (4, 5, 6, 7, 8)
_EDGE = re.compile(rb"^[^a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff]+$")


def window(word: bytes) -> bytes:
    """A word with its borders as overlapping byte triples."""
    s = b"^" + word + b"$"
    n = len(s) - 2
    out = bytearray(3 * n)
    out[0::3], out[1::3], out[2::3] = s[:-2], s[1:-1], s[2:]
    return bytes(out)


def compressor(chosen: list[bytes]) -> zstandard.ZstdCompressor:
    """Compressor with a dictionary of the words, the most frequent first in ``chosen``."""
    data = b"".join(window(w) for w in reversed(chosen)) or b"........"
    log = min(14, max(10, math.ceil(math.log2(len(data) + 512))))
    # magicless frames without sizes and checksums, small tables: a window is a few dozen bytes
    params = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
        window_log=log, hash_log=log, chain_log=log, search_log=5, min_match=5, target_length=64,
        strategy=zstandard.STRATEGY_GREEDY,
    )
    dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)


class Windows(dict):
    """Word -> (bytes with the toxic dictionary, bytes saved against the ordinary one), computed once."""

    def __init__(self, model: dict):
        self.toxic, self.ordinary = compressor(model["toxic"]), compressor(model["ordinary"])

    def measure(self, word: bytes) -> tuple[int, int]:
        core = _EDGE.sub(b"", word)
        if not core:
            return 99, 0
        # longer words in pieces: each is a window of its own, the best one counts
        best = (99, 0)
        for k in range(0, len(core), LONGEST):
            w = window(core[k : k + LONGEST])
            small = len(self.toxic.compress(w))
            if small <= MOST[-1]:
                best = min(best, (small, len(self.ordinary.compress(w)) - small), key=lambda x: (x[0], -x[1]))
        return best

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = self.measure(word)
        return found


class Flags(Windows):
    """Word -> 1 if its window is toxic under the calibrated thresholds."""

    def __init__(self, model: dict):
        super().__init__(model)
        self.most, self.gain = model["most"], model["gain"]

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        small, saved = self.measure(word)
        found = self[word] = int(small <= self.most and saved >= self.gain)
        return found


def _words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, each: int) -> DataFrame:
    """(toxic, calibrate, text) of the sampled training documents; the label table is cut to 2 * each rows first."""
    known = labels.filter((crc_mod("doc_id", 5) != 0) & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = cut_lineage(known.withColumn("h", F.xxhash64("doc_id")))
    parts = [known.filter(F.col("toxic") == k).orderBy("h").limit(each) for k in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]).withColumnRenamed("doc_id", "__id"))
    two = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text"))
    found = two.join(chosen, two["__doc"] == chosen["__id"])
    # equal texts fall on one side
    side = F.pmod(F.xxhash64("text"), F.lit(10)) >= 6
    return cut_lineage(found.filter(F.col("text").isNotNull()).select("toxic", side.alias("calibrate"), "text"))


def chosen_words(texts: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """Words of the toxic and of the ordinary dictionary, the most frequent first."""
    core = F.transform(words(F.lower("text")), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    rows = texts.filter(~F.col("calibrate")).dropDuplicates(["text"]).select("toxic", F.monotonically_increasing_id().alias("doc"), core.alias("w"))
    rows = cut_lineage(rows)
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return [], []
    pairs = rows.select("toxic", "doc", F.explode(F.arrays_zip(F.col("w").alias("b"), F.concat(F.array(F.lit("")), "w").alias("a"))).alias("p"))
    pairs = pairs.select("toxic", "doc", F.col("p.b").alias("word"), F.col("p.a").alias("before")).filter(F.length("word") >= 3)
    counts = pairs.select("toxic", "doc", "word").distinct().groupBy("word").agg(
        F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_ordinary")
    )
    contexts = pairs.filter("toxic = 1").select("word", "before").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("contexts"))
    least = max(3.0, CONTEXTS * total[1])
    toxic = (
        contexts.filter(F.col("contexts") >= least)
        .join(counts, "word")
        .filter(F.col("n_toxic") / total[1] > RATIO * (F.col("n_ordinary") + 0.5) / total[0])
        .orderBy(F.desc("contexts"), "word")
        .limit(WORDS)
    )
    ordinary = counts.orderBy(F.desc("n_ordinary"), "word").limit(WORDS)
    return tuple([r["word"].encode() for r in t.select("word").collect()] for t in (toxic, ordinary))


def histograms(texts: DataFrame, model: dict) -> list[tuple[int, int, list[int]]]:
    """(toxic, words, toxic windows at each pair of thresholds) of the calibration documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Windows(model)
        for batch in batches:
            sizes, hits = [], []
            for text in batch.column("text").to_pylist():
                ws = _words(text)
                near = [v for v in map(cache.__getitem__, ws) if v[0] <= MOST[-1]]
                sizes.append(len(ws))
                hits.append([sum(a <= m and b >= g for a, b in near) for m in MOST for g in GAIN])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(sizes, pa.int64()), pa.array(hits, pa.list_(pa.int64()))],
                names=["toxic", "size", "hits"],
            )

    some = texts.filter("calibrate").select("toxic", "text").mapInArrow(run, "toxic int, size long, hits array<long>")
    return [(r["toxic"], r["size"], r["hits"]) for r in some.collect()]


def features(hits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of a document: one, the logarithm of the toxic windows, two or more of them, and the size among those with any."""
    log = np.log1p(hits)
    return np.stack([np.ones(len(hits)), log, (hits >= 2) * 1.0, (hits > 0) * np.log1p(size) / 10], axis=1)


def calibrate(seen: list[tuple[int, int, list[int]]]) -> dict:
    """Thresholds with the best balanced accuracy and a logistic model of the windows they flag."""
    y = np.array([s[0] for s in seen], float)
    size = np.array([s[1] for s in seen], float)
    hits = np.array([s[2] for s in seen], float)
    grid = [(m, g) for m in MOST for g in GAIN]
    if not len(y) or y.min() == y.max():
        return {"most": MOST[1], "gain": GAIN[1], "weights": np.array([-3.0, 2.0, 2.0, 0.0])}
    # two words or one, whichever separates better, judges a pair of thresholds
    def judge(k: int) -> float:
        return max((np.mean(hits[y == 1, k] >= c) + np.mean(hits[y == 0, k] < c)) / 2 for c in (1, 2))

    best = max(range(len(grid)), key=judge)
    x = features(hits[:, best], size)
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + 0.01 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(weights))
        weights = weights - np.linalg.solve(curve, slope)
    return {"most": grid[best][0], "gain": grid[best][1], "weights": weights}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = SAMPLE) -> dict | None:
    texts = training_texts(docs, labels, id_col, text_col, each)
    toxic, ordinary = chosen_words(texts)
    if not toxic:
        return None
    model = {"toxic": toxic, "ordinary": ordinary}
    return model | calibrate(histograms(texts, model))


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and n_windows (toxic windows) of every document."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("n_windows", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = Flags(model) if model else None
        for batch in batches:
            hits, sizes = [], []
            for text in batch.column("text").to_pylist():
                ws = _words(text)
                sizes.append(len(ws))
                hits.append(sum(map(flags.__getitem__, ws)) if model else 0)
            if model:
                z = features(np.array(hits, float), np.array(sizes, float)) @ model["weights"]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                p = np.zeros(len(hits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p, pa.float64()), pa.array(hits, pa.int64())],
                names=["doc_id", "score", "n_windows"],
            )

    two = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows; learns from rows whose crc32 of the id, modulo 5, is not 0."""
    scored = score(docs, train(docs, labels, **options))
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows"
    )
