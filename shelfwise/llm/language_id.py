"""Language identification with string kernels.

The kernel of two texts counts the blended-spectrum n-grams (lengths 1 to 3, over lower-case letters with every
other run of characters as one blank) that are present in both, divided by the root of the product of both counts.
N-grams are hashed to 2^BITS places, so a text is a bit vector of fixed size whatever its length.

Nyström: LANDMARKS training texts span the feature space; their kernel matrix is decomposed once and a text maps to
K(text, landmarks) U Lambda^(-1/2). One-versus-rest kernel ridge regression on these features gives a score per
language. Texts are scored in blocks by two matrix products: presence bits times landmarks, features times weights.

Training rows are a bounded sample: at most ``train_rows`` in all, an equal share for each language, chosen by a
hash of the text. Candidates are selected by hash range on the executors and equal texts collapse, so a hot language
or a group of copies never meets in one task. What reaches the driver is bounded: train_rows * 2^BITS / 8 bytes. All
texts are read whole, for training and for scoring.

Nulls: a null text, or one without letters, is ``und`` with score 0. A null language is never learned. Without any
training row everything is ``und``. A null identifier counts as not held out. The score is a softmax of the
one-versus-rest outputs, between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import crc_mod, portions

BITS = 15
LENGTHS = 3
LANDMARKS = 160
TRAIN_ROWS = 1600
RIDGE = 1e-3
SHARPNESS = 6.0
BLOCK = 64
#: A document below this score has no reliable language; the pipeline drops it.
LEAST_SCORE = 0.4


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def presence(text: str | None, out: np.ndarray) -> bool:
    """Set the places of the text's n-grams in ``out``; False if the text has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return False
    # other characters become blanks, runs of blanks one, with a blank at both ends
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    sym = np.where(letter, points, 32)[keep].astype(np.uint64)
    lead = np.array([32], np.uint64)
    sym = np.concatenate([lead, sym] if sym[-1] == 32 else [lead, sym, lead])
    shift = np.uint64(64 - BITS)
    code = np.zeros(len(sym), np.uint64)
    for n in range(LENGTHS):
        if len(sym) <= n:
            break
        code = code[: len(sym) - n] * np.uint64(0x100000001B3) + sym[n:] + np.uint64(n)
        out[(code * np.uint64(0x9E3779B97F4A7C15)) >> shift] = True
    return True


def training_rows(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """(lang, h, bits): the sample of training texts as packed presence bits."""
    known = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    known = known.withColumn("h", F.xxhash64("text"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    langs = counts.agg(F.count(F.lit(1))).first()[0]
    each = max(1, rows // max(1, langs))
    # twice the share is expected below the cut, then the smallest hashes are taken
    cut = counts.select("lang", F.least(F.lit(1.0), 2.0 * each / F.col("n")).alias("part"))
    some = known.join(F.broadcast(cut.limit(rows)), "lang").filter(
        (F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) <= F.col("part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for text in batch.column("text").to_pylist():
                bit = np.zeros(1 << BITS, bool)
                bits.append(np.packbits(bit).tobytes() if presence(text, bit) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"), pa.array(bits, pa.binary())], names=["lang", "h", "bits"]
            )

    found = some.select("lang", "h", "text").mapInArrow(run, "lang string, h long, bits binary").filter("bits is not null")
    # equal texts have one hash: one row each, then a bounded window per language
    once = found.groupBy("lang", "h").agg(F.first("bits").alias("bits"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return once.withColumn("place", place).filter(F.col("place") <= each)


def fit(langs: list[str], bits: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict:
    """Landmarks and weights from packed presence bits (rows x 2^BITS / 8) and their languages; a block of rows at a time is unpacked."""
    names = sorted(set(langs))
    y = np.array([names.index(a) for a in langs])
    share = max(1, landmarks // len(names))
    chosen = np.concatenate([np.flatnonzero(y == k)[:share] for k in range(len(names))])[:landmarks]
    wide = lambda rows: np.unpackbits(rows, axis=1).astype(np.float32)
    mark = wide(bits[chosen])
    # counts of common places are whole numbers, exact in any block
    common = np.concatenate([wide(bits[lo : lo + BLOCK]) @ mark.T for lo in range(0, len(bits), BLOCK)])
    size = np.sqrt(np.bitwise_count(bits).sum(axis=1, dtype=np.int64).astype(np.float32))
    mark_size = size[chosen]
    values, vectors = np.linalg.eigh((common[chosen] / np.outer(mark_size, mark_size)).astype(np.float64))
    good = values > 1e-6 * values.max()
    project = vectors[:, good] / np.sqrt(values[good])
    z = (common / np.outer(size, mark_size)) @ project
    z = np.hstack([z, np.ones((len(z), 1))])
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    weights = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]), z.T @ target)
    # landmark sizes and the projection are constants of the second product
    inner = (project / mark_size[:, None]) @ weights[:-1]
    return {"names": names, "marks": bits[chosen], "inner": inner, "bias": weights[-1]}


def outputs(model: dict, bits: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """One-versus-rest outputs of a block of presence bits."""
    kernel = (bits.astype(np.float32) @ marks) / np.sqrt(np.maximum(1, bits.sum(axis=1)))[:, None]
    return kernel @ model["inner"] + model["bias"]


def classify(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: list[str] | None = None,
    train_rows: int = TRAIN_ROWS,
    landmarks: int = LANDMARKS,
) -> DataFrame:
    """``keep`` columns (default: the identifier) with lang_pred and score. ``learn`` selects the rows to learn from."""
    sample = training_rows(docs, learn, id_col, text_col, lang_col, train_rows)
    got = sample.select("lang", "bits").orderBy("lang", "h").collect()
    model = None
    if got:
        bits = np.array([np.frombuffer(r["bits"], np.uint8) for r in got])
        model = fit([r["lang"] for r in got], bits, landmarks)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [id_col] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        marks = None if model is None else np.unpackbits(model["marks"], axis=1).T.astype(np.float32)
        for batch in portions(batches):
            texts = batch.column("__text")
            names: list[str] = []
            scores: list[float] = []
            for lo in range(0, len(texts), BLOCK):
                block = texts.slice(lo, BLOCK).to_pylist()
                bits = np.zeros((len(block), 1 << BITS), bool)
                lettered = np.array([presence(t, row) for t, row in zip(block, bits)])
                if model is None:
                    names += ["und"] * len(block)
                    scores += [0.0] * len(block)
                    continue
                f = SHARPNESS * outputs(model, bits, marks)
                p = np.exp(f - f.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                names += [model["names"][k] if ok else "und" for k, ok in zip(best, lettered)]
                scores += [float(v) if ok else 0.0 for v, ok in zip(p.max(axis=1), lettered)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["__row", "lang_pred", "score"],
            )

    two = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"), F.col(text_col).cast("string").alias("__text")
    )
    schema = T.StructType([two.schema["__row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return two.mapInArrow(run, schema).select("__row.*", "lang_pred", "score")


def language_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows whose crc32 of the id, modulo 4, is not 2."""
    held_out = F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False))
    out = classify(docs, ~held_out, id_col=id_col, **options)
    return out.select(F.col(id_col).alias("doc_id"), F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, id_col: str = "doc_id", least: float = LEAST_SCORE) -> DataFrame:
    """Documents whose language is recognized, with all their columns; learns as ``language_report`` does."""
    held_out = F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False))
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("all"), id_col, "text", "lang")
    out = classify(packed, ~held_out, id_col=id_col, keep=["all"])
    kept = out.filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return kept.select(*[F.col(f"all.`{c}`").alias(c) for c in names])
