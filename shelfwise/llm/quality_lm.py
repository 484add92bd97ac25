"""Quality by an interpolated modified Kneser-Ney model.

The model is over the characters of the texts as they are, none folded, in n-grams of ORDER; its tables grow with what the
trusted documents hold. Documents are stored once, in pieces of about PIECE_CHARS characters, bucketed by piece. Every piece
gives its distinct n-grams with their count in trusted documents. The Kneser-Ney tables come from joins of these counts,
sharded by n-gram: continuation counts of every order by suffix, totals and numbers of singletons, doubletons and others
by context, three discounts per order from counts of counts, and the probability of every n-gram that any document holds by a
join with its context and with the next lower order; n-grams that trusted documents lack back off in the same join.

The probabilities are joined with the n-grams of each piece and meet the piece where it is stored, so neither the model nor a
text goes through the driver, a broadcast or a shuffle. The perplexity of a document is the exponential of its mean
surprise per character. A short text has an uncertain mean, so decisions use its lower bound, DEVIATIONS standard errors
below. Thresholds are a high quantile of the trusted documents' lower bounds in each language, times a margin; a language
without trusted documents takes the quantile over all. A document whose lower bound is above its threshold is dropped.

Nulls: a null or empty text has no perplexity and is not kept. A null label is not trusted; one positive label of an
identifier suffices. A null language is a language of its own. Without trusted text nothing can be judged and every
document with text is kept. A null identifier is scored, never trusted. A character that no trusted document holds has the
probability of one unknown character. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import scratch
from shelfwise.scale import cut_lineage

ORDER = 4
QUANTILE = 0.995
MARGIN = 1.1
DEVIATIONS = 3.0
PIECE = 1 << 20
PIECE_CHARS = 16 << 20
TABLE = 1 << 25
#: A code point takes 21 bits, the symbol before a text is none of them.
BASE = 1 << 21
PAD = 0x110000
#: Symbols of the small alphabet of ``codes``.
SYMBOLS = 48


def codes(text: str) -> np.ndarray:
    """Code of the n-gram that ends at every character, over a small alphabet (code points modulo); for dense tables."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.concatenate([np.zeros(ORDER - 1, np.int64), points % (SYMBOLS - 1) + 1])
    code = np.zeros(len(points), np.int64)
    for k in range(ORDER):
        code = code * SYMBOLS + s[k : k + len(points)]
    return code


def pieces(text: str) -> Iterator[np.ndarray]:
    """Codes of a long text in pieces of bounded size."""
    if len(text) <= PIECE:
        yield codes(text)
        return
    for k in range(0, len(text), PIECE):
        lead = max(0, k - ORDER + 1)
        yield codes(text[lead : k + PIECE])[k - lead :]


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order, and the place of every value among them."""
    top = int(values.max()) + 1 if len(values) else 0
    if top > TABLE:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(top, bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(top, np.int32)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def runs(texts: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(place of the text, code points) of parts of the texts, each after ORDER - 1 symbols of context, about PIECE at a time."""
    owners: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    for k, text in enumerate(texts):
        points = np.frombuffer((text.as_py() or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.concatenate([np.full(ORDER - 1, PAD, np.uint32), points])
        for at in range(0, len(points) - ORDER + 1, PIECE):
            owners.append(k)
            parts.append(points[at : at + PIECE + ORDER - 1])
            size += len(parts[-1])
            if size >= PIECE:
                yield np.array(owners), parts
                owners, parts, size = [], [], 0
    if parts:
        yield np.array(owners), parts


def grams(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as (context, symbol), ascending, and the place among them of the n-gram of every symbol of the parts."""
    # an n-gram is two pairs; numbers of distinct pairs multiply to less than 64 bits in any text
    chars, c = numbered(np.concatenate(parts))
    pairs, p = numbered(c[:-1].astype(np.int64) * len(chars) + c[1:])
    code = p[:-2].astype(np.int64) * len(pairs) + p[2:]
    starts = np.cumsum([len(x) for x in parts])[:-1]
    inside = np.ones(len(code), bool)
    inside[(starts[:, None] - np.arange(1, ORDER)).ravel()] = False
    found, place = numbered(code[inside])
    first, last = np.divmod(found, len(pairs))
    (a, b), (c, d) = np.divmod(pairs[first], len(chars)), np.divmod(pairs[last], len(chars))
    return (chars[a].astype(np.int64) * BASE + chars[b]) * BASE + chars[c], chars[d].astype(np.int64), place


def in_pieces(docs: DataFrame) -> DataFrame:
    """``docs`` (with text) with ``row``, unique, and ``piece``, of about PIECE_CHARS characters of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        row, chars = base, 0
        for batch in batches:
            sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column("text")], np.int64)
            ends = chars + np.cumsum(sizes)
            piece = base + (ends - sizes) // PIECE_CHARS
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(row + np.arange(batch.num_rows)), pa.array(piece)], names=[*batch.schema.names, "row", "piece"]
            )
            row += batch.num_rows
            chars = int(ends[-1]) if len(ends) else chars

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields]).add("row", T.LongType()).add("piece", T.LongType()))


def count_ngrams(stored: DataFrame, labels: DataFrame) -> DataFrame:
    """(piece, context, symbol, n): the n-grams of every piece of the documents and their number in its trusted documents."""
    trusted = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("__id")).distinct()
    # trusted identifiers grow with the corpus: never broadcast, at any size; only identifiers are shuffled
    named = stored.select(F.col("piece").alias("of"), F.col("row").alias("own"), F.col("doc_id").alias("name"))
    flags = named.join(trusted.hint("merge"), F.col("name") == F.col("__id"), "left_semi").select("of", "own")

    def count(docs: pa.Table, some: pa.Table) -> pa.Table:
        own = np.isin(docs["row"].to_numpy(), some["own"].to_numpy())
        met = []
        for owners, parts in runs(docs["text"]):
            context, symbol, place = grams(parts)
            counted = np.repeat(own[owners], [len(x) - ORDER + 1 for x in parts])
            n = np.bincount(place[counted], minlength=len(context))
            met.append(pa.table({"context": context, "symbol": symbol, "n": n}))
        none = np.zeros(0, np.int64)
        whole = pa.concat_tables(met or [pa.table({"context": none, "symbol": none, "n": none})])
        whole = whole.group_by(["context", "symbol"]).aggregate([("n", "sum")])
        piece = docs["piece"][0].as_py() if len(docs) else 0
        return pa.table({"piece": np.full(len(whole), piece), "context": whole["context"], "symbol": whole["symbol"], "n": whole["n_sum"]})

    by_piece = stored.select("piece", "row", "text").groupBy("piece").cogroup(flags.groupBy("of"))
    return by_piece.applyInArrow(count, "piece long, context long, symbol long, n long")


def discounts(counts: DataFrame) -> list[float]:
    """The three discounts of an order from its counts of counts."""
    row = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = [float(row[k] or 0) for k in range(4)]
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 3 - 3 * y]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


def kneser_ney(counts: DataFrame, base: int = BASE, symbols: int | None = None) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1 on: (context, symbol, p) of the n-grams, interpolated, and (context, gamma).

    ``counts`` has context (a number with a digit to ``base`` per symbol), symbol, and n, 0 for n-grams that are only asked for. With
    no number of ``symbols`` it is that of the seen ones and an unknown one.
    """
    by_order = [counts]
    for k in range(ORDER, 1, -1):
        # continuation counts: how many symbols stand before the suffix
        suffix = (F.col("context") % base ** (k - 2)).alias("context")
        by_order.insert(0, cut_lineage(by_order[0].groupBy(suffix, "symbol").agg(F.count_if(F.col("n") > 0).alias("n"))))
    if symbols is None:
        symbols = by_order[0].filter("n > 0").count() + 1
    out: list[tuple[DataFrame, DataFrame]] = []
    for k, counted in enumerate(by_order, 1):
        d1, d2, d3 = discounts(counted)
        cut = F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        sums = counted.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut).alias("held"))
        # nothing is known after a context that was never seen: all is left to the lower order
        gamma = F.when(F.col("total") > 0, F.col("held") / F.col("total")).otherwise(1.0)
        gamma = cut_lineage(sums.select("context", "total", gamma.alias("gamma")))
        rows = counted.join(gamma, "context")
        own = F.when(F.col("total") > 0, (F.col("n") - cut) / F.col("total")).otherwise(0.0)
        if k == 1:
            seen = rows.select("context", "symbol", (own + F.col("gamma") / symbols).alias("p"))
        else:
            lower = out[-1][0].select(F.col("context").alias("suffix"), "symbol", F.col("p").alias("p_lower"))
            rows = rows.withColumn("suffix", F.col("context") % base ** (k - 2)).join(lower, ["suffix", "symbol"])
            seen = rows.select("context", "symbol", (own + F.col("gamma") * F.col("p_lower")).alias("p"))
        out.append((cut_lineage(seen), gamma))
    return out


def tables(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """``kneser_ney`` over (gram, n) of ``codes``: per order (gram, p) and (context, gamma)."""
    split = counts.select(F.expr(f"gram div {SYMBOLS}").alias("context"), (F.col("gram") % SYMBOLS).alias("symbol"), "n")
    gram = (F.col("context") * SYMBOLS + F.col("symbol")).alias("gram")
    return [(seen.select(gram, "p"), gamma) for seen, gamma in kneser_ney(split, SYMBOLS, SYMBOLS)]


def log_table(found: list[tuple[DataFrame, DataFrame]]) -> np.ndarray:
    """Logarithm of the probability of every n-gram of ``codes``, seen or backed off; a small table, not used for scoring."""
    p = np.full(1, 1.0 / SYMBOLS)
    for k, (seen, gamma) in enumerate(found, 1):
        back = np.ones(SYMBOLS ** (k - 1))
        g = gamma.select("context", "gamma").toArrow()
        back[g["context"].to_numpy()] = g["gamma"].to_numpy()
        # p(suffix) of every n-gram of this order, weighted by its context
        dense = (back[:, None] * (np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS, 1)) if k > 1 else p[:1])).ravel()
        dense = np.broadcast_to(dense, SYMBOLS).copy() if k == 1 else dense
        s = seen.select("gram", "p").toArrow()
        dense[s["gram"].to_numpy()] = s["p"].to_numpy()
        p = dense
    return np.log(p).astype(np.float32)


def perplexities(stored: DataFrame, logs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity, lower_bound) of every stored document; ``logs`` has (piece, context, symbol, log)."""

    def score(docs: pa.Table, known: pa.Table) -> pa.Table:
        context, symbol = known["context"].to_numpy(), known["symbol"].to_numpy()
        order = np.lexsort((symbol, context))
        contexts, place = np.unique(context[order], return_inverse=True)
        keys, log = place * BASE + symbol[order], known["log"].to_numpy()[order]
        n, spent, squares = np.zeros(len(docs), np.int64), np.zeros(len(docs)), np.zeros(len(docs))
        for owners, parts in runs(docs["text"]):
            context, symbol, place = grams(parts)
            x = log[np.searchsorted(keys, np.searchsorted(contexts, context) * BASE + symbol)][place]
            of = np.repeat(owners, [len(x) - ORDER + 1 for x in parts])
            n += np.bincount(of, minlength=len(docs))
            spent -= np.bincount(of, x, len(docs))
            squares += np.bincount(of, x * x, len(docs))
        mean = spent / np.maximum(n, 1)
        error = np.sqrt(np.maximum(0.0, squares / np.maximum(n, 1) - mean * mean) / np.maximum(n, 1))
        return pa.table({
            "doc_id": docs["doc_id"], "lang": docs["lang"], "n_symbols": n, "perplexity": pa.array(np.exp(mean), mask=n == 0),
            "lower_bound": pa.array(np.exp(mean - DEVIATIONS * error), mask=n == 0),
        })

    schema = T.StructType([stored.schema["doc_id"], stored.schema["lang"], T.StructField("n_symbols", T.LongType()), T.StructField("perplexity", T.DoubleType()), T.StructField("lower_bound", T.DoubleType())])
    return stored.drop("row").groupBy("piece").cogroup(logs.groupBy("piece")).applyInArrow(score, schema)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Perplexities of ``docs`` (doc_id, lang, text); none without trusted text."""
    spark = docs.sparkSession
    name, folder = f"quality_pieces_{uuid.uuid4().hex}", scratch(spark, "quality")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # bucketed, so that n-grams come to the texts and not the texts to the n-grams
    options = {"path": f"{folder}/pieces", "compression": "zstd"}
    in_pieces(docs).write.bucketBy(buckets, "piece").sortBy("piece").options(**options).format("parquet").saveAsTable(name)
    try:
        stored = spark.table(name)
        count_ngrams(stored, labels).write.parquet(f"{folder}/grams")
        met = spark.read.parquet(f"{folder}/grams")
        counts = cut_lineage(met.groupBy("context", "symbol").agg(F.sum("n").alias("n")))
        if counts.filter("n > 0").isEmpty():
            return None
        logs = kneser_ney(counts)[-1][0].select("context", "symbol", F.log("p").alias("log"))
        return cut_lineage(perplexities(stored, met.drop("n").join(logs, ["context", "symbol"])))
    finally:
        spark.sql(f"DROP TABLE {name}")


def quality_report(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = QUANTILE,
    margin: float = MARGIN,
) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, lower_bound, threshold, kept of every document."""
    three = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
    scored = scored_documents(three, labels)
    if scored is None:
        plain = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.length(text_col).cast("long").alias("n_symbols"))
        none = F.lit(None).cast("double")
        return plain.select(
            "doc_id", "lang", F.coalesce("n_symbols", F.lit(0).cast("long")).alias("n_symbols"), none.alias("perplexity"),
            none.alias("lower_bound"), none.alias("threshold"), (F.coalesce("n_symbols", F.lit(0)) > 0).alias("kept"),
        )
    trusted = labels.filter(F.col("quality") == 1).select("doc_id").distinct()
    known = scored.filter(F.col("perplexity").isNotNull()).join(trusted.hint("merge"), "doc_id", "left_semi")
    high = F.percentile_approx("lower_bound", F.lit(quantile), F.lit(10_000)) * margin
    overall = known.agg(high.alias("t")).first()["t"]
    by_lang = known.groupBy(F.col("lang").alias("__lang")).agg(high.alias("own"))
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    # one row per language
    return (
        scored.join(F.broadcast(by_lang), scored["lang"].eqNullSafe(by_lang["__lang"]), "left")
        .select("doc_id", "lang", "n_symbols", "perplexity", "lower_bound", threshold.alias("threshold"))
        .withColumn("kept", F.coalesce(F.col("lower_bound") <= F.col("threshold"), F.lit(False)))
    )
