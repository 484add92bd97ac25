"""Similarity join of titles inside blocks, without comparing every two chunks of a block.

The ratio of two titles is at most 1 - D / (la + lb), where D is the L1 distance of their character counts. Counts over a
small alphabet (characters share cells) can only make D smaller, so they bound the ratio as well.

* A block is split into chunks of similar titles: as long as a part holds more than ``chunk_titles``, each of its titles goes
  to the nearest of up to 64 titles of the part (L1, ties dealt out by position). Parts are split in salted groups, so a
  block with a third of all titles is many tasks.
* A chunk has a box (least and largest count per character), a centre with a radius, and a range of lengths. Each gives a
  lower bound on D between two chunks. What the ratio counts is also a common subsequence: wherever it crosses the middle of
  one title, it crosses the other at some place, so it is at most what the two first parts share plus what the two last
  parts share, for the best such place. Chunks keep the largest counts of halves, and of first and last parts at 16 places,
  with the most digits and the most other characters that a single title has there.
  Two chunks meet in a tile only if no bound puts the ratio below the threshold.
* For components, chunks are first compared with themselves, then a few titles of sibling parts with each other, which
  joins nearly all of what belongs together at linear cost. Titles of a large component are then chunked again on their own
  and the few others together: chunks of one component never meet, so what is left grows with the others, not with the
  square of the block. A tile starts from the known components and only reports joins between them.

All pairs above the threshold are found; the bounds only leave out tiles that cannot hold one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.similarity import tile_edges
from shelfwise.scale import cut_lineage, skew_join, spread

CHUNK_TITLES = 1000
PIVOTS = 64
REPRESENTATIVES = 8
ASSIGN_ROWS = 20_000
CELL_CHUNKS = 500
ALPHABET = 128
PLACES = 16
_SMALLER = 1e-9
_DIGITS = slice(16, 26)
_WIDE = ALPHABET + 2  # largest counts, most digits, most others
_ARRAYS = {"low": (ALPHABET,), "centre": (ALPHABET,), "high": (_WIDE,), "halves": (2, _WIDE), "starts": (PLACES, _WIDE), "ends": (PLACES, _WIDE)}


def profiles(texts: Sequence[str]) -> np.ndarray:
    """Character counts, one row per text: a cell per printable ASCII character, 33 for all others."""
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    cell = np.where((codes >= 32) & (codes < 127), codes - 32, 95 + codes % 33)
    at = np.repeat(np.arange(len(texts)), lens) * ALPHABET + cell
    return np.bincount(at, minlength=len(texts) * ALPHABET).reshape(len(texts), ALPHABET).astype(np.int32)


def _assign(titles: pd.DataFrame, pivots: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """Each title with its part extended by its nearest pivot."""
    own = profiles(titles["norm"].tolist())
    others = profiles(pivots.sort_values("rank")["norm"].tolist())
    distance = np.stack([np.abs(own - p).sum(axis=1) for p in others], axis=1)
    near = distance == distance.min(axis=1, keepdims=True)
    turn = (titles["first_pos"].to_numpy() * 2654435761 >> 16) % near.sum(axis=1)
    pick = (near & (near.cumsum(axis=1) == (turn + 1)[:, None])).argmax(axis=1)
    out = titles[columns].copy()
    out["node"] = titles["node"] + pd.Series([f"{p:02x}" for p in pick], index=titles.index, dtype="object")
    return out


def profile_chunks(titles: DataFrame, keys: Sequence[str], chunk_titles: int = CHUNK_TITLES) -> DataFrame:
    """``titles`` with ``node``: the path of its chunk below its ``keys``; a chunk holds at most ``chunk_titles``.

    ``titles`` has norm, distinct per key, and a unique first_pos; its plan should be cut.
    """
    part = [*keys, "node"]
    columns = titles.columns
    rows, done = titles.withColumn("node", F.lit("")), []
    schema = T.StructType([*titles.schema.fields, T.StructField("node", T.StringType())])
    while True:
        big = cut_lineage(rows.groupBy(*part).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > chunk_titles))
        if big.isEmpty():
            break
        sized = cut_lineage(skew_join(rows, big, part, big, "__n", "left"))
        done.append(sized.filter("__n IS NULL").drop("__n"))
        wide = sized.filter("__n IS NOT NULL")
        n_salts = F.ceil(F.col("__n") / ASSIGN_ROWS).cast("int")
        by_hash = Window.partitionBy(*part).orderBy(F.xxhash64("norm", "node"), "first_pos")
        n_pivots = F.least(F.lit(PIVOTS), F.greatest(F.lit(2), F.ceil(2 * F.col("__n") / chunk_titles)))
        pivots = (
            wide.withColumn("rank", F.row_number().over(by_hash))
            .filter(F.col("rank") <= PIVOTS)
            .filter(F.col("rank") <= n_pivots)
            .select(*part, "norm", "rank", F.explode(F.sequence(F.lit(0), n_salts - 1)).alias("__salt"))
        )
        salted = spread(wide.withColumn("__salt", F.pmod(F.xxhash64("norm"), n_salts).cast("int")), *part, "__salt")
        rows = cut_lineage(
            salted.groupBy(*part, "__salt")
            .cogroup(pivots.groupBy(*part, "__salt"))
            .applyInPandas(lambda own, piv: _assign(own, piv, columns), schema)
        )
    for more in done:
        rows = rows.unionByName(more)
    return rows


def shape_of(texts: list[str]) -> dict[str, np.ndarray]:
    """What the bounds need of a chunk."""
    p = profiles(texts)
    centre = np.median(p, axis=0).astype(np.int32)
    lens = p.sum(axis=1)

    def most(parts: list[str]) -> np.ndarray:
        p = profiles(parts)
        digits = p[:, _DIGITS].sum(axis=1)
        return np.concatenate([p.max(axis=0), [digits.max(), (p.sum(axis=1) - digits).max()]]).astype(np.int32)

    return {
        "low": p.min(axis=0), "high": most(texts), "centre": centre,
        "halves": np.stack([most([t[: len(t) // 2] for t in texts]), most([t[len(t) // 2 :] for t in texts])]),
        "starts": np.stack([most([t[: -(-g * len(t) // PLACES)] for t in texts]) for g in range(1, PLACES + 1)]),
        "ends": np.stack([most([t[g * len(t) // PLACES :] for t in texts]) for g in range(PLACES)]),
        "radius": np.abs(p - centre).sum(axis=1).max(), "short": lens.min(), "long": lens.max(),
    }


def chunk_bounds(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Box, centre, radius, lengths, halves, starts and ends of every chunk (``keys`` and node)."""
    part = [*keys, "node"]

    def bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[part].head(1).copy()
        for name, value in shape_of(pdf["norm"].tolist()).items():
            out[name] = [value.tobytes()] if name in _ARRAYS else int(value)
        return out

    schema = T.StructType([chunks.schema[c] for c in part])
    for name in _ARRAYS:
        schema = schema.add(name, T.BinaryType())
    for name in ("radius", "short", "long"):
        schema = schema.add(name, T.LongType())
    return spread(chunks, *part).groupBy(*part).applyInPandas(bounds, schema)


def _shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Most characters that a title below the counts ``x`` shares with one below ``y``."""
    both = np.minimum(x, y)
    digits = both[..., _DIGITS].sum(axis=-1)
    others = both[..., :ALPHABET].sum(axis=-1) - digits
    return np.minimum(digits, both[..., ALPHABET]) + np.minimum(others, both[..., ALPHABET + 1])


def _crossing(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> np.ndarray:
    """Most characters in common order when the halves of ``a`` meet first and last parts of ``b``."""
    return (_shared(a["halves"][..., :1, :], b["starts"]) + _shared(a["halves"][..., 1:, :], b["ends"])).max(axis=-1)


def best_ratio(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> np.ndarray:
    """Upper bound of the ratio between one chunk ``a`` and each chunk of ``b``."""
    high_a, high_b = a["high"][..., :ALPHABET], b["high"][..., :ALPHABET]
    box = np.maximum(b["low"] - high_a, 0).sum(axis=1) + np.maximum(a["low"] - high_b, 0).sum(axis=1)
    ball = np.abs(a["centre"] - b["centre"]).sum(axis=1) - a["radius"] - b["radius"]
    length = np.maximum(b["short"] - a["long"], a["short"] - b["long"])
    apart = np.maximum(np.maximum(box, ball), np.maximum(length, 0))
    by_counts = 1.0 - apart / np.maximum(a["long"] + b["long"], 1)
    least = a["short"] + b["short"]
    shared = np.minimum(np.minimum(_crossing(a, b), _crossing(b, a)), _shared(a["high"], b["high"]))
    by_order = np.where(least > 0, 2.0 * shared / np.maximum(least, 1), 1.0)
    return np.minimum(by_counts, by_order)


def chunk_pairs(chunks: DataFrame, block: Sequence[str], min_sim: float, cell_chunks: int = CELL_CHUNKS) -> DataFrame:
    """``(block, lo, hi)``: chunks of a block that may hold a pair at the threshold, also a chunk with itself.

    ``chunks`` has part, a name unique in the block, and ``one``, true where all its titles are known to be one component
    named by ``component``: such a chunk meets neither itself nor another of the component. The table of chunks is
    compared in cells of bounded size.
    """
    block = list(block)
    per_block = cut_lineage(chunks.groupBy(*block).agg(F.count(F.lit(1)).alias("__n")))
    n_cells = F.ceil(F.col("__n") / cell_chunks).cast("int")
    cells = (
        skew_join(chunks, per_block, block, per_block, "__n")
        .withColumn("__cells", n_cells)
        .withColumn("__own", F.pmod(F.xxhash64("part"), F.col("__cells")).cast("int"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__cells") - 1)))
        .withColumn("__a", F.least("__own", "__other"))
        .withColumn("__b", F.greatest("__own", "__other"))
        .withColumn("__side", F.when(F.col("__own") > F.col("__other"), 1).otherwise(0))
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        side, name = pdf["__side"].to_numpy(), pdf["part"].to_numpy()
        one, component = pdf["one"].to_numpy(dtype=bool), pdf["component"].to_numpy()
        shape = {c: np.stack([np.frombuffer(v, np.int32).reshape(_ARRAYS[c]) for v in pdf[c]]) for c in _ARRAYS}
        shape |= {c: pdf[c].to_numpy() for c in ("radius", "short", "long")}
        cross = bool(side.any())
        found: list[tuple[str, str]] = []
        right = np.flatnonzero(side == 1) if cross else np.arange(len(pdf))
        for i in np.flatnonzero(side == 0):
            j = right if cross else right[right >= i]
            j = j[~(one[j] & one[i] & (component[j] == component[i]))]
            if not len(j):
                continue
            bound = best_ratio({k: v[i] for k, v in shape.items()}, {k: v[j] for k, v in shape.items()})
            found += [(min(name[i], name[k]), max(name[i], name[k])) for k in j[bound >= min_sim - _SMALLER]]
        out = pd.DataFrame(found, columns=["lo", "hi"])
        for c in block:
            out.insert(0, c, pdf[c].iloc[0])
        return out[[*block, "lo", "hi"]]

    schema = T.StructType([chunks.schema[c] for c in block]).add("lo", T.StringType()).add("hi", T.StringType())
    cell = [*block, "__a", "__b"]
    return spread(cells, *cell).groupBy(*cell).applyInPandas(compare, schema)


def tiles(titles: DataFrame, pairs: DataFrame, block: Sequence[str]) -> DataFrame:
    """Titles (with part) laid out to the tiles ``(block, lo, hi)`` of their chunk; side tells the two chunks apart."""
    ends = pairs.select(
        *block, "lo", "hi",
        F.explode(F.when(F.col("lo") == F.col("hi"), F.array(F.struct(F.col("lo").alias("part"), F.lit(0).alias("side")))).otherwise(
            F.array(F.struct(F.col("lo").alias("part"), F.lit(0).alias("side")), F.struct(F.col("hi").alias("part"), F.lit(1).alias("side")))
        )).alias("end"),
    ).select(*block, "lo", "hi", "end.part", "end.side")
    return titles.join(ends, [*block, "part"])


def _edges(pdf: pd.DataFrame, min_sim: float, forest: bool, known: str | None) -> tuple[pd.DataFrame, list[tuple[int, int]]]:
    pdf = pdf.sort_values("first_pos", kind="stable").reset_index(drop=True)
    label = pd.factorize(pdf[known])[0] if known else None
    side = pdf["side"].to_numpy() if "side" in pdf else np.zeros(len(pdf), int)
    return pdf, tile_edges(pdf["norm"].tolist(), pdf["first_pos"].to_numpy(), pdf["last_pos"].to_numpy(), side, min_sim, forest, label)


def _joins(rows: DataFrame, by: Sequence[str], min_sim: float, known: str) -> DataFrame:
    """Edges ``(u, v)`` between known components that a title pair of a tile joins."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, found = _edges(pdf, min_sim, True, known)
        at, name = np.array(found, dtype=np.int64).reshape(-1, 2), pdf[known].to_numpy()
        u, v = name[at[:, 0]], name[at[:, 1]]
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return spread(rows, *by).groupBy(*by).applyInPandas(join, "u long, v long")


def similar_edges(titles: DataFrame, block: Sequence[str], min_sim: float, chunk_titles: int = CHUNK_TITLES) -> DataFrame:
    """All pairs ``(u, v)`` of titles of a block at the threshold, named by first position."""
    chunks = cut_lineage(profile_chunks(titles, block, chunk_titles).withColumnRenamed("node", "part"))
    shapes = chunk_bounds(chunks.withColumnRenamed("part", "node"), block).withColumnRenamed("node", "part")
    pairs = chunk_pairs(shapes.withColumn("one", F.lit(False)).withColumn("component", F.lit(0).cast("long")), block, min_sim)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, found = _edges(pdf, min_sim, False, None)
        at, first = np.array(found, dtype=np.int64).reshape(-1, 2), pdf["first_pos"].to_numpy()
        u, v = first[at[:, 0]], first[at[:, 1]]
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    tile = [*block, "lo", "hi"]
    return spread(tiles(chunks, pairs, block), *tile).groupBy(*tile).applyInPandas(compare, "u long, v long")


def chunk_components(chunks: DataFrame, block: Sequence[str], min_sim: float) -> DataFrame:
    """``chunks`` with ``label``: the smallest first position that a title is joined to inside its chunk."""

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, found = _edges(pdf, min_sim, True, None)
        first = pdf["first_pos"].to_numpy()
        root = np.arange(len(pdf))
        for i, j in found:
            a, b = root[i], root[j]
            root[root == max(a, b)] = min(a, b)  # rows are in order of first_pos
        pdf["label"] = first[root]
        return pdf

    schema = T.StructType([*chunks.schema.fields, T.StructField("label", T.LongType())])
    part = [*block, "node"]
    return spread(chunks, *part).groupBy(*part).applyInPandas(label, schema)


def sibling_tiles(labelled: DataFrame, block: Sequence[str], representatives: int = REPRESENTATIVES) -> DataFrame:
    """A few titles of every child part, laid out to their parent part: at most 64 x ``representatives`` per tile."""
    above = labelled.withColumn("level", F.explode(F.expr("sequence(0, cast(length(node) / 2 as int) - 1)"))).select(
        *block, F.expr("substring(node, 1, level * 2)").alias("parent"), F.expr("substring(node, 1, level * 2 + 2)").alias("child"),
        "norm", "first_pos", "last_pos", "label",
    )
    w = Window.partitionBy(*block, "child").orderBy(F.xxhash64("norm"), "first_pos")
    return above.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= representatives)


def cross_tiles(labelled: DataFrame, block: Sequence[str], min_sim: float, chunk_titles: int) -> DataFrame:
    """Titles in the tiles that may still join two components; ``label`` is the component of a title."""
    block = list(block)
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("__size"))
    sized = skew_join(labelled, sizes, ["label"], sizes, "__size")
    # large components are chunked on their own, all others of a block together
    kind = F.when(F.col("__size") * 4 >= chunk_titles, F.col("label")).otherwise(F.lit(-1))
    titles = cut_lineage(sized.select(*block, "norm", "first_pos", "last_pos", "label", kind.cast("long").alias("kind")))
    chunks = cut_lineage(profile_chunks(titles, [*block, "kind"], chunk_titles))
    shapes = chunk_bounds(chunks, [*block, "kind"])
    name = F.concat(F.col("kind").cast("string"), F.lit("/"), F.col("node"))
    shapes = shapes.select(*block, name.alias("part"), (F.col("kind") >= 0).alias("one"), F.col("kind").alias("component"), *_ARRAYS, "radius", "short", "long")
    return tiles(chunks.withColumn("part", name), chunk_pairs(shapes, block, min_sim), block)


def component_labels(titles: DataFrame, block: Sequence[str], min_sim: float, chunk_titles: int, components) -> DataFrame:
    """``titles`` with ``label``, the smallest first position of its component.

    ``components(nodes, edges)`` labels a graph. Blocks of one chunk are done after their only tile.
    """
    block = list(block)
    chunks = profile_chunks(titles, block, chunk_titles)
    labelled = cut_lineage(chunk_components(chunks, block, min_sim))
    split = labelled.filter("node <> ''")
    if split.isEmpty():
        return labelled.drop("node")
    whole = labelled.filter("node = ''").drop("node")

    def relabel(rows: DataFrame, edges: DataFrame) -> DataFrame:
        roots = components(rows.select(F.col("label").alias("node")).distinct(), edges).withColumnRenamed("label", "root")
        sizes = cut_lineage(rows.groupBy("label").agg(F.count(F.lit(1)).alias("__n")))
        joined = skew_join(rows, roots.withColumnRenamed("node", "label"), ["label"], sizes, "__n")
        return cut_lineage(joined.drop("label").withColumnRenamed("root", "label"))

    near = sibling_tiles(split, block)
    split = relabel(split, _joins(near, [*block, "parent"], min_sim, "label")).drop("node")
    rest = cross_tiles(split, block, min_sim, chunk_titles)
    split = relabel(split, _joins(rest, [*block, "lo", "hi"], min_sim, "label"))
    return whole.unionByName(split)
