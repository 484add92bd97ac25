"""MinHash near-dedup with tensored banding.

A table key joins two half keys, one from each of two small collections of SIDE half keys, each made of HALF
minhashes. 2 * SIDE * HALF minhashes thus serve SIDE^2 tables of 2 * HALF minhashes. At the defaults 66 minhashes
serve 121 tables; a pair at similarity s meets in one with probability (1 - (1 - s^3)^11)^2: 0.9993 at 0.8, 0.99998
at 0.85.

Plan. Equal texts (same word sequence) collapse to a class first, so groups of copies cost one row. A half key that
only one class has can make no table key that two share, so it is dropped before the keys are combined. Inside a
table bucket all classes are compared with one leader only (a star): the class that meets most others over all
tables, so that the buckets of a group of near copies agree on few leaders. Similarities are confirmed on the full
shingle sets and linked classes contracted to components. A pair of one bucket is then still open only if its classes
lie in different components. The members x, y of a leader L know which shingles of L they miss and in which of PARTS parts by hash their others
fall, and |x & y| <= |L| - |missed by x or y| + parts that hold others of both + min(others beyond the first of their
part, of x or y). Pairs whose bound allows no link are dropped where they meet, in tiles of bounded size; the few that
are left are confirmed on full sets. So no candidate link is lost, and a group of near copies, or of texts that share
a passage, is never expanded into all pairs.

A hot class reaches its documents through a broadcast of at most HOT_KEYS rows (``attach``).

Nulls: null and empty texts have no words, an empty set, and are linked with nothing. A text with fewer words than
a shingle is one shingle. Identifiers may repeat: texts are told apart by digest. A null identifier never names a
component unless nothing else does. Only the identifier and the text are read; an empty table gives no rows.

``deduplicated`` leaves one row of every component: of the class that holds its smallest identifier, and there of the
rows with the smallest one. A row is known by identifier and class, so different texts under one identifier or under
null are judged one by one; rows without words all stay.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import attach, portions, text_or_empty, words
from shelfwise.llm.hashing import digest, minhash, mix64, shingle_set, tokens
from shelfwise.scale import broadcast_if_small, cut_lineage

SHINGLE = 4
THRESHOLD = 0.8
HALF = 3
SIDE = 11
SEED = 20240
#: Members of a leader that meet in one task, from each of two chunks.
TILE = 1000
#: Parts by hash in which shingles that a leader lacks are told apart before sets are compared.
PARTS = 4096


def text_class(text_col: str) -> tuple[Column, Column]:
    """(class digest of a text, number of its words) as native columns."""
    w = words(F.translate(text_or_empty(text_col), string.ascii_uppercase, string.ascii_lowercase))
    return F.unhex(F.substring(F.sha2(F.array_join(w, " "), 256), 1, 32)), F.size(w)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, cls, n, halves): class digest, set size, half keys of both collections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.arange(2 * SIDE, dtype=np.uint64)
        for batch in portions(batches):
            cls, sizes, halves = [], [], []
            for text in batch.column("text").to_pylist():
                words = tokens(text)
                values = shingle_set(words, shingle)
                cls.append(digest(words))
                sizes.append(len(values))
                if len(values):
                    least = minhash(values, 2 * SIDE * HALF, SEED).reshape(2 * SIDE, HALF)
                    h = slots
                    for j in range(HALF):
                        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + least[:, j])
                    halves.append(h.view(np.int64))
                else:
                    halves.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cls, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(halves, pa.list_(pa.int64()))],
                names=["doc_id", "cls", "n", "halves"],
            )

    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(run, "doc_id long, cls binary, n long, halves array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(cls, set) of the wanted classes; ``wanted`` names each by (cls, doc_id of one member)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            words = [tokens(t) for t in batch.column("text").to_pylist()]
            sets = [shingle_set(w, shingle).view(np.int64) for w in words]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(digest, words), pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                names=["cls", "set"],
            )

    ids = broadcast_if_small(wanted.select(F.col("doc_id").alias("__id")).distinct())
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = two.join(ids, two["doc_id"].eqNullSafe(ids["__id"]), "left_semi").select("text")
    sets = some.mapInArrow(run, "cls binary, set array<long>")
    return sets.join(wanted.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("set").alias("set"))


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, set_u, set_v, both) of the pairs, on full sets."""
    left = sets.select(F.col("cls").alias("u"), F.col("set").alias("set_u"))
    right = sets.select(F.col("cls").alias("v"), F.col("set").alias("set_v"))
    joined = pairs.join(left, "u").join(right, "v")
    return joined.withColumn("both", F.size(F.array_intersect("set_u", "set_v")))


def linked(threshold: float) -> Column:
    either = F.size("set_u") + F.size("set_v") - F.col("both")
    return F.col("both") * 100 >= either * round(threshold * 100)


def open_pairs(members: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """(u, v) of members (leader, n_leader, cls, label, n, miss, parts) of one leader that the bound leaves open.

    Members are dealt to chunks of about ``tile`` by hash; every two chunks of a leader meet in one tile.
    """
    sizes = members.groupBy("leader").agg(
        F.count(F.lit(1)).alias("rows"), F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    sizes = sizes.filter("lo != hi").select("leader", F.ceil(F.col("rows") / tile).cast("int").alias("chunks"))
    dealt = members.join(sizes, "leader").withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiled = dealt.withColumn("other", other).select(
        "leader", "n_leader", "cls", "label", "n", "miss", "parts", "chunk",
        F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
    )

    def run(key, table):
        lo, hi = key[1].as_py(), key[2].as_py()
        n = table.column("n").to_numpy()
        n_leader = int(table.column("n_leader")[0].as_py())
        cls = np.array(table.column("cls").to_pylist(), dtype=object)
        label = np.unique(np.array(table.column("label").to_pylist(), dtype=object), return_inverse=True)[1]
        chunk = table.column("chunk").to_numpy()
        miss = [np.asarray(m, np.int64) for m in table.column("miss").to_pylist()]
        parts = [np.asarray(m, np.int64) for m in table.column("parts").to_pylist()]
        lens, n_parts = np.array([len(m) for m in miss]), np.array([len(m) for m in parts])
        place = np.unique(np.concatenate(miss), return_inverse=True)[1]
        grid = np.zeros((len(n), int(place.max()) + 1 if len(place) else 1), np.float32)
        grid[np.repeat(np.arange(len(n)), lens), place] = 1
        other = np.zeros((len(n), PARTS), np.float32)
        other[np.repeat(np.arange(len(n)), n_parts), np.concatenate(parts)] = 1
        beyond = n - (n_leader - lens) - n_parts
        rows, cols = (np.arange(len(n)),) * 2 if lo == hi else (np.flatnonzero(chunk == lo), np.flatnonzero(chunk == hi))
        inside = n_leader - (lens[rows][:, None] + lens[cols] - grid[rows] @ grid[cols].T)
        bound = inside + other[rows] @ other[cols].T + np.minimum(beyond[rows][:, None], beyond[cols])
        total = n[rows][:, None] + n[cols]
        maybe = (bound * 100 >= (total - bound) * round(threshold * 100)) & (label[rows][:, None] != label[cols])
        if lo == hi:
            maybe &= rows[:, None] < cols
        i, j = np.nonzero(maybe)
        pairs = [(min(a, b), max(a, b)) for a, b in zip(cls[rows[i]], cls[cols[j]])]
        return pa.table({"u": pa.array([a for a, _ in pairs], pa.binary()), "v": pa.array([b for _, b in pairs], pa.binary())})

    return tiled.groupBy("leader", "lo", "hi").applyInArrow(run, "u binary, v binary").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): smallest node of each component; neighbour minimum and pointer jumping until nothing moves."""
    back = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = cut_lineage(edges.select(F.inline(F.array(F.struct("u", "v"), back))))
    labels = cut_lineage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")))
    while True:
        near = both.join(labels, both["u"] == labels["node"]).groupBy("v").agg(F.min("label").alias("near"))
        pulled = labels.join(near, labels["node"] == near["v"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        roots = pulled.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = cut_lineage(pulled.join(roots, "label").select("node", "old", F.least("label", "root").alias("label")))
        labels = moved.select("node", "label")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, cls): keys of tables that can be shared, from half keys that more than one class has."""
    halves = classes.select("cls", F.posexplode("halves").alias("slot", "half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("half")
    kept = halves.join(shared, "half", "left_semi")
    sides = kept.groupBy("cls").agg(
        F.collect_list(F.when(F.col("slot") < SIDE, F.col("half"))).alias("a"),
        F.collect_list(F.when(F.col("slot") >= SIDE, F.col("half"))).alias("b"),
    )
    combined = sides.select("cls", F.explode("a").alias("a"), "b").select("cls", "a", F.explode("b").alias("b"))
    return combined.select(F.xxhash64("a", "b").alias("key"), "cls")


def links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float) -> DataFrame:
    """(u, v): confirmed links that connect every component of the candidate graph."""
    keys = cut_lineage(table_keys(classes))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    keys = cut_lineage(keys.join(buckets, "key"))
    met = keys.groupBy("cls").agg(F.sum("size").alias("met"))
    ranked = keys.select("key", "cls").join(met, "cls")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("met", "cls")).alias("leader"))
    stars = cut_lineage(
        keys.join(leaders.select("key", F.col("leader.cls").alias("u")), "key")
        .filter(F.col("cls") != F.col("u"))
        .select("u", F.col("cls").alias("v"))
        .distinct()
    )
    ids = cut_lineage(classes.select("cls", "doc_id").join(met.select("cls"), "cls", "left_semi"))
    sets = cut_lineage(shingle_sets(docs, ids, id_col, text_col, shingle))
    first = cut_lineage(
        compare(stars, sets).select(
            "u", "v", linked(threshold).alias("linked"), F.size("set_u").alias("n_leader"), F.size("set_v").alias("n"),
            F.array_except("set_u", "set_v").alias("miss"),
            F.array_distinct(F.transform(F.array_except("set_v", "set_u"), lambda x: F.pmod(x, F.lit(PARTS)).cast("int"))).alias("parts"),
        )
    )
    found = first.filter("linked").select("u", "v")
    labels = components(found).withColumnRenamed("node", "cls")
    members = first.select(F.col("u").alias("leader"), "n_leader", F.col("v").alias("cls"), "n", "miss", "parts")
    members = members.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    more = compare(cut_lineage(open_pairs(members, threshold)), sets).filter(linked(threshold)).select("u", "v")
    return cut_lineage(found.unionByName(more))


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float) -> DataFrame:
    """(doc_id, n, cls, component_id, chosen) of every row; the chosen rows of a component share identifier and class."""
    rows = cut_lineage(signatures(docs, id_col, text_col, shingle))
    full = rows.filter("n > 0")
    classes = cut_lineage(
        full.groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"),
            F.first("halves").alias("halves"),
        )
    )
    labels = components(links(docs, classes, id_col, text_col, shingle, threshold))
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls")
    )
    # nulls last; identifiers are no names of components, as two of them may hold one
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cls"))
    smallest = named.groupBy("label").agg(first.alias("first"))
    groups = cut_lineage(
        named.select("cls", "label", "copies")
        .join(smallest, "label")
        .select("cls", "copies", F.col("first.doc_id").alias("component_id"), (F.col("cls") == F.col("first.cls")).alias("chosen"))
    )
    placed = attach(full.select("doc_id", "n", "cls"), groups, ["cls"], "copies").select(
        "doc_id", "n", "cls", "component_id", (F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("chosen")
    )
    alone = rows.filter("n = 0").select("doc_id", "n", "cls", F.col("doc_id").alias("component_id"), F.lit(True).alias("chosen"))
    return placed.unionByName(alone)


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and the class of equal texts."""
    return grouped(docs, id_col, text_col, shingle, threshold).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
        F.hex("cls").alias("text_class"),
    )


def deduplicated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One document of every group, with all columns."""
    report = cut_lineage(
        grouped(docs, id_col, text_col, shingle, threshold).select(F.col("doc_id").alias("__id"), F.col("cls").alias("__cls"), "n", "chosen")
    )
    named = report.filter("__id is not null")
    ids = cut_lineage(named.groupBy("__id").agg(F.max("chosen").alias("chosen"), F.count(F.lit(1)).alias("rows")))
    # an identifier of one row decides alone, without a digest
    drop = broadcast_if_small(ids.filter("not chosen or rows > 1").select("__id"))
    once = docs.filter(F.col(id_col).isNotNull()).join(drop, docs[id_col] == drop["__id"], "left_anti")
    repeated = broadcast_if_small(ids.filter("chosen and rows > 1").select("__id"))
    shared = docs.join(repeated, docs[id_col] == repeated["__id"], "left_semi")
    cls, n_words = text_class(text_col)
    shared = shared.unionByName(docs.filter(F.col(id_col).isNull())).withColumn("__own", cls).withColumn("__words", n_words)
    unclear = report.join(repeated, "__id", "left_semi").unionByName(report.filter("__id is null"))
    keys = broadcast_if_small(cut_lineage(unclear.filter("chosen and n > 0").select("__id", "__cls").distinct()))
    kept = shared.filter("__words > 0").join(
        keys, (shared["__own"] == keys["__cls"]) & shared[id_col].eqNullSafe(keys["__id"]), "left_semi"
    )
    # equal words under one identifier: the smallest text, of equal texts the smallest row
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col(text_col).cast("string"), F.to_json(whole))
    single = kept.groupBy(F.col(id_col).alias("__id"), "__own").agg(F.min_by(whole, order).alias("__row")).select("__row.*")
    empty = shared.filter("__words = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
    return once.unionByName(single).unionByName(empty)
