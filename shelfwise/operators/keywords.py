"""Word statistics: document frequencies, unmatched words, frequent word pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.scale import ROWS_PER_BUCKET, broadcast_if_small, cut_and_count, cut_lineage, number_rows

MIN_ITEMS_PER_WORD = 3
MIN_WORD_LEN = 4
UNMATCHED_MIN_LEN = 5
UNMATCHED_MIN_ITEMS = 4
MIN_ITEMS_PER_PAIR = 10
PAIRS_PER_GROUP = 128_000_000
PAIRS_PER_CHUNK = 2_000_000
CELLS_PER_TABLE = 4_000_000
IDS_PER_GROUP = 8_000_000
MAX_TASKS = 2000
#: Orders of projective planes: lines of q + 1 points, every two of the q * q + q + 1 points on one of as many lines.
PLANES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31)


def keyword_counts(items: DataFrame, min_items: int = MIN_ITEMS_PER_WORD, min_len: int = MIN_WORD_LEN) -> DataFrame:
    """``(side, word, item_count)``: items per word and field, one count per item."""
    sides = F.array(
        F.struct(F.lit("title").alias("side"), tx.keyword_set(F.col("title"), min_len).alias("words")),
        F.struct(F.lit("subtitle").alias("side"), tx.keyword_set(F.col("subtitle"), min_len).alias("words")),
    )
    return (
        items.select(F.inline(sides))
        .select("side", F.explode_outer("words").alias("word"))
        .filter("word IS NOT NULL")
        .groupBy("side", "word")
        .agg(F.count(F.lit(1)).alias("item_count"))
        .filter(F.col("item_count") >= min_items)
    )


def ranked_keywords(counts: DataFrame, **kw) -> DataFrame:
    """Rank inside a side: count descending, word ascending."""
    keyed = counts.withColumn("neg", -F.col("item_count"))
    return number_rows(keyed, ["neg", "word"], "rank", within=["side"], **kw).drop("neg")


def unmatched_words(
    items: DataFrame, min_len: int = UNMATCHED_MIN_LEN, min_items: int = UNMATCHED_MIN_ITEMS
) -> DataFrame:
    """Token and item counts per word over title plus subtitle, in one shuffle."""
    every = tx.lower_tokens(F.concat_ws(" ", "title", "subtitle"))
    once = F.transform(F.array_distinct(F.col("toks")), lambda w: F.struct(w.alias("word"), F.lit(0).alias("t"), F.lit(1).alias("i")))
    each = F.transform(F.col("toks"), lambda w: F.struct(w.alias("word"), F.lit(1).alias("t"), F.lit(0).alias("i")))
    return (
        items.select(F.filter(every, lambda w: F.length(w) >= min_len).alias("toks"))
        .select(F.inline(F.concat(each, once)))
        .groupBy("word")
        .agg(F.sum("i").alias("unmatched_item_count"), F.sum("t").alias("token_count"))
        .filter(F.col("unmatched_item_count") >= min_items)
    )


def vocabulary(words: DataFrame, seq: str) -> DataFrame:
    """Distinct lower-cased words; the first spelling and its list position are kept."""
    return (
        words.filter(F.col("word").isNotNull() & (F.col("word") != ""))
        .groupBy(F.lower("word").alias("word_low"))
        .agg(F.min_by("word", seq).alias("display"), F.min(seq).alias("seq"))
    )


def _field_lists(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(row, ids, also)`` per field with two words: its sorted word numbers, and which of a title's are in the subtitle too."""
    title, subtitle = (batch.column(c) for c in ("title_ids", "subtitle_ids"))
    (t, t_at), (s, s_at) = ((c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for c in (title, subtitle))
    for r in range(batch.num_rows):
        mine, other = t[t_at[r] : t_at[r + 1]], s[s_at[r] : s_at[r + 1]]
        if len(mine) > 1:
            yield r, mine, np.isin(mine, other, assume_unique=True)
        if len(other) > 1:
            yield r, other, np.zeros(len(other), bool)


def _plane(q: int) -> tuple[int, ...]:
    """For a prime ``q``, places of zeros in a recurrence over it: any two of q * q + q + 1 classes meet in one group only."""
    n = q * q + q + 1
    for a, b, c in product(range(q), range(q), range(1, q)):
        x, found = (0, 0, 1), []
        for k in range(n):
            if x[0] == 0:
                found.append(k)
            x = (x[1], x[2], (a * x[2] + b * x[1] + c * x[0]) % q)
        if len(found) == q + 1 and len({(i - j) % n for i in found for j in found}) == n:
            return tuple(found)
    raise ValueError(f"{q} is no prime")


def _cover(blocks: int) -> tuple[int, ...]:
    """Offsets by which any two of ``blocks`` classes of words meet in a group: group g holds the classes g + offset, in a circle."""
    for q in PLANES:
        if q * q + q + 1 == blocks:
            return _plane(q)
    step = max(1, round((blocks / 2) ** 0.5))
    return tuple(sorted({o % blocks for o in (*range(step), *range(2 * step - 1, blocks // 2 + step, step))}))


def _owned(blocks: int, cover: tuple[int, ...]) -> list[tuple[int, int]]:
    """Per distance of two classes, the places in the cover under which their group counts them."""
    place: dict[int, tuple[int, int]] = {0: (0, 0)}
    for p, a in enumerate(cover):
        for q, b in enumerate(cover):
            place.setdefault((b - a) % blocks, (p, q))
    return [place[d] for d in range(blocks // 2 + 1)]


def _deal_lists(blocks: int, shared, kind: pa.DataType):
    """Arrow function that sends a field to every group of classes, with its words of these classes.

    ``shared`` holds the cover (empty: the one of ``blocks``). The class of a word is its number modulo ``blocks``. A word is
    sent as its place in the cover and its number in the class, doubled: the last bit marks a title's word that is in the
    subtitle too. The words of a row are in the order of places, then numbers.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = np.asarray(shared.value[0] if len(shared.value[0]) else _cover(blocks), np.int64)
        m = len(cover)

        def packed(fields: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            ids = np.concatenate([i for i, _ in fields])
            also = np.concatenate([a for _, a in fields])
            field = np.repeat(np.arange(len(fields)), [len(i) for i, _ in fields])
            group = (ids[:, None] % blocks - cover) % blocks
            local = ids // blocks
            high = int(local.max()) + 1
            key = ((field[:, None] * blocks + group) * m + np.arange(m)) * high + local[:, None]
            key = np.sort((key * 2 + also[:, None]).ravel())
            word, place = (key >> 1) % high, (key >> 1) // high
            row, place = place // m, place % m
            first = np.flatnonzero(np.diff(row, prepend=-1))
            # a lone word makes no pair
            alone = np.diff(np.append(first, len(row))) == 1
            if alone.any():
                keep = np.ones(len(row), bool)
                keep[first[alone]] = False
                word, place, row, key = word[keep], place[keep], row[keep], key[keep]
                first = np.flatnonzero(np.diff(row, prepend=-1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array((word * m + place) * 2 + (key & 1), kind))
            return pa.RecordBatch.from_arrays([pa.array(row[first] % blocks, pa.int64()), lists], names=["block", "ids"])

        for batch in batches:
            fields, held = [], 0
            for _, ids, also in _field_lists(batch):
                if also.all():  # every pair of such a title is counted in the subtitle
                    continue
                fields.append((ids, also))
                held += len(ids) * m
                if held > 1_000_000:
                    yield packed(fields)
                    fields, held = [], 0
            if fields:
                yield packed(fields)

    return deal


def _classes(batches: Iterator[pa.RecordBatch], m: int) -> tuple[int, int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The group, its rows, and per place of the cover the rows, numbers and marks of its words, by row and number."""
    group, rows, parts = 0, 0, [[] for _ in range(m)]
    for batch in batches:
        if not batch.num_rows:
            continue
        group, lists = batch.column("block")[0].as_py(), batch.column("ids")
        ids = lists.flatten().to_numpy()
        row = np.repeat(np.arange(rows, rows + batch.num_rows, dtype=np.int32), lists.value_lengths().to_numpy())
        rows += batch.num_rows
        place = (ids >> 1) % m
        for k in range(m):
            own = place == k
            parts[k].append((row[own], ((ids[own] >> 1) // m).astype(np.int32), (ids[own] & 1).astype(bool)))
    none = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool))
    for k in range(m):  # one place after the other, so that little is held twice
        parts[k] = tuple(np.concatenate([x[i] for x in parts[k]]) for i in range(3)) if parts[k] else none
    return group, rows, parts


def _pairs_of_classes(first: tuple, second: tuple | None, rows: int, width: int, cells: int, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(u, v, n)``: rows with number u of the first and v of the second class (None: u below v of the first), some numbers u at a time."""
    (row, local, marked), (row2, local2, marked2) = first, second or first
    held = np.bincount(row2, minlength=rows)
    ends = held.cumsum()
    order = np.argsort(local, kind="stable")
    begin = order + 1 if second is None else (ends - held)[row[order]]
    n = ends[row[order]] - begin
    order, begin, n = order[n > 0], begin[n > 0], n[n > 0]
    u, before = local[order], np.concatenate([[0], n.cumsum()])
    marks = marked.any() and marked2.any()
    step, i = max(1, cells // width), 0
    while i < len(order):
        low = int(u[i])
        stop = int(np.searchsorted(u, low + step))
        # as many numbers as make a chunk of pairs, one at least
        stop = max(int(np.searchsorted(u, u[min(int(np.searchsorted(before, before[i] + chunk)), stop) - 1])), int(np.searchsorted(u, low, side="right")))
        span = (int(u[stop - 1]) - low + 1) * width
        few = before[stop] - before[i] < span // 8
        total, codes = None if few else np.zeros(span, np.int64), []
        while i < stop:
            j = min(max(i + 1, int(np.searchsorted(before, before[i] + chunk, side="right")) - 1), stop)
            size = n[i:j]
            take = np.repeat(begin[i:j] - (before[i:j] - before[i]), size) + np.arange(before[j] - before[i])
            code = np.repeat((u[i:j].astype(np.int64) - low) * width, size) + local2[take]
            if marks:
                # a title pair with both words in the subtitle is counted there
                code = code[~(np.repeat(marked[order[i:j]], size) & marked2[take])]
            if few:
                codes.append(code)
            else:
                total += np.bincount(code, minlength=span)
            i = j
        if few:
            seen, count = np.unique(np.concatenate(codes), return_counts=True)
        else:
            seen = np.flatnonzero(total)
            count = total[seen]
        yield seen // width + low, seen % width, count


def _count_pairs(min_items: int, blocks: int, width: int, shared, cells: int = CELLS_PER_TABLE, chunk: int = PAIRS_PER_CHUNK):
    """Arrow function of one group: pairs of two classes are counted at a time, in a table of some words by all of a class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover, owned = shared.value
        group, rows, parts = _classes(batches, len(cover))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for d, (p, q) in enumerate(owned):
            x, y = (group + cover[p]) % blocks, (group + cover[q]) % blocks
            if 2 * d == blocks and x > y:  # the group of the other way round has these
                continue
            for u, v, n in _pairs_of_classes(parts[p], parts[q] if d else None, rows, width, cells, chunk):
                some = n >= min_items
                a, b = u[some] * blocks + x, v[some] * blocks + y
                found.append((np.minimum(a, b).astype(np.int32), np.maximum(a, b).astype(np.int32), n[some].astype(np.int32)))
                if sum(len(f[0]) for f in found) >= chunk:
                    yield _by_first(found)
                    found = []
        if any(len(f[0]) for f in found):
            yield _by_first(found)

    return count


def _by_first(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Counted pairs as a row per first word."""
    a, b, n = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    cuts = pa.array(np.append(first, len(a)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(a[first], pa.int64()), pa.ListArray.from_arrays(cuts, b), pa.ListArray.from_arrays(cuts, n)], names=["a", "b", "n"])


def item_word_numbers(items: DataFrame, numbered: DataFrame, key: str = "id") -> DataFrame:
    """``id, title_ids, subtitle_ids``: sorted distinct word numbers of each field, over all rows of an identifier (or ``key``)."""
    sides = F.array(
        F.struct(F.lit(0).alias("f"), tx.token_set(F.col("title")).alias("words")),
        F.struct(F.lit(1).alias("f"), tx.token_set(F.col("subtitle")).alias("words")),
    )
    flat = items.filter("id IS NOT NULL AND id <> ''").select(key, F.inline(sides)).select(key, "f", F.explode("words").alias("word_low"))
    known = flat.join(broadcast_if_small(numbered), "word_low")
    return (
        known.groupBy(key)
        .agg(
            F.sort_array(F.collect_set(F.when(F.col("f") == 0, F.col("word_no")))).alias("title_ids"),
            F.sort_array(F.collect_set(F.when(F.col("f") == 1, F.col("word_no")))).alias("subtitle_ids"),
        )
    )


def _made(lists: DataFrame) -> tuple[int, int]:
    """Words of all fields, and the pairs they make."""
    size = lambda c: F.size(c).cast("long")
    fields = ("title_ids", "subtitle_ids")
    ids, twice = sum(size(c) for c in fields), sum(size(c) * (size(c) - 1) for c in fields)
    return tuple(lists.agg(F.coalesce(F.sum(ids), F.lit(0)), F.coalesce(F.sum(twice) / 2, F.lit(0)).cast("long")).first())


def pair_lists(lists: DataFrame, n_words: int, min_items: int, pairs_per_group: int) -> DataFrame:
    """``a, b, n``: per word number the numbers behind it that share a field of at least ``min_items`` rows of ``lists``, and how many.

    Words are dealt to classes, and every two classes meet in one of as many groups. A group holds about the root of the classes,
    so a field is sent that often, however many pairs it makes. There are enough groups for the cores, and for a group to hold
    its words (``IDS_PER_GROUP``).
    """
    if n_words >= 1 << 31:
        raise ValueError("more words than a number of 32 bits names")
    ids, made = _made(lists)
    session = lists.sparkSession
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, min(tasks, 2 * session.sparkContext.defaultParallelism, made * 16 // pairs_per_group))
    blocks = wanted if wanted < 7 else next((n for n in (q * q + q + 1 for q in PLANES) if n >= wanted), wanted)
    while ids * len(_cover(blocks)) > IDS_PER_GROUP * blocks:
        blocks = next((n for n in (q * q + q + 1 for q in PLANES) if n > blocks), 2 * blocks)
    width, cover = n_words // blocks + 1, _cover(blocks)
    shared = session.sparkContext.broadcast((cover, _owned(blocks, cover)))
    largest = 2 * (width + 1) * len(cover)
    kind, name = (pa.int16(), "short") if largest < 1 << 15 else (pa.int32(), "int") if largest < 1 << 31 else (pa.int64(), "long")
    dealt = lists.mapInArrow(_deal_lists(blocks, shared, kind), f"block long, ids array<{name}>")
    return (
        dealt.repartition(max(tasks, min(4 * blocks, MAX_TASKS)), "block").groupBy("block")
        .applyInArrow(_count_pairs(min_items, blocks, width, shared), "a long, b array<int>, n array<int>")
    )


def _counted_pairs(items: DataFrame, vocab: DataFrame, min_items: int, pairs_per_group: int) -> tuple[DataFrame, DataFrame, int, int]:
    """``pair_lists`` of the items by numbers of words in their order, the words of the numbers, how many there are, and how many
    pairs there can be."""
    named = items.filter("id IS NOT NULL AND id <> ''")
    support = (
        named.select(F.explode(F.array_union(tx.token_set(F.col("title")), tx.token_set(F.col("subtitle")))).alias("word_low"))
        .groupBy("word_low").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_items)
    )
    kept = cut_lineage(vocab.select("word_low", "display").join(support, "word_low"))
    numbered, n_words = cut_and_count(number_rows(kept, ["word_low"], "word_no"))
    lists = cut_lineage(item_word_numbers(named, numbered.select("word_low", "word_no")))
    most = min(n_words * n_words // 2, _made(lists)[1] // max(1, min_items)) + 1
    return pair_lists(lists, n_words, min_items, pairs_per_group), numbered, n_words, most


def _sorted_runs(table: pa.Table) -> pa.Table:
    """Pairs of one range of first words, one row per count, sorted."""
    lists = [table.column(c).combine_chunks() for c in ("b", "n")]
    b, n = ((c.chunk(0) if isinstance(c, pa.ChunkedArray) else c) for c in lists)
    a = np.repeat(table.column("a").to_numpy(), b.value_lengths().to_numpy()).astype(np.int32)
    b, n = b.flatten().to_numpy(), n.flatten().to_numpy()
    order = np.lexsort((b, a, -n))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.diff(n, prepend=-1))
    cuts = pa.array(np.append(first, len(n)), pa.int32())
    bucket = pa.array(np.full(len(first), table.column("bucket")[0].as_py()), pa.int64())
    return pa.table({"bucket": bucket, "n": pa.array(n[first], pa.int32()), "a": pa.ListArray.from_arrays(cuts, a), "b": pa.ListArray.from_arrays(cuts, b)})


def _ranked_numbers(counted: DataFrame, n_words: int, ranges: int) -> DataFrame:
    """``a, b, unmatched_item_count, rank``: rank by count descending, then by the numbers.

    First words are dealt to ``ranges``, whose pairs are sorted and stored as arrays, a row per count. The place of a row among all
    is a prefix sum over the rows, so pairs are neither sorted as a whole nor written as rows.
    """
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(1, -(-(n_words + 1) // ranges))
    dealt = counted.withColumn("bucket", F.expr(f"a div {width}")).repartition(max(tasks, min(ranges, MAX_TASKS)), "bucket")
    runs = cut_lineage(dealt.groupBy("bucket").applyInArrow(_sorted_runs, "bucket long, n int, a array<int>, b array<int>"))
    heads = runs.select("bucket", "n", F.size("a").cast("long").alias("pairs"))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # a row per distinct count: by arithmetic about the root of all pairs made
    counts = heads.groupBy("n").agg(F.sum("pairs").alias("all")).select(
        "n", F.coalesce(F.sum("all").over(ahead(Window.partitionBy(F.lit(0)).orderBy(F.desc("n")))), F.lit(0)).alias("more")
    )
    same = F.coalesce(F.sum("pairs").over(ahead(Window.partitionBy("n").orderBy("bucket"))), F.lit(0))
    places = cut_lineage(heads.join(counts, "n").select("bucket", "n", (F.col("more") + same).alias("before")))
    return (
        runs.join(broadcast_if_small(places), ["bucket", "n"])
        .select("n", "before", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p"))
        .select(F.col("p.a").cast("long").alias("a"), F.col("p.b").cast("long").alias("b"), F.col("n").cast("long").alias("unmatched_item_count"),
                (F.col("before") + F.col("at") + 1).alias("rank"))
    )


def _with_words(counted: DataFrame, numbered: DataFrame) -> DataFrame:
    first = numbered.select(F.col("word_no").alias("a"), F.col("word_low").alias("w1"), F.col("display").alias("display1"))
    second = numbered.select(F.col("word_no").alias("b"), F.col("word_low").alias("w2"), F.col("display").alias("display2"))
    more = [c for c in counted.columns if c not in ("a", "b", "neg")]
    return (
        counted.join(broadcast_if_small(first), "a")
        .join(broadcast_if_small(second), "b")
        .select("w1", "w2", "display1", "display2", *more)
    )


def frequent_pairs(
    items: DataFrame, vocab: DataFrame, min_items: int = MIN_ITEMS_PER_PAIR, pairs_per_group: int = PAIRS_PER_GROUP
) -> DataFrame:
    """Word pairs found together in one field of at least ``min_items`` identifiers, in the spelling of ``vocab``.

    Words below the minimum cannot be part of such a pair and are dropped first. Words are dealt to groups in which every two of
    them meet once (``pair_lists``); pairs are only made inside a group, a chunk at a time, and leave it as arrays, counted.
    """
    counted, numbered, _, _ = _counted_pairs(items, vocab, min_items, pairs_per_group)
    flat = counted.select("a", F.inline(F.arrays_zip("b", "n"))).select("a", F.col("b").cast("long").alias("b"), F.col("n").cast("long").alias("unmatched_item_count"))
    return _with_words(flat, numbered)


def ranked_frequent_pairs(
    items: DataFrame, vocab: DataFrame, min_items: int = MIN_ITEMS_PER_PAIR, rows_per_bucket: int = ROWS_PER_BUCKET, batch: int | None = None
) -> DataFrame:
    """``ranked_pairs`` of ``frequent_pairs``: numbers are in the order of their words, so pairs are ranked and stored by number.

    With ``batch`` pairs are dealt by ``batch_no``, of so many ranks each, before they get their words.
    """
    counted, numbered, n_words, most = _counted_pairs(items, vocab, min_items, PAIRS_PER_GROUP)
    ranges = -(-most // rows_per_bucket)
    ranked = _ranked_numbers(counted, n_words, ranges)
    if batch:
        tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranked = ranked.withColumn("batch_no", F.expr(f"(rank - 1) div {int(batch)}")).repartition(max(tasks, min(ranges, MAX_TASKS)), "batch_no")
    return _with_words(ranked, numbered)


def ranked_pairs(pairs: DataFrame, **kw) -> DataFrame:
    """Rank pairs by count descending, then alphabetically."""
    keyed = pairs.withColumn("neg", -F.col("unmatched_item_count"))
    return number_rows(keyed, ["neg", "w1", "w2"], "rank", **kw).drop("neg")
