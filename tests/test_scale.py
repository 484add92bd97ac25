import random

from pyspark.sql import functions as F

from shelfwise import scale
from shelfwise.operators.groups import connected_components
from shelfwise.scale import broadcast_if_small, number_rows, side_by_side, skew_join


def test_number_rows_in_many_ranges(spark):
    keys = random.Random(1).sample(range(10**6), 5000)
    df = spark.createDataFrame([(k, f"g{k % 3}" if k % 7 else None) for k in keys], "k long, g string").repartition(5)
    got = {r.k: r.n for r in number_rows(df, ["k"], "n", rows_per_bucket=300).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}
    per_group = number_rows(df, ["k"], "n", within=["g"], rows_per_bucket=300, start=0).collect()
    assert len(per_group) == 5000
    for g in ("g0", "g1", "g2", None):
        ks = sorted(r.k for r in per_group if r.g == g)
        assert {r.k: r.n for r in per_group if r.g == g} == {k: i for i, k in enumerate(ks)}


def test_number_rows_by_two_columns(spark):
    rows = [(-(i % 5), f"w{i:04d}") for i in range(2000)]
    got = number_rows(spark.createDataFrame(rows, "a int, w string"), ["a", "w"], "n", rows_per_bucket=100).collect()
    assert [(r.a, r.w) for r in sorted(got, key=lambda r: r.n)] == sorted(rows)


def test_skew_join_keeps_every_row(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(3000)], "i long, k string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 3000, 6)], "k string, v long")
    counts = big.groupBy("k").count()
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(dim, "k", how).collect()
        salted = skew_join(big, dim, ["k"], counts, "count", how, hot_rows=100, salts=7)
        assert sorted(map(str, salted.select(*big.join(dim, "k", how).columns).collect())) == sorted(map(str, plain))


def test_side_by_side_has_no_join(spark):
    a = spark.range(5).agg(F.count("*").alias("n"))
    b = spark.range(9).agg(F.sum("id").alias("s"), F.lit("x").alias("t"))
    out = side_by_side(a, b)
    assert tuple(out.first()) == (5, 36, "x")
    assert "Join" not in out._jdf.queryExecution().toString()


def test_broadcast_only_below_the_bound(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(1000)], "i long, s string")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(df, 10**6)) and not hinted(broadcast_if_small(df, 10**4))


def test_components(spark):
    rnd = random.Random(3)
    nodes = list(range(400))
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(330)] + [(i, i + 1) for i in range(100, 180)]
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    got = connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "u long, v long")
    ).collect()
    assert {r.node: r.label for r in got} == {n: find(n) for n in nodes}


def test_large_arrays_do_not_pass_the_driver(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "cast(id % 13 as string) AS word")
    total = lambda t: (t.num_rows, sum(t["id"].to_pylist()), sorted(set(t["word"].to_pylist())))
    want = scale.shared_arrays(df, total).value
    gathered = []
    monkeypatch.setattr(type(df), "toArrow", lambda self: gathered.append(1))
    stored = scale.shared_arrays(df, total, 0)
    assert not gathered and isinstance(stored, scale.StoredArrays) and stored.value == want
    empty = scale.shared_arrays(df.limit(0), lambda t: (t.num_rows, t.column_names), -1)
    assert empty.value == (0, ["id", "word"])

    def seen(batches):
        for b in batches:
            import pyarrow as pa

            yield pa.RecordBatch.from_pydict({"n": [stored.value[0]] * b.num_rows})

    assert spark.range(3).mapInArrow(seen, "n long").collect() == [(5000,)] * 3
