"""Token files, WARC archives, registration and the pipeline."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm.token_blocks import BLOCK, BlockWriter, Encoder, default_tokenizer, pack_blocks, read_file, token_files, unpack_block
from shelfwise.llm.warc import assemble, members, parse, read_archives, transaction, warc_report, write_archives
from tests.llm.conftest import odd_rows, prose


@pytest.mark.parametrize("ids", [
    [5], [0] * 3000, list(range(BLOCK + 1)), [7, 2**32 - 1, 0, 9], [1] * 1000 + [50_000] * 24, [2**32 - 1] * BLOCK,
    np.random.default_rng(3).integers(0, 50_257, 5000).tolist(),
])
def test_blocks_round_trip(ids):
    out = [unpack_block(memoryview(b), 0) for b in pack_blocks(np.array(ids, np.uint32))]
    assert np.concatenate(out).tolist() == ids


def test_file_round_trip_and_damage():
    class Sink(list):
        def write(self, data):
            self.append(data)

    sink = Sink()
    writer = BlockWriter(sink)
    rng = np.random.default_rng(0)
    docs = [(k if k else None, rng.integers(0, 60_000, n).astype(np.uint32)) for k, n in enumerate([1, 0, 5, 200_000, 3, 1024, 1])]
    for name, ids in docs:
        writer.add(name, ids)
    writer.close()
    data = b"".join(sink)
    got = list(read_file(data))
    assert [n for n, _ in got] == [n for n, _ in docs] and all(np.array_equal(a, b) for (_, a), (_, b) in zip(got, docs))
    with pytest.raises(ValueError):
        list(read_file(data[:1000] + b"x" + data[1001:]))


TRICKY = ["", " ", "  a  b ", "a\n b\n\nc", "it's don't", "x  y", "a\t b", "<|endoftext|> z <|endoftext|>", "é ü  ñ\r\n", "1 22 333", "a \x1c b", "end \n"]


SIGNS = [
    "end. end, (end) end!? x<|endoftext|>. .<|endoftext|>a, it's. it'S, 'tis 's.s", 'a"\'s b.\'ll c-d.e_f', "É. été, ñandú! ß? ÿ* ª. µ, ×. ÷,",
    "12. 3,4 x5: 6'7 ½. ²,", "中文。 日本, слово. 😀! e\u0301. \u00a0b. a\u2028b.", "%%% und&&& der### .a ..b a..", "one\ntwo.\nthree, <|endoftext|>\nx",
]


@pytest.mark.parametrize("text", [*SIGNS, " ".join(SIGNS)])
def test_signs_behind_words_are_cut_off(text):
    encoder = Encoder(default_tokenizer())
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in (text, "", text)]
    assert [ids.tolist() for ids in encoder.encode_all(pa.array([text, "", text]))] == want


def test_workers_give_memory_back(monkeypatch):
    from shelfwise.llm import common, token_blocks

    given = []
    monkeypatch.setattr(common, "release", lambda: given.append(1))
    assert len(list(common.portions(iter([pa.record_batch({"a": [1, 2, 3]})] * 2), 2))) == 4 and given == [1]
    # a worker that reads holds no encoder of an earlier task
    monkeypatch.setattr(token_blocks, "contents", lambda *a: type("Files", (), {"mapInArrow": lambda self, run, schema: list(run(iter([])))})())
    token_blocks.encoder_of(default_tokenizer())
    token_blocks.read_tokens(None, "")
    assert token_blocks.encoder_of.cache_info().currsize == 0


def test_a_word_is_encoded_once_whatever_signs_follow():
    encoder = Encoder(default_tokenizer())
    encoder.encode("a " + " ".join("quickly" + sign for sign in ".,;:!?)"))
    assert " quickly" in encoder.known and not any("quickly" in p and p != " quickly" for p in encoder.known)


def test_other_tokenizers_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, normalizers

    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.normalizer = normalizers.Replace("d. f", "df")
    tokenizer.save(path := str(tmp_path / "other.json"))
    assert Encoder(path).encode("abc d. f x").tolist() == tokenizer.encode("abc df x", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("text", [*TRICKY, prose(1, 300), " ".join(TRICKY)])
def test_pieces_equal_whole_encoding(text):
    encoder = Encoder(default_tokenizer())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert encoder.encode(text).tolist() == want
    assert encoder.encode(text).tolist() == want


def test_token_files(odd_docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    rows = sorted(((d is not None, d, t or "") for d, t, *_ in odd_rows()), key=lambda r: r[:2] if r[1] is not None else (False, 0))
    got = sorted(token_files(odd_docs).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [d for _, d, _ in rows]
    want = Counter((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for _, d, t in rows
                   for ids in [tokenizer.encode(t, add_special_tokens=False).ids + [2]])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert token_files(no_docs).count() == 0


def pages(spark):
    rows = [(1, "http://a/x?q#f", "<p>é</p>"), (2, "http://a/y", "<p>é</p>"), (9, None, "<p>é</p>"), (4, "u", None), (5, "", ""),
            (6, "http://b", "<p>" + "long " * 50_000), (7, "http://c\r\nX-Evil: 1", "\r\n\r\nWARC/1.1"), (7, "http://c\r\nX-Evil: 1", "\r\n\r\nWARC/1.1"),
            (None, "http://n", "null id")]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, type int")


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, least):
    rows, table = pages(spark)
    got = warc_report(table, least).collect()
    largest = {}
    for i, _, h in rows:
        known = [v for v in (largest.get(h or ""), i) if v is not None]
        largest[h or ""] = max(known, default=None)
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= least and i != largest[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want[(i, len(raw), digest, "revisit" if revisit else "response", largest[h or ""] if revisit else None)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    assert all(r["complete"] for r in got)


def test_transactions_are_nested(spark, tmp_path):
    rows, table = pages(spark)
    folder = f"file://{tmp_path}/warc"
    assert write_archives(table, folder).agg({"n_captures": "sum"}).first()[0] == len(rows)
    records = read_archives(spark, folder)
    assert records.count() == 3 * len(rows) and records.select("record_id").distinct().count() == 3 * len(rows)
    whole = {r["capture"]["page_id"]: r for r in assemble(records).collect()}
    assert whole[9]["capture"]["block"] == "<p>é</p>" and whole[1]["capture"]["block"] == ""
    assert whole[1]["request"]["block"].startswith("GET /x?q HTTP/1.1") and "page-id: 1" in whole[1]["metadata"]["block"]
    lonely = records.filter("type in ('response', 'revisit')")
    assert all(r["request"] is None for r in assemble(lonely).collect())


def test_records_cut_short_raise():
    data = b"".join(transaction(1, "http://a", b"body", "D", None, 0))
    assert len([parse(m) for m in members(data)]) == 3
    with pytest.raises(ValueError):
        parse(list(members(data))[1][:-30])


def test_warc_empty(spark):
    assert warc_report(pages(spark)[1].filter("page_id = 99")).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op5_warc", "op6_near_dedup", "op7_decontaminate", "op10_mixing"])
def test_queries_equal_sql(spark, name):
    import duckdb

    from shelfwise.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf)
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    a = Counter(tuple(r[c] for c in columns) for r in got.collect())
    assert a == Counter(want.select(*columns).fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline
    from shelfwise.llm.common import scratch
    from tests.llm.test_dedup import brute_components
    from shelfwise.llm.hashing import tokens

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
        assert name == "token_output" or docs.columns == columns
    before, after = [[(r["doc_id"], r["text"]) for r in x.collect()] for x in seen["near_dedup"]]
    want = {c for _, _, c in brute_components([(d, tokens(t)) for d, t in before], 5)}
    assert {d for d, _ in after} == want and len(after) == len(want)
    assert seen["language_id"][1].count() == seen["language_id"][0].count()
    emitted = Counter(r["doc_id"] for r in seen["mixing"][1].collect())
    assert set(emitted.values()) <= {1, 2}
    assert Counter(r["doc_id"] for r in seen["token_output"][1].collect()) == emitted
