"""Classifiers, quality model, extraction."""

import numpy as np
import pytest

from shelfwise.llm.html_extract import extract, main_text
from shelfwise.llm.language_id import BITS, identified, language_report, presence
from shelfwise.llm.quality_lm import ORDER, SYMBOLS, codes, log_table, pieces, quality_report, tables
from shelfwise.llm.toxicity import Flags, compressor, toxicity_report, window
from tests.llm.conftest import odd_rows, prose


def kernel(a, b):
    """Brute force: n-grams (1 to 3) present in both texts."""

    def grams(t):
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        return {s[k : k + n] for n in (1, 2, 3) for k in range(len(s) - n + 1)}

    return len(grams(a) & grams(b))


def test_language_fit_unpacks_a_block_at_a_time():
    import tracemalloc

    from shelfwise.llm.language_id import fit, outputs

    rng = np.random.default_rng(4)
    bits = rng.random((1600, 1 << BITS), dtype=np.float32) < 0.02
    bits[:800, :400] |= rng.random((800, 400)) < 0.5
    packed = np.packbits(bits, axis=1)
    tracemalloc.start()
    model = fit(["a"] * 800 + ["b"] * 800, packed)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20  # all rows as 32-bit numbers take 210 MB
    f = outputs(model, bits, np.unpackbits(model["marks"], axis=1).T.astype(np.float32))
    assert ((f[:, 0] > f[:, 1]) == (np.arange(1600) < 800)).mean() > 0.99


def test_presence_counts_common_ngrams():
    texts = ["Hello, world! It is 42.", "hello there", "Ñandú über ça", "a"]
    bits = np.zeros((len(texts), 1 << BITS), bool)
    assert all([presence(t, b) for t, b in zip(texts, bits)])
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert abs(int((bits[i] & bits[j]).sum()) - kernel(a, b)) <= 1
    empty = np.zeros(1 << BITS, bool)
    assert not presence(None, empty) and not presence("12 !?", empty) and not empty.any()


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 150 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(odd_docs, no_docs):
    got = language_report(odd_docs).collect()
    assert len(got) == len(odd_rows())
    by = {r["doc_id"]: r for r in got}
    assert by[5]["lang_pred"] == by[6]["lang_pred"] == by[11]["lang_pred"] == "und" and by[11]["score"] == 0
    assert language_report(no_docs).count() == 0
    kept = identified(odd_docs)
    assert kept.columns == odd_docs.columns and {5, 6, 7, 11}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_language_without_labels(odd_docs):
    from pyspark.sql import functions as F

    got = language_report(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in got} == {"und"}


def test_windows_compress_dictionary_words():
    toxic = compressor([b"idiot", b"worthless", b"scum"])
    for w in (b"idiot", b"worthless", b"scum"):
        assert len(toxic.compress(window(w))) <= 12
    assert len(toxic.compress(window(b"gardening"))) > 20
    flags = Flags({"toxic": [b"idiot"], "ordinary": [b"the", b"and"], "most": 12, "gain": 5})
    assert [flags[w] for w in (b"idiot", b"idiot,", b"the", b"...", b"", b"y" * 1000)] == [1, 1, 0, 0, 0, 0]


def toxic_tables(spark, n=900):
    rows, labels = [], []
    for k in range(n):
        words = prose(k, 40 + k % 30).split()
        bad = k % 3 == 0
        if bad:
            for j in range(3):
                words[(5 + 11 * j + k) % len(words)] = ["vilewretch", "dreadfool", "nastyswine"][(j + k) % 3]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = toxic_tables(spark)
    got = toxicity_report(docs, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100 and sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    _, labels = toxic_tables(spark, 60)
    odd_labels = labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 1), (1, 0, 1)], labels.schema))
    assert toxicity_report(odd_docs, odd_labels).count() == len(odd_rows())
    assert toxicity_report(no_docs, labels).count() == 0
    nothing = toxicity_report(odd_docs, labels.filter("toxic = 0")).collect()
    assert {r["score"] for r in nothing} == {0.0}


def brute_kneser_ney(texts):
    """Interpolated modified Kneser-Ney of the counts, by definition."""
    from collections import Counter, defaultdict

    grams = Counter()
    for t in texts:
        for c in codes(t).tolist():
            grams[tuple((c // SYMBOLS**k) % SYMBOLS for k in range(ORDER - 1, -1, -1))] += 1
    counts = [grams]
    for _ in range(ORDER - 1):
        counts.insert(0, Counter(g[1:] for g in counts[0]))
    found = []
    for c in counts:
        n = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 3 - 3 * y]
            d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]
        else:
            d = [0.5, 0.75, 0.9]
        total, held = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[g[:-1]] += v
            held[g[:-1]] += d[min(v, 3) - 1]
        found.append((c, d, total, held))

    def p(g):
        if not g:
            return 1 / SYMBOLS
        c, d, total, held = found[len(g) - 1]
        if not total.get(g[:-1]):
            return p(g[1:])
        own = c[g] - d[min(c[g], 3) - 1] if c.get(g) else 0
        return own / total[g[:-1]] + held[g[:-1]] / total[g[:-1]] * p(g[1:])

    return p


def test_kneser_ney_against_definition(spark):
    texts = [prose(k, 30) + "." for k in range(20)]
    from collections import Counter

    counts = Counter(c for t in texts for c in codes(t).tolist())
    table = log_table(tables(spark.createDataFrame(list(counts.items()), "gram long, n long")))
    p = brute_kneser_ney(texts)
    rng = np.random.default_rng(1)
    for c in [*rng.choice(list(counts), 60), *rng.integers(0, SYMBOLS**ORDER, 60)]:
        g = tuple((int(c) // SYMBOLS**k) % SYMBOLS for k in range(ORDER - 1, -1, -1))
        assert np.exp(table[int(c)]) == pytest.approx(p(g), rel=1e-4)
    assert np.exp(table.reshape(-1, SYMBOLS)).sum(axis=1)[rng.integers(0, SYMBOLS ** (ORDER - 1), 50)] == pytest.approx(1, abs=1e-3)


def test_pieces_join_to_the_whole():
    import shelfwise.llm.quality_lm as q

    text = prose(5, 400)
    whole, old = codes(text), q.PIECE
    q.PIECE = 100
    try:
        assert np.array_equal(np.concatenate(list(pieces(text))), whole)
    finally:
        q.PIECE = old


def test_quality(spark, odd_docs, no_docs):
    rows = [(k, prose(k, 60), "en" if k % 2 else None) for k in range(200)]
    junk = [(1000 + k, " ".join("QX%$ZJ#" + str(j * k) for j in range(60)), "en") for k in range(10)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(150)] + [(1000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_report(docs, labels).collect()}
    assert all(got[k]["kept"] for k in range(200)) and not any(got[1000 + k]["kept"] for k in range(10))
    odd = quality_report(odd_docs, labels).collect()
    assert len(odd) == len(odd_rows()) and all(not r["kept"] for r in odd if r["perplexity"] is None)
    assert quality_report(no_docs, labels).count() == 0
    assert all(r["kept"] == (r["n_symbols"] > 0) for r in quality_report(odd_docs, labels.filter("quality = 7")).collect())


def brute_perplexities(texts, trusted):
    """Perplexity of every text by the definition, over its own characters."""
    from collections import Counter, defaultdict

    pad = lambda t: "\U0010ffff" * (ORDER - 1) + t
    grams = lambda t: [pad(t)[k : k + ORDER] for k in range(len(t))]
    counts = [Counter(g for t in trusted for g in grams(t))]
    for _ in range(ORDER - 1):
        counts.insert(0, Counter(g[1:] for g in counts[0]))
    symbols, found = len(counts[0]) + 1, []
    for c in counts:
        n = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0
        d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 3 - 3 * y] if y else [0.5, 0.75, 0.9]
        d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]
        total, held = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[g[:-1]] += v
            held[g[:-1]] += d[min(v, 3) - 1]
        found.append((c, d, total, held))

    def p(g):
        if not g:
            return 1 / symbols
        c, d, total, held = found[len(g) - 1]
        if not total.get(g[:-1]):
            return p(g[1:])
        own = c[g] - d[min(c[g], 3) - 1] if c.get(g) else 0
        return (own + held[g[:-1]] * p(g[1:])) / total[g[:-1]]

    return [float(np.exp(-np.mean([np.log(p(g)) for g in grams(t)]))) if t else None for t in texts]


@pytest.mark.parametrize("run, piece", [(None, None), (70, 400)])
def test_quality_scores_true_characters(spark, monkeypatch, run, piece):
    import shelfwise.llm.quality_lm as q

    if run:  # texts are cut over runs and pieces
        monkeypatch.setattr(q, "PIECE", run)
        monkeypatch.setattr(q, "PIECE_CHARS", piece)
    texts = [prose(k, 30) + " caf\u00e9 \u4e2d\u6587 \U0001f600 Ab12\n" for k in range(12)]
    # letters that were one class: other code points, equal modulo 12; other capitals and digits; unknown characters
    odd = [texts[0].replace("\u00e9", "\u00f5"), texts[0].replace("Ab12", "Zb12"), texts[0].replace("12", "73"), "\u0416\u0416\u0416", "", "a"]
    rows = [(k, t, "en") for k, t in enumerate(texts + odd)] + [(99, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(k, 1) for k in range(10)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_report(docs, labels).collect()}
    expected = brute_perplexities([t for _, t, _ in rows], texts[:10])
    assert len(got) == len(rows)
    for k, e in enumerate(expected[:-1]):
        assert got[k]["perplexity"] == (pytest.approx(e, rel=1e-9) if e else None)
        assert got[k]["n_symbols"] == len(rows[k][1])
    assert got[99]["perplexity"] is None and got[99]["n_symbols"] == 0
    assert min(got[k]["perplexity"] for k in (12, 13, 14)) > got[0]["perplexity"] + 1e-6


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p><p>no</p>"</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, sorry.</div>
<!-- <p>no</p> --><{open}>{body}<div class="comments"><article><p>First! Great, really great.</p></article></div></{close}>
<aside>More, of, this.</aside><form><p>Your name, please.</p></form><footer>&copy; Us, 2020.</footer></body></html>"""


@pytest.mark.parametrize("open, close", [("article", "article"), ("div id=content", "div"), ("main", "main")])
def test_article_blocks(open, close):
    body = "<h1>A  title</h1><p>One &amp; two,\n three &lt;b&gt;.<br>Four <b>bold</b>.<p>Short<ul><li>x<li>y, z</ul><div>Tail, and end.</div>"
    want = "A title\nOne & two, three <b>. Four bold.\nShort\nx\ny, z\nTail, and end."
    assert main_text(PAGE.format(open=open, close=close, body=body)) == want


LONG = "A long sentence, with marks; it goes on, and on. " * 12


@pytest.mark.parametrize("body, want", [
    (f"<h1>Title here</h1><div class=intro><p>{LONG}</p></div><div class=body><p>{LONG * 4}</p></div>", ["Title here", LONG, LONG * 4]),
    (f"<div>{LONG}</div><div>{LONG * 9}</div><div>Last, short.</div>", [LONG, LONG * 9, "Last, short."]),
    (f"<article><p>{LONG * 5}</p></article><article><p>{LONG}</p></article>", [LONG * 5, LONG]),
])
def test_no_content_node_is_left_outside(body, want):
    page = f"<body><nav><p>Home, no.</p></nav><div id=content>{body}</div><footer><p>No, no.</p></footer></body>"
    assert main_text(page) == "\n".join(w.strip() for w in want)


@pytest.mark.parametrize("page", [
    "<div id=page class='site right-sidebar'><article>{}</article></div>", "<div class=header><main>{}</main></div>",
    "<article class='post has-comments'>{}</article>", "<main class='no-sidebar comments'>{}</main>", "<div class=sidebar><div>{}</div></div>",
    "<article><div class='article-header'>{}</div></article>", "<div id=content><p title=it's>{}</div>", "<p title='it>{}",
    '<p title="a > b" data-x=a"b>{}<p class="ad">', "<div id=a\"b>{}<div class=ad>It's bad, no.</div></div>",
])
def test_cues_and_quotes_drop_no_article(page):
    body = f"<h2>Title</h2><p>{LONG}</p><p class=notice>Note, this.</p><p>{LONG}</p>"
    page = "<div class='cookie-notice'>Cookies, no.</div>" + page.format(body)
    assert main_text(page) == "\n".join(["Title", LONG.strip(), "Note, this.", LONG.strip()])


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), (" \n ", ""), ("plain &eacute; text", "plain é text"), ("<p>open <!-- never closed", "open"),
    ("<nav>only</nav>", ""), ("<p>a<script>b", "a"), ("</div></p>x", "x"), ("a < b", "a < b"), ("<p title='>'>q</p>", "q"),
])
def test_broken_pages(page, want):
    assert main_text(page) == want


def test_extract_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>One, two.</p>", 1), (1, "u", "<p>One, two.</p>", 1), (2, None, None, 2), (None, "v", "", 3)],
                                  "page_id long, url string, html string, text int")
    got = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in extract(pages).collect()), key=str)
    assert got == [(0, "v", "", 0), (1, "u", "One, two.", 9), (1, "u", "One, two.", 9), (2, None, "", 0)]
    assert extract(pages.filter("page_id = 99")).count() == 0
