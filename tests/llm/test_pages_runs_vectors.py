"""HTML extraction, periodic runs and whitening against plain versions of their definitions, odd rows included."""

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest

from lumenfold.llm import html_extract, periodic_runs, queries, whitening

# html extraction


def plain(page: str) -> str:
    """Main text of the synthetic pages: what lies in the article, a block for each heading or paragraph."""
    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    texts = (" ".join(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in parts)
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_texts_of_all_pages(spark, sf):
    got = {r.page_id: r for r in queries.op11_html_extraction(spark, f"/root/testdata/{sf}").collect()}
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for p in pages:
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, plain(p.html), len(plain(p.html)))


def n(k: int) -> str:
    return " ".join(["word"] * k)


#: Layouts that the labelled table doesn't hold, and their main text.
UNSEEN = [
    (f"<header><a href=/>Site</a><nav><a href=/a>A</a></nav></header><article><h1>Title</h1><p>One two.</p><p>{n(50)}</p></article><aside><p>{n(30)}</p></aside><footer>c</footer>", ["Title", "One two.", n(50)]),
    (f"<div class='container has-sidebar'><div class='main-content'><h1>T</h1><p>{n(5)}</p><p>ab <a href=x>link words here</a></p></div><div class='sidebar'><p>{n(60)}</p></div></div><div id=footer>{n(9)}</div>", ["T", n(5), "ab link words here"]),
    (f"<main><article><h1>T</h1><p>{n(8)}</p></article><section class='comments'><h2>Comments</h2><div class=comment><p class='comment-body'>{n(80)}</p></div></section></main>", ["T", n(8)]),
    (f"<div id='cookie-banner'>{n(40)}<button>OK</button></div><div role=main><p>{n(3)}</p></div><form action=x><label>Name</label><input><p>{n(20)}</p></form>", [n(3)]),
    (f"<form id=aspnetForm><div class=nav>x</div><article><h1>T</h1><p>{n(6)}</p></article></form>", ["T", n(6)]),
    (f"<div><a href=1>Home</a> <a href=2>News</a></div><h1>{n(5)}</h1><p>{n(60)}</p><p>{n(33)}</p><p>{n(44)}</p><div><a href=3>Imprint</a></div>", [n(5), n(60), n(33), n(44)]),
    (f"<article><p>{n(4)}</p><div class='ad-slot'><p>{n(50)}</p></div><p>{n(6)}</p><div class=share><a>x</a></div></article>", [n(4), n(6)]),
    (f"<div>{n(20)}</div><article><p>{n(3)}</p></article><div>{n(20)}</div>", [n(3)]),
    (f"<div class='header'><h1>Site</h1></div><div class='entry'><h2>T</h2><div class='entry-content'><p>{n(9)}</p></div></div><div class='footer'>{n(30)}</div>", ["T", n(9)]),
    ("<article>Hi</article>", ["Hi"]),
]
#: Markup that is broken, nested or only looks like markup.
ODD = [
    ("<article><p>a &lt;b&gt; &amp;amp; &#233;&#x41;&nbsp;c&notit; &am</p><p>1 < 2 > 0</p></article>", ["a <b> &amp; éA c¬it; &am", "1 < 2 > 0"]),
    ("<article><script>var a='<p>no</p>';</script><style>p{}</style><p>yes<!-- <p>no</p> --> it<b>alic</b> is</p><template><p>no</p></template><p hidden>no</p><p style='display:none'>no</p></article>", ["yes italic is"]),
    ("<article><p>one<p>two<ul><li>a<li>b</ul><p>three <a href='x'>link<p>four</article><footer>no</footer>", ["one", "two", "a", "b", "three link", "four"]),
    ("<article><p title='a > b' data-x=\"<p>\">ok\n\t it<br>is</p></article>", ["ok it is"]),
    ("<article><p>ok</p><p class='x", ["ok"]),
    ("<article><p>ok</p><!-- no", ["ok"]),
    ("<ARTICLE><P>ok</P><SCRIPT>no</SCRIPT ><p>\x00\U0001f600</p></ARTICLE>", ["ok", "\x00\U0001f600"]),
    ("<article></p></div></b><p>&#0;&#xD800;</p></article>", ["��"]),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", ["deep"]),
    ("<>< ></>", []),
    ("", []),
    (None, []),
    (" \n\t", []),
]


def test_unseen_and_broken_pages(spark):
    rows = [(i, None if i == 3 else f"u{i}", h, 1, "x") for i, (h, _) in enumerate(UNSEEN + ODD)] + [(None, None, UNSEEN[0][0], 1, "x"), (0, "u0", UNSEEN[0][0], 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string").repartition(3)
    got = sorted((r.page_id if r.page_id is not None else -1, r.url, r.text, r.n_chars) for r in html_extract.extract(df).collect())
    want = [(r[0] if r[0] is not None else -1, r[1], "\n".join((UNSEEN + ODD)[r[0] or 0][1])) for r in rows]
    assert got == sorted((*w, len(w[2])) for w in want)
    blocks = html_extract.classify_blocks(df).where("page_id = 6").orderBy("n").collect()
    assert [b.n for b in blocks] == [0, 1, 2, 3] and [b.p_main >= 0.5 for b in blocks] == [True, False, True, False] and blocks[3].link_density == 1
    assert html_extract.extract(df.limit(0)).count() == 0


def test_pages_are_read_in_linear_time():
    import time

    for piece in ("<a b=\"", "<p ", "</x>", "<i>", "<!--", "<", "&amp", "<div><a>", "<td><p>"):
        begin = time.time()
        html_extract.blocks_of(piece * 100_000)
        assert time.time() - begin < 20, piece


def test_tree_knows_its_table():
    x, y = html_extract.labelled()
    nodes = html_extract.tree()
    assert ((html_extract.probability(nodes, x) >= 0.5) == y).mean() > 0.99
    used = {html_extract.FEATURES[f] for f, *_ in nodes if f >= 0}
    assert {"words", "words_behind"} <= used


# periodic runs


def brute_runs(w, shortest=12):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, 2 * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, size, q) for (s, size), q in best.items())


def run_texts():
    r = random.Random(3)
    a, b = ["a"], ["a", "b"]
    while len(b) < 300:
        a, b = b, b + a
    texts = [b[:300], [str(bin(i).count("1") % 2) for i in range(300)], ["x"] * 77, [], ["a"], list("abcab") * 30 + list("xabca") * 9]
    for _ in range(150):
        w = [r.choice("abcde"[: r.choice([1, 2, 3, 5])]) for _ in range(r.randint(0, 110))]
        if w and r.random() < 0.6:
            at = r.randrange(len(w))
            w[at:at] = [r.choice("abc") for _ in range(r.randint(1, 15))] * r.randint(1, 6)
        texts.append(w)
    return texts


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_all_runs(spark, shortest):
    texts = run_texts()
    df = spark.createDataFrame([(i, " ".join(t), "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, runs string, start int").repartition(5)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df, shortest).collect()}
    for i, w in enumerate(texts):
        want = brute_runs(w, shortest)
        assert [tuple(x) for x in got[i].runs] == want
        gone = {k for s, size, q in want for k in range(s + q, s + size)}
        assert got[i].collapsed == " ".join(x for k, x in enumerate(w) if k not in gone)


def brute_digest(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, m = h // 10, len(w)
    if h % 10 == 0 and m:
        a = g % m
        p = 1 + (m - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, m)]
    runs = brute_runs(w)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    kept = [x for k, x in enumerate(w) if k not in gone]
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_run_digests(spark):
    r = random.Random(8)
    texts = [None, "", " \t\n ", "é ü\x0b日本\x00 \U0001f600 " * 9, "same " * 400, *(" ".join(t) for t in run_texts()), *(" ".join(r.choice("abcdefghij") + str(r.randrange(60)) for _ in range(r.randint(1, 260))) for _ in range(60))]
    rows = [(i * 7, t, 1, "x") for i, t in enumerate(texts)] + [(None, texts[4], 1, "x"), (28, texts[4], 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs int, salt string").repartition(4)
    cols = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = collections.Counter((x.doc_id, *(x[c] for c in cols)) for x in periodic_runs.digest(df).collect())
    assert got == collections.Counter((d, *brute_digest(d, t)) for d, t, *_ in rows)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, *_ in rows) > 5  # the planted branch was met
    assert periodic_runs.digest(df.limit(0)).count() == 0


def test_runs_of_a_very_long_text(spark):
    r = random.Random(4)
    unit = [str(r.randrange(10**6)) for _ in range(40_000)]
    w = [str(r.randrange(10**6)) for _ in range(50_000)] + unit * 3 + unit[:10] + ["end"] * 30_000
    df = spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")
    got = [tuple(x) for x in periodic_runs.periodic_runs(df).first().runs]
    assert got == [(50_000, 120_010, 40_000), (170_010, 30_000, 1)]


def test_run_table_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000").collect()
    got = {x.doc_id: x for x in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        x = got[d.doc_id]
        assert (x.n_runs, x.start, x.length, x.period, x.exponent_milli, x.runs_sha256, x.collapsed_sha256) == brute_digest(d.doc_id, d.text)


# whitening


def check_whitened(got, ids, x, k):
    """got: rows of the digest; x: integer vectors of the rows in the order of ids."""
    u = np.unique(x, axis=0)
    m, s = len(u), u.sum(axis=0)
    c = u - s / m
    e, v = np.linalg.eigh(c.T @ c / m)
    e, v = e[::-1], v[:, ::-1]
    z = (x - s / m) @ v[:, :k] / np.sqrt(e[:k])
    by = collections.defaultdict(dict)
    for r in got:
        by[r.vec_id][r.component] = r
    assert len(got) == len(ids) * k
    w = np.array([[by[i][j].whitened for j in range(1, k + 1)] for i in ids])
    assert np.allclose(w * np.sign((w * z).sum(axis=0)), z, atol=1e-6)
    assert all(by[i][j].n == m and by[i][j].deviation == int(((m * row.astype(object) - s.astype(object)) ** 2).sum()) for i, row in zip(ids, x, strict=True) for j in range(1, k + 1))
    assert np.allclose([by[ids[0]][j].explained for j in range(1, k + 1)], e[:k] / e.sum(), rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("fan", [64, 2])
def test_whitened_embeddings(spark, small, fan, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", fan)  # 2: several rounds of factors
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 1_000_000
    check_whitened(queries.op13_embedding_whitening(spark, small).collect(), [r.vec_id for r in rows], x, 16)


def test_whitening_of_odd_rows(spark):
    r = np.random.default_rng(2)
    base = (r.standard_normal((40, 5)) * [9, 3, 1, 0.5, 0.2]).astype(np.float32)
    good = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, base[7].tolist()) for i in range(30)]
    bad = [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [float("nan")] * 5), (504, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (505, [1.0, 2.0])]
    df = spark.createDataFrame([(*x, 1, 2.0) for x in good + bad], "vec_id long, embedding array<float>, n int, whitened double").repartition(4)
    x = np.floor(64 * np.array([v for _, v in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    check_whitened(whitening.digest(df).collect(), [i for i, _ in good], x, 5)
    assert whitening.digest(df.limit(0)).count() == 0
    assert whitening.digest(df.where("vec_id = 0")).count() == 0  # one vector has no variance
    assert whitening.digest(df.where("vec_id in (0, 1)")).count() == 2  # two have one component
    twice = df.where("vec_id < 40").union(df.where("vec_id < 40").selectExpr("cast(null as long) vec_id", "embedding", "n", "whitened"))
    assert whitening.digest(twice).groupBy("vec_id").count().where("vec_id is null").first()[1] == 200


def test_exact_distances_of_large_sums():
    x = np.array([[1 << 40, -5], [3, 7]], np.int64)
    sums = [(1 << 55) + 1, 12]
    want = [sum((9 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert [int(v) for v in whitening.exact_deviation(x, 9, sums).to_pylist()] == want


@pytest.mark.parametrize("d", [1, 2, 7, 64, 65])
def test_jacobi_factors(d):
    r = np.triu(np.random.default_rng(d).standard_normal((d, d))) * 10.0 ** -np.arange(d).clip(0, 9)
    sigma, v = whitening.jacobi(r)
    assert np.allclose(v.T @ v, np.eye(d), atol=1e-13) and (np.diff(sigma) <= 0).all()
    assert np.allclose(sigma, np.linalg.svd(r, compute_uv=False), rtol=1e-9, atol=1e-16)
    assert np.allclose(((r @ v) ** 2).sum(axis=0), sigma**2, rtol=1e-9)
