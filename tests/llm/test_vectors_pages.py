"""Embedding and page operators against brute force."""

import time

import numpy as np
import pytest

from strandline.llm import embeddings, htmltext
from strandline.llm import queries as llm_queries


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * 0.05 * (i % 4)).tolist()) for i in range(120)]
    rows += [(200, [0.0] * 24), (201, None), (202, [float("nan")] + [1.0] * 23), (203, [float("inf")] * 24), (204, []), (205, [None] * 24)]
    rows += [(206, rows[0][1]), (207, [x * 7 for x in rows[0][1]]), (208, [1.0, 2.0]), (209, [2.0, 4.0]), (0, rows[1][1]), (None, rows[0][1])]
    return rows + [(210, [1e-200, 2e-200]), (211, [-1.0, -2.0])]


def test_links_equal_brute_force(spark, vectors, monkeypatch):
    usable = {}
    for k, (i, v) in enumerate(vectors):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[k] = np.array(v)
    keys = sorted(usable)
    near = {k: set() for k in keys}
    for a in keys:
        for b in keys:
            x, y = usable[a], usable[b]
            if a != b and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95 - 1e-12:
                    near[a].add(b)
    seen, component = {}, {}
    for k in keys:
        if k not in seen:
            todo, own = [k], set()
            while todo:
                x = todo.pop()
                if x not in own:
                    own.add(x)
                    todo += near[x]
            for x in own:
                seen[x] = own
        component[k] = min(vectors[x][0] for x in seen[k])
    want = []
    for k, (i, _) in enumerate(vectors):
        root = component.get(k, i)
        want.append((i, len(near.get(k, ())), root, i is None or i == root))
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in vectors], "vec_id long, embedding array<double>, node string, data int").repartition(3)
    for block in (embeddings.BLOCK, 4):
        monkeypatch.setattr(embeddings, "BLOCK", block)
        got = [tuple(r) for r in embeddings.near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert embeddings.near_vectors(df.where("false")).count() == 0


def test_pairs_at_the_threshold_are_judged_alike(spark):
    """Pairs built to lie at the threshold, where sums in another order would decide otherwise."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(60):
        x, z = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        z -= (x @ z) * x
        z /= np.linalg.norm(z)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.95 * x + np.sqrt(1 - 0.95**2) * z).tolist())]
    found = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for k in range(60):
        a, b = found[2 * k], found[2 * k + 1]
        assert a.n_links == b.n_links == (a.component_id == b.component_id)
    x, y = np.array([rows[0][1]]), np.array([r[1] for r in rows])
    for i in range(len(y)):
        assert embeddings.linked(x, y, 0.95)[0, i] == embeddings.linked(x, y[i : i + 1], 0.95)[0, 0]


def test_strangers_stay_few_at_any_size():
    for n in (500, 50_000, 10**7, 10**10):
        tables, hashes = embeddings.bucket_plan(n, 64, 0.95, 7)
        assert n * tables * (1 + hashes) ** 2 / 128**hashes <= embeddings.STRANGERS
    assert embeddings.bucket_plan(10**10, 64, 0.95, 7)[0] < 100


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = embeddings.hadamard(x)
    assert np.allclose((y * y).sum(axis=1), 32 * (x * x).sum(axis=1)) and np.allclose(embeddings.hadamard(y), 32 * x)


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- ad <p>no</p> -->
<article><h1>A &amp; B</h1><p><b>First<br><p>Second   part &eacute;&#8212;x
of it<div class="share">Share</div><p>Repeated</p><form>Search</form><section class="comments"><p>nice</p></section></article>
<aside>More</aside><footer>&copy; site</footer></body></html>"""


def test_article_text(spark):
    rows = [(1, "http://a.example/1", PAGE), (2, None, None), (3, "bad url", ""), (4, "http://a.example/2", "<p>a<p>b&am"), (5, "http://a.example/1", PAGE)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, template int")
    got = {r.page_id: r for r in htmltext.extract_text(df).collect()}
    assert got[1].text == "A & B\nFirst\nSecond part é—x of it\nShare\nRepeated" == got[5].text and got[1].n_chars == len(got[1].text)
    assert got[2].text == "" == got[3].text and got[4].text == "a\nb&am" and got[2].url is None
    assert htmltext.extract_text(df.where("false")).count() == 0


def test_template_subtrees_go(spark):
    body = "<div><span>Brand of the site</span><a>Start</a></div><div><p>{}</p><p>{}</p></div><div><i>All rights</i></div>"
    rows = [(i, f"https://h.example/{i}", body.format(f"text {i}", f"more {i * 7}")) for i in range(8)]
    rows.append((9, "https://other.example/", body.format("text", "more")))
    got = {r.page_id: r.text for r in htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"text {i}\nmore {i * 7}" for i in range(8))
    assert got[9] == "Brand of the siteStart\ntext\nmore\nAll rights"


def test_pages_equal_what_they_were_made_of(spark):
    """Pages of hosts with and without article elements, a notice in each article, and a copied article."""
    rng = np.random.default_rng(3)
    text = lambda n: " ".join("".join(rng.choice(list("abcdeiou"), rng.integers(1, 8))) for _ in range(n))
    copied = [text(12) for _ in range(3)]
    rows, want = [], {}
    for page in range(60):
        host, own = ("with", "without")[page % 2], [text(rng.integers(5, 30)) for _ in range(rng.integers(2, 6))]
        own = copied if page % 10 == 4 else own
        notice = f"<p>Subscribe to {host}</p>"
        body = "".join(f"<p>{x}</p>" if k else f"<h1>{x}</h1>" for k, x in enumerate(own))
        menu = f"<div class='top'><a>Start</a><a>{host} news</a></div>"
        inner = f"<article>{body}{notice}<div class='comment'><p>{text(4)}</p></div></article>" if host == "with" else f"<div>{body}</div>"
        rows.append((page, f"https://{host}.example/{page}", f"<html><body>{menu}{inner}<div><i>All rights of {host}</i></div></body></html>"))
        want[page] = "\n".join(own)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in htmltext.extract_text(df).collect()} == want


def test_names_within_longer_names_say_nothing():
    page = "<article><section id='share-prices'><p>Prices rose</p></section><div class='widget social'><p>and fell</p></div></article>"
    root = htmltext.parse(page)
    htmltext.digest(root)
    assert htmltext.main_text(root, set()) == "Prices rose\nand fell"


BROKEN = ['<a b="x" ', "<a ", "<!--", "<a b='", '<a b=">', "<p>", "<table><tr><td>", "< ", "<script>", "<i></b>"]


@pytest.mark.parametrize("piece", BROKEN)
def test_broken_pages_of_a_megabyte_take_seconds(piece):
    began = time.process_time()
    root = htmltext.parse(piece * ((1 << 20) // len(piece)) + "<i>" * 20_000 + "</b>" * 20_000)
    htmltext.digest(root)
    htmltext.main_text(root, set())
    assert time.process_time() - began < 30


@pytest.mark.parametrize("text", ["", "<", "<p", "<p a='x>y'>z", "</p>x", "<script>a", "<!--", "a<b>c</i>d", "<li>1<li>2", "&#0;&#x110000;&bogus;", "<p>" * 3000 + "x"])
def test_odd_markup_does_not_crash(text):
    root = htmltext.parse(text)
    htmltext.digest(root)
    htmltext.candidates(root)
    assert isinstance(htmltext.main_text(root, set()), str)


def test_queries_are_registered():
    assert [f"op{n}_" for n in range(1, 11)] == sorted({q.split("_")[0] + "_" for q in llm_queries.QUERIES if q.startswith("op")}, key=lambda x: int(x[2:-1]))
