"""URL filter, main text and vectors against brute force; the pipeline; SQL of this subpackage."""

import html
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from hourboard.llm import html_text, url_filter, vector_join
from hourboard.llm.queries import ORACLE
from hourboard.llm.shared import components, stored

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, host string, kind string, score string, id long"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    found = queries()[name](spark, "/root/testdata/sf0.01").select(*columns).collect()
    assert Counter(map(tuple, found)) == Counter(cursor.fetchall())


# URLs


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


def plain_rule(host, path):
    fits = [
        rule
        for rule, _ in url_filter.RULES
        for rule_host, rule_path in [rule.split("/", 1)]
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path)
    ]
    return max(fits, key=len, default=None)


def plain_scores(seen, texts):
    """Witten-Bell mixtures of all orders, by dictionaries."""
    counts = {"allow": Counter(), "block": Counter()}
    for text, kind, weight in seen:
        padded = url_filter.START * url_filter.ORDER + text
        for k in range(len(text)):
            for order in range(url_filter.ORDER + 1):
                end = k + url_filter.ORDER
                counts[kind][padded[end - order : end], padded[end]] += weight
    contexts = {kind: {} for kind in counts}
    for kind, found in counts.items():
        for (context, _), n in found.items():
            total, kinds = contexts[kind].get(context, (0, 0))
            contexts[kind][context] = total + n, kinds + 1

    def p(kind, context, letter):
        value = 1 / url_filter.ALPHABET
        for order in range(url_filter.ORDER + 1):
            own = context[len(context) - order :]
            total, kinds = contexts[kind].get(own, (0, 0))
            if kinds:
                value = (counts[kind][own, letter] + kinds * value) / (total + kinds)
        return value

    found = {}
    for text in texts:
        padded = url_filter.START * url_filter.ORDER + text
        pairs = [(padded[k : k + url_filter.ORDER], padded[k + url_filter.ORDER]) for k in range(len(text))]
        ratios = [math.log(p("allow", c, x)) - math.log(p("block", c, x)) for c, x in pairs]
        found[text] = sum(ratios) / len(text) if text else 0.0
    return found


def check_urls(spark, rows, found):
    parts = [(page_id, *plain_parts(url)) for page_id, url in rows]
    rules = [(i, h, p, plain_rule(h, p)) for i, h, p in parts]
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in found) == Counter(rules)
    kinds = dict(url_filter.RULES)
    assert all(r.verdict == kinds[r.rule] for r in found if r.rule)
    weights = Counter((h + p, kinds.get(r)) for _, h, p, r in rules)
    hashed = spark.createDataFrame([(t,) for t, _ in weights], "t string").selectExpr("t", "pmod(xxhash64(t), 4) = 0 AS held_out")
    held_out = dict(map(tuple, hashed.collect()))
    seen = [(t, k, n) for (t, k), n in weights.items() if k and not held_out[t]]
    expected = plain_scores(seen, {t for (t, k) in weights if not k})
    free = [r for r in found if r.rule is None]
    for r in free:
        assert r.score == pytest.approx(expected[r.host + r.path], abs=1e-9)
    assert {r.verdict for r in free} <= {"allow", "block"}
    allowed = [r.score for r in free if r.verdict == "allow"]
    blocked = [r.score for r in free if r.verdict == "block"]
    assert not allowed or not blocked or min(allowed) >= max(blocked)


def test_url_query(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    check_urls(spark, rows, queries()["op4_url_filter"](spark, SMALL).collect())


def test_urls_of_odd_rows(spark):
    urls = [
        None, "", "no scheme.org/en", "http://", "http://org/", "https://ORG", "http://a.org?q=/x", "http://EXAMPLE.org/es/1#x",
        "x://y://z.com/fr/", "http://b.com/fr/1", "http://b.com/FR/1", "http://c.com/de/", "http://Éa.com/de/",
        "http://example.org/en/1", "http://sub.example.org/en/12", "http://notexample.org/es/", "http://acom/fr/",
        "http://q.net/" + "a" * 5000, "http://a.net/x\ny?z", "http://a.net/x\ny?z", "http://[::1]:80/p",
    ]
    rows = [(k if k % 5 else None, url) for k, url in enumerate(urls)]
    table = spark.createDataFrame([(*r, *[None] * 6) for r in rows], PAGES)
    check_urls(spark, rows, url_filter.url_filter(table).collect())
    assert url_filter.url_filter(table.limit(0)).count() == 0


def test_urls_are_not_broadcast(spark):
    """Only scores by characters and those of hot urls are, whatever size Spark takes the other tables for."""
    rows = [(k, f"http://a{k % 7}.{'com' if k % 3 else 'net'}/{'fr' if k % 2 else 'de'}/{k}") for k in range(40)]
    texts = stored(spark.createDataFrame([(r[1],) for r in rows], "text string"), "texts")
    seen = stored(url_filter.windows(texts).select("gram", F.lit(1).alias("yes"), F.lit(2).alias("no")).distinct(), "seen")
    for frame, broadcast, merged in (
        (url_filter.scores(texts, seen), 3, 9),
        (url_filter.url_filter(stored(spark.createDataFrame(rows, "page_id long, url string"), "pages")), 2, 1),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert (plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")) == (broadcast, merged)


# Main text


def test_html_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = queries()["op5_html_text"](spark, SMALL).collect()
    assert {r.page_id for r in found} == set(pages)
    for r in found:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in blocks]
        assert r.text == " ".join(filter(None, blocks))
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b<!-- never closed", "a b"),
        ("<p>a</p><div class='", "a"),
        ("<script>var x = '<p>no</p>';</script><style>p{}</style>", ""),
        ("<p>one<b>two</b> three<br>four\n\t five</p>", "onetwo three four five"),
        ("<p>5 &lt; 6 &eacute;&#233;&#xE9; &nbsp; x</p>", "5 < 6 ééé x"),
        ("<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>", "one two c1 c2"),
        ("</p></div></b>text</article>", "text"),
    ],
)
def test_main_text_of_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_main_text_leaves_the_rest_out():
    story = "A sentence of the article that goes on for quite a while, as sentences in articles do. "
    page = f"""<html><body class="no-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
    <nav><a href=x>Home</a></nav><div id="page"><article><h1>Title</h1><p>{story * 3}<p>Short.
    <div class="ad-box"><p>{story * 4}</div><p>End of it.</p><form><label>Name</label><input></form>
    <section id="comments"><p>{story * 5}</p></section></article><aside>{story}</aside></div>
    <div class="sidebar">{story}</div><footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page) == f"Title {(story * 3).strip()} Short. End of it."


def test_main_text_without_an_article():
    story = "A sentence of the text that goes on for quite a while, as sentences in pages do. "
    page = f"<body><div><p>{story * 3}</p><p>Short.</p></div><div><a href=a>More</a> <a href=b>Older</a></div></body>"
    assert html_text.main_text(page) == f"{(story * 3).strip()} Short."


STORY = "A sentence of the text that goes on for quite a while, as sentences in pages do."


def test_main_text_keeps_content_whatever_its_class_or_id_says():
    page = f"""<body><div class="menu"><a href=a>Home</a> <a href=b>News</a></div><article><h1>Title</h1><p>{STORY * 3}</p>
    <h2 id="Header_files">Header files</h2><p>{STORY} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>
    <section id="discussion"><h2>Discussion</h2><p>{STORY * 3}</p></section>
    <div class="related social"><a href=c>Other</a> <a href=d>Share</a></div><p>{STORY * 2}</p></article></body>"""
    text = f"Title {STORY * 3} Header files {STORY} x=2 Discussion {STORY * 3} {STORY * 2}"
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize("sizes", [(6, 2, 2), (5, 3, 2), (2, 6, 2), (8, 2)])
def test_main_text_of_several_regions(tag, sizes):
    paragraph = f"<p>{STORY * 3}</p>"
    parts = "".join(f"<{tag}>{paragraph * n}</{tag}>" for n in sizes)
    page = f"<body><nav><a href=a>Home</a></nav>{parts}{paragraph * 2}<footer>&copy;</footer></body>"
    assert html_text.main_text(page) == " ".join([STORY * 3] * (sum(sizes) + 2))


def test_html_of_odd_rows(spark):
    rows = [(1, None, "<p>x"), (None, "u", None), (1, None, "<p>x"), (2, "v", "<p>" + "long " * 200_000)]
    table = spark.createDataFrame([(*r, *[None] * 5) for r in rows], PAGES)
    found = Counter((r.page_id, r.url, r.n_chars) for r in html_text.extract(table).collect())
    assert found == Counter({(1, None, 1): 2, (None, "u", 0): 1, (2, "v", 999_999): 1})
    assert html_text.extract(table.limit(0)).count() == 0


def test_two_means():
    assert html_text.content(np.array([1.0, 2, 1, 50, 60, 2])).tolist() == [False, False, False, True, True, False]
    assert html_text.content(np.array([3.0, 3])).tolist() == [True, True]
    assert html_text.smoothed(np.full(5, 2.0)) == pytest.approx(np.full(5, 2.0))


# Vectors


def check_vectors(found, rows, limit=0.9):
    fine = []
    for k, (_, v) in enumerate(rows):
        v = None if v is None or any(x is None for x in v) else np.array(v, float)
        if v is not None and len(v) and np.isfinite(v).all() and v.any():
            fine.append((k, v))
    links = [0] * len(rows)
    label = list(range(len(rows)))
    for a, (i, x) in enumerate(fine):
        for j, y in fine[a + 1 :]:
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if len(x) == len(y) and (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= limit:
                links[i] += 1
                links[j] += 1
                same = True
            if same:
                old, new = label[j], label[i]
                label = [new if m == old else m for m in label]
    least = {}
    for k, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[label[k]] = min(least.get(label[k], vec_id), vec_id)
    usable = {k for k, _ in fine}
    expected = Counter()
    for k, (vec_id, _) in enumerate(rows):
        component = least.get(label[k]) if k in usable else vec_id
        expected[vec_id, links[k], component, vec_id == component] += 1
    assert Counter(map(tuple, found)) == expected


@pytest.mark.parametrize("per_pivot, block, stride", [(2048, 8192, 1024), (20, 30, 7)])
def test_vector_join(monkeypatch, spark, per_pivot, block, stride):
    for name, value in (("PER_PIVOT", per_pivot), ("BLOCK", block), ("STRIDE", stride)):
        monkeypatch.setattr(vector_join, name, value)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.25).tolist()) for i in range(240)]
    rows += [(900, None), (901, [0.0] * 8), (902, [math.nan] * 8), (903, [math.inf] + [1.0] * 7), (904, [None] * 8), (905, [])]
    rows += [(906, rows[3][1]), (907, rows[3][1]), (None, rows[3][1]), (None, None), (908, [1e30] * 8), (909, [2e30] * 8)]
    rows += [(910, [1.0, 2.0]), (911, [1.0, 2.0, 0.0]), (912, [-0.0, 2.0]), (913, [0.0, 2.0])]
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    table = spark.createDataFrame([(*r, None, None, None) for r in rows], "vec_id long, embedding array<float>, label int, id long, copies long")
    check_vectors(vector_join.vector_join(table).collect(), rows)
    assert vector_join.vector_join(table.limit(0)).count() == 0


def test_vectors_are_not_replicated(monkeypatch, spark):
    """However many cells a vector is compared with, it is stored in one block, and pairs of blocks are not shuffled."""
    tables, plans = {}, {}

    def kept(frame, name, stored=vector_join.stored):
        plans[name] = frame._jdf.queryExecution().executedPlan().toString()
        tables[name] = stored(frame, name)
        return tables[name]

    for name, value in (("PER_PIVOT", 10), ("BLOCK", 15), ("FILE_BYTES", 2000), ("stored", kept)):
        monkeypatch.setattr(vector_join, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(200)]
    rows += [(i + 200, [x * 1.01 + 1e-3 for x in v]) for i, v in rows[:20]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    check_vectors(vector_join.vector_join(table).collect(), rows)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batches
    blocks = tables["vector-blocks"].collect()
    assert len(blocks) > 20 and sum(len(r.ids) for r in blocks) == 8 * len(rows)
    assert "CartesianProduct" in plans["vector-links"] and "Exchange" not in plans["vector-links"]


def test_single_precision_candidates_may_all_fail(spark):
    """Pairs just below the bound pass in single precision, and none is confirmed."""
    rows = [(k, [math.cos(t), math.sin(t)]) for k, t in enumerate([0.0, math.acos(0.9) + 1e-6])]
    check_vectors(vector_join.vector_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)


@pytest.mark.parametrize("width", [3, 64])
def test_pivots_that_are_copies_of_one_direction_lose_no_partner(width):
    """Vectors about one direction, dealt over the cells of two scaled copies of it."""
    lost = links = 0
    for seed in range(40):
        rng = np.random.default_rng(seed)
        centre = rng.normal(size=width).astype(np.float32)
        pivots = np.stack([centre, centre * np.float32(3.3)]).astype(float)
        around = rng.normal(size=(300, width)) * rng.choice([0.02, 0.1, 0.4], size=(300, 1)) + centre
        units = vector_join.unit(around)
        cells = vector_join.Cells(vector_join.unit(pivots), 0.9)
        home, far = cells.homes(units)
        visits = cells.visited(home, far)
        linked = np.triu(units @ units.T >= 0.9, 1) & (home[:, None] != home[None, :])
        met = visits[:, home] | visits[:, home].T
        links += linked.sum()
        lost += (linked & ~met).sum()
    assert links > 1000 and not lost


def test_vector_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_vectors(queries()["op7_vector_join"](spark, SMALL).collect(), rows)


def test_components_of_long_chains(spark):
    nodes = spark.range(300)
    edges = spark.createDataFrame([(k, k + 1) for k in range(99)] + [(150, k) for k in range(151, 300)], "a long, b long")
    found = dict(map(tuple, components(nodes, edges).collect()))
    assert {found[k] for k in range(100)} == {0} and {found[k] for k in range(150, 300)} == {150}
    assert all(found[k] == k for k in range(100, 150))


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    counts, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
            assert not docs.exceptAll(before).count()
        if name == "quality":
            left = {r.doc_id for r in docs.collect()}
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in left for d in good) >= 0.99 * len(good)
        if name == "exact_dedup":
            assert docs.select("text").distinct().count() == docs.count() == before.select("text").distinct().count()
    assert counts[0] > counts[1] >= counts[2] > counts[3] >= counts[4]
    kept = {r.doc_id for r in before.collect()}
    assert {r.doc_id for r in docs.collect()} == kept


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.count() == 0
