"""Learned and search operators against brute force, gradients and held-out labels."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import ann, html_text, mixing, queries, textkit, toxicity
from tests.conftest import SF001, SF01

ODD = [(0, ""), (1, None), (2, " \n "), (3, "a"), (3, "a"), (None, "word " * 40), (4, "x" * 4000), (5, "été " * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 9, "q") for i, t in ODD], "doc_id long, text string, score int, tokens string")


# --- nearest neighbours ------------------------------------------------------------------

def brute_nearest(rows, is_query, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in ok:
        if is_query(q):
            near = sorted((-(x @ y) / np.sqrt((x @ x) * (y @ y)), j) for j, y in ok if j != q)
            out[q] = [(j, -s) for s, j in near[:k]]
    return out


def test_recall_against_brute_force(spark):
    vectors = spark.read.parquet(f"{SF01}/embeddings.parquet")
    got = {}
    for r in queries.op4_nearest_neighbours(spark, SF01).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_nearest([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 50 == 0, 5)
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        hits += len({r[1] for r in rows} & {j for j, _ in want[q]})
        exact = dict(want[q])
        assert all(abs(exact[r[1]] - r[2]) < 1e-12 for r in rows if r[1] in exact)
    assert hits >= 0.9 * 5 * len(want)


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]),
            (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, []), (9, [1.0]), (None, [1.0, 1.0]), (100, [0.0, 0.0]), (50, [1.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.PermutationIndex(table).search(F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 6), (0, 2, 7), (0, 3, 50), (0, 4, 50), (50, 1, 0), (50, 2, 6), (50, 3, 7)]
    assert ann.PermutationIndex(table.limit(0)).search(F.col("vec_id") % 50 == 0).count() == 0


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(0)
    prefix = np.array([rng.permutation(12)[:5] for _ in range(40)])
    files = ann.InvertedFiles(prefix, 12)
    query = rng.permutation(12)[:5]

    def places(p):
        out = np.full(12, 5)
        out[p] = np.arange(5)
        return out

    footrule = np.array([np.abs(places(p) - places(query)).sum() for p in prefix])
    assert (footrule == 5 * 6 - 2 * files.saving(query)).all()


# --- toxicity ------------------------------------------------------------------------------

def test_gradients_equal_differences():
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(6, toxicity.WORD_SIZE + toxicity.CHAR_SIZE)), np.zeros((1, toxicity.WORD_SIZE + toxicity.CHAR_SIZE))])
    index = rng.integers(0, 6, (3, 5))
    index[1, 3:] = -1
    weight = rng.normal(size=3)
    _, kept = net.forward(x, index, keep=True)
    grads, d_x = net.backward(kept, weight)
    for name, g in grads.items():
        flat, at = net.p[name].reshape(-1), rng.integers(0, net.p[name].size)
        old = flat[at]
        values = []
        for step in (1e-3, -1e-3):
            flat[at] = old + step
            values.append(net.forward(x, index) @ weight)
        flat[at] = old
        assert abs((values[0] - values[1]) / 2e-3 - np.asarray(g).reshape(-1)[at]) < 1e-3, name
    values = []
    for step in (1e-3, -1e-3):
        y = x.copy()
        y[2, 4] += step
        values.append(net.forward(y, index) @ weight)
    assert abs((values[0] - values[1]) / 2e-3 - d_x[2, 4]) < 1e-3


def test_windows_cover_and_overlap():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = toxicity.windows(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))
        assert all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_toxicity_on_held_out_labels(spark):
    got = queries.op6_toxicity(spark, SF01).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    clean = [s for s, y in held if y == 0]
    assert np.mean([s < 0.5 for s in clean]) >= 0.95


def test_toxicity_learns_prefixes_and_words():
    rng = np.random.default_rng(5)
    filler = ["".join(rng.choice(list("aeiorstnl"), 5)) for _ in range(300)]

    def text(toxic):
        w = list(rng.choice(filler, rng.integers(30, 200)))
        for _ in range(3 * toxic):
            w[rng.integers(0, len(w))] = "zvqk" + str(rng.choice(filler))
        return " ".join(w)

    y = [int(i % 4 == 0) for i in range(600)]
    model = toxicity.train([text(t) for t in y], y)
    test = [int(i % 2) for i in range(100)]
    data, offsets = textkit.buffers(pa.array([text(t) for t in test] + [""]))
    s = toxicity._score_chunk(model, data, offsets)
    assert np.mean((s[:-1] >= 0.5) == np.array(test, bool)) >= 0.95 and s[-1] < 0.5


def test_toxicity_of_odd_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(2, None), (None, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        got = toxicity.toxicity(docs, labels).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert {r.predicted for r in got if r.doc_id in (0, 1, 2)} == {0}
    assert toxicity.toxicity(docs.limit(0), some).count() == 0


# --- mixing --------------------------------------------------------------------------------

def test_rates_meet_feasible_targets(spark):
    rng = np.random.default_rng(0)
    p, t = rng.dirichlet([0.4, 0.3, 0.3], 500), rng.integers(0, 900, 500)
    members = spark.createDataFrame([(int(n), [float(v) for v in row]) for n, row in zip(t, p)], "tokens long, posterior array<double>")
    targets = np.array([0.6, 0.1, 0.3]) * t.sum()
    steps = mixing.fit_rates(members, list(targets))
    rates = np.array([r[0] for r in members.select(mixing.rate_of(steps, 3, None)).collect()])
    r = np.ones(500)
    for y in steps:
        r = np.maximum(r - p @ y, 0)
    assert np.allclose(sorted(rates), sorted(r)) and (rates >= 0).all()
    assert np.abs((r * t) @ p - targets).max() <= 2e-4 * t.sum()
    capped = mixing.fit_rates(members, list(targets), max_rate=1.0)
    assert max(x[0] for x in members.select(mixing.rate_of(capped, 3, 1.0)).collect()) <= 1.0


def test_mixing_real_documents(spark):
    rows = queries.op2_source_mixing(spark, SF01).collect()
    assert len(rows) == 1000
    t, r, p = (np.array([x[c] for x in rows]) for c in ("tokens", "rate", "posterior"))
    got = (t * r) @ p / t.sum()
    want = [queries.MIX_WEIGHTS[d] for d in sorted(queries.MIX_WEIGHTS)]
    assert np.abs(got - want).max() < 0.01 and (r >= 0).all()
    copies = np.array([x.copies for x in rows])
    assert (np.abs(copies - r) < 1).all()


def test_posteriors_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), queries.labelled_domains(spark.read.parquet(f"{SF01}/labels.parquet"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = mixing.fit(docs, labels.where(~fold), ["clean", "low", "toxic"])
    got = mixing.posteriors(docs, model, ["doc_id"]).join(labels.where(fold), "doc_id").where("domain IN ('clean', 'low')").collect()
    right = [(x.posterior[0] >= x.posterior[1]) == (x.domain == "clean") for x in got]
    assert np.mean(right) >= 0.9


def test_mixing_odd_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, domain string")
    got = mixing.mix(docs, none, {"a": 0.5, "b": 0.5}, carry=docs.columns).collect()
    assert len(got) == len(ODD) and all(r.posterior == [0.5, 0.5] and r.rate >= 0 for r in got)
    assert mixing.mix(docs.limit(0), none, {"a": 0.5, "b": 0.5}).count() == 0


# --- html ------------------------------------------------------------------------------------

ARTICLE = ("<html><head><title>T</title><style>p{{}}</style><script>var t=\"</p>\";</script></head><body><nav><ul><li><a href=/a>{m}</a></li></ul></nav>"
           "<!-- x <p>no</p> --><div class=\"ad\">Buy {m}.</div><article><h1>Head &amp; {i}</h1><p><b>One {i}.<br><p>Two &lt;b&gt;\n  x&nbsp;y {i}</p>{more}"
           "<div class='comments'><p>me too {i}</p></div></article><aside>s {i}</aside><footer>&copy; site</footer></body></html>")


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_article_pages(spark):
    rows = [(i, f"https://a.example.com/{i}", ARTICLE.format(i=i, m="menu", more="<ul><li>L1</li><li>L2</li></ul>" * (i % 3))) for i in range(12)]
    for r in html_text.extract(pages_of(spark, rows)).collect():
        i = r.page_id
        assert r.text == "\n\n".join([f"Head & {i}", f"One {i}.", f"Two <b> x y {i}"] + ["L1", "L2"] * (i % 3))
        assert r.n_chars == len(r.text)


def test_constant_nodes_are_template_without_an_article(spark):
    html = "<body><div class=top><p>Welcome to our site</p></div><div class=txt><p>Story {i} begins.</p><p>It ends {i}.</p></div><div class=end>All rights</div></body>"
    rows = [(i, "http://b.example.com/x", html.format(i=i)) for i in range(8)]
    assert {r.text for r in html_text.extract(pages_of(spark, rows)).collect()} == {f"Story {i} begins.\n\nIt ends {i}." for i in range(8)}


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://c.d/", "plain & <text"), (None, "http://c.d/", "<p>a<p>b"), (5, "http://c.d/", "<div><p>unclosed <b>x"),
            (6, "http://c.d/", "<script>no"), (6, "http://c.d/", "<script>no"), (7, "http://c.d/", "<p>" + "w " * 50000 + "</p>")]
    got = {(r.page_id, r.n_chars) for r in html_text.extract(pages_of(spark, rows)).collect()}
    assert {(1, 0), (2, 0), (6, 0), (7, 99999)} <= got
    assert html_text.extract(pages_of(spark, rows).limit(0)).count() == 0


def test_every_skeleton_shapes_the_wrapper(spark):
    """Nearly every page has its own block order; rare and long ones keep their text."""
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for i in range(150):
        kinds = rng.choice(["p", "ul", "table", "blockquote"], 2 + i % 14)
        body, texts = "", []
        for j, kind in enumerate(kinds):
            texts.append(f"{kind} {j} of {i}")
            body += {"p": "<p>{}</p>", "ul": "<ul><li>{}</li></ul>", "table": "<table><tr><td>{}</td></tr></table>",
                     "blockquote": "<blockquote><p>{}</p></blockquote>"}[kind].format(texts[-1])
        rows.append((i, "http://e.example.com/x", f"<body><div class=top><p>Welcome</p></div><div class=txt>{body}</div></body>"))
        want[i] = "\n\n".join(texts)
    fan, html_text.FAN = html_text.FAN, 8  # three levels of partial wrappers
    try:
        got = {r.page_id: r.text for r in html_text.extract(pages_of(spark, rows)).collect()}
    finally:
        html_text.FAN = fan
    assert got == want
    assert {r.page_id: r.text for r in html_text.extract(pages_of(spark, rows)).collect()} == want


def test_article_regions_hold_page_by_page(spark):
    """Two layouts on one host, and a notice that is constant inside the articles."""
    article = "<body><div class=top><p>Menu {i}</p></div><article><div class=box>Read our terms</div><p>Story {i}</p></article></body>"
    post = "<body><div class=post><p>Post {i}</p><table><tr><td>cell {i}</td></tr></table></div></body>"
    rows = [(i, url, (post if i % 3 else article).format(i=i)) for i in range(12) for url in (None, "http://f.example.com/x")]
    got = {(r.page_id, r.text) for r in html_text.extract(pages_of(spark, rows)).collect()}
    assert got == {(i, f"Post {i}\n\ncell {i}" if i % 3 else f"Story {i}") for i in range(12)}


def test_copies_of_one_article_keep_their_text(spark):
    rows = [(i, "http://g.example.com/x", f"<body><nav>m {i}</nav><article><h1>Head</h1><p>Same story</p></article></body>") for i in range(6)]
    assert {r.text for r in html_text.extract(pages_of(spark, rows)).collect()} == {"Head\n\nSame story"}


def test_only_real_attributes_name_a_role():
    label = html_text._label
    assert label("div", ' style="overflow: hidden" title="a hidden gem" data-class="nav"') == "div"
    assert label("div", " CLASS='nav top' class=x id=main-box hidden") == "div.!hidden.box.main.nav.top"
    assert label("p", ' title = "x class=nav" hidden=""') == "p.!hidden"
    assert label("div", ' class="overflow-hidden has-sidebar no-nav a"') == "div.a.overflow"


@pytest.mark.parametrize("opening", [
    '<body class="no-sidebar">', '<body class="fixed-header">', '<body><div class="layout has-sidebar">', '<body><div class="header-top wrap">',
    '<body><div class="sidebar-left"><div class="nav-open">', '<body><form id=all>', '<body style="overflow: hidden"><div title="a hidden gem">'])
@pytest.mark.parametrize("element", ["article", "main"])
def test_layout_words_do_not_reject_an_article(opening, element):
    page = (f"{opening}<nav>menu</nav><div class=sidebar><article>teaser {{i}}</article></div>"
            f"<{element}><p title='a hidden gem'>Story {{i}}</p><div hidden>x {{i}}</div></{element}>")
    form = [html_text.parse(page.format(i=i)) for i in range(5)]
    wrapper = html_text.to_json(html_text.induce([(html_text.collapse(form[0]), [
        {"pages": 5, "chars": 5, "links": 0, "low": "a", "high": "b"} for _ in html_text.preorder(form[0])])]))
    assert html_text.page_text(page.format(i=3), wrapper) == "Story 3"


def test_an_article_in_a_sidebar_does_not_shut_out_the_post(spark):
    rows = [(i, "http://h.example.com/x", f"<body><div class=sidebar><article>teaser {i}</article></div><div class=post><p>Post {i}</p></div></body>")
            for i in range(6)]
    assert all(f"Post {r.page_id}" in r.text for r in html_text.extract(pages_of(spark, rows)).collect())


def test_simple_tree_matching_is_the_largest_mapping():
    a = html_text.shape_of("(r(x(p)(q))(y)(x(p)))")
    b = html_text.shape_of("(r(y)(x(p)(z)(q)))")
    assert html_text.match(a, b, {})[0] == 4  # r, y, x, p
    html_text.merge(a, b, {})
    assert [s.label for s in html_text.shapes(a)] == ["r", "x", "p", "q", "y", "x", "p", "z", "q"]


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, SF001)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        kept = kept.cache()
        ids = [r.doc_id for r in kept.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "personal_data":
            assert len(ids) == before.count() and kept.where("text LIKE '%@mail%.example.com%'").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF001)
    assert pieces.select("doc_id").distinct().count() == kept.count()
