"""Toxicity, line quality and HTML blocks: planted cases, edge cases, and held-out accuracy."""

import html
import math
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from compare import MEDIUM

from sedimenta.llm import block_labeller, line_quality, toxicity
from sedimenta.llm.common import read_table
from sedimenta.llm.html_blocks import leaves
from sedimenta.llm.labelled import held_out, training_sample
from sedimenta.llm.queries import QUERIES

EDGE = ["", None, " \n ", "word", "a\n\n\nb", "x " * 30_000, "!!! ||| ###"]


def accuracy(spark, name, label):
    rows = QUERIES[name](spark, "/root/testdata/sf0.1").toPandas()
    truth = read_table(spark, "/root/testdata/sf0.1", "labels").toPandas()
    both = rows.merge(truth, on="doc_id")
    both = both[both.held_out]
    assert rows.score.between(0, 1).all() and len(rows) == 10_000
    return both, (both.predicted == both[label]).mean()


def test_toxicity_on_the_held_out_fold(spark):
    both, right = accuracy(spark, "op4_toxicity", "toxic")
    assert right >= 0.95
    assert (both[both.toxic == 0].predicted == 0).mean() >= 0.99


def test_quality_on_the_held_out_fold(spark):
    both, right = accuracy(spark, "op8_line_quality", "quality")
    assert right >= 0.98
    assert (both[both.quality == 1].predicted == 1).mean() >= 0.99


def test_held_out_rows_are_a_fifth(spark):
    import zlib
    rows = spark.range(500).selectExpr("id as doc_id").select("doc_id", held_out().alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


@pytest.mark.parametrize("module, name", [(toxicity, "toxic"), (line_quality, "quality")])
def test_edge_cases_and_other_columns(documents, labels, module, name):
    rows = [*enumerate(EDGE), (None, "no id"), (3, "word")]
    docs = documents(rows, True)
    known = labels([(i, i % 2, i % 2) for i in range(7)] + [(1, None, None), (None, 1, 1), (99, 1, 1)])
    for model in (module.fit(docs, known), module.fit(docs, labels([]))):
        scored = module.score(docs, model)
        assert scored.columns == [*docs.columns, module.SCORE]
        values = [r[module.SCORE] for r in scored.collect()]
        assert len(values) == len(rows) and all(0 <= v <= 1 for v in values)
    assert module.score(documents([]), model).count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    offsets = np.array([0, 3, 3, 4, 9])
    good, pairs = rng.normal(size=9), rng.normal(size=(2, 2))
    marginals, expected, _ = line_quality.forward_backward(good, pairs, offsets)
    sums = np.zeros((2, 2))
    for a, b in zip(offsets[:-1], offsets[1:]):
        if a == b:
            continue
        paths = [[p >> k & 1 for k in range(b - a)] for p in range(1 << (b - a))]
        weight = np.array([np.exp(sum(good[a + k] * y for k, y in enumerate(p))
                                  + sum(pairs[u, v] for u, v in zip(p, p[1:]))) for p in paths])
        weight /= weight.sum()
        assert np.allclose(marginals[a:b, 1], (np.array(paths) * weight[:, None]).sum(0))
        for p, w in zip(paths, weight):
            for u, v in zip(p, p[1:]):
                sums[u, v] += w
    assert np.allclose(expected, sums)


def test_lines_of_one_text_do_not_touch_another():
    alone = line_quality.line_features(pa.array(["ok line.\nbad || line"], pa.large_string()))[0]
    both = line_quality.line_features(pa.array(["zz", "ok line.\nbad || line"], pa.large_string()))[0]
    assert np.allclose(alone, both[1:])


def test_lstm_slopes_equal_differences():
    rng = np.random.default_rng(1)
    model = block_labeller.Labeller.start(3)
    x, sizes = rng.normal(size=(9, block_labeller.INPUTS)), np.array([4, 0, 5])
    truth, weight = rng.integers(0, 2, 9).astype(float), np.full(9, 1 / 9)

    def loss():
        p = block_labeller.Run(model, x, sizes).probability
        return -np.sum(weight * (truth * np.log(p) + (1 - truth) * np.log(1 - p)))

    for values, slope in zip(model.parameters(), block_labeller.Run(model, x, sizes).gradients(truth, weight)):
        for at in [tuple(rng.integers(0, n) for n in values.shape) for _ in range(6)]:
            old = values[at]
            values[at] = old + 1e-5
            up = loss()
            values[at] = old - 1e-5
            down = loss()
            values[at] = old
            assert abs((up - down) / 2e-5 - slope[at]) < 1e-6


def test_leaves_of_broken_markup():
    page = ("<html><head><title>no</title></head><body><p>One &amp; <b>two<p>three<br>four</b><ul><li>five<li>six</ul>"
            "<script>var a = '<p>no</p>';</script><!-- no --><td>seven < 8</td><a href='>'>link</a><style>no")
    assert [leaf.text for leaf in leaves(page)] == ["One & two", "three four", "five", "six", "seven < 8", "link"]
    assert leaves(None) == leaves("") == leaves("<!-- never ends") == leaves("<p") == []


def article(source):
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"<[a-zA-Z/!][^>]*>", " ", re.sub(r"</?b>", "", inside))).split())


def test_main_text_of_given_pages_and_of_another_layout(spark):
    pages = read_table(spark, MEDIUM, "pages")
    model = block_labeller.fit(pages)
    source = {r.page_id: r.html for r in pages.collect()}
    rows = block_labeller.extract(pages, model).collect()
    right = [r.text == article(source[r.page_id]) and r.n_chars == len(r.text) for r in rows]
    assert len(rows) == len(source) and np.mean(right) >= 0.99
    body = [article(s) for s in source.values()][:20]
    made = [f"<body><div class='topnav'><a href='/'>Home</a></div><main><h2>{html.escape(t[:60])}</h2><p>{html.escape(t[60:])}</p>"
            f"</main><div class='comments'><p>Bob says great post</p></div><footer>All rights reserved</footer></body>"
            for t in body]
    got = block_labeller.main_texts(made, model)
    assert np.mean([g == f"{t[:60].strip()} {t[60:].strip()}" for g, t in zip(got, body)]) >= 0.8


def test_empty_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, ""), (2, "u", "<p> </p>"), (2, "u", "<p> </p>")],
                                  "page_id long, url string, html string")
    model = block_labeller.fit(pages)
    assert [(r.text, r.n_chars) for r in block_labeller.extract(pages, model).collect()] == [("", 0)] * 4
    assert block_labeller.extract(pages.where("false"), None).count() == 0


INSIDE = ("<div class='container'><div class='row'><div class='col-md-4'><div class='box'><div class='inner wrap'>"
          "<ul class='list-unstyled'><li class='item'><p class='lead small'>")
OUTSIDE = "</p></li></ul>" + "</div>" * 5


def test_the_outermost_names_of_a_long_path_count(spark):
    inner = leaves(f"{INSIDE}x")[0].path
    assert len(inner) >= 18
    one, other = (block_labeller.path_vector(("body", name, *inner), {}) for name in ("main", "footer"))
    assert not np.allclose(one, other)

    pages = read_table(spark, MEDIUM, "pages")
    model = block_labeller.fit(pages)
    texts = [t for t in (article(r.html) for r in pages.select("html").collect()) if len(t) > 450][:40]
    parts = [[("nav class=menu", "<a href='/'>Home</a>"), ("main", html.escape(t[:200])), ("main", html.escape(t[200:])),
              ("section class=comments", "Bob says great post I wrote"),
              ("footer class=site-footer", "Imprint Terms All rights reserved")] for t in texts]
    deep = ["<body>" + "".join(f"<{name}>{INSIDE}{text}{OUTSIDE}</{name.split()[0]}>" for name, text in page)
            for page in parts]
    got = block_labeller.main_texts(deep, model)
    want = [" ".join(f"{t[:200]} {t[200:]}".split()) for t in texts]
    assert np.mean([g == w for g, w in zip(got, want)]) >= 0.8


def test_reading_in_stretches_equals_one_pass(monkeypatch):
    model = block_labeller.Labeller.start(3)
    rng = np.random.default_rng(4)
    pages = [[block_labeller.Leaf(("body", "div", f".n{rng.integers(9)}"), f"word {k} and more.", int(rng.integers(5)))
              for k in range(size)] for size in (1, 1, 3, 7, 40)]
    whole = block_labeller.Run(model, block_labeller.block_inputs(pages), np.array([len(p) for p in pages])).probability
    assert np.allclose(block_labeller.probabilities(model, pages), whole)
    assert np.allclose(block_labeller.probabilities(model, pages[-1:], most=9), whole[-40:])
    together = block_labeller.main_texts(["<p>a<p>b."] * 5, model)
    monkeypatch.setattr(block_labeller, "BLOCKS_AT_ONCE", 3)
    assert block_labeller.main_texts(["<p>a<p>b."] * 5, model) == together


def test_a_page_of_100_000_blocks_beside_short_ones_needs_little_memory():
    model = block_labeller.Labeller.start(3)
    model.label[-1] = 100  # every block is text
    source = "".join(f"<p>{k}" for k in range(100_000))
    tracemalloc.start()
    texts = block_labeller.main_texts([source, *["<p>short"] * 100], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts == [" ".join(map(str, range(100_000))), *["short"] * 100]
    assert peak < 300 << 20


def test_a_very_long_page_is_learned_from_whole(monkeypatch):
    seen = []
    whole = block_labeller.Run

    def run(model, x, sizes):
        seen.append(sizes)
        return whole(model, x, sizes)

    monkeypatch.setattr(block_labeller, "Run", run)
    page = leaves("<main>" + "<p>text of it." * 5000 + "</main><footer>" + "<p>All rights" * 100 + "</footer>")
    block_labeller.fit_labeller([page], epochs=1)
    sizes = np.concatenate(seen)
    assert sizes.max() <= block_labeller.STRETCH and sizes.sum() >= len(page) + 2 * 5000


@pytest.mark.parametrize("page", [
    "<!doctype html><head><title>T</title><body><p>Hello", "<html><head><title>T</title><p>Hello",
    "<head><title>T</title><p>Hello</p>", "<html><head><meta charset=x><link rel=y><title>T</title>Hello",
    "<head><style>p {}</style><script>x</script></head><body>Hello", "<head> <noscript>no</noscript> <a href=x>Hello</a>"])
def test_a_head_may_have_no_end_tag(page):
    assert [leaf.text for leaf in leaves(page)] == ["Hello"]


def test_paths_and_their_vectors_are_those_of_the_plain_names():
    page = "<body class='a b'><div id=a><div class='b c'><p>x<b>y</b></p></div>z</div><ul><li>1<li class=a>2</ul>tail"
    blocks = leaves(page)
    assert [tuple(b.path) for b in blocks] == [
        ("body", ".a", ".b", "div", ".a", "div", ".b", ".c", "p"), ("body", ".a", ".b", "div", ".a"),
        ("body", ".a", ".b", "ul", "li"), ("body", ".a", ".b", "ul", "li", ".a"), ("body", ".a", ".b")]
    known = {}
    for block in blocks:
        assert len(block.path) == len(tuple(block.path)) and block.path.distinct == len(set(block.path))
        assert np.allclose(block_labeller.path_vector(block.path, known), block_labeller.path_vector(tuple(block.path), {}))
    marked = [block_labeller.Leaf(tuple(b.path), b.text, 0) for b in leaves("<main><p>t<nav>n</nav></main><div>d")]
    assert block_labeller.own_labels(leaves("<main><p>t<nav>n</nav></main><div>d")).tolist() == [1, 0, 0]
    assert block_labeller.own_labels(marked).tolist() == [1, 0, 0]


@pytest.mark.parametrize("page", [
    "<div class='wrap n'>x" * 100_000, "<foo>x" * 50_000, "<b>x" * 50_000 + "</u>" * 50_000,
    "<div>" * 50_000 + "</section>" * 50_000 + "end", "".join(f"<div id={'abcdefghij'[n % 10]}{'xyz'[n % 3] * (n % 7)}>t" for n in range(30_000))])
def test_very_deep_pages_are_read_in_seconds(page):
    started = time.thread_time()
    blocks = leaves(page)
    scores = block_labeller.probabilities(block_labeller.Labeller.start(), [blocks])
    block_labeller.own_labels(blocks)
    assert len(scores) == len(blocks) > 0 and time.thread_time() - started < 60


def test_a_very_deep_page_needs_little_memory():
    page = "<div class=a><p>x" * 50_000
    tracemalloc.start()
    blocks = leaves(page)
    vectors: dict = {}
    block_labeller.block_inputs([blocks[-1000:]], known=vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(blocks) == 50_000 and len(vectors) > 50_000 and peak < 300 << 20


def test_samples_are_bounded_in_bytes(spark, documents, labels):
    docs = documents([(n, "w" * (900 if n % 10 else 9000)) for n in range(300)])
    known = labels([(n, 1, n % 2) for n in range(300)])
    every = training_sample(docs, known, "toxic", 1000).collect()
    some = training_sample(docs, known, "toxic", 1000, 100_000).collect()
    assert len(every) > 200 and {len(r.text) for r in every} == {900, 9000}
    assert 60 < sum(len(r.text) for r in some) / 1000 <= 100 and {len(r.text) for r in some} == {900}


@pytest.mark.parametrize("l1", [0.0, 0.5])
def test_ftrl_equals_a_loop_over_coordinates(l1):
    """The update rule against the plain algorithm, one coordinate at a time."""
    draw = np.random.default_rng(5)
    rows = [draw.choice(64, draw.integers(1, 12), replace=False) for _ in range(60)]
    truth = [int(y) for y in draw.integers(0, 2, 60)]
    alpha, beta, l2 = 0.7, 0.9, 0.2
    model = toxicity.fit_ftrl(list(zip(rows, truth)), 6, alpha, beta, l1, l2, epochs=3)

    rate = (sum(truth) + 0.5) / (len(truth) + 1)
    z, n, bias, bias_n = [0.0] * 64, [0.0] * 64, math.log(rate / (1 - rate)), 0.0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(3):
        for row, y in zip(rows, truth):
            held = {i: weight(i) for i in row}
            g = 1 / (1 + math.exp(-(sum(held.values()) + bias))) - y
            for i, w in held.items():
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w
                n[i] += g * g
            bias_n += g * g
            bias -= alpha * g / (beta + math.sqrt(bias_n))
    want = np.array([weight(i) for i in range(64)])
    got = np.zeros(64)
    got[model.index] = model.weight
    assert np.allclose(got, want, atol=1e-6) and math.isclose(model.bias, bias, rel_tol=1e-9)
    assert l1 == 0 or (want == 0).any()
