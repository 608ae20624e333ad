"""Main text of pages: known pages, held-out pages, and a plain LSTM beside the batched one."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from loomvec.llm import block_labeller as bl
from loomvec.llm import queries
from loomvec.llm.html_blocks import blocks_of


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks_and_paths():
    page = "<html><head><title>no</title></head><body class='Home-page'><!-- x --><div id=main><p>One &amp;amp;  two<br>three<p><b>four <a href='>'>five</a></div>tail</body>"
    found = blocks_of(page)
    assert [b.text for b in found] == ["One &amp; two three", "four five", "tail"]
    assert found[0].path >= {"body", ".home", ".page", "div", ".main", "p"} and found[0].tag == "p"
    assert found[1].linked == 4 and found[2].tag == "body"


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), (" \n\t ", []), ("plain text", ["plain text"]), ("a < b & c", ["a < b & c"]), ("<p>", []), ("x<", ["x<"]),
    ("<script>var t='</p><p>no'</script>yes", ["yes"]), ("<script>never closed", []), ("<!-- never closed", []), ("a<!---->b", ["ab"]),
    ("<ul><li>1<li>2<ul><li>3</ul></ul>4", ["1", "2", "3", "4"]), ("</div></p>x</li>", ["x"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("&nbsp;&#x41;&eacute;&unknown;", ["Aé&unknown;"]), ("<p>a</p><p>a</p>", ["a", "a"]), ("<header>h</header><head>no</head>", ["h"]),
    ('<p title="a > b">x</p>', ["x"]), ('<p title="open>x</p><p>y</p>', ["x", "y"]), ("<style>p{}</style><P>Big</P>", ["Big"]), ("a<br>b<hr>c", ["a b", "c"]),
    ("x\x00y", ["x\x00y"]), ("<select><option>no</select>ok", ["ok"]),
])
def test_awkward_markup(page, want):
    assert texts(page) == want


def test_long_and_deep_pages_take_linear_time():
    assert len(texts("<div>" * 50_000 + "x" + "</div>" * 50_000)) == 1
    assert len(texts("<p><b>word" * 50_000)) == 50_000
    assert len(texts("</div>" * 200_000 + "<a " * 200_000)) == 0


@pytest.fixture(scope="module")
def model():
    return bl.fit()


SITES = {
    "tags": "<body><header>My site</header><nav><ul><li><a href=/>Home</a></ul></nav><main><h1>The day</h1><p>It rained, and then it did not.</p><p>Short.</p></main><aside>Most read</aside><footer>&copy; x</footer>",
    "classes": "<body><div class=menu><a href=/>Home</a></div><div class='entry-content'><h1>The day</h1><p>It rained, and then it did not.</p><div class=ad>Buy now</div><p>Short.</p></div><div id=comments><p>Bob says: great post</p></div><div class=footer>imprint</div>",
    "notice": "<body><div class='cookie-notice'><p>This site uses cookies</p><button>Accept</button></div><article><h1>The day</h1><p>It rained, and then it did not.</p><p>Short.</p></article><form><label>Your name</label></form>",
}


@pytest.mark.parametrize("site", SITES)
def test_known_pages(model, site):
    assert bl.main_texts([SITES[site]], model) == ["The day\nIt rained, and then it did not.\nShort."]


def test_unseen_composed_pages(model):
    pages, labels = bl.composed(300, 4242)
    right = np.concatenate([(s >= 0.5) == (y > 0) for s, y in zip(model.scores(pages), labels)])
    assert right.mean() >= 0.995


def test_given_pages_whose_article_is_marked(model):
    pages = pd.read_parquet("/root/testdata/sf0.1/pages.parquet").html.tolist()
    want = ["\n".join(b.text for b in blocks_of(p) if "article" in b.path) for p in pages]
    same = [a == b for a, b in zip(bl.main_texts(pages, model), want)]
    assert np.mean(same) >= 0.999


def plain_scores(blocks, model):
    """Both directions block by block, without batches, padding or parts."""
    s = bl.features([blocks], model.settings)
    x, w = model.vectors(s)[0].astype(float), {k: v.astype(float) for k, v in model.weights.items()}
    z = np.full(len(blocks), w["bias"][0])
    sigmoid = lambda a: 1 / (1 + np.exp(-a))
    for side, order in (("f", range(len(blocks))), ("b", range(len(blocks) - 1, -1, -1))):
        h = c = np.zeros(model.settings.hidden)
        for t in order:
            f, i, o, g = np.split(x[t] @ w["in" + side] + h @ w["re" + side], 4)
            c = sigmoid(f) * c + sigmoid(i) * np.tanh(g)
            h = sigmoid(o) * np.tanh(c)
            z[t] += h @ w["out" + side]
    return sigmoid(z)


def test_batches_and_parts_equal_a_plain_run(model):
    pages, _ = bl.composed(30, 77)
    pages += [[], pages[0] * 40]
    small = bl.Model(model.weights, bl.Settings(cells=50))
    for blocks, a, b in zip(pages, model.scores(pages), small.scores(pages)):
        want = plain_scores(blocks, model)
        assert len(a) == len(b) == len(blocks)
        assert np.allclose(a, want, atol=1e-4) and np.allclose(b, want, atol=1e-4)


def test_gradients_equal_differences():
    settings = bl.Settings(hidden=3, names=16, words=16, name_size=2, word_size=2)
    pages, labels = bl.composed(4, 5)
    pages, labels = [p[:6] for p in pages], np.concatenate([y[:6] for y in labels])
    model = bl.Model({k: v.astype(np.float64) for k, v in bl._fresh(settings).items()}, settings)
    s = bl.features(pages, settings)

    def loss():
        flat = np.concatenate(model.scores(pages)).astype(float)
        return -np.mean(labels * np.log(flat) + (1 - labels) * np.log(1 - flat))

    made = bl._gradients(model, s, labels)
    for name, weight in model.weights.items():
        at = np.unravel_index(np.abs(made[name]).argmax(), weight.shape)
        kept, step = weight[at], 1e-3
        weight[at] = kept + step
        up = loss()
        weight[at] = kept - step
        down = loss()
        weight[at] = kept
        assert made[name][at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4)


def test_operator_on_awkward_rows(spark, model):
    long = "<article>" + "".join(f"<p>Paragraph number {i} of many words.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, "u", 1, "t"), (2, "", "u", 1, "t"), (3, SITES["tags"], None, 1, "t"), (3, SITES["tags"], None, 1, "t"), (None, SITES["notice"], "u", None, None), (4, long, "v", 1, "t")]
    frame = spark.createDataFrame(rows, "page_id long, html string, url string, n_chars long, text string").repartition(2)
    found = bl.extract_main_text(frame, model)
    assert found.columns == ["page_id", "html", "url", "text", "n_chars"]
    got = {(r.page_id, r.url): r for r in found.collect()}
    assert found.count() == 6 and got[1, "u"].text == got[2, "u"].text == "" and got[1, "u"].n_chars == 0
    assert got[3, None].text == got[None, "u"].text == "The day\nIt rained, and then it did not.\nShort."
    assert got[4, "v"].text.count("\n") == 19_999 and got[4, "v"].n_chars == len(got[4, "v"].text)
    assert bl.extract_main_text(frame.limit(0), model, keep=["page_id"]).collect() == []


def test_query(spark):
    frame = queries.QUERIES["op12_block_labeller"](spark, "/root/testdata/sf0.01")
    assert frame.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").set_index("page_id").html
    rows = frame.collect()
    assert len(rows) == len(pages)
    want = {i: "\n".join(b.text for b in blocks_of(h) if "article" in b.path) for i, h in pages.items()}
    assert np.mean([r.text == want[r.page_id] and r.n_chars == len(r.text) for r in rows]) >= 0.99
