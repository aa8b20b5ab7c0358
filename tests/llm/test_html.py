from __future__ import annotations

import itertools

import numpy as np
import pytest

from orderloom.llm import html

SENTENCE = "This is a long sentence of the article that goes on for some time, and then it ends. " * 2
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style><script>var t="</p>";</script></head><body>
<header><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></header><!-- note <p>no</p> --><div class="cookie-notice"><p>{SENTENCE}</p></div>
<div id=wrap><ARTICLE class='post'><h1>A  title &amp; more</h1><p>{SENTENCE}<b>bold&nbsp;text</b>, <a href='x>y'>a link</a>.<p>Second<br>line
&lt;tag&gt; &eacute;.<ul><li>First point.<li>Second point.</ul></ARTICLE><div class="sidebar"><p>{SENTENCE}</p></div>
<div id="comments"><p>{SENTENCE}</p></div><form>Name <button>Send</button></form></div><footer>&copy; us</footer>"""


def test_article_without_the_rest():
    model = html.fit([PAGE] * 3)
    assert html.main_texts([PAGE], model) == [
        "\n".join([
            "A title & more", f"{SENTENCE.strip()} bold text, a link.", "Second line <tag> é.", "First point.", "Second point.",
        ])
    ]
    assert html.main_texts([PAGE.replace("ARTICLE", "div")], model) == html.main_texts([PAGE], model)


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "</p>", "<p>", "&am", "<a href='", "<!--", "<script>", "<div " * 50, "<div>" * 3000 + "x", "x" * 200_000])
def test_broken_pages(page):
    found = html.main_texts([page, PAGE, page], html.prior_model())
    assert found[0] == found[2] and found[1]


def texts(page):
    return [t for t in html.parse(page).texts if t is not None]


@pytest.mark.parametrize("tag", [
    "<svg/>", '<svg class="icon"/>', "<svg class='a=b/' />", "<svg>", '<svg class="icon"><path d="M0"/>', "<svg class=icon/>", "<svg><title/>",
    "<svg><style/><title>", "<select>", "<template>", "<noscript>", "<svg><g></svg>", "<select><option>x<option>y</select>",
    "<template><div>x</template>", "<noscript><p>x</p></noscript>", "<svg><title>x</title><text>y</text><!-- </svg> --><a>z</a></svg>",
])
def test_nothing_is_cut_behind_a_hidden_element(tag):
    assert texts(f"<body><p>One {tag}two.</p><div><p>Three.</p>four</div><article>five</article></body>") in (
        ["One two.", "Three.", "four", "five"], ["One", "two.", "Three.", "four", "five"],
    )
    model = html.fit([PAGE] * 3)
    for page in (PAGE.replace("<div id=wrap>", f"<div id=wrap>{tag}"), PAGE.replace("</head><body>", f"{tag}</head><body>")):
        assert html.main_texts([page], model) == html.main_texts([PAGE], model)


def test_hidden_text_is_left_out_and_raw_elements_run_on():
    assert texts("<p>a <svg><text>b</text></svg>c <select><option>d</select>e<noscript>f</noscript> <template>g</template></p>h") == ["a c e", "h"]
    assert texts("<p>a</p><svg><foreignObject><p>b</p></foreignObject><svg>c</svg>d</svg>e") == ["a", "e"]
    for tag in ("script", "style", "title", "textarea", "iframe"):
        assert texts(f"<p>a</p><{tag}/>b<p>c") == ["a"]


def test_marginals_are_those_of_all_assignments():
    page = html.parse("<div><p>One.</p><ul><li>two</ul></div>three")
    model = html.prior_model()
    forest = html.Forest.of([page, page])
    p, _ = forest.marginals(model.weights, model.pairs)
    n = len(page.parent)
    own = np.bincount(forest.rows, model.weights[forest.columns], 2 * n)[:n]
    weight, content = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        score = sum(own[i] for i in range(n) if y[i])
        score += sum(model.pairs[forest.child_kind[i], y[page.parent[i]], y[i]] for i in range(1, n))
        weight += np.exp(score)
        content += np.exp(score) * np.array(y)
    assert np.allclose(p[:n], content / weight) and np.allclose(p[n:], p[:n])


def test_training_raises_the_likelihood_and_holds_out_well(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [r.html for r in pages.orderBy("page_id").collect()]
    model = html.fit(rows[:100])
    held = [html.parse(h) for h in rows[100:]]
    for weights in (model, html.prior_model()):
        p, _ = html.Forest.of(held, [True] * len(held)).marginals(weights.weights, weights.pairs)
        y = np.concatenate([html.labels(x) for x in held])
        text = np.array([t is not None for x in held for t in x.texts])
        right = ((p > 0.5) == y)[text].mean()
        if weights is model:
            trained = right
    assert trained > 0.95 and trained >= right


def test_awkward_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (3, None, ""), (4, "v", "<p>" + "long text. " * 30_000)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    out = html.extract(pages).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    by_id = {r.page_id: r.text for r in out}
    assert by_id[None] == by_id[3] == "" and len(by_id[4]) == len("long text. " * 30_000) - 1
    assert html.extract(pages.limit(0)).count() == 0
