import numpy as np
import pytest

from pulsewatch.llm import html_text as H


def blocks(source):
    p = H.Page(source)
    return [t for t, k in zip(p.text, p.kind) if k == H.KIND_AT[H.TEXT]]


def test_blocks_of_broken_pages():
    assert blocks("<p>a <b>b<br>c<p>d &amp; &eacute;&#33;</p>e") == ["a b c", "d & é!", "e"]
    assert blocks("<ul><li>x<li>y <ul><li>z</ul>w</ul>") == ["x", "y", "z", "w"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert blocks("<script>var t='</p><p>';</script>a<!-- <p>no --> b<style>p{}") == ["a b"]
    assert blocks("a < b and <3 <p title='x>y'>c</p><!-- open") == ["a < b and <3", "c"]
    assert blocks("</div></p>a<div>b</span></div>") == ["a", "b"]
    assert blocks("") == [] and blocks("   \n") == []


def exact(model, forest):
    """Marginals by summing over all labellings."""
    n = len(forest.kind)
    step, alone, root = model.steps(forest), model.alone(forest), model.root
    weight = np.zeros((n, 2))
    for case in range(1 << n):
        x = [(case >> k) & 1 for k in range(n)]
        w = 1.0
        for k in range(n):
            w *= alone[k, x[k]] * (root[x[k]] if forest.parent[k] < 0 else step[k, x[forest.parent[k]], x[k]])
        for k in range(n):
            weight[k, x[k]] += w
    return weight[:, 1] / weight.sum(1)


def test_messages_give_the_exact_marginals():
    model = H.Potentials()
    pages = [H.Page("<nav><a href=/>x</a></nav><article><h1>t</h1><p class=ad>y</p><p>long text here</p></article>")]
    forest = H.Forest(pages)
    model.count(forest, forest.labels(pages))
    assert model.marginals(forest) == pytest.approx(exact(model, forest), rel=1e-9)


PAGE = ('<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul>'
        '</nav><div class="cookie-notice">We use cookies</div><{0}><h1>Title {1}</h1><p>First <b>text {1}</p><div class="ad">Buy</div><p>Second&nbsp;&amp; last</{0}>'
        '<section class="comments"><p>Nice post, thanks for it!</p></section><aside>More</aside><form>Name <input></form><footer>&copy; site</footer></body></html>')


def test_main_text_and_odd_rows(spark):
    rows = [(k, f"u{k}", PAGE.format("article", k), 1) for k in range(40)] + [(100, None, None, 1), (101, "x", "", 1), (0, "u0", PAGE.format("article", 0), 1)]
    rows += [(200, "y", PAGE.format('div class="content"', 7).replace('</div class="content">', "</div>"), 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT int")
    got = {r["page_id"]: r for r in H.main_texts(df).collect()}
    for k in range(40):
        assert got[k]["text"] == f"Title {k}\nFirst text {k}\nSecond & last"
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert got[100]["text"] == got[101]["text"] == "" and got[100]["url"] is None
    assert "First text 7" in got[200]["text"] and "cookies" not in got[200]["text"] and "Nice post" not in got[200]["text"]
    assert H.main_texts(df).count() == len(rows)
    assert H.main_texts(df.limit(0)).collect() == []


def test_trains_on_labelled_pages_only(spark, monkeypatch):
    monkeypatch.setattr(H, "SAMPLE", 5)
    plain = "<!-- <main> --><script>'<article>'</script><div><p>no mark</p></div>"
    rows = [(k, plain) for k in range(200)] + [(k, PAGE.format("article", k)) for k in range(300, 303)] + [(None, PAGE.format("main", k)) for k in range(2)]
    got = H.train(spark.createDataFrame(rows, "page_id long, html string"))
    wanted, pages = H.Potentials(), [H.Page(x) for _, x in rows[200:]]
    forest = H.Forest(pages)
    wanted.count(forest, forest.labels(pages))
    assert all(getattr(got, name) == pytest.approx(getattr(wanted, name)) for name in H.TABLES)


def test_text_after_and_in_inner_elements_stays():
    assert blocks('<p>a<svg class="x"/>b</p><p>c</p><svg><text>no</text></svg><p>d</p>') == ["a", "b", "c", "d"]
    assert blocks("<p>let <math><mi>x</mi></math> be<math/> one</p><p>c</p>") == ["let x be one", "c"]
    assert blocks("<p>a<object data=f><p>b</p></object>c<noscript>d</noscript>e</p>") == ["a", "b", "c", "d", "e"]
    page = H.Page("<article><p>a</p><noscript>b</noscript></article>")
    forest = H.Forest([page])
    assert [k for k, t in zip(forest.labels([page]), page.text) if t] == [1, 1]


LONG = "This paragraph has a fair number of words, commas and full stops, as the text of an article has. "
WRAPS = ["<footer>{}</footer>", "<nav>{}</nav>", "<aside>{}</aside>", "<form>{}</form>", "<header>{}</header>", '<section class="comments">{}</section>',
         '<div class="cookie-notice">{}</div>', '<div class="ad">{}</div>', '<div id="sidebar"><div class="x1">{}</div></div>', '<ul class="menu"><li>{}</li></ul>']


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    return H.train(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))


def extracted(model, source):
    page = H.Page(source)
    forest = H.Forest([page])
    return [t for t, m in zip(page.text, model.marginals(forest)) if t and m > 0.5]


@pytest.mark.parametrize("n, size", [(1, 1), (1, 6), (3, 2), (8, 3)])
@pytest.mark.parametrize("wrap", WRAPS)
def test_paragraphs_in_furniture_stay_out_of_other_layouts(trained, wrap, n, size):
    """Inside and outside the article, few and many, short and long, in a layout that training never saw."""
    junk = wrap.format("".join(f"<p>junk {k} {LONG * size}</p>" for k in range(n)))
    body = [f"text {k} {LONG * 2}".strip() for k in range(3)]
    article = "<h2>Heading</h2>" + f"<p>{body[0]}</p><div class='q7'><p>{body[1]}</p></div>{{}}<blockquote><p>{body[2]}</p></blockquote>"
    for main in ("article", "main"):
        for inside, before, after in ((junk, "", ""), ("", junk, ""), ("", "", junk)):
            page = f"<html><body>{before}<div><{main}>{article.format(inside)}</{main}></div>{after}</body></html>"
            assert extracted(trained, page) == ["Heading", *body]


@pytest.mark.parametrize("wrap", WRAPS)
def test_pages_without_an_article_element(trained, wrap):
    """Long paragraphs side by side are the text, whatever the element around them is called; furniture is not."""
    body = [f"text {k} {LONG * 3}".strip() for k in range(6)]
    text = "".join(f"<p>{x}</p>" for x in body)
    for around in ("<div class='zz'>{}</div>", "<div class='entry-content'>{}</div>", "<section><div>{}</div></section>", "<table><tr><td>{}</table>"):
        page = f"<body><div class='k3'><a href=/>Home</a></div>{around.format(text)}{wrap.format('<p>junk ' + LONG + '</p>')}</body>"
        assert extracted(trained, page) == body
