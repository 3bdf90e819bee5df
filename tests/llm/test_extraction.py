import html
import re

import numpy as np

from holdfast.llm import extraction as X

WORDS = "Something that is said about the matter at hand, in a sentence. " * 4


def test_articles_of_the_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    found = {r.page_id: r for r in X.op9_html_extraction(spark, sf).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert found[r.page_id].text == want and found[r.page_id].n_chars == len(want)


def test_boilerplate_is_left_out():
    page = f"""<html><head><title>no</title><style>p{{}}</style></head><body class="has-sidebar">
      <div id="site-header">no {WORDS}</div><div role="navigation">no {WORDS}</div>
      <div class="cookie-notice">no {WORDS}</div><main><h1>Head</h1><p>{WORDS}</p><p>Ok.</p>
      <aside>no {WORDS}</aside><form>no {WORDS}<input></form><div class="ad">no {WORDS}</div>
      <script>var no = "</p>{WORDS}"</script><p>{WORDS}</p></main>
      <section id="comments"><article class="comment">no {WORDS}</article></section>
      <div class="related-posts">no</div><footer>no {WORDS}</footer></body></html>"""
    body = " ".join(WORDS.split())
    assert X.main_text(page) == f"Head\n{body}\nOk.\n{body}"


def test_without_article_the_densest_container():
    page = f"<div class=top><a href=x>One</a> <a href=y>Two</a></div><div><div><p>{WORDS}<p>Short.<p>{WORDS}</div><div><a>More</a></div></div>"
    body = " ".join(WORDS.split())
    assert X.main_text(page) == f"{body}\nShort.\n{body}"


def test_wrappers_with_names_of_page_parts_stay():
    body = " ".join(WORDS.split())
    inner = f"<h1>Head</h1><p>{WORDS}</p><p>Ok.</p><p>{WORDS}</p>"
    aside = f'<div id="sidebar"><a>no</a> {WORDS}</div>'
    want = f"Head\n{body}\nOk.\n{body}"
    for wrapper in ('div class="layout has-sidebar"', 'div id="social-issues"', 'div class="post has-comments"', "form id=aspnetForm method=post", 'div role="form"', "fieldset"):
        tag = wrapper.split()[0]
        assert X.main_text(f"<body><{wrapper}>{inner}</{tag}></body>") == want, wrapper
        assert X.main_text(f"<body><nav>no {WORDS}</nav><{wrapper}><div>{inner}{inner}</div>{aside}</{tag}><footer>no</footer></body>") == f"{want}\n{want}", wrapper


def test_a_teaser_article_does_not_replace_the_body():
    body = " ".join(WORDS.split())
    teaser = f"<section><article><h2>Next</h2><p>{WORDS[:130]}</p></article></section>"
    page = f"<body><div><p>{WORDS}</p><p>Ok.</p>{f'<p>{WORDS}</p>' * 6}</div>{teaser}</body>"
    assert X.main_text(page) == "\n".join([body, "Ok."] + [body] * 6)


def test_long_comments_stay_out():
    body = " ".join(WORDS.split())
    comments = f'<div class="comments">{f"<p>no {WORDS}</p>" * 9}</div>'
    assert X.main_text(f"<body><div><p>{WORDS}</p><p>{WORDS}</p></div>{comments}</body>") == f"{body}\n{body}"


def test_broken_markup_and_edges():
    for page, want in [
        ("", ""),
        ("plain", "plain"),
        ("<script>x", ""),
        ("a < b & c", "a < b & c"),
        ("&lt;b&gt; &#x41;&nbsp;&amp;c", "<b> A &c"),
        ("<p>a</p></div></article>b", "a\nb"),
        ("<![CDATA[x]]>y", "y"),
        ("<![if x]>z<![endif]>", "z"),
        ("<article><p>a\n  b<br>c<b>d</b></article>", "a b cd"),
        ("<div>" * 5000 + "deep", "deep"),
    ]:
        assert X.main_text(page) == want, page[:40]


def test_null_and_clashing_columns(spark):
    schema = "page_id long, html string, text string, n_chars long, found string"
    pages = spark.createDataFrame([(1, None, "x", 1, "y"), (1, None, "x", 1, "y"), (None, f"<p>{WORDS}", None, None, None)], schema)
    found = pages.select("*", X.extract(pages).alias("extracted")).collect()
    assert [r.extracted.n_chars for r in found] == [0, 0, len(WORDS.strip())] and found[0].text == "x"
    assert pages.limit(0).select(X.extract(pages)).count() == 0


LONG = "Long words go on here and there. " * 9


def test_topics_in_names_stay():
    related = "Other authors wrote of it at length and well. " * 4
    recipes = "Take butter and flour and sugar, then stir it all. " * 3
    banner = "We use cookies on this site to make it all better for you and for us, so please accept them now."
    page = (
        f'<article><p>{LONG}</p><div class="related-work"><p>{related}</p></div><div id="cookie-recipes"><p>{recipes}</p></div>'
        f'<div class="cookie-banner">{banner}</div><div class="related-posts"><a href="/a">One</a> <a href="/b">Two</a></div></article>'
    )
    assert X.main_text(page) == "\n".join(t.strip() for t in (LONG, related, recipes))


def test_large_broken_pages_are_linear():
    import time

    began = time.time()
    deep = X.main_text("<div><p>word " * 160_000)
    assert deep.count("word") == 128_000  # the smallest container with most of the lines
    assert X.main_text("<!--" * 500_000) == ""
    assert X.main_text("<div>" * 100_000 + "</table></main>" * 50_000 + "text here") == "text here"
    assert X.main_text("<article><div>" * 50_000 + "</section>x" * 50_000 + "</main>").count("x") == 50_000
    assert time.time() - began < 40


def test_comments_without_an_end():
    assert X.main_text(f"<p>{LONG}</p><!-- hidden > <p>{LONG}</p>") == "\n".join([LONG.strip()] * 2)
    assert X.main_text(f"<p>{LONG}</p><!-- all hidden") == LONG.strip()
    assert X.main_text(f"<p>{LONG}</p><!-- a --><p>{LONG}</p><!-- b") == "\n".join([LONG.strip()] * 2)
    assert X.main_text(f"<script><!-- x </script><p>{LONG}</p>") == LONG.strip()


def test_cluster_equals_its_definition():
    """Ratios, the Gaussian and the threshold, computed line by line; a page without regions keeps the lines of its densest container."""
    import math
    import random

    rng = random.Random(2)
    for _ in range(50):
        n = rng.randrange(1, 30)
        size, tags = [rng.randrange(1, 400) for _ in range(n)], [rng.randrange(1, 9) for _ in range(n)]
        boiler = [rng.random() < 0.3 for _ in range(n)]
        ratio = [0.0 if b else s / t for s, t, b in zip(size, tags, boiler)]
        weights = [math.exp(-0.5 * (k / X.SIGMA) ** 2) for k in range(-X.RADIUS, X.RADIUS + 1)]
        at = lambda i: ratio[min(max(i, 0), n - 1)]
        smooth = [sum(w * at(i + k) for w, k in zip(weights, range(-X.RADIUS, X.RADIUS + 1))) / sum(weights) for i in range(n)]
        mean = sum(smooth) / n
        limit = math.sqrt(sum((x - mean) ** 2 for x in smooth) / n)
        got = X._cluster(np.array(size, float), np.array(tags, float), np.array(boiler))
        sure = [abs(x - limit) > 1e-9 for x in smooth]
        assert all(g == (not b and x >= limit) for g, b, x, s in zip(got, boiler, smooth, sure) if s)
    menu = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(30))
    page = f"<body><div><ul>{menu}</ul></div><div><p>{LONG}</p><p>short</p><p>{LONG}</p></div><div><a href=x>a</a> <a href=y>b</a></div></body>"
    assert X.main_text(page) == "\n".join([LONG.strip(), "short", LONG.strip()])
