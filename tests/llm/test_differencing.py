"""Every page is differenced against its neighbour, those with an article as well."""

from covaria.llm import extract


def pages(spark):
    menu, foot = "<nav><ul><li>Home<li>News</ul></nav>", "<footer><p>All rights reserved</footer>"
    rows = [
        (1, "http://h/a/1", f"{menu}<p>Top story<article><p>one</p><p>the same sentence</p></article>{foot}"),
        (2, "http://h/a/2", f"{menu}<p>Top story<article><p>two</p><p>the same sentence</p></article>{foot}"),
        (3, "http://h/a/3", f"{menu}<p>Top story<div>three</div>{foot}"),
        (4, "http://h/a/4", f"{menu}<p>Top story<div>four</div><p>the same sentence</p>{foot}"),
        (5, "http://other/", f"{menu}<article>alone</article>"), (None, "http://h/a/2", "<article>no id</article>"), (6, None, None),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_pages_with_an_article_are_differenced(spark):
    found = {r.id: (r.text, r.n_blocks, r.n_shared) for r in extract.differenced(pages(spark)).collect()}
    # Two lines of the menu, one of the footer, the line that all pages have, and the sentence of two articles.
    assert found[1] == ("one\nthe same sentence", 6, 5) and found[2] == ("two\nthe same sentence", 6, 5)
    assert found[3] == ("three", 5, 4)
    # A sentence of another's article is no template.
    assert found[4] == ("four\nthe same sentence", 6, 4)
    assert found[5] == ("alone", 3, 0) and found[None] == ("no id", 1, 0) and found[6] == ("", 0, 0)


def test_rows_that_share_an_id_stay_single(spark):
    rows = [(1, f"http://h/{i}", f"<p>{i}<article>text {i}</article>") for i in range(4)] + [(2, "http://h/2a", "<p>2")]
    got = extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.id, r.text) for r in got if r.id == 1) == [(1, f"text {i}") for i in range(4)] and len(got) == 5


def test_blocks_outside_are_seen_in_place():
    html = "<nav>menu</nav><p>a <button>press</button> b<div class=ad>buy <b>now</b></div><p>c"
    assert extract.visible_blocks(html) == [
        (extract.ASIDE, "menu"), (extract.ASIDE, "press"), (extract.OUTER, "a b"), (extract.ASIDE, "buy now"), (extract.OUTER, "c"),
    ]
    assert extract.blocks(html) == [(extract.OUTER, "a b"), (extract.OUTER, "c")]
