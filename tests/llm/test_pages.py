"""Page structure by names, hidden articles, deep nesting and long alignments."""

import random
import time
import tracemalloc

import pytest

from covaria.llm import extract


@pytest.mark.parametrize("html, want", [
    # A reader's comment is never preferred to a story outside of articles.
    ("<div class=story><p>story</p></div><div id=comments><article>a comment that is longer than the story</article></div>", ["story"]),
    ("<article><p>story<ul class=comment-list><li>troll</ul></article>", ["story"]),
    ("<article><p>story</p><div class='cookie-notice'>ok?</div><div class=related-posts>r</div><div id=share_buttons>s</div></article>", ["story"]),
    ("<article>a <span class=ad>buy</span> b<p class=advert>buy<p>c</article>", ["a b", "c"]),
    ("<article><p>story</p><article class='comment byuser'>troll</article><p>end</article>", ["story", "end"]),
    ("<article><p>a<figure class='ad-slot'>x</figure><section id=newsletterSignup>x</section><div class='cookieBanner'>x</div></article>", ["a"]),
    # Names with any other word beside them speak of content.
    ("<article><section id=related-work>a</section><p class=notice-of-intent>b<div class=comment-on-hegel>c</div></article>", ["a", "b", "c"]),
    # An article in a named wrapper is shown where it holds more than all around it.
    ("<div class=sidebar-layout><article>the article</article></div><p>foot", ["the article"]),
    ("<div class=sidebar-left><article>the article</article></div><p>foot", ["the article"]),
    ("<div class=widget><article>card</article></div><div><p>a story told at length</p></div>", ["a story told at length"]),
    ("<div id=comments><article>only this</article></div>", ["only this"]),
    ("<div class=ad><div class=comments><article>x</article></div></div><p>y", ["y"]),
    ("<p>a<li>b<p>c</li></p>d<body><p>e", ["a", "b", "c", "d", "e"]),
])
def test_names(html, want):
    found = extract.blocks(html)
    texts = [t for k, t in found if k == extract.INNER] or [t for _, t in found]
    assert texts == want


@pytest.mark.parametrize("tag", ["div", "b", "article", "div class=ad", "ul><li", "span class=comment", "div class=comments><article"])
def test_time_is_linear_in_nesting(tag):
    def seconds(n):
        start = time.process_time()
        closing = "".join(f"</{t.split()[0]}>" for t in reversed(tag.split("><")))
        extract.blocks("<p>start" + f"<{tag}>" * n + "deep" + closing * n + "<p>end")
        return time.process_time() - start

    seconds(1000)
    assert seconds(100_000) < 12


def plain_lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last, best = best, [0]
        for j, y in enumerate(b):
            best.append(last[j] + 1 if x == y else max(last[j + 1], best[j]))
    return best[-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(3)
    for letters, longest in ((2, 40), (8, 60), (60, 200)):
        for _ in range(60):
            a = [str(rng.randrange(letters)) for _ in range(rng.randrange(longest))]
            b = [str(rng.randrange(letters)) for _ in range(rng.randrange(longest))]
            if rng.random() < 0.3:
                b = [x for x in a if rng.random() < 0.8]
            shared = [x for x, s in zip(a, extract.shared_lines(a, b), strict=True) if s]
            rest = iter(b)
            assert all(x in rest for x in shared) and len(shared) == plain_lcs(a, b)
    assert extract.shared_lines([], ["a"]) == [] and extract.shared_lines(["a"], []) == [False]


def test_long_alignment_holds_linear_memory():
    rng = random.Random(4)
    a = [f"line {rng.randrange(30_000)}" for _ in range(60_000)]
    b = [f"line {rng.randrange(30_000)}" for _ in range(60_000)]
    tracemalloc.start()
    shared = extract.shared_lines(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    picked = [x for x, s in zip(a, shared) if s]
    rest = iter(b)
    assert all(x in rest for x in picked) and len(picked) > 500
    assert peak < 60_000_000
