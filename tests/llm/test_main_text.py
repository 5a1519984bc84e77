import random
import time

import numpy as np
import pytest

from eventide.llm import main_text
from eventide.llm.main_text import repeated_tokens
from eventide.llm.page_blocks import parse
from fixtures import clashing

PAGES = "page_id long, url string, html string"
WORDS = "time year people way day man thing woman life child world school state family student group country problem".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def texts(spark, rows, **options):
    found = main_text.main_text(spark.createDataFrame(rows, PAGES), **options).collect()
    assert all(r.n_chars == len(r.text) for r in found)
    return {r.page_id: r.text for r in found}


@pytest.mark.parametrize("seed", range(4))
def test_repeated_tokens_against_brute_force(seed):
    rng = random.Random(seed)
    stream, page = [], []
    for p in range(6):
        for _ in range(rng.randrange(40)):
            stream.append(rng.randrange(3))
            page.append(p // 2)  # two streams of one page: repeats between them do not count
        stream.append(-1)
        page.append(p // 2)
    want = np.zeros(len(stream), bool)
    for i in range(len(stream) - 7):
        for j in range(len(stream) - 7):
            if page[i] != page[j] and stream[i:i + 8] == stream[j:j + 8] and min(stream[i:i + 8]) >= 0:
                want[i:i + 8] = True
    assert (repeated_tokens(np.array(stream), np.array(page)) == want).all()
    assert len(repeated_tokens(np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def test_parts_that_name_themselves_go(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu</a></ul></nav><!-- <p>hidden</p> -->
      <div class="cookie-notice">We use cookies.</div><div class='ad'>Buy now.</div>
      <article><header><h1>Head&amp;line</h1></header><p>One &lt;two&gt;<b>&nbsp; three<br>four.<p>Five&#233;&#x41;\n\n six.
      <aside>Aside</aside><form><label>Mail</label><input><button>Go</button></form><ul><li>Item</li></ul>
      <table><tr><td>a</td><td>b</td></tr></table><footer>By me</footer></article>
      <section id="comments"><article><p>First reader!</p></article></section><div hidden>later</div>
      <div id="sidebar"><p>Also read</p></div><footer>&copy; site</footer>"""
    want = "Head&line\n\nOne <two> three four.\n\nFiveéA six.\n\nItem\n\na b"
    assert texts(spark, [(1, "http://a.b/1", page)]) == {1: want}


def soup(rng, i, body):
    menu = "".join(f"<div>{w} pages of this site here</div>" for w in WORDS[:4])
    return (f"<html><body><div><div>{menu}</div><div><p>{sentence(rng, 5)}</p>{body}</div>"
            f"<div><p>All rights are reserved by the owners of this site</p></div></div></body></html>")


def test_without_article_element_the_host_tells(spark):
    rng = random.Random(5)
    shared = "<p>This very same paragraph of more than eight words stands in many of the articles here</p>"
    rows, want = [], {}
    for i in range(60):
        own = [sentence(rng, 40), sentence(rng, 30)]
        body = f"<p>{own[0]}</p>{shared}<p>{own[1]}</p>"
        page = soup(rng, i, body)
        rows.append((i, f"https://Host.example/{i}", page))
        first = page.split("<p>")[1].split("</p>")[0]
        want[i] = "\n\n".join([first, own[0], shared[3:-4], own[1]])
    assert texts(spark, rows) == want
    # in groups of a few pages the same comes out: whole blocks are compared across them
    assert texts(spark, rows, group_bytes=5000) == want
    assert texts(spark, rows, group_bytes=1) == want


def test_copies_keep_their_article(spark):
    body = "<p>" + sentence(random.Random(6), 60) + "</p>"
    page = f"<html><body><nav>Menu one two three four five six seven eight</nav><article>{body}</article></body></html>"
    found = texts(spark, [(i, "http://h.x/" + str(i), page) for i in range(40)] + [(99, "http://h.x/9", page.replace("Menu", "List"))])
    assert set(found.values()) == {body[3:-4]} and len(found) == 41


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", "plain text"), (4, "http://u@h.com:80/a", "<p>a<p>b"), (None, "http://h.com", "<nav>x</nav>"),
            (6, "http://h.com", "a <!-- open"), (7, "//h.com", "a <script> open"), (8, "h", "1 < 2 & 3 &bogus; &#0; &#xD800;"),
            (9, "h", "</div></p><p>x</article>"), (10, "h", "<p title='a>b'>q</p>"), (11, "h", "<p title='a>q</p>"), (11, "h", "<p title='a>q</p>")]
    df = clashing(spark.createDataFrame(rows, PAGES))
    found = [(r.page_id, r.text) for r in main_text.main_text(df).collect()]
    assert len(found) == len(rows)
    got = dict(found)
    assert got == {1: "", 2: "", 3: "plain text", 4: "a\n\nb", None: "", 6: "a", 7: "a", 8: "1 < 2 & 3 &bogus; � �", 9: "x", 10: "q", 11: "q"}
    assert main_text.main_text(df.where("false")).count() == 0


def test_a_container_that_was_never_closed(spark):
    text = sentence(random.Random(7), 50)
    assert texts(spark, [(1, "h", f"<div class='ad'>Buy<article><h1>T</h1><p>{text}</p></article>")]) == {1: f"T\n\n{text}"}
    assert texts(spark, [(1, "h", f"<form><div class='content with-sidebar'><h1>T</h1><p>{text}</p></div></form>")]) == {1: f"T\n\n{text}"}


@pytest.mark.parametrize("piece", ["<!--", '<a "', "<script ", "<", "<a \"x' ", "<div>", "</div", "&#1", "<p>", "<p x='\"", "<b>x</i>"])
def test_any_markup_takes_linear_time(piece):
    start = time.perf_counter()
    parse(piece * (1_000_000 // len(piece)))
    parse("<div>" * 1000 + piece * 100_000 + "</div>" * 1000)
    assert time.perf_counter() - start < 20


def test_very_long_page(spark):
    text = sentence(random.Random(8), 300_000)
    assert texts(spark, [(1, "h", f"<article><p>{text}</p></article>"), (2, "h", "<p>x</p>")], group_bytes=1000) == {1: text, 2: "x"}


def test_repeats_do_not_depend_on_how_a_host_is_cut(spark):
    rng = random.Random(9)
    menu = "".join(f"<li><a href=x>{sentence(rng, 5)}</a></li>" for _ in range(6))
    notice = sentence(rng, 30)
    rows = []
    for i in range(40):
        # the notice is no block of its own, and the menu's blocks differ by a word
        own = sentence(rng, 40)
        rows.append((i, f"http://h.x/{i}", f"<html><body><div><p>{notice} {own.split()[0]}</p></div><ul>{menu}</ul>"
                     f"<div><p>{own}</p><p>{sentence(rng, 30)}</p></div></body></html>"))
        rows.append((100 + i, f"http://h.x/{100 + i}", f"<article><p>{own}</p><p><a href=y>{notice}</a></p></article>"))
    whole = texts(spark, rows)
    assert all(notice not in whole[100 + i] for i in range(40))
    assert texts(spark, rows, group_bytes=4000) == whole
    assert texts(spark, rows, group_bytes=1) == whole


def test_runs_of_two_groups_meet():
    pages = [parse(f"<p>{t}</p>") for t in ("a b c d e f g h i", "x b c d e f g h i", "x b c d e f g h i", "1 2 3")]
    assert main_text.repeated_shares(pages[:1])[0] == [0.0]
    left, right = main_text.Runs(pages[:1]), main_text.Runs(pages[1:])
    both = set(left.keys.tolist()) & set(right.keys.tolist())
    assert len(both) == 1 and not right.several.any() and right.place[-4:].tolist() == [-1] * 4
    shares = main_text.repeated_shares(pages[:1], np.isin(left.keys, right.keys))
    assert shares == main_text.repeated_shares(pages)[:1] == [[0.8]]
