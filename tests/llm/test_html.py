from tallyweb.llm import html_extraction as he

SITE = """<html><head><title>T</title></head><body><div id="hdr" class="site-header">My Site</div><ul><li><a href=x>Home</a></li><li><a href=y>About us</a></li></ul>
<div><div class="post"><h2>The Title</h2><p>First paragraph, with text   that is long enough. And more, of it.</p><p>Second &amp; third, again with punctuation; indeed.</p></div>
<div class="comments"><p>I liked this, a lot. Very much so, and I will tell all of my friends.</p></div></div><div>Copyright 2020</div></body></html>"""
ARTICLE = """<!DOCTYPE html><html><head><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad --><div class="ad">Buy now, please.</div>
<article><h1>Head &lt;1&gt;</h1><p><b>One.<br>More<p>Two&nbsp;<a href=x>links</a> here.</p><aside>Not this.</aside><form><p>Nor this</p></form><section class="comments"><article class="comment"><p>Nice one, really.</p></article></section></article><footer>&copy; me</footer></body></html>"""


def test_marked_article():
    assert he.main_text(ARTICLE) == "Head <1>\nOne. More\nTwo links here."


def test_ratios():
    assert he.main_text(SITE) == "The Title\nFirst paragraph, with text that is long enough. And more, of it.\nSecond & third, again with punctuation; indeed."


def test_odd_pages():
    assert he.main_text(None) == he.main_text("") == he.main_text("<html></html>") == ""
    assert he.main_text("a < b and more") == "a < b and more"
    assert he.main_text("<script>x") == ""
    assert he.main_text("<article><p>one<p title='a>b'>two") == "one\ntwo"
    assert he.main_text("<article><p>" + "x " * 200_000 + "</article>") == ("x " * 200_000).strip()


def test_table(spark):
    pages = spark.createDataFrame([(1, "u", ARTICLE, "c"), (2, None, None, "c"), (None, "", "", None), (1, "u", ARTICLE, "c")], "page_id long, url string, html string, text string")
    rows = he.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in rows) == [(0, 0), (1, 34), (1, 34), (2, 0)]
    assert he.extract(pages.limit(0)).count() == 0


def test_header_of_the_article():
    page = "<div class='page-header'>Site</div><article><div class='entry-header'><h1>Title</h1></div><p>Text.</p><div class='share-bar'>Share</div></article>"
    assert he.main_text(page) == "Title\nText."


def test_unclosed_elements():
    for tag in ("button", "video", "select", "canvas", "object", "svg"):
        assert he.main_text(f"<article><p>Before it.</p><{tag}>x<p>After one, there is more.</p>").endswith("After one, there is more.")
    assert he.main_text("<article><p>Seen, all of it.</p><script>never") == "Seen, all of it."


def test_class_names_are_one_signal():
    page = "<article><p>Some words, here they are. And more of them; indeed.</p><div class='search-history'><p>The search for the ship went on, for years. It was found, at last.</p></div><h2><a href=x>A linked heading</a></h2></article>"
    assert he.main_text(page).split("\n")[1:] == ["The search for the ship went on, for years. It was found, at last.", "A linked heading"]


def test_deep_nesting_is_linear():
    import time

    took = []
    for n in (2000, 8000):
        began = time.time()
        text = he.main_text("".join(f"<div>Line {i}, with some words." for i in range(n)))
        took.append(time.time() - began)
        assert text.count("Line") == n
    assert took[1] < 12 * took[0] + 0.5


def sentence(rng):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(2 + rng.randrange(7))) for _ in range(6 + rng.randrange(12))).capitalize() + rng.choice([".", ".", "!", "?"])


def planted(rng):
    """A page and the lines of its article."""
    paragraphs = [" ".join(sentence(rng) for _ in range(1 + rng.randrange(5))).replace(" ", ", ", 1) for _ in range(3 + rng.randrange(6))]
    title = sentence(rng)[:-1]
    items = [sentence(rng) for _ in range(rng.choice([0, 0, 3]))]
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + ("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if items else "")
    kind = rng.randrange(4)
    body = [f"<article>{body}</article>", f"<main><div class='entry'>{body}</div></main>", f"<div class='post-body'>{body}</div>", f"<div id='c17'><section>{body}</section></div>"][kind]
    links = "".join(f"<li><a href=/{k}>{sentence(rng)[:12]}</a></li>" for k in range(8))
    noise = [f"<nav><ul>{links}</ul></nav>", f"<div class='menu'><ul>{links}</ul></div>", f"<ul>{links}</ul>", f"<div class='ad'>{sentence(rng)}</div>", f"<aside><p>{sentence(rng)}</p></aside>"]
    after = [f"<div class='comments'><div class='comment'><p>{sentence(rng)} {sentence(rng)}</p></div></div>", "<footer>&copy; 2020</footer>", f"<div class='cookie-notice'>{sentence(rng)}</div>", f"<form><p>{sentence(rng)}</p></form>"]
    return f"<html><head><title>t</title></head><body>{''.join(rng.sample(noise, 3))}{body}{''.join(rng.sample(after, 2))}</body></html>", [title, *paragraphs, *items]


def test_planted_articles():
    """Of generated pages the lines of the article are found, and little else, whether it is marked or not."""
    import random

    rng = random.Random(5)
    hits = got = want = 0
    for _ in range(300):
        page, lines = planted(rng)
        found = he.main_text(page).split("\n")
        hits, got, want = hits + len(set(found) & set(lines)), got + len(set(found)), want + len(set(lines))
    assert hits >= 0.98 * want and hits >= 0.98 * got


def test_bytes_that_are_no_utf8(spark):
    pages = spark.range(1).selectExpr("id AS page_id", "'u' AS url", "cast(concat(cast('<article><p>Words' AS binary), X'FF', cast(' go on.</p>' AS binary)) AS string) AS html")
    assert he.extract(pages).first()["text"] == "Words\ufffd go on."
