import html
import random
import re
from collections import defaultdict

import numpy as np

from emporium.llm import html_text
from emporium.llm.common import read


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(spark, rows):
    return {r.page_id: r for r in html_text.extract(frame(spark, rows)).collect()}


def test_articles_of_the_given_pages(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", x)).split())
                  for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_marked_parts(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><meta name=x></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href='/a>b'>Menu</a></ul></nav>
      <main><div class="breadcrumbs">Home &gt; News</div><article><header><h1>The&nbsp;title</h1></header>
      <p>One <b>bold</b>   word &amp; <i>two</i><br>lines<p>Next<span class="ad"> buy now</span> part
      <script>if (a < b) x("</p>")</script><ul><li>item 1<li>item 2</ul>
      <table><tr><td>cell</td><td>other</td></tr></table><form><input><button>Send</button></form>
      <aside>Related</aside><div hidden>secret</div><div id="cookie-notice"><p>We use cookies</div>
      <section class="comments"><article class="comment"><p>First!</p></article></section>
      <blockquote>quote &#8212; &lt;b&gt; 3 < 4</blockquote></article></main>
      <div>Loose text outside</div><footer>&copy; us</footer></body></html>"""
    got = texts(spark, [(1, "http://h/1", page)])[1].text
    assert got == ("The title\nOne bold word & two lines\nNext part\nitem 1\nitem 2\ncell\nother\n"
                   "quote — <b> 3 < 4")


def test_repeats_decide_where_nothing_is_marked(spark):
    shell = ("<html><body><div>Our site offers daily news for you</div><div>%s</div><div>%s</div>"
             "<p>All rights reserved by the site owners since 1999</p></body></html>")
    rows = [(i, f"http://h.org/{i}", shell % (f"Story {i} tells of number {i * 7} things", "line " * (i + 6) + str(i)))
            for i in range(6)]
    rows += [(50, "http://other.org/", shell % ("Alone on its host it keeps everything", "x")),
             (51, "http://h.org/copy", rows[0][2]), (52, None, None), (53, "odd", ""), (54, "http://h.org/z", "no markup at all"),
             (55, "http://h.org/u", "<p>open <b>never closed <div>next &amp")]
    got = texts(spark, rows)
    for i in range(6):
        lines = got[i].text.split("\n")
        assert lines[0] == f"Story {i} tells of number {i * 7} things" and "rights" not in got[i].text
    assert got[50].text.startswith("Our site offers") and got[50].text.endswith("since 1999")
    assert got[51].text == got[0].text
    assert (got[52].text, got[52].n_chars, got[53].text, got[54].text) == ("", 0, "", "no markup at all")
    assert got[55].text == "open never closed\nnext &"
    assert html_text.extract(frame(spark, rows).limit(0)).collect() == []


def test_long_and_broken_pages():
    assert html_text.page_blocks("<" * 50_000)
    assert html_text.page_blocks("<a href=\"" * 2000) is not None
    assert html_text.page_blocks("<div>" * 20_000 + "deep")[-1] == (html_text.OPEN, "deep")
    assert html_text.page_blocks("<!-- open <p>never shown") == []
    assert html_text.page_blocks("<script>x<p>y") == []


def test_class_words_that_may_mean_content(spark):
    page = ("<article><h2 class='header'>Heading</h2><div class='post-header'>By A</div><p class='share-price'>12.5"
            "</p><p>Body <span class='share-price'>7</span></p><div class='share-buttons'>Tweet</div>"
            "<div class='post-comments'>First!</div></article>")
    got = texts(spark, [(1, "http://h/1", page)])[1].text
    assert got == "Heading\nBy A\n12.5\nBody 7"
    line = "<article><p>Text %d</p><div class='post-header'>Read all the news of the day here</div></article>"
    got = texts(spark, [(i, "http://h/", line % i) for i in range(4)] + [(9, "http://g/", line % 9)])
    assert [got[i].text for i in range(4)] == [f"Text {i}" for i in range(4)]
    assert got[9].text == "Text 9\nRead all the news of the day here"


def test_shared_articles_of_unmarked_pages_stay(spark):
    story = "<p>%s</p>" % " ".join(f"word{i}" for i in range(60))
    shell = "<div>Read daily news of our town here</div><div>Day %d</div>%s<p>All rights are with the owners of it</p>"
    rows = [(i, f"http://h/{i}", shell % (i, story)) for i in range(2)]
    got = texts(spark, rows)
    assert all("word0 word1" in r.text and "word59" in r.text for r in got.values())
    other = [(10 + i, f"http://h/o{i}", shell % (10 + i, "<p>%s</p>" % " ".join(f"w{i}x{j}" for j in range(20))))
             for i in range(8)]
    rows = [(i, f"http://h/{i}", shell % (i, story)) for i in range(4)] + other
    got = texts(spark, rows)  # the story is on 4 of 12 pages, the shell on all
    assert all(got[i].text == f"Day {i}\n{' '.join(f'word{j}' for j in range(60))}" for i in range(4))
    assert got[10].text == "Day 10\n" + " ".join(f"w0x{j}" for j in range(20))


def test_repeats_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        blocks = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(0, 4))]
        rows.append((i % 50, f"http://h{i % 3}.org/{i}", "".join(f"<p>{b}</p>" for b in blocks)))
    rows += [rows[0], rows[7]]
    on, pages = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        words = re.sub("<[^>]*>", " ", page).split()
        host = url.split("/")[2]
        pages[host].add(page)
        n = html_text.SHARED
        for run in ([words[i:i + n] for i in range(len(words) - n + 1)] if len(words) >= n else [words] if words else []):
            on[host, tuple(run)].add(page)
    want = sorted((len(x), len(pages[k[0]])) for k, x in on.items() if len(x) >= html_text.PAGES)
    parsed = html_text._parsed(frame(spark, rows), "page_id", "url", "html")
    for parts in (8, 3):  # intervals are cut by other borders
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = html_text.repeats(parsed).collect()
        assert sorted((r.pages, r.of) for r in got) == want and len(want) > 20
        assert all(r.longest == 0 or html_text.SHARED <= r.longest <= html_text.DEPTH for r in got)
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_repeated_ids_and_other_columns(spark):
    df = frame(spark, [(1, "http://h/", "<p>one"), (1, "http://h/", "<p>two"), (None, None, "<p>one")])
    df = df.selectExpr("*", "1 AS row", "2 AS key", "3 AS text", "4 AS host")
    got = sorted((r.page_id is None, r.text) for r in html_text.extract(df).collect())
    assert got == [(False, "one"), (False, "two"), (True, "one")]


def test_boilerplate_of_marked_articles_is_dropped(spark):
    """Repetition decides marked pages too: what most pages of a host have in their article isn't of it."""
    def page(head, *lines):
        return f"<nav>{head}</nav><article>{''.join(f'<p>{x}</p>' for x in lines)}</article>"

    def story(k):
        return " ".join(f"w{k}x{j}" for j in range(30))

    shell = "Follow our daily letter for more news of the town"
    half = "This line stands on half of the pages of it"
    rows = [(i, f"http://h/{i}", page(i, story(i), shell, *([half] if i < 3 else []))) for i in range(6)]
    rows += [(10, "http://alone/", page("n", story(10), shell))]
    rows += [(20 + i, f"http://copy/{i}", page(i, "One story", story(20), shell)) for i in range(8)]  # no lesser part
    rows += [(30 + i, f"http://few/{i}", page(i, story(30 + i), shell)) for i in range(html_text.MAIN_PAGES - 1)]
    rows += [(40, "http://h/copy", rows[0][2]), (41, "http://empty/", None)]
    got = {k: r.text.split("\n") for k, r in texts(spark, rows).items()}
    assert all(got[i] == [story(i), *([half] if i < 3 else [])] for i in range(6))
    assert got[10] == [story(10), shell] and got[40] == got[0] and got[41] == [""]
    assert all(got[20 + i] == ["One story", story(20), shell] for i in range(8))
    assert all(got[30 + i] == [story(30 + i), shell] for i in range(html_text.MAIN_PAGES - 1))


def test_all_blocks_of_marked_pages_are_in_the_array(spark):
    rng = random.Random(11)

    def line(least):
        return " ".join(rng.choice("abc") for _ in range(rng.randint(least, 9)))

    rows, on, pages, total = [], defaultdict(set), defaultdict(set), 0
    for i in range(40):
        runs = [[line(1)], [line(1), line(0), line(3)], [line(1), line(2)]]
        rows.append((i, f"http://h{i % 2}/", "<nav>%s</nav><article><p>%s<p>%s<p>%s</article><footer>%s</footer>Loose %s" % (
            runs[0][0], *runs[1], *runs[2])))
        runs[2][1] = "loose " + runs[2][1]
        pages[i % 2].add(rows[-1][2])
        total += sum(len(x.split()) for run in runs for x in run)
        for words in (" ".join(run).split() for run in runs):
            n = html_text.SHARED
            for run in [words[j:j + n] for j in range(len(words) - n + 1)] if len(words) >= n else [words]:
                on[i % 2, tuple(run)].add(rows[-1][2])
    want = sorted((len(x), len(pages[k[0]])) for k, x in on.items() if len(x) >= html_text.PAGES)
    parsed = html_text._parsed(frame(spark, rows), "page_id", "url", "html")
    assert parsed.agg({"tokens": "sum"}).first()[0] == total
    assert sorted((r.pages, r.of) for r in html_text.repeats(parsed).collect()) == want and len(want) > 20


def test_repeats_of_many_tokens(spark):
    """More than a million tokens, so that slots are counted in several ranges."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(5000)]
    phrases = [" ".join(rng.choices(words, k=7)) for _ in range(400)]
    where = [rng.sample(range(24), rng.randint(1, 6)) for _ in phrases]
    rows = []
    for i in range(24):
        parts = [" ".join(rng.choices(words, k=120)) for _ in range(380)]
        parts += [p for p, pages in zip(phrases, where) if i in pages]
        rng.shuffle(parts)
        tag = ("article", "div")[i % 2]
        rows.append((i, "http://h/", f"<{tag}>{' '.join(parts)}</{tag}>"))
    on = defaultdict(int)
    for _, _, page in rows:
        own = re.sub("<[^>]*>", "", page).split()
        for run in set(zip(*(own[j:] for j in range(html_text.SHARED)))):
            on[run] += 1
    want = sorted(n for n in on.values() if n >= html_text.PAGES)
    got = html_text.repeats(html_text._parsed(frame(spark, rows), "page_id", "url", "html")).collect()
    assert sum(len(r[2].split()) for r in rows) > 1 << 20 and len(want) > 500
    assert sorted(r.pages for r in got) == want and all(r.of == 24 for r in got)


def test_packed_numbers():
    for x in ([], [0], [0, 255, 3], [256, 1], [1 << 16, 0, 7], [(1 << 32) - 1, 5]):
        assert html_text._unpacked(html_text._packed(np.array(x, np.int64))).tolist() == x
