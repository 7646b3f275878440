import random

from tagweave.llm import page_diff as P

PAGES = "page_id long, url string, html string, text string"


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randrange(5) for _ in range(rng.randrange(12))]
        b = [rng.randrange(6) for _ in range(rng.randrange(12))]
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
        got = P.common_lines(a, b)
        rest = iter(b)
        assert len(got) == d[-1][-1] and got == sorted(set(got)) and all(a[i] in rest for i in got)


def texts(page):
    return [t for kind, t in P.page_lines(page) if kind == "article"]


def test_markup_decides():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav>
    <article><h1>Head&amp;line</h1><p>One <b>bold</b>ly  put&nbsp;x<br>next<p>Two<script>var x="</p>";</script> more
    <div class="ad">Buy</div><aside>Side</aside><form><p>Mail</form><ul><li>a<li>b</ul>
    <section id="comments"><p>First!</p></section><div class="cookie-notice"><p>We use</p></div><!-- <p>no</p> --></article>
    <footer>&copy; F</footer></body></html>"""
    assert texts(page) == ["Head&line", "One boldly put x", "next", "Two", "more", "a", "b"]


def test_broken_markup():
    assert texts("<article><p>a<p>b<!-- open <p>c") == ["a", "b"]
    assert texts("<article><p class=\"x>y\">a</p><P>b &lt;i&gt; 1 < 2</P></ARTICLE>z") == ["a", "b <i> 1 < 2"]
    assert texts("<main><script>if (a</b) <p>x") == []
    assert P.page_lines(None) == P.page_lines("") == [] and texts("<article>" + "x " * 50_000 + "</article>")[0].count("x") == 50_000


def page(top, *body):
    return f"<div>{top}</div><div>Home | Top</div>" + "".join(f"<p>{x}</p>" for x in body) + "<div>Imprint</div>"


def test_differencing_deletes_shared_lines(spark):
    rows = [(1, "http://a.b/news/1", page("Welcome", "first story with its own long words", "and more of it"), "x"),
            (2, "http://a.b/news/2?q", page("Welcome", "second story that says another thing"), None),
            (3, "http://a.b/zoo/3", page("Other head", "third story about the animals there"), None),
            (4, "http://c.d/1", page("Welcome", "alone on its host"), None),
            (5, "http://e.f/1", page("W", "same text on both"), None), (6, "http://e.f/2", page("W", "same text on both"), None),
            (7, None, None, None), (8, "nothing", "", None), (None, None, "<p>only &#x41;</p>", None),
            (9, "http://a.b/news/9", "<article><p>Imprint</p><p>own</p></article><div>Imprint</div>", None)]
    got = {r["page_id"]: r for r in P.extract(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert {k: r["text"] for k, r in got.items()} == {
        1: "first story with its own long words and more of it", 2: "second story that says another thing",
        # the nearest page of /zoo/3 is /news/9, which shares only the last line
        3: "Other head Home | Top third story about the animals there", 4: "Welcome Home | Top alone on its host Imprint",
        # copies say nothing about templates
        5: "W Home | Top same text on both Imprint", 6: "W Home | Top same text on both Imprint",
        7: "", 8: "", None: "only A", 9: "Imprint own"}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_empty(spark):
    assert P.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_raw_elements_end_where_they_end():
    for top in ("<svg-icon></svg-icon>", "<button-group></button-group>", "<title-bar>t</title-bar>", "<svg viewBox='0 0 1 1'/>",
                "<svg><path d='M0'/><text>no</text></svg>", "<datalist><option>a<option value='b'>b</datalist>",
                "<select><optgroup><option>a<optgroup><option>b</select>", "<div><button>x</div>", "<div><select><option>x</div>",
                "<noscript><article>no</article></noscript>", "<template><main>no</main></template>"):
        assert texts(f"{top}<article><p>A</p>{top}<p>B</p></article>")[-1] == "B", top
        assert [t for t in texts(f"{top}<article>A</article>") if t != "t"] == ["A"], top
    assert texts("<article><button>one<button>two</button>A</article>") == ["A"]
    assert texts("<article><script>x</script >A<textarea><p>b</textarea>C<style>d</article>") == ["A", "C"]


def test_scanning_is_linear():
    import time
    awful = ["<article>A</article><div " + " ".join(f'a{k}="x"' for k in range(40)), "<article>A</article><div " + "\"'" * 10_000,
             "<article>A</article>" + "<a '\"" * 10_000, "<article>A</article>" + "<a b=\"c>" * 10_001, "<article>A" + "<" * 100_000,
             "<article>A</article>" + "</script " * 20_000, "<article>A</article>" + "<!-- " * 20_000, "<article>A</article>" + "<a '" * 10_001 + ">"]
    for text in awful:
        begun = time.monotonic()
        assert texts(text)[0].startswith("A")
        assert time.monotonic() - begun < 1, text[:60]


def test_truncated_tags_and_quotes():
    assert texts("<article>A<p class=\"x") == ["A"] and texts("<article>A</artic") == ["A"] and texts("<article>A<!doc") == ["A"]
    assert texts("<article><p title=\"a > b\">A</p><p title='it\"s'>B</p>") == ["A", "B"]
    assert texts("<article><p title=\"open>A</p><p>B</p>") == ["A", "B"] and texts("<article>1 < 2 <3") == ["1 < 2 <3"]


def test_comments_and_teasers_are_not_the_article():
    story = "<h1>Head</h1><p>Story</p>"
    for other in ('<article class="comment"><p>C</p></article>', "<article><p>C</p></article>", '<article id="reply-3">C</article>',
                  '<article class="teaser related">C</article>', '<section class="post-comments"><article>C</article></section>'):
        assert texts(f"<article>{story}{other}</article>") == ["Head", "Story"], other
    assert texts(f"<main>{story}</main><article>teaser</article>") == ["Head", "Story"]
    assert texts(f"<article>teaser</article><main><article class='post category-social has-sidebar'>{story}</article></main>") == ["Head", "Story"]
    assert texts(f"<article class='comment'>C</article><article>{story}</article>") == ["Head", "Story"]
    assert texts(f"<article><div class='article-body'>{story}</div></article>") == ["Head", "Story"]


def brute(rows):
    """Texts of pages without a marked article, without Spark: sort, pair, align, delete."""
    order = sorted({(u.split("://")[1].split("/")[0], "/" + u.split("/", 3)[3], h) for _, u, h, _ in rows})
    out = {}
    for host, path, h in order:
        mine = [t for t in P.page_lines(h)]
        lines, same = [t for _, t in mine], [x for x in order if x[0] == host]
        at = same.index((host, path, h))
        near = [same[at + d] for k in range(1, P.NEIGHBOURS + 1) for d in (-k, k) if 0 <= at + d < len(same)]
        others = [(p, [t for _, t in P.page_lines(x)]) for _, p, x in near]
        on = [sum(line in o for _, o in others) for line in lines]
        own = [2 * n <= len(others) if len(others) > 1 else n == 0 for n in on]
        gone = set()
        if any(own):
            common = lambda p: next((k for k, (a, b) in enumerate(zip(p, path)) if a != b), min(len(p), len(path)))
            for p, o in sorted(others, key=lambda x: -common(x[0])):
                d = [[0] * (len(o) + 1) for _ in range(len(lines) + 1)]
                for i, x in enumerate(lines):
                    for j, y in enumerate(o):
                        d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
                i, j, hit = len(lines), len(o), set()
                while i and j:
                    if d[i][j] == d[i - 1][j]:
                        i -= 1
                    elif d[i][j] == d[i][j - 1]:
                        j -= 1
                    else:
                        hit.add(i - 1)
                        i, j = i - 1, j - 1
                if 2 * sum(len(lines[k]) for k in hit if own[k]) <= sum(len(x) for x, y in zip(lines, own) if y):
                    gone = hit
                    break
        out[host, path, h] = " ".join(t for k, (kind, t) in enumerate(mine) if kind != "chrome" and k not in gone)
    return out


def result(spark, rows):
    found = P.extract(spark.createDataFrame(rows, PAGES).repartition(4)).collect()
    return {r["page_id"]: r["text"] for r in found}


def test_short_stories_under_large_menus(spark):
    menu = "".join(f"<div>Menu entry {k} with some words</div>" for k in range(20))
    rows = [(k, f"http://h.i/s/{k}", f"{menu}<p>Only story {k} is here</p><div>Footer</div>", None) for k in range(5)]
    assert result(spark, rows) == {k: f"Only story {k} is here" for k in range(5)} == {
        k: t for k, t in enumerate(brute(rows).values())}


def test_copies_send_a_page_to_further_neighbours(spark):
    top, end = "<div>The name of the site</div><div>Home News Sport</div>", "<div>Imprint</div>"
    story = "".join(f"<p>Sentence {k} of a story that two pages share</p>" for k in range(6))
    rows = [(1, "http://h.i/news/1", f"{top}{story}<p>seen 5 times</p>{end}", None), (2, "http://h.i/news/1?p=2", f"{top}{story}<p>seen 9 times</p>{end}", None)]
    rows += [(k, f"http://h.i/zoo/{k}", f"{top}<p>Another story, number {k}, on an animal</p><p>more {k}</p>{end}", None) for k in range(3, 9)]
    got = result(spark, rows)
    whole = " ".join(f"Sentence {k} of a story that two pages share" for k in range(6))
    assert got[1] == f"{whole} seen 5 times" and got[2] == f"{whole} seen 9 times" and got[3] == "Another story, number 3, on an animal more 3"


def test_untagged_pages_equal_the_brute_version(spark):
    rng = random.Random(4)
    pool = [f"line {k} " + "w" * rng.randrange(30) for k in range(60)]
    rows = []
    for k in range(90):
        host = f"h{rng.choice([0, 0, 0, 1, 2, 3])}.org"
        body = pool[:rng.randrange(4)] + rng.sample(pool, rng.randrange(1, 8)) + [f"own {k}"] * rng.randrange(2) + pool[4:4 + rng.randrange(3)]
        chrome = "<nav>Menu</nav>" if k % 3 else ""
        rows.append((k, f"http://{host}/{rng.choice(['a', 'ab', 'b'])}/{k}", chrome + "".join(f"<p>{x}</p>" for x in body), None))
    rows += [(100 + k, *rows[k][1:]) for k in range(5)]  # repeated pages count as one
    want = brute(rows)
    got = result(spark, rows)
    assert len(got) == len(rows)
    for k, u, h, _ in rows:
        assert got[k] == want[u.split("://")[1].split("/")[0], "/" + u.split("/", 3)[3], h], u


def test_long_unmarked_page_and_names_that_clash(spark):
    long = "".join(f"<p>paragraph {k}</p>" for k in range(20_000))
    rows = [(1, "http://h.i/1", f"<div>Top</div>{long}", "x"), (2, "http://h.i/2", "<div>Top</div><p>short</p>", None)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as pk", "2 as host", "'y' as body", "3 as c0", "4 as _pd_pk", "5 as shared")
    got = {r["page_id"]: r for r in P.extract(df).collect()}
    assert got[1]["text"].startswith("paragraph 0 ") and got[1]["n_chars"] == len(got[1]["text"]) and got[2]["text"] == "short"
    assert (got[1]["pk"], got[1]["host"], got[1]["body"], got[1]["c0"], got[1]["shared"]) == (1, 2, "y", 3, 5)


def test_marked_pages_are_differenced_too(spark):
    rows = [(k, f"http://h.i/{k}", f"<div>Top</div><nav>Menu</nav><article><p>Said by all</p><p>Story {k} is here</p></article><div>Imprint</div>", None)
            for k in range(6)]
    got = {r["page_id"]: r for r in P.extract(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    # the neighbours share all but the story; the article's shared line is put back, the others stay deleted
    assert {k: (r["text"], r["lines_shared"], r["lines_back"]) for k, r in got.items()} == {
        k: (f"Said by all Story {k} is here", 4, 1) for k in range(6)}
    alone = P.extract(spark.createDataFrame(rows[:1], PAGES)).first()
    assert (alone["text"], alone["lines_shared"], alone["lines_back"]) == ("Said by all Story 0 is here", 0, 0)


def test_pages_next_to_the_bounds_of_stretches(spark, monkeypatch):
    rng = random.Random(9)
    rows = []
    for k in range(75):
        body = [f"line {x}" for x in rng.sample(range(12), 5)] + [f"own {k}"]
        rows.append((k, f"http://h{k % 30 // 20}.org/{k:03}", "<p>Top</p>" + "".join(f"<p>{x}</p>" for x in body) + "<p>End</p>", None))
    want = brute(rows)
    for size in (8, 9, 256):  # 9: the last stretch is shorter than the neighbourhood
        monkeypatch.setattr(P, "STRETCH", size)
        got = result(spark, rows)
        assert all(got[k] == want[u.split("://")[1].split("/")[0], "/" + u.split("/", 3)[3], h] for k, u, h, _ in rows)
