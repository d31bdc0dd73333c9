import random
import re

from lagline.llm.page_wrappers import GROUP, TEXT, Item, Page, aligned, chosen, folded, main_texts, outside, read, slots, symbol, written

SCHEMA = "page_id long, url string, html string, host string, form string, keep string, slots string, text string"


def texts(spark, pages):
    rows = [(i, url, html, *["x"] * 5) for i, (url, html) in enumerate(pages)]
    found = main_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id][0] for r in found) and len(found) == len(pages)
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


def tree(rng, depth):
    """A random tree of tags: (name, children), or None for text; neighbours tend to repeat."""
    out = []
    for _ in range(rng.randrange(0, 5)):
        if depth and rng.random() < 0.7:
            node = (rng.choice("abc"), tree(rng, depth - 1))
            out += [node] * rng.choice([1, 1, 3])
        elif not out or out[-1] is not None:
            out.append(None)
    if len(out) > 1 and rng.random() < 0.3:
        out = out * 3
    return [x for i, x in enumerate(out) if x is not None or i == 0 or out[i - 1] is not None]


def items_of(nodes):
    return folded([Item(TEXT) if n is None else Item(n[0], items_of(n[1])) for n in nodes])


def line(nodes):
    return "".join("#" if n is None else f"<{n[0]}>{line(n[1])}</{n[0]}>" for n in nodes)


def pattern(items):
    out = ""
    for x in items:
        body = "#" if x.sym == TEXT else pattern(x.items) if x.sym[0] == GROUP else f"<{x.sym}>{pattern(x.items)}</{x.sym}>"
        out += f"(?:{body}){'*' if x.rep and x.opt else '+' if x.rep else '?' if x.opt else ''}"
    return out


def test_wrappers_accept_their_pages():
    """A page's expression accepts the page's tokens, the wrapper of many pages accepts those of all of them."""
    rng = random.Random(6)
    for _ in range(150):
        pages = [tree(rng, 3) for _ in range(4)]
        forms = [written(items_of(p)) for p in pages]
        for page, form in zip(pages, forms):
            assert written(read(form)) == form and re.fullmatch(pattern(read(form)), line(page))
        whole = read(forms[0])
        for form in forms[1:]:
            whole = aligned(whole, read(form))
        for page in pages:
            assert re.fullmatch(pattern(whole), line(page)), (written(whole), line(page))


def test_repeats_and_options():
    page = lambda html: Page(html, {}).text
    assert page("<ul><li>a<li>b<li>c</ul>") == "ul{li{#}+}"
    assert page("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "dl{(dt{#}dd{#})+}"
    assert page("<div class='Post-12 x'><p>a<b>b</b><p>c</div>") == "div.post-9.x{p{#}+}"
    both = aligned(read("h1{#}p{#}+"), read("h1{#}div.ad{#}p{#}"))
    assert written(both) == "h1{#}div.ad{#}?p{#}+"
    grown = aligned(read("(h2{#}p{#})+"), read("h2{#}p{#}ul{li{#}}"))
    assert written(grown) == "(h2{#}p{#})+ul{li{#}}?"
    first, second = read("a{#}b{#}"), read("b{#}")
    own = slots(second)
    assert written(aligned(first, second)) == "a{#}?b{#}" and own[0].final() is slots(first)[1]


def test_what_stands_outside():
    yes = ["<div class='ad'>", "<div id=sideBar>", "<section class='user-comments'>", "<div role=navigation>", "<p hidden>", "<div class='cookie-notice x'>", "<article class=comment>", "<div class='ad-12'>"]
    no = ["<div class='has-sidebar'>", "<article class='post no-ads'>", "<div class='shadow header-x read'>", "<div id=lead>", "<main class='with-sidebar'>"]
    assert all(outside(symbol(t)[1]) for t in yes) and not any(outside(symbol(t)[1]) for t in no)
    items = read("header{#}article{header{h1{#}}p{#}+footer{#}}aside{article{#}}")
    assert chosen(items, {i: (100, 0, False) for i in range(5)}) == [1, 2]


def test_articles(spark):
    a = lambda n, extra="": (
        f"https://News.example.com:80/{n}",
        f"""<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>if (a<b) document.write("<p>no</p>");</script></head>
        <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/x>X {n}</a></ul></nav>
        <!-- <p>comment</p> --><div class="cookie-notice"><p>We use cookies {n}</p></div>
        <article><header><h1>Head {n} &amp; more</h1></header><p>First   line {n}<br>goes <b>on</b> &lt;here&gt;.
        <p>Second <a href=x>link</a> {n}<div class="ad">Buy {n}</div><ul><li>one {n}<li>two</ul>{extra}
        <form><label>Mail</label><input><button>Send</button></form><div id="comments"><p>Nice {n}!</p></div></article>
        <aside><h2>Also</h2><article><p>Other {n}</p></article></aside><footer>&copy; {n}</footer></body></html>""")
    want = lambda n, extra="": f"Head {n} & more\nFirst line {n} goes on <here>.\nSecond link {n}\none {n}\ntwo{extra}"
    pages = [a(n) for n in range(4)] + [a(9, "<table><tr><td>c1<td>c2<tr><td>c3</table><pre>x\n  y</pre>")]
    wants = [want(n) for n in range(4)] + [want(9, "\nc1\nc2\nc3\nx y")]
    # the article is the deepest element with most of the text; what is the same on all pages is the site's
    b = lambda n: (
        "http://plain.example.org/p", f"<div class=top><a href=1>One</a> <a href=2>Two</a></div><div id=x9><div class=box><h2>About {n}</h2>"
        + "".join(f"<p>Some longer text number {n} {i}, of the page." for i in range(n + 2))
        + f"<p><i>Please support this site.</i></p></div><div class=list><a href=q>Read item {n}</a></div></div>")
    pages += [b(n) for n in range(4)]
    wants += [f"About {n}\n" + "\n".join(f"Some longer text number {n} {i}, of the page." for i in range(n + 2)) + "\nPlease support this site." for n in range(4)]
    c = lambda n: ("http://plain2.example.org/p", b(n)[1].replace("<p><i>", "<div><i>").replace("</i></p>", "</i></div>"))
    pages += [c(n) for n in range(4)]
    wants += [w.replace("\nPlease support this site.", "") for w in wants[-4:]]
    # one page of a host is built in another way
    pages.append(("https://news.example.com/odd", "<main><p>Odd one</p></main><footer>f</footer>"))
    wants.append("Odd one")
    assert texts(spark, pages) == wants


def test_broken_and_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>low</p>" + "</div>" * 3000
    long_ = "<article>" + "".join(f"<p>para {i}" for i in range(20_000)) + "</article>"
    pages = [
        (None, None), ("", ""), (None, "   "), ("http://a/", "plain words only"), ("http://b/", "<article><p>cut off in <b tit"), ("http://c/", deep),
        ("http://d/", long_), ("http://e/", "a < b & c &unknown; &#x41;&#66 <!-- open"), ("http://f/", '<article><p title="a>b">x</p><p class="y>z</p></article>'),
        ("http://g/", "</div></p><article></div><p>fine</article>"), ("nothing", "<script>never ends"), ("http://i/", "<p>é 日 x\U0001f600</p>"),
        ("http://j/", "<nav>only a menu</nav>"), ("http://j/", "<nav>only a menu</nav>"),
    ]
    got = texts(spark, pages)
    assert got[:3] == ["", "", ""] and got[3:6] == ["plain words only", "cut off in", "low"]
    assert got[6] == "\n".join(f"para {i}" for i in range(20_000)) and got[7] == "a < b & c &unknown; AB"
    assert got[8].startswith("x") and got[9] == "fine" and got[10] == "" and got[11] == "é 日 x\U0001f600" and got[12:] == ["", ""]
    none = spark.createDataFrame([], SCHEMA)
    assert main_texts(none).count() == 0


def test_order_of_rows_does_not_matter(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    first = {r.page_id: r.text for r in main_texts(pages).collect()}
    assert first == {r.page_id: r.text for r in main_texts(pages.orderBy("html").repartition(7)).collect()} and all(first.values())
