import random

from tessera.llm import html_extract as hx
from tessera.llm.rowwise import unpacked
from tests.conftest import ORACLE_SF


def _pages(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    if extra:
        from pyspark.sql import functions as F

        for name in ("text", "n_chars", "node", "_host", "_row", "_page"):
            df = df.withColumn(name, F.lit("x"))
    return df


def _texts(df):
    return {r["page_id"]: r["text"] for r in unpacked(hx.extract(df), "text", "n_chars").collect()}


def test_names_decide_for_a_lone_page(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav><script>var t="</p>";</script>
    <div class="cookie-notice">We use cookies</div><div id="sidebar">Links</div>
    <article><header><h1>Caf&eacute; &amp; more</h1></header><p><b>First
      para<br>graph<p>Second <a href='x>y'>link</a> &lt;b&gt;<!-- note --><div class="ad">Buy</div>
      <form><input>Name</form><table><tr><td>cell 1<td>cell 2</table><div class="comments"><p>nice post</div></article>
    <aside>See also</aside><footer>&copy; 2024</footer>"""
    rows = [(0, "http://a.example/x", page), (1, None, None), (2, "::", ""), (3, "http://b.example", "plain &am text <")]
    rows += [(4, "http://c.example", "<p>a<p>b</i></div><ul><li>c"), (0, "http://a.example/x", page)]
    df = _pages(spark, rows, extra=True)
    got = _texts(df)
    assert got[0] == "Café & more\nFirst para graph\nSecond link <b>\ncell 1\ncell 2"
    assert (got[1], got[2], got[3], got[4]) == ("", "", "plain &am text <", "a\nb\nc")
    assert hx.extract(df).count() == 6 and hx.extract(_pages(spark, [])).count() == 0


def test_what_repeats_on_a_site_goes(spark, monkeypatch):
    rng = random.Random(1)
    line = lambda: " ".join(rng.choice("alpha beta gamma delta".split()) + str(rng.randrange(999)) for _ in range(9))
    rows, want = [], {}
    for i in range(40):
        own = [line() for _ in range(rng.randrange(1, 4))]
        slogan = rng.choice(["Buy now at half the price", "Join our club today"])
        body = f'<div class="b7">{slogan}</div><div class="c{i}">' + "".join(f"<p>{x}</p>" for x in own) + "</div>"
        rows.append((i, f"https://shop.example:8080/{i}", f"<html><body>{body}<div class=z>Call us</div></body></html>"))
        want[i] = "\n".join(own)
    df = _pages(spark, rows)
    assert _texts(df) == want
    monkeypatch.setattr(hx, "BROADCAST_NODES", 0)  # the way beyond the broadcast bound
    assert _texts(df) == want


def test_given_pages_keep_their_article(spark):
    import html
    import re

    pages = spark.read.parquet(f"{ORACLE_SF}/pages.parquet")
    got = _texts(pages)
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        body = re.sub(r"</?b>", "", body.replace("<br>", " "))
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", body)]
        assert got[r["page_id"]] == "\n".join(x for x in blocks if x)


def _site(i, name, rng):
    line = lambda: " ".join(f"w{rng.randrange(9999)}" for _ in range(9))
    own = [line() for _ in range(3)]
    return own, "".join(f"<p>{x}</p>" for x in own), f"https://{name}.example/{i}"


def test_repeats_inside_content_go(spark):
    rng, rows, want = random.Random(5), [], {}
    for i in range(100):
        own, body, url = _site(i, "wrap", rng)
        menu = "<div class=q><ul>" + "".join(f"<li>Link {k}</li>" for k in range(12)) + "</ul></div>"
        rows.append((i, url, f"<html><body><div id=content>{menu}<div class=z>{body}</div></div></body></html>"))
        want[i] = "\n".join(own)
    assert _texts(_pages(spark, rows)) == want


def test_article_under_a_noise_name_stays(spark, monkeypatch):
    rng, rows, want = random.Random(6), [], {}
    for i in range(200):
        own, body, url = _site(i, "side", rng)
        rare = f"<table><tr><td>only {i}</td></tr></table>" if i == 7 else ""
        rows.append((i, url, f'<html><body><div class="related">{body}{rare}</div><div class=menu>Home</div></body></html>'))
        want[i] = "\n".join(own + ["only 7"] * bool(rare))
    # few pages don't outvote a name
    rows += [(1000 + i, f"https://few.example/{i}", f'<p>text {i}</p><div class="related">more {i}</div>') for i in range(9)]
    want |= {1000 + i: f"text {i}" for i in range(9)}
    df = _pages(spark, rows)
    assert _texts(df) == want
    monkeypatch.setattr(hx, "BROADCAST_NODES", 0)
    assert _texts(df) == want


def test_formulas_drawings_and_fallbacks_are_kept(spark):
    page = ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p><svg><text>Axis label</text></svg>"
            "<object data='a.swf'><p>No player here</p></object><script>var a;</script></article>")
    assert _texts(_pages(spark, [(1, "http://a.example/1", page)]))[1] == "Let x=2 be.\nAxis label\nNo player here"


def _plain_importances(pages):
    """Sorted (pages, importance) of every site node, from counts kept in lists per node."""
    import math
    import re
    from html.parser import HTMLParser

    prior = {"": (0.7, 4.0), "article": (1.0, 16.0), "in article": (1.0, 4.0), "nav": (0.0, 16.0), "in nav": (0.0, 16.0)}
    seen, styles, lines, role = {}, {}, {}, {}

    class Reader(HTMLParser):
        def __init__(self, host):
            super().__init__()
            self.path, self.roles, self.children, self.found = [host], [""], [[]], []

        def handle_starttag(self, tag, attrs):
            self.children[-1].append(tag)
            self.path.append(self.path[-1] + "/" + tag + "".join("." + re.sub("[0-9]+", "#", v) for _, v in attrs))
            above = self.roles[-1].removeprefix("in ")
            self.roles.append(tag if tag in ("article", "nav") else f"in {above}" if above else "")
            self.children.append([])
            role[self.path[-1]] = self.roles[-1]
            self.found.append(("page", self.path[-1], 0))

        def handle_endtag(self, tag):
            if children := self.children.pop():
                self.found.append(("style", self.path[-1], tuple(children)))
            self.path.pop()
            self.roles.pop()

        def handle_data(self, data):
            for node in self.path[1:]:
                if not node.endswith(("/html", "/body")):
                    self.found.append(("line", node, data))

    for url, source in pages:
        reader = Reader(url.split("/")[2])
        reader.feed(source)
        for kind, node, value in set(reader.found):
            {"page": seen, "style": styles, "line": lines}[kind].setdefault(node, []).append(value)

    def entropy(values):
        share = [values.count(v) / len(values) for v in set(values)]
        return -sum(p * math.log(p) for p in share)

    out = []
    for node, visits in seen.items():
        n = len(visits)
        value, trust = prior[role[node]]
        found, weight = value, math.log2(n)
        if own := lines.get(node):
            # how many pages hold a line, averaged over the lines shown, in logarithms
            content = 1 - sum(math.log(own.count(x)) for x in own) / len(own) / math.log(max(n, 2))
            shape = entropy(styles[node]) / math.log(max(n, 2)) if node in styles else content
            found = min(max(0.1 * shape + 0.9 * content, 0.0), 1.0)
        out.append((n, round((value * trust + found * weight) / (trust + weight), 9)))
    return sorted(out)


def test_importances_equal_a_plain_count(spark):
    from pyspark.sql import functions as F

    rng = random.Random(12)
    line = lambda: " ".join(rng.choice("alpha beta gamma".split()) for _ in range(2))
    rows = []
    for i in range(60):
        nav = "<nav>" + "".join(f"<div class=m{k}>Link {k}</div>" for k in range(rng.randrange(1, 4))) + "</nav>"
        own = "".join(f"<div class=k{rng.randrange(30)}><section>{line()}</section>{line()}</div>" for _ in range(rng.randrange(4)))
        body = f"<div class=q>{line()}</div><article><h1>Title {i}</h1>{own}</article>" if i % 3 else f"<div class=q>{own}</div>"
        rows.append((i, f"http://{rng.choice(['a', 'b', 'lone' + str(i)])}.example/{i}", f"<html><body>{nav}{body}</body></html>"))
    rows += [(60, "http://a.example/0", rows[0][2])] * 2
    pages = _pages(spark, rows).select(F.regexp_extract("url", hx.HOST, 1).alias("_host"), F.col("html").alias("_html"))
    got = sorted((int(r["pages"]), round(r["importance"], 9)) for r in hx.style_tree(pages).collect())
    want = _plain_importances([(u, h) for _, u, h in rows])
    assert len(got) == len(want) and len({i for _, i in want}) > 15
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-8 for a, b in zip(got, want))


def test_a_very_long_page(spark):
    line = "word " * 20
    page = "<article>" + f"<p>{line}</p>" * 50_000 + "</article><nav>" + "<a>Link</a>" * 50_000 + "</nav>" + "<div>" * 20_000 + "deep"
    got = _texts(_pages(spark, [(1, "http://a.example/1", page)]))[1]
    assert got == "\n".join([line.strip()] * 50_000) + "\ndeep"
