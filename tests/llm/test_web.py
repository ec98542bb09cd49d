"""Urls and pages."""

import html
import random
import re

import pytest

from fundtrail.llm import pages, registry, urls
from tests.conftest import SF_SMALL


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


ODD_URLS = [
    None, "", "example.com/en/1", "http://", "http://Example.COM/en/1", "http://www.example.com/en/x?y#z", "x://net/es/",
    "http://a.net/es", "http://a.net?/es/", "http://notexample.com/en/", "https://a.b.example.com/en/", "http://com/", "http://com",
    "http://É.example.com/en/", "a://b://c/d", "http://x.net/fr/1/2/3/4/5/6/7/8/9", "http://x.net//fr/",
]


def test_host_path_and_rules(spark):
    frame = spark.createDataFrame(list(enumerate(ODD_URLS)) + [(None, "http://x.net/fr/")], "page_id long, url string")
    frame = frame.selectExpr("*", "'h' as host", "'t' as template", "1 as id", "0 as bad")
    rows = urls.filter_urls(frame, registry.URL_RULES).collect()
    assert len(rows) == len(ODD_URLS) + 1
    for r in rows:
        url = ODD_URLS[r["page_id"]] if r["page_id"] is not None else "http://x.net/fr/"
        assert (r["host"], r["path"]) == plain(url)
        rule = plain_rule(r["host"], r["path"], registry.URL_RULES)
        assert r["rule"] == (rule.text if rule else None)
        assert r["verdict"] == (rule.verdict if rule else "allow")
    assert urls.filter_urls(frame.limit(0), registry.URL_RULES).count() == 0


def test_registered_query(spark):
    source = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = registry.op3_url_filter(spark, SF_SMALL).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert (r["host"], r["path"]) == plain(source[r["page_id"]])
        rule = plain_rule(r["host"], r["path"], registry.URL_RULES)
        assert r["rule"] == (rule.text if rule else None)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == rule.verdict)


def test_templates_learn_from_labels(spark):
    rows, labels = [], []
    for k in range(200):
        rows += [(4 * k, f"http://shop.org/deal/{k}.html"), (4 * k + 1, f"http://shop.org/news/item-{k}/text")]
        rows += [(4 * k + 2, f"http://shop.org/user/name{chr(97 + k % 26)}{k % 7}/posts"), (4 * k + 3, "http://other.org/deal/7.html")]
        if k % 4 == 0:
            labels += [(4 * k, 1), (4 * k + 1, 0), (4 * k + 2, int(k % 8 == 0))]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(labels, "page_id long, bad int")
    got = {r["page_id"]: r for r in urls.filter_urls(frame, [], labels=known).collect()}
    assert got[0]["template"] == "/deal/<num>.html" and got[1]["template"] == "/news/<any>/text"
    assert got[2]["template"] == "/user/<any>/posts"
    assert {got[4 * k]["verdict"] for k in range(200)} == {"block"}
    assert {got[4 * k + 1]["verdict"] for k in range(200)} == {"allow"}
    assert {got[4 * k + 2]["verdict"] for k in range(200)} == {"allow"}
    assert {got[4 * k + 3]["verdict"] for k in range(200)} == {"allow"}  # no labelled url of its own


def test_registered_query_blocks_by_the_tree(spark, tmp_path):
    """The rules block /fr/<num> on many net hosts; a host without rule follows, but not for other templates or with labels."""
    rows = [f"http://h{h}.net/fr/{k}" for h in range(5) for k in range(8)]
    rows += [f"http://h{h}.net/de/{k}" for h in range(5) for k in range(8)]
    other = ["http://a.org/fr/77", "http://b.org/de/77", "http://c.org/fr/seventy", "http://d.org/", "http://shop.com/fr/77"]
    pages_ = [(k, u, "") for k, u in enumerate(rows + other)]
    spark.createDataFrame(pages_, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in registry.op3_url_filter(spark, str(tmp_path)).collect()}
    assert len(got) == len(pages_)
    verdicts = [got[len(rows) + k]["verdict"] for k in range(len(other))]
    assert verdicts == ["block", "allow", "allow", "allow", "allow"]
    assert got[len(rows)]["rule"] is None and got[len(rows)]["template"] == "/fr/<num>"


def test_an_unlike_branch_stays_out_of_the_merged_one(spark):
    """One bad branch among 20 good ones, 30 labelled urls each: the others merge, and their share has none of its urls."""
    rows = [("h", f"/a/b{b}", int(b == 0)) for b in range(21) for _ in range(30)] + [("h", "/a/new", None)]
    frame = spark.createDataFrame(rows, "host string, template string, bad int")
    got = {r["template"]: r for r in urls.template_purity(frame).collect()}
    assert got["/a/b0"]["labelled"] == 30 and got["/a/b0"]["purity"] > 0.9
    assert got["/a/b1"]["labelled"] == got["/a/new"]["labelled"] == 600
    assert got["/a/b1"]["purity"] < 0.01


def article_text(source):
    m = re.search(r"<article>(.*?)</article>", source, re.DOTALL)
    parts = re.split(r"</?(?:p|h1|br)[^>]*>", m[1]) if m else []
    clean = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in parts]
    return "\n\n".join(x for x in clean if x)


def test_article_text(spark):
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = registry.op9_html_text(spark, SF_SMALL).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r["text"] == article_text(source[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    "source,blocks",
    [
        (None, []),
        ("", []),
        ("plain text", ["plain text"]),
        ("<div>a<p>b<br>c<b>d</b> e<script>x='</p>'</script></div>", ["a", "b cd e"]),
        ("<article><h1>T</h1><p>x<div class='ad'>ad</div><p>y&nbsp;&amp;<section class=comments><p>no</section></article>", ["T", "x", "y &"]),
        ("<nav>n</nav><div id=main>Hello<ul><li>1<li>2</ul></div><footer>f</footer>", ["Hello", "1", "2"]),
        ("<p>a &lt;b&gt; &copy; <!-- c --> d", ["a <b> © d"]),
        ("<p>open <b>bold", ["open bold"]),
        ("<form>f</form><aside>s</aside><p>t</p><style>p{}</style>", ["t"]),
        ("<article><header><h1>In</h1></header><p>x</article><header>Out</header>", ["In", "x"]),
    ],
)
def test_blocks(source, blocks):
    kept = [b for b in pages.blocks_of(source or "") if b[1] and not b[2]]
    assert [b[1] for b in ([b for b in kept if b[3]] or kept)] == blocks


def test_template_text_is_no_content(spark):
    """Pages without an element for the article: what all pages of the host share goes."""
    page = "<html><body><div class=top><span>Welcome</span></div><div class=x>Our notice</div><div class=y>About us</div><div class=z>{}</div><p>{}</p></body></html>"
    rows = [(k, f"http://a.org/{k}", page.format("Imprint", f"own text {k}")) for k in range(8)]
    rows += [(20, "http://b.org/1", page.format("Imprint", "lonely")), (None, "http://a.org/n", page.format("Imprint", "own text n"))]
    rows += [(21, None, None), (22, "http://a.org/e", ""), (7, "http://a.org/7", page.format("Imprint", "own text 7"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as host", "3 as tokens")
    got = pages.extract_text(frame).collect()
    assert len(got) == len(rows)
    text = {}
    for r in got:
        text.setdefault(r["page_id"], []).append(r["text"])
    assert text[3] == ["own text 3"] and text[7] == ["own text 7"] * 2 and text[None] == ["own text n"]
    assert text[20][0].startswith("Welcome") and text[21] == [""] and text[22] == [""]
    assert pages.extract_text(frame.limit(0)).count() == 0


def test_template_text_inside_the_article(spark):
    """What all pages of a host share goes inside the article too; the element that holds the article needs no telling name."""
    rng = random.Random(6)
    say = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    inside = "<html><body><div class=q><p>{}</p></div><article><div class=z>Read in the app</div><p>{}</p><p>{}</p><div class=k>Write to us</div></article></body></html>"
    plain = "<html><body><div class=q><p>{}</p></div><div class=u><div class=v>Our notice</div><p>{}</p><p>{}</p></div></body></html>"
    rows, want = [], {}
    for k in range(24):
        one, two = (say(30) for _ in range(2)) if k % 8 or k % 2 else ("the same", "copied text")
        page = (inside if k % 2 else plain).format(say(4), one, two)
        rows.append((k, f"http://host{k % 2}.org/{k}", page))
        want[k] = f"{one}\n\n{two}"
    rows += [(100 + k, f"http://copies.org/{k}", inside.format("x", "all alike", "again")) for k in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract_text(frame).collect()}
    assert {k: got[k] for k in want} == want
    assert all("all alike\n\nagain" in got[100 + k] for k in range(6))
