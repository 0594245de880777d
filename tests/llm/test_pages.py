"""Main text of pages and URL verdicts."""

import html
import random
import re
from collections import Counter

from corpusloom.llm import q_pages
from corpusloom.llm.html_text import best_run, extract_text, learn_weights, main_text, token_counts, weights_of
from corpusloom.llm.url_templates import judge_urls

SF = "/root/testdata/sf0.01"


def article(page):
    """The article of the test pages by its own tags."""
    body = page[page.index("<article>") + 9:].split("</article>")[0]
    lines = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\n", body)).split("\n")
    return "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in lines) if x)


def test_every_page_gives_its_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = q_pages.op6_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


WEIGHTS = weights_of({(False, "#word", False, True): 900, (False, "#word", False, False): 40, (False, "#link", False, False): 60,
                      (False, "li", False, False): 60, (False, "p", False, True): 100, (False, "h1", False, True): 10, (True, "#word", True, True): 900})


def test_pages_without_marks_and_with_disturbances():
    cases = {
        "<body><header><h1>Site</h1></header><nav><a href=1>a</a></nav><div id='content'><div class=\"ad\">buy this</div><h2>Hello</h2>"
        "<p>Some long paragraph with many words in it to keep.</p><div class='comments'><p>I comment a lot about it all</p></div></div>"
        "<aside>side</aside><form><label>Name</label></form><footer>(c)</footer></body>": "Hello\nSome long paragraph with many words in it to keep.",
        "<div class=sidebar>x<article><h1>T</h1><p>one &amp; two&nbsp;three</p><aside>no</aside><ul><li>l1</li><li><a href=x>l2</a></li></ul>"
        "<p>last</article><section class='comments'><article class='comment'><p>hey</p></article></section>": "T\none & two three\nl1\nl2\nlast",
        "plain text only": "plain text only",
        "<p>unclosed <b>bold": "unclosed bold",
        "<script>alert('x')": "",
        '<a href="a>b">link</a> text': "link text",
        "<p>a<br>b</p><!-- x": "a b",
        "<article><header><h1>Head</h1></header><p>x &#233;&#xFC;&euro;</p></article>": "Head\nx éü€",
        "": "",
    }
    for page, text in cases.items():
        assert main_text(page, WEIGHTS) == text


def test_extraction_defined_cases(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<article><p>a  b\n c</p></article>", None), (3, "<article><p>a  b\n c</p></article>", None), (4, "<p>" + "word " * 60000 + "</p>", "x")]
    df = spark.createDataFrame(rows, "page_id int, html string, TEXT string")
    got = extract_text(df).drop("html").collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got[:4]] == [(1, "", 0), (2, "", 0), (3, "a b c", 5), (3, "a b c", 5)] and got[4].n_chars == 299999
    assert extract_text(df.limit(0)).collect() == []
    assert not token_counts("<p>no mark</p>")


def without_names(page):
    """A page whose sectioning elements are all ``div`` and that has no class, id or role."""
    page = re.sub(r"<(/?)(?:nav|article|main|footer|aside|section|header|form)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"(<[a-z0-9]+)\s+(?:class|id|role)=\"[^\"]*\"", r"\1", page)


def test_weights_find_the_article_of_pages_without_names(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").repartition(3)
    weights = learn_weights(pages)
    total = Counter()
    for page in (r.html for r in pages.collect()):
        want, got = Counter(article(page).split()), Counter(main_text(without_names(page), weights).split())
        total.update(both=sum((want & got).values()), want=sum(want.values()), got=sum(got.values()))
    assert total["both"] >= 0.99 * total["want"] and total["both"] >= 0.99 * total["got"]


def test_best_run_against_all_runs():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randrange(12)
        costs = [-rng.choice([0, 0.5, 1, 4]) for _ in range(n)]
        values = [rng.choice([0, 0, 0.5, 1, 3]) for _ in range(n)]
        score = lambda a, b: sum(values[a:b]) + sum(costs[a + 1:b])  # noqa: B023, E731
        first, end = best_run(costs, values)
        assert score(first, end) == max((score(a, b) for a in range(n) for b in range(a + 1, n + 1)), default=0)


def test_classes_are_learned_from_labelled_pages(spark):
    outside = '<div class="teaser-rail"><p>{}</p></div>'.format("read this now " * 10)
    rows = [(i, f"<body>{outside if i % 2 else ''}<article><p>{'some words of it ' * 20}</p><div class='lead'><p>lead text</p></div></article>{outside}</body>") for i in range(30)]
    weights = learn_weights(spark.createDataFrame(rows, "page_id int, html string"))
    assert weights[False, ".teaser", False] < 0.02 and weights[False, ".lead", False] > 0.9
    page = f"<div><p>{'first part ' * 40}</p>{outside}<p>{'second part ' * 40}</p></div>"
    want = ("first part " * 40).strip() + "\n" + ("second part " * 40).strip()
    assert main_text(page, weights) == want and main_text(f"<article>{page}</article>", weights) == want
    assert learn_weights(spark.createDataFrame([(1, None), (2, "<p>no mark</p>")], "page_id int, html string")) == {}


def longest_rule(host, path):
    fits = [(r, ok) for r, ok in q_pages.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits, key=lambda r: len(r[0])) if fits else None


def test_hosts_paths_and_rules(spark):
    rows = q_pages.op10_url_templates(spark, SF).collect()
    urls = dict(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect())
    assert len(rows) == len(urls)
    for r in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (m[1], m[2]) if m else ("", "")
        host = re.sub("[A-Z]", lambda c: c.group().lower(), host)
        rule = longest_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        assert r.verdict == ("allow" if (rule[1] if rule else r.purity >= 0.5) else "block")


def test_url_plan_has_no_python(spark):
    plan = q_pages.op10_url_templates(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_url_defined_cases(spark):
    urls = [None, "nourl", "HTTP://A.Example.ORG/ES/x", "http://a.example.org/es/x?u", "http://org", "http://org/", "http://xorg/a", "x://Ü.COM/fr/#a", "http://h/a://b/c", "http://a.example.org/en/1", "http://h/a://b/c"]
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)], "page_id int, url string, HOST string")
    got = {r.page_id: r for r in judge_urls(df, q_pages.RULES).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(10)] == [
        ("", "", None), ("", "", None), ("a.example.org", "/ES/x", "org/"), ("a.example.org", "/es/x", "example.org/es/"), ("org", "", None),
        ("org", "/", "org/"), ("xorg", "/a", None), ("Ü.com", "/fr/", "com/fr/"), ("h", "/a://b/c", None), ("a.example.org", "/en/1", "example.org/en/1")]
    assert len(got) == 11 and judge_urls(df.limit(0), q_pages.RULES).collect() == []


def test_templates_reject_by_purity_and_generalise(spark):
    rows = [(i, f"http://h.com/de/{i}/slug-{i}") for i in range(60)] + [(100 + i, f"http://h.com/fr/{i}") for i in range(60)]
    rows += [(200 + i, f"http://other.net/de/{i}/name{chr(97 + i % 26)}x") for i in range(30)] + [(300 + i, f"http://other.net/fr/{i}") for i in range(30)]
    rows += [(400 + i, f"http://x.net/user{'abcdefghijklmnopqrstuvwxyz'[i]}q/page") for i in range(26)]
    df = spark.createDataFrame(rows, "page_id int, url string")
    got = {r.page_id: r for r in judge_urls(df, q_pages.RULES).collect()}
    assert got[0].verdict == "block" and got[100].verdict == "allow" and got[300].verdict == "allow"
    assert {got[400 + i].template for i in range(26)} == {got[400].template} and "user" not in got[400].template


def test_templates_generalise_and_merge_below_the_first_level(spark):
    name = lambda i: chr(97 + i % 26) + chr(97 + i // 26)
    rows = [(i, f"http://h.com/de/s{name(i)}/t{name(i)}") for i in range(60)] + [(100 + i, f"http://h.com/fr/{i}") for i in range(300)]
    rows += [(1000 + i, f"http://other.net/de/u{name(i)}/v{name(i)}") for i in range(60)]
    rows += [(2000 + 2 * i + k, f"http://m.com/{lang}/{part}/page/{i}") for i in range(0, 400, 2) for k, (lang, part) in enumerate(
        [("de", "aa"), ("de", "bb"), ("fr", "aa"), ("fr", "bb")])]
    df = spark.createDataFrame(rows, "page_id int, url string")
    got = [(r.url.split("/")[2:5], r) for r in judge_urls(df, q_pages.RULES).select("*").collect()]
    other = [r for u, r in got if u[0] == "other.net"]
    assert len({r.template for r in other}) == 1 and other[0].template.endswith("/*/*") and {r.verdict for r in other} == {"block"}
    assert {(u[1], r.template) for u, r in got if u[0] == "m.com"} == {("de", "/de/{}/page/#"), ("fr", "/fr/{}/page/#")}


def test_names_of_headings_and_long_attributes():
    page = (f'<nav>menu</nav><article><h2 id="market-share">Market</h2><p id="search-results">One <img alt="a > b" src="data:{"x" * 50_000}>"> two</p>'
            '<div class="related">Other</div><p class="comment">Three</p></article><div id="sidebar">Side</div>')
    assert main_text(page, {}) == "Market\nOne two\nThree"
