import re

import numpy as np
import pandas as pd

from drumlin.llm import html
from drumlin.llm.common import table

SF_DIR = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, text string, covered string, host string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def text(page):
    return html.main_text(html.blocks(page), {})


def test_articles(spark):
    """Against a plain reading of the pages' own template."""
    import html as entities

    found = {r.page_id: r for r in html.registered(table(spark, SF_DIR, "pages")).collect()}
    given = table(spark, SF_DIR, "pages").collect()
    assert len(found) == len(given)
    for r in given:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        parts = [re.sub(r"\s+", " ", entities.unescape(re.sub("<[^>]*>", "", x))).strip() for x in parts]
        want = "\n".join(filter(None, parts))
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (want, len(want), r.url)


def test_markup():
    page = """<html><head><title>no</title><style>p{}</style></head><body class="has-sidebar"><header>no</header>
    <nav><p>no</nav><main><header><h1>A &amp; B</h1></header><p>one<br>two <b>x</b><p>three &lt;p&gt;
    <div class="share-buttons"><p>no</div><aside>no</aside><form><input>no</form><!-- <p>no -->
    <script>"</p>no"</script><p>four</p><section id="comments"><article><p>no</article></section>
    <p class="notice">no</p><span class="ad">no</span><p>a < b &copy; 1 &amp 2</main><p>no</p><footer>no</footer>"""
    assert text(page) == "A & B\none two x\nthree <p>\nfour\na < b © 1 & 2"


def test_broken_markup():
    assert text("") == "" and text("plain") == "plain" and text("a <") == "a <"
    assert text("<article><p>x<!-- y") == "x"
    assert text("<article>x<p title='a>b'>y</p><p title=\"z") == "x\ny"
    assert text("<article>x<script>y") == "x"
    assert text("<article>" + "<b>" * 3000 + "x" + "</i>" * 3000) == "x"


def test_suffix_runs_name_equal_substrings():
    rng = np.random.default_rng(3)
    streams = [[f"t{x}" for x in rng.integers(0, 3, rng.integers(1, 40))] for _ in range(12)]
    stream, offset, number = html.suffix_runs(streams, 4)
    by = {}
    for s, o, n in zip(stream, offset, number, strict=True):
        by.setdefault(int(n), set()).add(tuple(streams[s][o : o + 4]))
    assert all(len(x) == 1 for x in by.values())
    assert len({next(iter(x)) for x in by.values()}) == len(by)
    want = sum(max(len(x) - 3, 1) for x in streams)
    assert len(number) == want


def test_boilerplate_of_pages_without_an_article(spark):
    menu = "home news sport culture science travel weather contact imprint"
    rows = [
        (i, f"http://a.example/{i}", f"<div>{menu}</div><div>story {i} " + " ".join(f"w{i}x{j}" for j in range(30)) + f"</div><div>{menu}</div>")
        for i in range(5)
    ]
    rows += [(9, "http://b.example/1", f"<div>{menu}</div>"), (10, "http://b.example/1", f"<div>{menu}</div>")]
    found = {r.page_id: r.text for r in html.registered(pages(spark, rows)).collect()}
    for i in range(5):
        assert found[i].startswith(f"story {i} w{i}x0") and "home" not in found[i]
    assert found[9] == found[10] == menu  # copies of a page are one page


def test_hot_hosts_are_sharded(spark, monkeypatch):
    menu = "one two three four five six seven eight nine"
    rows = [(i, "http://a.example/x", f"<p>{menu}</p><p>own{i} words</p>") for i in range(40)]
    monkeypatch.setattr(html, "SHARD_PAGES", 3)
    found = html.registered(pages(spark, rows)).collect()
    assert sorted(r.text for r in found) == sorted(f"own{i} words" for i in range(40))


def own(name, n=40):
    return " ".join(f"{name}x{j}" for j in range(n))


def test_near_copies_and_shared_parts_stay(spark):
    """Only furniture goes: no near copy's text, no heading, quotation or short block that pages share."""
    quote = own("quote", 12)
    rows, want = [], {}
    for i in range(6):  # near copies of one page
        rows.append((i, "http://near.example/", f"<h2>Introduction</h2><p>{own('same', 120)}</p><p>day{i} end</p>"))
        want[i] = f"Introduction\n{own('same', 120)}\nday{i} end"
    for i in range(10, 22):  # a heading on all pages, a quotation on a few, in the middle
        cited = f"<p>{quote}</p>" if i < 14 else ""
        rows.append((i, "http://mixed.example/", f"<p>{own(i)}</p><h2>Introduction</h2>{cited}<p>Yes.</p><p>{own(-i)}</p>"))
        want[i] = "\n".join(x for x in (own(i), "Introduction", quote if cited else "", "Yes.", own(-i)) if x)
    found = {r.page_id: r.text for r in html.registered(pages(spark, rows)).collect()}
    assert found == want


def test_furniture_inside_articles(spark, monkeypatch):
    """Found by the host's suffix arrays, whatever its classes are named, and in all shards."""
    letter = "<p>Get the best of our stories</p><p>in your mailbox every single morning</p>"
    line = "one line that every page repeats in its middle"
    rows = [(i, "http://a.example/", f"<article><p>{own(i)}</p><p>{line}</p><p>{own(-i)}</p><div class='zz'>{letter}</div></article>") for i in range(1, 13)]
    rows += [(20 + i, "http://b.example/", f"<article><p>{own(i)}</p>{letter}</article>") for i in range(2)]  # two pages are too few
    for shard in (html.SHARD_PAGES, 3):
        monkeypatch.setattr(html, "SHARD_PAGES", shard)
        found = {r.page_id: r.text for r in html.registered(pages(spark, rows)).collect()}
        assert all(found[i] == f"{own(i)}\n{line}\n{own(-i)}" for i in range(1, 13))
        assert all("mailbox" in found[20 + i] for i in range(2))


def test_edge_cases(spark):
    rows = [(1, None, None), (2, None, ""), (None, "x", "<p>y"), (2, None, ""), (5, "http://h/", "<article>" + "w " * 50_000)]
    found = html.registered(pages(spark, rows)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 1), (1, 0), (2, 0), (2, 0), (5, 99_999)]
    assert html.registered(pages(spark, [])).count() == 0
    assert set(html.extract(pages(spark, rows)).columns) == {"page_id", "url", "covered", "host", "text"}


def test_tokens_are_counted_by_bucket(spark, monkeypatch):
    """A vector a host and batch, not a row a token, is what moves; a bucket never counts fewer pages than its tokens are on."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 60 * (1 + i % 3) ** 4, 40 + i)) for i in range(60)]
    bodies = [html._packed([html.Block(html.OPEN, x)]) for x in texts]
    hosts = ["a" if i % 3 else "b" for i in range(60)]
    frame = pd.DataFrame({"host": hosts, "body": bodies})
    found = pd.concat(html._token_counts(iter([frame[:25], frame[25:]])))
    assert len(found) == 4
    for name, parts in found.groupby("host"):
        size = int(parts["size"].max())
        total = html._added(parts["counts"], size)
        sets = [set(x.split(" ")) for x, h in zip(texts, hosts, strict=True) if h == name]
        for token in set().union(*sets):
            at = int(pd.util.hash_array(np.array([token], dtype=object), categorize=False).astype(np.int64)[0]) & (size - 1)
            assert total[at] >= sum(token in x for x in sets)
    menu = "home news sport culture science travel weather contact imprint"
    rows = [(i, "http://a.example/", f"<div>{menu}</div><p>{own(f'w{i}')}</p><div>{menu}</div>") for i in range(12)]
    want = {i: own(f"w{i}") for i in range(12)}
    assert {r.page_id: r.text for r in html.registered(pages(spark, rows)).collect()} == want
    exact = html._token_counts

    def crowded(batches):  # eight buckets, all full: every token passes for common
        for part in exact(batches):
            full = html._packed_counts(np.full(8, 12))
            yield part.assign(size=8, counts=[full] * len(part))

    monkeypatch.setattr(html, "_token_counts", crowded)
    assert {r.page_id: r.text for r in html.registered(pages(spark, rows)).collect()} == want
