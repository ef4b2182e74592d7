"""Pages with a known text, and repeated substrings against comparing all pairs of pages."""

import html
import random
import re
import time

import pytest

from millrace.llm import extraction as E
from millrace.llm import queries

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, text string, row int, host int"


def page(body, title="T"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>if (a<b) x='</p>'</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        (None, ""),
        ("", ""),
        ("<article>", ""),
        ("just text &amp; more", "just text & more"),
        (page("<nav>menu</nav><article><h1>Head  line</h1><p>One <b>two\n<br>three<p>Four &lt;five&gt;&nbsp;&#233;</article><footer>foot</footer>"), "Head line\n\nOne two three\n\nFour <five> é"),
        (page("<header>top</header><div id='sidebar'>side</div><main><p>Text<!-- no --> here</p><aside>not</aside><form>f</form></main>"), "Text here"),
        (page("<article><header><h1>Title</h1></header><p>Body</p><div class=\"ad\">buy</div><section id=comments><article>me too</article></section></article>"), "Title\n\nBody"),
        (page("<div class='page with-sidebar'><div class='nav content'><article><p>In</p></article></div></div>"), "In"),
        (page("<article><p>a</p><ul><li>b<li>c</ul><table><tr><td>d<td>e</table><script>no</script><p>f"), "a\n\nb\n\nc\n\nd\n\ne\n\nf"),
        (page("<article><p class=cookie>no<p>yes</article>"), "yes"),
        (page("<article><p>1 < 2 & 3 > 2 \"q\" <img alt='x > y' src=a>z</p></article>"), '1 < 2 & 3 > 2 "q" z'),
        (page("<p>open text without an article</p><div class='cookie notice'>we use cookies</div>"), "open text without an article"),
        ("<article><p>cut off <b", "cut off <b"),
        ("<article>" + "<p>x</p>" * 5000 + "</article>", "\n\n".join("x" * 5000)),
    ],
)
def test_text_of_a_page(spark, frame, markup, text):
    row = E.extract(frame(PAGES, [(1, "http://a.b/", markup, "t", 1, 1)])).first()
    assert (row.page_id, row.url, row.text, row.n_chars) == (1, "http://a.b/", text, len(text))


def test_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in E.extract(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n\n".join(p for p in parts if p)


@pytest.mark.parametrize("piece", ["<a ", '<a ">"', "<a '\">", "<b><a \"", "</script ", "<b></i>", "<!-", "<script>", "<a\"", "&"])
@pytest.mark.parametrize("end", ["", ">", "</p>", "<p>z</p>"])
def test_long_odd_markup(piece, end):
    begun = time.perf_counter()
    E.blocks("<script>" * (piece == "</script ") + piece * (1_000_000 // len(piece)) + end)
    assert time.perf_counter() - begun < 20


def test_tags_against_one_pattern():
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choice(["<a ", "<b", '"', "'", ">", "x", "<!--", "-->", "</a>", " "]) for _ in range(rng.randint(0, 25)))
        first, at = E._tag_reader(text), 0
        while tag := E._TAG.search(text, at):
            assert first(at).span() == tag.span() and first(at)[3] == tag[3], text
            at = tag.end()
        assert first(at) is None


def plain_unique(tokens, others, size):
    """Tokens not covered by a substring of ``size`` tokens that another stream has."""
    runs = {tuple(o[i : i + size]) for part in others for o in part for i in range(len(o) - size + 1)}
    kept = [True] * len(tokens)
    for i in range(len(tokens) - size + 1):
        if tuple(tokens[i : i + size]) in runs:
            kept[i : i + size] = [False] * size
    return [t for t, k in zip(tokens, kept) if k]


def test_repeated_substrings(spark, frame):
    rng = random.Random(6)
    phrases = [[rng.choice("abcdef") + str(rng.randrange(5)) for _ in range(rng.randint(3, 9))] for _ in range(25)]
    rows, streams = [], {}
    for i in range(60):
        host = f"h{i % 3 if i < 40 else 0}"
        menu, free = (sum((rng.choice(phrases) for _ in range(rng.randint(0, 3))), []) for _ in range(2))
        free = free + [f"own{i}"] * rng.randint(0, 8)
        if i in (7, 10):  # equal streams on one host
            menu, free = ["m"] * 9, ["n"] * 9
        body = f"<nav>{' '.join(menu)}</nav><p>{' '.join(free)}</p>" + ("<article>art</article>" if i % 5 == 0 else "")
        rows.append((i, f"http://{host}/x", page(body), "t", 1, 1))
        streams[i] = (host, free, menu)
    got = {r.page_id: r.text for r in E.extract(frame(PAGES, rows)).collect()}
    for i, (host, free, menu) in streams.items():
        if i % 5 == 0:
            assert got[i] == "art"
            continue
        others = [(f, m) for h, f, m in streams.values() if h == host and (f, m) != (free, menu)]
        assert got[i].split() == plain_unique(free, others, E.RUN_TOKENS), i


def test_odd_rows(spark, frame):
    rows = [(None, None, "<p>a b</p>", "t", 1, 1), (1, "x", None, "t", 1, 1), (1, "x", None, "t", 1, 1), (2, "http://h/", "<p>" + "w " * 100_000, "t", 1, 1)]
    got = sorted(((str(r.page_id), r.text, r.n_chars) for r in E.extract(frame(PAGES, rows)).collect()))
    assert got == [("1", "", 0), ("1", "", 0), ("2", ("w " * 100_000).strip(), 199_999), ("None", "a b", 3)]
    assert E.extract(frame(PAGES, [])).count() == 0


def test_only_whole_blocks_of_many_pages_go(spark, frame, tmp_path):
    footer = "all the news of the town and what else goes on here"
    phrase = "at the end of the day it is what counts"
    reprint = " ".join(f"r{i}" for i in range(40))
    rows, want = [], []
    for i in range(12):
        prose = f"own{i} first {phrase} and own{i} last"
        parts = [prose, *([reprint] if i in (3, 8) else []), f"only{i}"]
        body = "".join(f"<p>{p}</p>" for p in parts) + f"<div><p>{footer}</p></div>"
        rows.append((i, "http://h/x", page(body), "t", 1, 1))
        want.append("\n\n".join(parts))
    frame(PAGES, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in queries.op5_extraction(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(want))


def test_share_of_a_hosts_pages(spark, frame):
    shared = "one two three four five six seven"
    rows = [(i, f"http://{h}/x", page(f"<p>own{h}{i}</p>" + f"<p>{shared}</p>" * (i < 6)), "t", 1, 1) for h, n in (("a", 8), ("b", 30)) for i in range(n)]
    got = E.extract(frame(PAGES, rows), least_pages=5, share=0.5, whole_blocks=True).collect()
    kept = {h: sum(shared in r.text for r in got if r.url == f"http://{h}/x") for h in "ab"}
    assert kept == {"a": 0, "b": 6}


def plain_left(streams, size, least_pages, share):
    """Texts of one host's pages, given as ``(article, blocks, rest)``, by comparing all runs."""

    def runs(tokens):
        return {tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)}

    distinct = {(tuple(" ".join(b).split()), tuple(r.split())) for _, b, r in streams}
    held = [runs(b) | runs(r) for b, r in distinct]
    texts = []
    for article, parts, _ in streams:
        tokens, covered = " ".join(parts).split(), set()
        for i in range(len(tokens) - size + 1):
            pages = sum(tuple(tokens[i : i + size]) in h for h in held)
            if pages >= least_pages and pages >= share * len(distinct):
                covered.update(range(i, i + size))
        kept, at = [], 0
        for p in parts:
            n = len(p.split())
            if not covered.issuperset(range(at, at + n)):
                kept.append(p)
            at += n
        texts.append("\n\n".join(parts if article and 2 * len(" ".join(kept).split()) < len(tokens) else kept))
    return texts


@pytest.mark.parametrize("group_pages", [4, 1000])
@pytest.mark.parametrize("share", [0.2, 0.5])
def test_main_text_against_all_runs(spark, frame, monkeypatch, group_pages, share):
    monkeypatch.setattr(E, "GROUP_PAGES", group_pages)
    rng = random.Random(8)
    shared = [" ".join(f"s{rng.randrange(9)}" for _ in range(rng.randint(4, 12))) for _ in range(6)]
    rows, hosts = [], {}
    for i in range(90):
        host, article = f"h{min(i % 10, 3)}", rng.random() < 0.6
        parts = [rng.choice(shared) if rng.random() < 0.6 else f"own{i} " * rng.randint(1, 14) for _ in range(rng.randint(1, 5))]
        rest = rng.choice(shared)
        if i in (7, 17, 27):  # equal pages count once
            article, parts, rest = True, shared[:3], shared[3]
        name = "article" if article else "div"
        rows.append((i, f"http://{host}/x", page(f"<nav>{rest}</nav><{name}>" + "".join(f"<p>{p}</p>" for p in parts) + f"</{name}>"), "t", 1, 1))
        hosts.setdefault(host, []).append((i, (article, [" ".join(p.split()) for p in parts], rest)))
    want = {}
    for pages in hosts.values():
        want |= dict(zip([i for i, _ in pages], plain_left([s for _, s in pages], E.RUN_TOKENS, 5, share)))
    got = {r.page_id: r.text for r in E.main_text(frame(PAGES, rows), share=share).collect()}
    assert got == want
    assert any(got[i] != "\n\n".join(s[1]) for pages in hosts.values() for i, s in pages if s[0])


def test_notice_in_articles_goes_and_reprints_stand(spark, frame, tmp_path):
    notice = "sign up here for all the news of the town"
    reprint = " ".join(f"r{i}" for i in range(40))
    rows, want = [], []
    for i in range(12):
        own = reprint + f" last{i}" if i < 7 else f"own{i} is what this page has to say, and no other"
        rows.append((i, "http://h/x", page(f"<article><p>{own}</p><p>{notice}</p></article>"), "t", 1, 1))
        want.append(own)
    rows += [(20 + i, "http://g/x", page(f"<article><p>{reprint}</p></article><nav>n{i}</nav>"), "t", 1, 1) for i in range(8)]
    frame(PAGES, rows).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in queries.op5_extraction(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(want)) | {20 + i: reprint for i in range(8)}


def test_articles_without_their_tags(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    stripped = pages.selectExpr("page_id", "url", "regexp_replace(html, '</?article>', '') html")
    got, want = ({r.page_id: r.text for r in E.main_text(p).collect()} for p in (stripped, pages))
    assert got == want
    assert want == {r.page_id: r.text for r in E.extract(pages).collect()}
