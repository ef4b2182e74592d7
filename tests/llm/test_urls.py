"""Verdicts against a plain loop over all rules, with colliding digests and several files."""

import random

import pytest

from millrace.llm import urls as U

PAGES = "page_id long, url string, host int, rule int"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("b.example.net", "/en/x", "block"), ("q.org", "", "block")]
URLS = [
    None, "", "no scheme", "http://", "http:///", "http://net", "http://net/", "HTTP://A.Example.NET/en/1?x#y", "http://example.net/EN/",
    "http://b.example.net/en/x", "http://b.example.net/en/y", "https://notexample.com/de/", "https://example.com/de", "https://x.y.example.com/de/?q=://z",
    "a://b://c.net/", "http://user@org/fr/", "http://.org/fr/a", "http://é.Q.org", "http://ÉQ.org?x", "http://e.org#/fr/", "http://e.org/fr/\nx", "//net/", "http://net:80/", "x://q.org/fr/",
]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
        path = rest[stop:].split("?")[0].split("#")[0]
    fits = []
    for h, p, verdict in rules:
        h, p = (h or "").lower(), p or ""
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), h + p, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


@pytest.fixture
def rules(frame):
    return lambda rows: frame("host string, path string, verdict string", rows)


@pytest.mark.parametrize("how", ["plain", "collisions", "files"])
def test_judge(spark, frame, rules, monkeypatch, how):
    rng = random.Random(0)
    more = [(f"h{rng.randrange(50)}.example.org", f"/{'p' * rng.randrange(4)}/", rng.choice(["block", "allow"])) for _ in range(150)]
    keyed = {h.lower() + (p or ""): (h, p, v) for h, p, v in RULES + more}
    urls = URLS + [f"http://{rng.choice(['', 'w.'])}h{rng.randrange(60)}.example.org/{'p' * rng.randrange(4)}/z" for _ in range(200)]
    if how == "files":
        monkeypatch.setattr(U, "FILE_BYTES", 500)
    if how == "collisions":
        monkeypatch.setattr(U, "_digest", lambda key: len(key))
        files = U.Digests.__new__(U.Digests)
        packed = U._packed([(h.lower() + p, v) for h, p, v in keyed.values()])
        monkeypatch.setattr(U.np, "memmap", lambda *a, **k: U.np.frombuffer(packed, dtype=U.np.uint8))
        files.__init__("")
        keys = [h.lower() + p for h, p, _ in keyed.values()] + ["other", "net"]
        found = files.find(keys, U.np.array([len(k) for k in keys], dtype="<u8"))
        assert found == {i: v for i, (_, _, v) in enumerate(keyed.values())}
        return
    given = rules([*keyed.values(), (None, "/", "block"), ("", "/", "block"), ("z", None, None)])
    got = U.judge(frame(PAGES, [(i, u, 1, 1) for i, u in enumerate(urls)]), given).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id], keyed.values())


def test_block_list_comes_after_rules(spark, frame, rules):
    pages = frame(PAGES, [(1, "http://a.spam.net/en/", 1, 1), (1, "http://a.spam.net/en/", 1, 1), (None, "http://spam.net", 1, 1), (3, "http://x.y", 1, 1)])
    got = U.judge(pages, rules([("spam.net", "/en/", "allow")]), rules([("spam.net", None, "block")])).collect()
    assert sorted((str(r.page_id), r.rule, r.verdict, r.listed) for r in got) == sorted([
        ("1", "spam.net/en/", "allow", "spam.net"), ("1", "spam.net/en/", "allow", "spam.net"), ("None", None, "block", "spam.net"), ("3", None, "allow", None),
    ], key=lambda r: r[0])


def test_empty_tables(spark, frame, rules):
    assert U.judge(frame(PAGES, []), rules(RULES)).count() == 0
    assert [r.verdict for r in U.judge(frame(PAGES, [(1, "http://net/", 1, 1)]), rules([])).collect()] == ["allow"]
