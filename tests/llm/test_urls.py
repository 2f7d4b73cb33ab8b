import re

from rillmart.llm import urls

RULES = (*urls.SITE_RULES, ("a.org/x", "block"), (r"/\/cgi-bin\//", "block"), (r"/[0-9]{6}/", "block"))


def by_hand(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in RULES:
        if rule.startswith("/"):
            continue
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    blocked = bool(url and (re.search(r"/cgi-bin/", url.lower()) or re.search("[0-9]{6}", url)))
    return host, path, best and best[0], best[1] if best else "block" if blocked else "allow"


def test_every_url_as_by_hand(spark):
    from rillmart.llm.frames import ready
    ready(spark)
    given = [None, "", "no scheme", "http://", "http://WWW.Example.com/en/a?x#y", "https://example.com/en/", "https://badexample.com/en/",
             "http://m.example.com/en", "http://x.net/es/1", "http://x.net/ES/1", "http://net/fr/", "http://a.org/xyz", "http://a.org/x",
             "http://a.org/cgi-bin/z", "ftp://u@h:80/p/123456", "http://com", "http://com?/", "http://É.com/", "http://x.com/" + "a/" * 5000,
             "http://example.com/en/", "http://example.com/en/"]
    pages = spark.createDataFrame([(i if i % 7 else None, u, "r", "v") for i, u in enumerate(given)],
                                  "page_id long, url string, rule string, verdict string")
    out = urls.judge_urls(pages, RULES).collect()
    got = sorted(map(repr, ((r.url, r.host, r.path, r.rule, r.verdict) for r in out)))
    assert got == sorted(map(repr, ((u, *by_hand(u)) for u in given)))
    assert urls.judge_urls(pages.limit(0), RULES).count() == 0


def test_passes_of_few_rules_agree(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.org/xyz"), (2, "http://www.example.com/en/")], "page_id long, url string")
    once = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, RULES).collect()}
    monkeypatch.setattr(urls, "BLOCK_RULES", 2)
    assert {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, RULES).collect()} == once


def test_rules_are_filed_under_their_rarest_token():
    rules = [urls.parse_rule("www.example.com/en/", "allow"), urls.parse_rule("com/en", "block"), urls.parse_rule("/[0-9]+/", "block")]
    assert rules[0].needs == (("www",), ("example",), ("com",), ("en",)) and rules[1].needs == (("com",),)
    index = urls.index_rules(rules, {"com": 9, "example": 5, "www": 2, "en": 3})
    assert {k: [r.pattern for r in v] for k, v in index.items()} == {
        "www": ["www.example.com/en/"], "com": ["com/en"], "": ["/[0-9]+/"]}


def test_an_alternation_is_filed_under_a_token_of_each_branch():
    rules = [urls.parse_rule(r"/\.(?:exe|my-zip)$/", "block"), urls.parse_rule(r"/\/a\//", "block")]
    index = urls.index_rules(rules, {"zip": 1, "exe": 2, "a": 1})
    assert {k: len(v) for k, v in index.items()} == {"exe": 1, "zip": 1, "a": 1}
    assert all(r.needs for r in (urls.parse_rule(*x) for x in urls.PATTERN_RULES))


EXPRESSIONS = (
    r"\/ab\/", r"ab\.", r"\.ab", r"\.(?:ab|b-a|a)(?:$|[?#])", r"\.(?:ab|b*)\.", r"\/a+\/", r"\/ab?\/", r"\/(?:b\.)?a\/", r"\/(?:b)?a\/",
    r"\/[^a]b\/", r"\/[/.]b\/", r"(?i)\/AB\/", r"(?i:A)b\/", r"\ba\b", r"\Bb\.", r"^a\/", r"a$", r"(?:^|\/)a(?=\/)", r"\/(?!b)a\.", r"\/(a|b)\.\1",
    r"\.a{2}\.", r"\.(?:a\.){2}b", r"\/(?:\.ab\.|\.b\.)", r"\/a|\.b", r"\.\wb\.", r"\.[a-b]\.", r"(?:\.|a)b\.", r"\.b(?:\.|a)", r"\/a_b\/", r"/É?a/")


def test_needed_tokens_are_in_every_text_that_an_expression_is_found_in():
    import itertools
    texts = ["".join(x) for n in range(7) for x in itertools.product("ab./", repeat=n)] + ["/a_b/", "/éa/", "/ab\n", ".ab?", ".b-a#"]
    held = [(t, set(urls.TOKEN.findall(t))) for t in texts]
    for regex in EXPRESSIONS:
        needs, found = urls.needed_tokens(regex), re.compile(regex, re.DOTALL)
        assert all(tokens & set(x) for text, tokens in held if found.search(text) for x in needs), regex
    assert urls.needed_tokens(EXPRESSIONS[0]) == (("ab",),) and urls.needed_tokens(r"\.(?:ab|b-a|a)(?:$|[?#])") == (("ab", "b", "a"),)
