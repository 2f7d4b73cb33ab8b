"""URL filter: pattern rules indexed by their rarest literal token.

A rule is ``(pattern, verdict)``. Patterns:

- ``host/path``: fits the host and all its subdomains, where the URL's path starts with ``/path``;
- ``/regex/``: a regular expression searched in the whole URL.

Every rule becomes one regular expression and what any URL it fits must hold: one whole token (a run
of letters and digits) of each of some sets, which have one token, or one for each branch of an alternation. It
is filed under all tokens of the set that the fewest URLs hold; a rule without such a set is a
candidate for every URL. The tokens of a URL fetch its candidates, and only those run their expression.

URLs stay in their partition: nothing is shuffled but the counts of the rules' own tokens, so a
host that holds a third of all rows is no hot key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _parser as syntax

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[a-z0-9]+")
BLOCK_RULES = 100_000

#: The rules that the query judges by first; the longest that fits decides.
SITE_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: For URLs that no site rule fits. A ``block`` here yields to any site rule.
PATTERN_RULES = (
    (r"/^[a-z]+:\/\/(?:[^\/?#]*\.)?(?:ads|adserver|doubleclick)\./", "block"),
    (r"/[?&]sessionid=[0-9a-f]{16,}/", "block"),
    (r"/\/wp-login\.php(?:$|[?#])/", "block"),
    (r"/\/cgi-bin\//", "block"),
    (r"/\.(?:exe|dmg|apk|zip|rar)(?:$|[?#])/", "block"),
)


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str
    regex: str
    needs: tuple[tuple[str, ...], ...]
    site: bool


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host between ``://`` and the next ``/``, ``?``, ``#`` with A-Z lower-cased."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search(r"[/?#]", rest)
    host, tail = (rest[: end.start()], rest[end.start():]) if end else (rest, "")
    return ascii_lower(host), re.split(r"[?#]", tail, maxsplit=1)[0]


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def parse_rule(pattern: str, verdict: str) -> Rule:
    """Regular expression and certain tokens of one rule.

    Site rules are searched in host + path, which a host cannot confuse as it holds no slash.
    For tokens of a ``/regex/`` rule see :func:`needed_tokens`.
    """
    if len(pattern) > 1 and pattern.startswith("/") and pattern.endswith("/"):
        body = pattern[1:-1]
        return Rule(pattern, verdict, body, needed_tokens(body), False)
    host, slash, path = pattern.partition("/")
    whole = TOKEN.findall(ascii_lower(host)) + [
        t.group() for t in TOKEN.finditer(ascii_lower(path)) if t.end() < len(path)]
    regex = rf"\A(?:[^/]*\.)?{re.escape(ascii_lower(host))}{re.escape(slash + path)}"
    return Rule(pattern, verdict, regex, tuple((t,) for t in dict.fromkeys(whole)), True)


ANCHORS = (syntax.AT_BEGINNING, syntax.AT_BEGINNING_STRING, syntax.AT_END, syntax.AT_END_STRING, syntax.AT_BOUNDARY)
REPEATS = (syntax.MAX_REPEAT, syntax.MIN_REPEAT)


def needed_tokens(regex: str) -> tuple[tuple[str, ...], ...]:
    """Sets of tokens of which any lower-cased text that ``regex`` is found in holds one each, as a whole token.

    Found are plain runs of letters and digits between things that are certainly neither: other plain characters, classes
    without letters and digits, anchors, and groups that begin or end so. An alternation gives a set if every branch
    has one. What is not understood gives nothing, so the rule is tried more often than need be, never less.
    """
    if re.compile(regex).flags & re.IGNORECASE:
        return ()
    return tuple(dict.fromkeys(_needed(list(syntax.parse(regex)), False, False)))


def _edges(op, value) -> tuple[bool, bool, bool]:
    """(begins, ends with no letter or digit unless empty, can be empty) of one element of an expression."""
    if op is syntax.LITERAL:
        plain = not chr(value).isalnum()
        return plain, plain, False
    if op is syntax.IN:
        plain = all(kind is syntax.LITERAL and not chr(c).isalnum() for kind, c in value)
        return plain, plain, False
    if op is syntax.AT:
        return value in ANCHORS, value in ANCHORS, value not in ANCHORS
    if op is syntax.SUBPATTERN and not value[1]:
        return _edges_of(list(value[3]))
    if op is syntax.BRANCH:
        begins, ends, empty = zip(*(_edges_of(list(x)) for x in value[1]), strict=True)
        return all(begins), all(ends), any(empty)
    if op in REPEATS:
        begins, ends, empty = _edges_of(list(value[2]))
        return begins, ends, empty or value[0] == 0
    return False, False, True


def _edges_of(items: list) -> tuple[bool, bool, bool]:
    edges = [_edges(*x) for x in items]
    return _stops(edges, 0, True), _stops([(e, b, n) for b, e, n in reversed(edges)], 0, True), all(n for _, _, n in edges)


def _stops(edges: list[tuple[bool, bool, bool]], at: int, beyond: bool) -> bool:
    """Whether what follows place ``at`` begins with no letter or digit; ``beyond`` tells of what lies past the end."""
    for begins, _, empty in edges[at:]:
        if not begins:
            return False
        if not empty:
            return True
    return beyond


def _needed(items: list, before: bool, after: bool) -> Iterator[tuple[str, ...]]:
    edges = [_edges(*x) for x in items]
    back = [(e, b, n) for b, e, n in reversed(edges)]

    def bounded(start: int, end: int) -> tuple[bool, bool]:
        return _stops(back, len(items) - start, before), _stops(edges, end, after)

    at = 0
    while at < len(items):
        op, value = items[at]
        end = at
        while end < len(items) and items[end][0] is syntax.LITERAL and TOKEN.fullmatch(chr(items[end][1])):
            end += 1
        if end > at:
            if all(bounded(at, end)):
                yield ("".join(chr(c) for _, c in items[at:end]),)
        elif op is syntax.SUBPATTERN and not value[1]:
            yield from _needed(list(value[3]), *bounded(at, at + 1))
        elif op is syntax.BRANCH:
            found = [list(_needed(list(x), *bounded(at, at + 1))) for x in value[1]]
            if all(found):
                longest = [max(sets, key=lambda x: min(map(len, x))) for sets in found]
                yield tuple(dict.fromkeys(t for x in longest for t in x))
        at = max(end, at + 1)


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; as many rows as the rules have tokens."""
    wanted = sorted(set(tokens))
    if not wanted:
        return {}
    held = F.array_intersect(F.split(F.lower("url"), "[^a-z0-9]+"), F.array(*map(F.lit, wanted)))
    rows = urls.select(F.explode(held).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in rows}


def index_rules(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by the tokens of their rarest set (ties: the first in code point order); ``""`` has the rest."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        tokens = min(rule.needs, key=lambda x: (sum(counts.get(t, 0) for t in x), x), default=("",))
        for token in tokens:
            index.setdefault(token, []).append(rule)
    return index


def _judge(index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compiled = {t: [(r, re.compile(r.regex, re.DOTALL)) for r in rules]
                for t, rules in index.value.items()}
    always = compiled.pop("", [])
    for batch in batches:
        rows = batch.to_pydict()
        fits, verdicts, others = [], [], []
        for url, rule, verdict, other in zip(rows["url"], rows["rule"], rows["verdict"],
                                             rows["pattern"], strict=True):
            host, path = split_url(url)
            best = (rule, verdict) if rule is not None else None
            lowered = ascii_lower(url or "")
            for r, regex in [x for t in set(TOKEN.findall(lowered)) for x in compiled.get(t, ())] + always:
                if not regex.search(host + path if r.site else lowered):
                    continue
                if not r.site:
                    other = min(filter(None, (other, r.pattern)))
                elif best is None or (len(r.pattern), r.pattern) > (len(best[0]), best[0]):
                    best = (r.pattern, r.verdict)
            fits.append(best and best[0])
            verdicts.append(best and best[1])
            others.append(other)
        hosts, paths = zip(*map(split_url, rows["url"]), strict=True) if rows["url"] else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
             *(pa.array(x, pa.string()) for x in (fits, verdicts, others))],
            names=["page_id", "url", "host", "path", "rule", "verdict", "pattern"])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = SITE_RULES + PATTERN_RULES,
               default: str = "allow") -> DataFrame:
    """Every row of ``pages`` judged: page_id, url, host, path, rule, verdict, pattern.

    The longest site rule that fits decides (ties: the later in code point order). Where none
    fits, a ``/regex/`` rule decides (the first in code point order of those that fit, told in
    ``pattern``), else ``default``. Rules are a list on the driver; those beyond
    ``BLOCK_RULES`` are applied in further passes of that many each, so what is broadcast at once
    is bounded.

    Null URL or one without ``://``: host and path empty, rule null. Repeated rows and rows with
    null ids are each judged. An empty table gives an empty result. Other columns of ``pages``
    are not read.
    """
    spark = pages.sparkSession
    parsed = [parse_rule(p, v) for p, v in rules]
    urls = pages.select("page_id", "url")
    counts = token_counts(urls, [t for r in parsed for x in r.needs for t in x])
    verdict_of = {r.pattern: r.verdict for r in parsed if not r.site}
    out = urls.select("*", *(F.lit(None).cast("string").alias(c)
                             for c in ("host", "path", "rule", "verdict", "pattern")))
    schema = out.schema
    for at in range(0, max(1, len(parsed)), BLOCK_RULES):
        index = spark.sparkContext.broadcast(index_rules(parsed[at: at + BLOCK_RULES], counts))
        out = out.mapInArrow(lambda it, index=index: _judge(index, it), schema)
    by_pattern = F.lit(default)
    if verdict_of:
        verdicts = F.create_map(*[F.lit(x) for kv in verdict_of.items() for x in kv])
        by_pattern = F.coalesce(F.try_element_at(verdicts, F.col("pattern")), F.lit(default))
    return out.withColumn("verdict", F.coalesce("verdict", by_pattern))
