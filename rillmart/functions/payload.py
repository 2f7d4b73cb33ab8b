"""JSON payloads held as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


VARIANTS = "map<string,variant>"


def record(text: Column | str) -> Column:
    """The entries of text that is one JSON object and nothing else, else null; no field or type is lost.

    The parser stops at the end of the first value. So the text is parsed as a member of an
    object with a last member named by a hash of the text: anything that ends the text's object too
    early or adds to it loses that member or adds others. What is parsed is bound to a name, or every use would parse it again.
    """
    c = _col(text)
    last = F.concat(F.lit("#"), F.xxhash64(c))
    framed = F.try_parse_json(F.concat(F.lit('{"r":'), c, F.lit(',"'), last, F.lit('":0}'))).try_cast(VARIANTS)

    def inner(f: Column) -> Column:
        whole = (F.size(f) == 2) & F.map_contains_key(f, last)
        return F.when(whole & c.rlike(r"^[ \t\r\n]*\{"), f["r"].try_cast(VARIANTS))

    return F.transform(F.array(framed), inner)[0]


def is_object(text: Column | str) -> Column:
    """True when the text is one JSON object; never null."""
    return record(text).isNotNull()


def leaf(value: Column, path: str, kind: str = "string") -> Column:
    """What a path leads to in a variant, null if there is none of that kind."""
    return F.try_variant_get(value, path, kind)


def get_text(text: Column | str, path: str) -> Column:
    return F.get_json_object(_col(text), path)


def get_texts(df: DataFrame, text: str, paths: Sequence[str], out: Sequence[str]) -> DataFrame:
    """Add :func:`get_text` of many paths ``a`` or ``a.b``: the text is parsed once, and once for each ``a`` that has paths below it."""
    heads = list(dict.fromkeys(p.partition(".")[0] for p in paths))
    found = df.select("*", F.json_tuple(_col(text), *heads).alias(*[f"_h{i}" for i in range(len(heads))]))
    names = dict(zip(paths, out, strict=True))
    for i, head in enumerate(heads):
        below = [p for p in paths if p.startswith(f"{head}.")]
        if below:
            found = found.select("*", F.json_tuple(f"_h{i}", *[p.partition(".")[2] for p in below]).alias(*[f"_{names[p]}" for p in below]))
    leaves = [F.col(f"_{names[p]}" if "." in p else f"_h{heads.index(p)}").alias(names[p]) for p in paths]
    return found.select(*[F.col(f"`{c}`") for c in df.columns], *leaves)


def get_long(text: Column | str, path: str) -> Column:
    return F.get_json_object(_col(text), path).try_cast("bigint")


def put(record: Column | str, name: str, value: Column) -> Column:
    """Set one field of a struct column."""
    return _col(record).withField(name, value)


def remove(record: Column | str, *names: str) -> Column:
    return _col(record).dropFields(*names)


def put_entry(entries: Column | str, name: str, value: Column) -> Column:
    """Set one entry of a map column, replacing an older one."""
    kept = F.map_filter(_col(entries), lambda k, v: k != F.lit(name))
    return F.map_concat(kept, F.create_map(F.lit(name), value))


def text_of(record: Column | str) -> Column:
    return F.to_json(_col(record))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
