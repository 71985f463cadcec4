"""URL rules by Bloom filter cascades (operator 8).

A rule is a host and a path prefix with a verdict. Each url of the corpus has
candidate keys: its last n host labels and its first k path characters, for
the (n, k) that occur among the rules. For block and for allow rules a cascade
is built: level 0 holds the listed keys, level 1 the keys of the corpus that
level 0 wrongly lets through, level 2 the listed keys that level 1 wrongly
holds, and so on until no key is wrong. Over the corpus's own keys membership
is then exact, and judging a url is an expression over a few constant bit
strings: no join, no shuffle.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: Bits in a byte of a level's constant (so each byte is an ASCII character).
_BITS = 6


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path:
    what follows up to ``?``, ``#`` or the end. Port and user stay in the host.
    """
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _positions(key: Column, level: int, salt: int, m: int, k: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(salt), F.lit(level), F.lit(i)), F.lit(m).cast("long")) for i in range(k)]


class Cascade:
    """Levels of constant bit strings; ``member(key)`` is exact on the keys it was built over."""

    def __init__(self, salt: int):
        self.salt = salt
        self.levels: list[tuple[bytes, int, int]] = []

    def _passes(self, key: Column, level: int) -> Column:
        bits, m, k = self.levels[level]
        hit = F.lit(True)
        for p in _positions(key, level, self.salt, m, k):
            word = F.substring(F.lit(bits), (p / _BITS).cast("int") + 1, 1)
            char = F.ascii(word.cast("string"))
            bit = F.call_function("shiftright", char - 48, F.pmod(p, F.lit(_BITS)).cast("int"))
            hit = hit & (bit.bitwiseAND(F.lit(1)) == 1)
        return hit

    def member(self, key: Column) -> Column:
        """True for listed keys, false for every other key of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)      # passed the last level
        for i in reversed(range(len(self.levels))):
            out = F.when(self._passes(key, i), out).otherwise(F.lit(i % 2 == 1))
        return out

    def add_level(self, keys: DataFrame, n: int, fp: float, max_bytes: int) -> None:
        k = max(1, round(-math.log2(fp)))
        m = max(8 * _BITS, math.ceil(n * k / math.log(2)))
        if m // _BITS > max_bytes:
            raise ValueError(f"a level of {m // _BITS} bytes exceeds max_level_bytes={max_bytes}; "
                             "split the rule list (by host) and judge with each part")
        level = len(self.levels)
        pos = keys.select(F.explode(F.array(*_positions(F.col("key"), level, self.salt, m, k))).alias("p"))
        # one row per set bit: at most n x k, bounded by the list and max_bytes
        at = np.array([r[0] for r in pos.distinct().collect()], dtype=np.int64)
        chars = np.zeros(m // _BITS + 1, dtype=np.uint8)
        np.bitwise_or.at(chars, at // _BITS, (1 << (at % _BITS)).astype(np.uint8))
        self.levels.append((bytes(chars + 48), m, k))


def build_cascade(listed: DataFrame, universe: DataFrame, salt: int = 0,
                  max_level_bytes: int = 16 << 20, max_levels: int = 60) -> Cascade:
    """A cascade for the ``key`` strings of ``listed`` over those of ``universe`` (both distinct).

    Level 0 has a false positive rate of about listed * sqrt(2) / universe, the
    others one half, so every level is about as large as the list whatever the
    corpus's size; a level above ``max_level_bytes`` raises an error.
    """
    c = Cascade(salt)
    r, s = listed.count(), universe.count()
    if r == 0:
        return c
    hold, test = listed, None
    for level in range(max_levels):
        fp = min(0.5, r * math.sqrt(2) / max(s, 1)) if level == 0 else 0.5
        n = r if level == 0 else hold.count()
        if level and n == 0:
            return c
        c.add_level(hold, n, fp, max_level_bytes)
        passes = c._passes(F.col("key"), level)
        if level == 0:
            wrong = universe.where(passes).join(listed, "key", "left_anti")
        else:
            wrong = test.where(passes)
        hold, test = stage(wrong, f"cascade{level}"), hold
    raise RuntimeError(f"the cascade did not end in {max_levels} levels")


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys of a url: for each shape (labels, characters) that it has, host suffix + path prefix."""
    labels = F.size(F.split(host, r"\.", -1))
    out = [F.when((labels >= n) & (F.length(path) >= k),
                  F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, k))) for n, k in shapes]
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_cols: tuple[str, ...] = ("page_id",),
                default: str = "allow", max_level_bytes: int = 16 << 20, max_shapes: int = 2000) -> DataFrame:
    """``id_cols``, host, path, rule, verdict of every row of ``pages``.

    ``rules`` has host, path, verdict (block or allow). A rule fits its host and
    all subdomains if the url's path starts with the rule's; the longest rule
    wins, and block wins over allow for the same key. Without a fitting rule the
    rule is null and the verdict ``default``. A null url, or one without
    ``://``, has empty host and path and so fits only a rule of an empty host.
    Rules with a null part are left out. Repeated pages are judged each; an
    empty table gives an empty result. Only ``id_cols`` and the url are read.
    """
    rules = stage(rules.where("host is not null and path is not null and verdict in ('block', 'allow')")
                  .select(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
                          "path", "verdict").distinct(), "rules")
    shapes = [(r[0], r[1]) for r in rules.select(F.size(F.split("host", r"\.", -1)), F.length("path"))
              .distinct().orderBy(F.lit(1)).limit(max_shapes + 1).collect()]
    if len(shapes) > max_shapes:
        raise ValueError(f"more than {max_shapes} shapes of rules (host labels, path length)")
    host, path = split_url(F.col("_url"))
    urls = (pages.select(*id_cols, F.col(url_col).alias("_url")).withColumn("host", host).withColumn("path", path)
            .drop("_url"))
    if not shapes:
        return urls.select(*id_cols, "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    keys = _candidates(F.col("host"), F.col("path"), sorted(shapes))
    universe = stage(urls.select(F.explode(keys).alias("key")).distinct(), "keys")
    cascades = {}
    for i, verdict in enumerate(("allow", "block")):
        listed = rules.where(F.col("verdict") == verdict).select(F.concat("host", "path").alias("key")).distinct()
        cascades[verdict] = build_cascade(stage(listed, "listed"), universe, salt=i, max_level_bytes=max_level_bytes)
    blocked, allowed = cascades["block"], cascades["allow"]

    def judged(key: Column) -> Column:
        verdict = F.when(blocked.member(key), "block") if blocked.levels else F.lit(None).cast("string")
        if allowed.levels:
            verdict = F.coalesce(verdict, F.when(allowed.member(key), "allow"))
        return F.struct(F.length(key).alias("n"), key.alias("rule"), verdict.alias("verdict"))

    best = F.array_max(F.filter(F.transform(keys, judged), lambda x: x["verdict"].isNotNull()))
    return (urls.withColumn("_best", best)
            .select(*id_cols, "host", "path", F.col("_best.rule").alias("rule"),
                    F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict")))
