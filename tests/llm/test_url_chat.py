"""URL filter (8) and chat formatting (9)."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format as C
from tidemark.llm.url_filter import build_cascade, filter_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("ORG", "/fr/", "allow")]


def _judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h.lower() + p, v) for h, p, v in rules
           if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_against_brute_force(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "http://", "://x.net/", "http://net", "http://NET/a?b#c", "ftp://a.example.net/en/x",
            "http://example.net/en", "http://xexample.com/de/1", "http://a.b.example.com/de/1?u=://z", "http://u@example.com:8/de/",
            "http://" + "a." * 300 + "org/fr/" + "p" * 3000, "http://.net/", "http://net./", "http://q?x/net/", "HTTP://É.Org/fr/é"]
    for _ in range(300):
        urls.append(f"http://{rng.choice(['', 'a.', 'b.c.'])}{rng.choice(['example.net', 'example.com', 'w.org', 'net'])}/"
                    f"{rng.choice(['en/', 'de/', 'fr/', 'fr'])}{rng.randint(0, 50)}")
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)] + [(0, None, "x", 1)],
                                  "page_id long, url string, host string, Rule int")
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), ("x", None, "allow")], "host string, path string, verdict string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, rules).collect()]
    assert len(got) == len(urls) + 1
    for i, h, p, rule, v in got:
        assert (h, p, rule, v) == _judge(urls[i], RULES), urls[i]


def test_long_lists_are_exact(spark):
    rng = random.Random(5)
    hosts = [f"h{i}.example" for i in range(800)]
    listed = rng.sample(hosts, 300)
    rules = spark.createDataFrame([(h, "/", "block") for h in listed], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages, rules).collect()}
    assert got == {i: "block" if h in set(listed) else "allow" for i, h in enumerate(hosts)}


def test_no_rules_no_pages_and_bound(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert filter_urls(pages, rules.limit(0)).collect()[0]["verdict"] == "allow"
    assert filter_urls(pages.limit(0), rules).collect() == []
    keys = spark.range(100).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError):
        build_cascade(keys, keys, max_level_bytes=4)


def _digest(turns):
    h, loss = hashlib.sha256(), "".join(t for r, t in turns if r == "assistant")
    for role, text in turns:
        h.update(f"{role}\n{text}\n".encode())
    return len(turns), h.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip_windows_and_masks(spark):
    rng = random.Random(3)
    alphabet = ["a ", "b\n", "\\", "#", "<", "</turn>", "### user: ", "é🙂", " ", ":", "\\\\### "]
    rows, want = [], {}
    for c in range(30):
        turns = []
        for t in range(rng.randint(1, 40)):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "as:sis\\tant"])
            turns.append((role, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))))
        want[c] = _digest(turns)
        rows += [(c, t, r, x, 1, "clash") for t, (r, x) in enumerate(turns)]
    rows += [(50, None, None, None, 1, "c"), (50, 1, "assistant", "y" * 200_000, 1, "c")]
    want[50] = _digest([("", ""), ("assistant", "y" * 200_000)])
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int, formatted string")
    windows = C.format_conversations(df, budget=60, history=20)
    got = {r["conv_id"]: r for r in C.read_back(windows).collect()}
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want
    per = windows.collect()
    assert sum(len(w["formatted"]) for w in per) == sum(r["formatted_chars"] for r in got.values())
    systems = {c: x for c, t, r, x, *_ in rows if r == "system"}
    for w in per:
        turns = C.parse_window(w["formatted"])
        assert len(turns) == w["n_context"] + w["n_turns"] and w["n_turns"] >= 1
        if w["n_turns"] > 1:
            assert w["n_tokens"] <= 60
        if w["window_id"] and w["conv_id"] in systems:
            assert ("system", systems[w["conv_id"]]) in turns[:w["n_context"]]
        context = sum(C.count_tokens(t) for r, t in turns[:w["n_context"]] if r != "system")
        assert context <= 20


def test_chat_ties_repeats_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "assistant", "z")]
    got = {r["conv_id"]: r for r in C.read_back(C.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert got[1]["turns_sha256"] == _digest([("user", "a"), ("user", "a"), ("user", "b")])[1]
    assert got[None]["loss_chars"] == 1
    assert C.read_back(C.format_conversations(spark.createDataFrame([], schema))).collect() == []
    for s in ["", "\\", "</turn>", "a\\#<b", "### x: "]:
        assert C.unescape(C.escape(s)) == s
