"""Suffix-array dedup (2), fuzzy lines (5), decontamination (1), pieces (4)."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup as S
from tidemark.llm.decontaminate import decontaminate, find_contamination
from tidemark.llm.common import stage
from tidemark.llm.line_dedup import _by_key, bag_words, dedup_lines, gram_table, line_table


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for t in (b"banana", b"a" * 300, bytes(rng.integers(97, 99, 700, dtype=np.uint8)), b"ab" * 100 + b"\x00\x00", b"x"):
        a = np.frombuffer(t, dtype=np.uint8)
        sa, place = S.suffix_array(a)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        assert (place[sa] == np.arange(len(t))).all()
        got = S.common_prefixes(a, sa, place, 50, lanes=7).tolist()
        want = [0] + [min(50, len(os.path.commonprefix([t[x:], t[y:]]))) for x, y in zip(sa[:-1], sa[1:])]
        assert got == want


def _removed(rows, length):
    seen, out = {}, {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen and seen[s] != (d, p):
                gone[p:p + length] = b"\x01" * length
            seen.setdefault(s, (d, p))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("shard", [2 << 20, 3000])
def test_repeats_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(S, "SHARD", shard)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = prose(400), prose(30)
    rows = []
    for d in range(80):
        kind = d % 8
        t = prose(rng.randint(0, 60))
        if kind == 1:
            t = t + passage + prose(5)
        elif kind == 2:
            cut = rng.randrange(len(base))
            t = base[:cut] + prose(2) + base[cut + 9:]
        elif kind == 3:
            t = base
        elif kind == 4:
            t = t + "-" * rng.randint(90, 400)
        elif kind == 5:
            t = (t[:70] + "xy") * 6
        rows.append((d, t))
    rows += [(100, None), (101, ""), (102, "a" * 99), (103, "b" * 100), (104, "b" * 100)]
    df = spark.createDataFrame(rows + [rows[3], rows[12]], "doc_id long, text string").withColumn("n_bytes", F.lit("clash"))
    want = _removed(rows, 100)
    out = S.remove_repeats(df).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) == want[r["doc_id"]], r["doc_id"]


def test_an_anchor_of_more_than_a_shard_goes_by_windows(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijkl") for _ in range(n))
    menu = word(80)
    long_menu = menu + word(60)         # holds windows that are equal in different surroundings
    rows = [(d, word(120) + (long_menu if d % 5 == 0 else menu) + word(120)) for d in range(150)]
    staged = {}

    def stage(df, name, real=S.stage):
        staged[name] = real(df, name)
        return staged[name]
    monkeypatch.setattr(S, "stage", stage)
    monkeypatch.setattr(S, "SHARD", 3000)
    want = _removed(rows, 100)
    for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]][1:4], r["doc_id"]
    assert staged["heavy-anchors"].count() and staged["windows"].count()
    # what is left for the suffix arrays: no anchor has more than a shard
    left = staged["places"].select(F.explode("at").alias("x")).groupBy("x.fp").agg(F.sum(F.col("x.span") + 100).alias("n"))
    assert left.where("n > 3000").count() == 0


def test_repeats_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(empty).collect() == []
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefghij") for _ in range(130))
    df = spark.createDataFrame([(None, t), (1, t), (1, "z" + t)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in S.remove_repeats(df).collect())
    assert got == [(0, 130, 0), (1, 130, 130), (1, 131, 130)]


LONG = " ".join(f"word{i}" for i in range(40))


def test_lines(spark):
    very_long = " ".join(f"w{i % 90}x{i}" for i in range(700))
    huge = " ".join(f"w{i % 9}x{i}" for i in range(32_000))
    rows = [(1, f"{LONG}\nunique line of document one here\n\nshort"), (2, f"  {LONG.upper()}!\nanother unique line in document two\nshort"),
            (3, LONG.replace("word7 ", "wordy ")), (4, None), (5, ""), (6, f"{very_long}\n{very_long}."),
            (8, f"{huge}\n{huge} "), (7, "something that has no copy at all in here\n" * 2), (1, "a second text of the same document id, unique")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, N_removed string").withColumn("extra", F.lit(1))
    out = dedup_lines(df).collect()
    got = {(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in out}
    assert len(out) == len(rows) and out[0]["extra"] == 1
    assert (1, 4, 0, rows[0][1]) in got
    assert (2, 3, 2, "another unique line in document two") in got      # an equal line goes at any length
    assert (3, 1, 1, "") in got                        # one word of forty is another
    assert (4, 0, 0, None) in got and (5, 1, 0, "") in got
    assert (6, 2, 1, very_long) in got and (8, 2, 1, huge) in got
    assert (7, 3, 1, "something that has no copy at all in here\n") in got
    assert dedup_lines(df.limit(0)).collect() == []
    table = line_table(df, 20)[1].where("doc_id = 6").collect()
    assert len({r["simhash"] for r in table}) == 1     # counted in chunks
    words = [w for r in rows for line in (r[1] or "").split("\n") for w in line.lower().replace("!", "").replace(".", "").split()]
    known = spark.createDataFrame([(w,) for w in set(words)], "w string").selectExpr("w", "xxhash64(7, w) AS h")
    code = {r["w"]: r["h"] & (2 ** 64 - 1) for r in known.collect()}
    for d, text in ((1, LONG), (6, very_long), (8, huge)):
        hs = np.array([code[w] for w in text.split()], dtype=np.uint64)
        want = sum(1 << b for b in range(64) if int(((hs >> np.uint64(b)) & np.uint64(1)).sum()) * 2 > len(hs))
        got = line_table(df.where(f"doc_id = {d}"), 20)[1].where("line = 0").collect()
        assert want in {r["simhash"] & (2 ** 64 - 1) for r in got}, d


def test_a_line_in_a_third_of_all_documents_stays_once(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("the very same line in many documents")).otherwise(
        F.concat(F.lit("a line of its own, numbered so: "), F.sha2(F.col("id").cast("string"), 256))).alias("text"))
    out = dedup_lines(df)
    assert out.where("n_removed = 1").count() == 99 and out.where("doc_id = 0").first()["n_removed"] == 0


def test_near_lines_are_found(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for k in range(200):
        # one word of ten or twenty changes, or a character at two places, at a similarity of 0.9 and more
        w = [word(rng.randint(5, 8)) for _ in range((10, 20)[k % 2])]
        v, at = list(w), rng.randrange(len(w))
        if k % 4 < 2:
            v[at] = word(len(w[at]))[:5] + w[at][5:]
        else:
            for i in (at, at - 3):
                v[i] = v[i][:2] + "z" + v[i][3:]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    for k in range(200, 250):           # a line without blanks
        t = han(40)
        rows += [(2 * k, t), (2 * k + 1, t[:20] + han(2) + t[22:])]
    out = {r["doc_id"]: r["n_removed"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(out[d] for d in out if d % 2 == 0)
    assert sum(out.values()) >= 245


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_equal_brute_force(spark):
    """Every line against every other by edit similarity: what goes is what links and equal lines demand."""
    import re
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice((1, 2, 6, 9, 14, 30)))) for _ in range(120)]
    for k in range(60):       # a word less or another one; many copies of one line, each with a word of its own
        w = rng.choice(lines[:120]).split()
        w[rng.randrange(len(w))] = rng.choice(words)
        lines.append(" ".join(w))
    stem = [rng.choice(words) for _ in range(25)]
    lines += [" ".join([*stem[:k % 25], words[k], *stem[k % 25 + 1:]]) for k in range(80)] + ["a", "A!", "a", "漢字", "漢字。", "...", "...", ""]
    rng.shuffle(lines)
    docs = [(d, "\n".join(lines[d * 7:d * 7 + 7])) for d in range(len(lines) // 7 + 1)]
    flat = [(d, i, re.sub(r"[^\w\n]+|_", " ", x.lower()).strip()) for d, t in docs for i, x in enumerate(t.split("\n"))]
    distinct = sorted({x for _, _, x in flat if x})
    group = {x: x for x in distinct}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x
    for i, x in enumerate(distinct):
        for y in distinct[i + 1:]:
            longest = max(len(x), len(y))
            if min(len(x), len(y)) >= 20 and abs(len(x) - len(y)) <= longest * 0.1 and _edits(x, y) <= longest * 0.1 + 1e-9:
                group[top(x)] = top(y)
    seen, want = set(), {}
    for d, i, x in flat:
        if x and top(x) in seen:
            want[d] = want.get(d, 0) + 1
        elif x:
            seen.add(top(x))
    out = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r["doc_id"]: r["n_removed"] for r in out}
    short = sum(want.get(d, 0) - got[d] for d in got)
    assert all(got[d] <= want.get(d, 0) for d in got) and short <= 0.03 * sum(want.values())


def test_recall_at_the_bound(spark):
    """Lines of 5 to 90 words with so many words changed as the similarity allows: nine in ten are found at every length."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows, of, d = [], {}, 0
    for n in (5, 10, 20, 40, 90):
        for _ in range(60):
            w = [word(rng.randint(3, 9)) for _ in range(n)]
            v, left = list(w), int(len(" ".join(w)) * 0.1 + 1e-9)
            for i in rng.sample(range(n), n):
                if len(w[i]) <= left:
                    v[i], left = word(len(w[i])), left - len(w[i])
            if v != w:
                rows += [(d, " ".join(w)), (d + 1, " ".join(v))]
                of[d + 1] = n
                d += 2
    out = {r["doc_id"]: r["n_removed"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n in set(of.values()):
        lines = [x for x in of if of[x] == n]
        assert sum(out[x] for x in lines) >= 0.9 * len(lines), n


def test_a_key_of_very_many_lines(spark, monkeypatch):
    """Lines that share two least hashes, more than are held against each other: near ones are still found."""
    import tidemark.llm.line_dedup as M
    monkeypatch.setattr(M, "TOGETHER", 3)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    head = [word() for _ in range(24)]
    rows = []
    for k in range(40):       # half of each line is the same in all; every second line repeats the one before but for a word
        own = [word() for _ in range(24)]
        again = list(own)
        again[k % 24] = word()
        rows += [(2 * k, " ".join(head + own)), (2 * k + 1, " ".join(head + again))]
    out = {r["doc_id"]: r["n_removed"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(out[d] for d in out if d % 2 == 0) and sum(out.values()) >= 37


def test_no_line_of_a_key_of_very_many_is_left_out(spark, monkeypatch):
    """Three quarters of each line are the same in all, so that most share all their least hashes and the pairs that
    repeat each other differ from the first of them; every pair is found, in blocks of a few lines too."""
    import tidemark.llm.line_dedup as M
    monkeypatch.setattr(M, "BLOCK", 16, raising=False)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    head, rows = [word() for _ in range(24)], []
    for k in range(60):
        own = [word() for _ in range(8)]
        again = list(own)
        again[k % 8] = word()
        rows += [(2 * k, " ".join(head + own)), (2 * k + 1, " ".join(head + again))]
    out = {r["doc_id"]: r["n_removed"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(out[d] for d in out if d % 2 == 0) and sum(out.values()) >= 59


def test_lines_that_share_only_a_phrase_are_not_all_held_together(spark, monkeypatch):
    """Lines of a frequent key meet again only under rarer hashes; those that repeat one another are still found."""
    import tidemark.llm.line_dedup as M
    blocks, in_blocks = [], M.in_blocks
    monkeypatch.setattr(M, "in_blocks", lambda *a, **b: blocks.append(1) or in_blocks(*a, **b))
    monkeypatch.setattr(M, "ROUND_LINES", 10, raising=False)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    head, rows = [word() for _ in range(11)], []
    for k in range(150):
        own = [word() for _ in range(21)]
        rows.append((2 * k, " ".join(head + own)))
        if k % 3 == 0:
            own[k % 21] = word()
            rows.append((2 * k + 1, " ".join(head + own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = gram_table(docs, 20).withColumn("id", F.xxhash64("h1"))
    assert _by_key(lines).groupBy("key").count().agg(F.max("count")).first()[0] > M.TOGETHER
    out = {r["doc_id"]: r["n_removed"] for r in dedup_lines(docs).collect()}
    assert not blocks
    assert not any(out[d] for d in out if d % 2 == 0) and sum(out.values()) >= 49


@pytest.mark.parametrize("few", [2, 256])
def test_refined_keys_lose_no_pair_that_agrees(spark, monkeypatch, few):
    """All pairs of lines that agree in enough sampled hashes are met under their rarest common ones, at any depth."""
    import tidemark.llm.line_dedup as M
    monkeypatch.setattr(M, "FEW", few)
    monkeypatch.setattr(M, "DIFFER", 64)
    rng = random.Random(4)
    common, rows = [rng.randrange(1 << 30) for _ in range(24)], []
    for k in range(60):
        z = rng.choice((1, 2, 5, 12, 14, 16, 16, 16))
        kept = rng.sample(common, min(z, rng.randint(0, 12)))
        rows.append((k, [*kept, *[rng.randrange(1 << 30, 1 << 31) for _ in range(z - len(kept))]]))
    lines = spark.createDataFrame([(i, sorted(h), None, 0, 0, 100) for i, h in rows],
                                  "id long, sample0 array<int>, sample1 array<int>, sketch0 long, sketch1 long, n_chars int")
    # the sketch tells a line's two kinds apart
    lines = lines.withColumn("sketch1", F.lit(1).cast("long"))
    ranked = stage(M._ranked(lines.select("id", F.col("id").alias("c")), lines), "test-ranked")
    parents, pairs, wide = M._rarest(ranked), [], []
    for depth in range(2, M.DEEPEST + 1):
        level = M._level(parents, depth, 2, 0.9)
        pairs.append(level.where("a is not null").select("a", "b"))
        rest = level.where("key is not null")
        parents = rest.withColumn("c", F.col("id")).join(ranked.select("id", "sketch", "t", "h"), ["id", "sketch"])
        wide.append(parents.where(f"t <= {depth if depth < M.DEEPEST else 16}").select("key", "id"))
    last = pairs[0].where("false")
    for w in wide:
        last = last.unionByName(w.alias("x").join(w.alias("y"), "key").where("x.id < y.id").selectExpr("x.id a", "y.id b"))
    for p in pairs:
        last = last.unionByName(p)
    got = {(r.a, r.b) for r in M._agreeing(last.distinct(), [], ranked).collect()}

    def agree(x, y):
        z = max(len(x), len(y))
        return len(set(x) & set(y)) >= max(min(z, 2), z - M.MISSES)
    want = {(i, j) for i, x in rows for j, y in rows if i < j and agree(x, y)}
    assert len(want) > 20 and got == want


def test_distance_without_equal_ends(spark):
    from tidemark.llm.line_dedup import _within
    rng = random.Random(6)
    letters, pairs = "abc é中\U00020000", []
    for n in (0, 1, 2, 7, 40, 130):
        for edits in (0, 1, 2, 5, 13, 40):
            x = [rng.choice(letters) for _ in range(n)]
            y = list(x)
            for _ in range(edits):
                at = rng.randrange(len(y)) if y else 0
                y[at:at + rng.randint(0, 1)] = rng.choice(([], [rng.choice(letters)]))
            pairs += [("".join(x), "".join(y), k) for k in (0, 1, 3, 13)]
    df = spark.createDataFrame(pairs, "x string, y string, allowed int")
    rows = df.select(_within(F.col("x"), F.col("y"), F.col("allowed")).alias("got"), (F.levenshtein("x", "y") <= F.col("allowed")).alias("want")).collect()
    assert all(r.got == r.want for r in rows) and {r.want for r in rows} == {True, False}


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew potent quaffs tonight"


def test_shuffle_files_of_a_staged_table_go(spark):
    import time

    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}
    before = kept()
    out = stage(spark.range(20_000).groupBy(F.xxhash64("id").alias("k")).count(), "test-cleanup")
    for _ in range(50):
        if not kept() - before:
            break
        time.sleep(0.1)
    assert not kept() - before and out.count() == 20_000


def test_bags_differ_by_no_more_than_edits(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz 0159äßжщ中\U00020000\U0001D400"
    pairs, far = [], 0
    for n in (1, 5, 30, 130, 700):
        for edits in (0, 1, 2, n // 10, n // 3):
            x = [rng.choice(letters) for _ in range(n)]
            y = list(x)
            for _ in range(edits):
                at = rng.randrange(len(y)) if y else 0
                y[at:at + rng.randint(0, 1)] = rng.choice(([], [rng.choice(letters)], ["e"]))
            pairs.append(("".join(x), "".join(y), edits))
    other = ["".join(rng.choice(letters[:26]) for _ in range(110)) for _ in range(2)]
    pairs.append((*other, 110))
    df = spark.createDataFrame(pairs, "x string, y string, edits int")
    df = df.withColumn("d", sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(bag_words(F.col("x")), bag_words(F.col("y")))), F.lit(0)))
    rows = df.withColumn("lev", F.levenshtein("x", "y")).collect()
    assert len(rows) == 26 and all(r.d <= 2 * r.lev for r in rows)
    far = [r.d for r in rows if r.edits == 110]
    assert far[0] > 22          # twice the edits that a line of 110 characters may have


def test_keys_of_one_line_are_not_made(spark):
    rng = random.Random(9)
    line = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(60)]
    other = [[w[::-1] + "x" for w in rng.sample(line, 60)] for _ in range(30)]
    docs = [(0, " ".join(line)), (1, " ".join(line[:59] + ["another"])), *[(2 + k, " ".join(o)) for k, o in enumerate(other)]]
    grams = gram_table(spark.createDataFrame(docs, "doc_id long, text string"), 20).withColumn("id", F.col("doc_id"))
    by = {}
    for r in _by_key(grams).collect():
        by.setdefault(r.key, set()).add(r.id)
    assert any(v == {0, 1} for v in by.values())
    # without the counting of hashes before, every line has ten keys
    assert sum(map(len, by.values())) < 60


def test_contamination(spark):
    w = ITEM.split()
    substituted = " ".join(["slow" if k in (4, 11) else x for k, x in enumerate(w)])
    docs = [(1, "Intro text. " + ITEM.upper() + "!! and more"), (2, "before " + substituted + " after"), (3, "the quick brown fox sleeps"),
            (4, None), (5, ""), (6, " ".join(w[:8])), (7, "x " * 30000 + ITEM), (8, "say hello big world now"), (9, "hello small world"),
            (7, ITEM), (None, ITEM)]
    bench = [(10, ITEM), (11, "hello big world"), (12, None), (13, "..."), (None, "x"), (10, ITEM)]
    d = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*r, 5) for r in bench], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in find_contamination(d, b).collect()}
    assert set(got) == {(1, 10), (2, 10), (7, 10), (8, 11)} and got[(1, 10)] == len(w)
    left = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in decontaminate(d, b).collect())
    # an item of three tokens is reported, but removes no document
    assert [x[1] for x in left if not x[0]] == [3, 4, 5, 6, 8, 9] and (True, 0) in left
    assert find_contamination(d.limit(0), b).collect() == [] and find_contamination(d, b.limit(0)).collect() == []


def _best_run(doc, item, penalty=2):
    """(score, first place) of the best diagonal."""
    best = (0, 0)
    for at in range(-len(item) + 1, len(doc)):
        run = top = 0
        for k, x in enumerate(item):
            if 0 <= at + k < len(doc):
                run = max(0, run + (1 if doc[at + k] == x else -penalty))
                top = max(top, run)
        if top > best[0]:
            best = (top, at)
    return best


def test_contamination_against_brute_force(spark):
    """All documents against all items along every diagonal: what reaches the score is found, and nothing else."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    items = [[rng.choice(words) for _ in range(n)] for n in (16, 20, 33, 59, 12, 8, 7, 3, 1) for _ in range(3)]
    docs = []
    for k in range(160):
        doc = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        if k % 2:
            part = list(rng.choice(items))
            for _ in range(rng.choice((0, 0, 1, 2))):
                part[rng.randrange(len(part))] = rng.choice(words)
            cut = rng.choice((0, 0, len(part) // 3))
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = part[cut:]
        docs.append(doc)
    d = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in find_contamination(d, b).collect()}
    want, sure = {}, set()
    for i, doc in enumerate(docs):
        for j, item in enumerate(items):
            n = len(item)
            score, at = _best_run(doc, item)
            if score >= (n if n < 8 else min(10, -(-n * 6 // 10))):
                want[i, j] = score
                beside = [k for k in range(n) if 0 <= at + k < len(doc) and doc[at + k] != item[k]]
                if not beside:      # an unbroken run of a mask's length always shares a seed
                    sure.add((i, j))
    assert set(got) <= set(want) and sure <= set(got) and all(got[x] == want[x] for x in got)
    assert len(want) > 50 and len(got) >= 0.95 * len(want)


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no tokenizer file")
def test_pieces_round_trip_and_equal_the_library(spark):
    import sentencepiece

    from tidemark.llm.piece_codec import decode_pieces, encode_pieces
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["Hello world", " ", "  a   b  ", "\x00é\n\n x", "日本語 🙂🙂 text", "a" * 500, "\t\tif x:\n        return 1", "-" * 77 + "=" * 33,
             "the quick brown fox " * 200, "<s> </s> <unk> <0x41>", "ünïcödé\u00a0x\u3000y"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(90, None), (91, ""), (92, "a\u2581b\u2581"), (0, texts[0])]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, N_pieces int")
    out = encode_pieces(df, MODEL).collect()
    assert len(out) == len(rows) and all(r["decodes"] for r in out)
    for r in out:
        assert r["n_pieces"] == len(r["ids"])
        if r["doc_id"] < 90:
            assert list(r["ids"]) == lib.encode(texts[r["doc_id"]])
    assert all(r["ids"] == [] for r in out if r["doc_id"] in (90, 91))
    back = decode_pieces(encode_pieces(df, MODEL).withColumnRenamed("text", "t"), MODEL).collect()
    assert all(r["text"] == (r["t"] or "") for r in back)
    assert encode_pieces(df.limit(0), MODEL).collect() == []


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no tokenizer file")
def test_unigram_path_is_the_least():
    import itertools

    from tidemark.llm.piece_codec import load_transducer
    t = load_transducer(MODEL)
    t.merges = False
    t.pieces, t.score = {"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4}, {0: -1.0, 1: -1.5, 2: -1.2, 3: -2.9, 4: -4.0}
    t.longest = 3
    for s in ("abab", "aabab", "babab", "aba"):
        best = min((sum(-t.score[t.pieces[p]] for p in parts), parts) for n in range(1, len(s) + 1)
                   for cuts in itertools.combinations(range(1, len(s)), n - 1)
                   for parts in [[s[a:b] for a, b in zip((0, *cuts), (*cuts, len(s)))]] if all(p in t.pieces for p in parts))
        path = t._least_path(s)
        assert abs(sum(-t.score[i] for i in path) - best[0]) < 1e-9
