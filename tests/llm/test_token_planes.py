"""Token files of planes: block round trips, ids against the library, starts, random access, edge rows."""

import random
import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import plane_files as P
from tidemark.llm.queries import BYTE_TOKENIZER, op12_token_planes
from tidemark.llm.token_ids import IdEncoder, cut_at_blanks, distinct_parts

PIECES = ["a", "B", " ", "  ", "\n", " \n", "\t", "'s", "'", "9", "12", ".", ",", "é", "漢字", " ", "　", "\x1c",
          "\x85", "word", "The", "<|endoftext|>", "▁", "🙂", "é"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTE_TOKENIZER)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_parts_join_to_the_text(pieces):
    text = "".join(pieces)
    assert " ".join(cut_at_blanks(text)) == text


@pytest.mark.parametrize("special_as_text", [False, True])
def test_ids_equal_the_librarys(library, special_as_text):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "x" * 5000, " " * 3000, "word " * 4000, "a<|endoftext|> b\n <|endoftext|>"]
    encoder = IdEncoder(BYTE_TOKENIZER, special_as_text)
    assert encoder.by_parts
    library.encode_special_tokens = special_as_text
    for t, got in zip(texts, encoder.encode(texts), strict=True):
        want = np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert got == want, repr(t)
    library.encode_special_tokens = False


def test_distinct_parts_are_the_cuts():
    rng = random.Random(6)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(30))) for _ in range(300)] + ["", " ", "a b a b"]
    for some in (texts, texts[-1:], [""], []):
        parts, of, offsets = distinct_parts(some)
        assert len(set(parts)) == len(parts)
        assert [[parts[k] for k in of[x:y]] for x, y in zip(offsets[:-1], offsets[1:], strict=True)] == list(map(cut_at_blanks, some))


def test_a_part_is_looked_up_once_for_all_texts(monkeypatch):
    encoder, asked = IdEncoder(BYTE_TOKENIZER), []
    learn = encoder.memory.learn
    monkeypatch.setattr(encoder.memory, "learn", lambda parts: asked.append(len(parts)) or learn(parts))
    encoder.encode([" ".join(f"word{k % 50}" for k in range(j, j + 3000)) for j in range(100)])
    assert sum(asked) <= 100        # two million characters are cut at once (before: four times as many looks)


def test_memory_is_bounded(library, monkeypatch):
    import tidemark.llm.token_ids as M
    monkeypatch.setattr(M, "REMEMBERED", 50)
    encoder = IdEncoder(BYTE_TOKENIZER)
    for k in range(40):
        t = " ".join(f"w{k}x{j}" for j in range(30))
        assert encoder.encode([t]) == [np.array(library.encode(t).ids, dtype="<u4").tobytes()]
        assert len(encoder.memory.new) + len(encoder.memory.old) <= 160


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("top", [0, 1, 255, 256, 50_256, 2**32 - 1])
def test_planes_round_trip(planes, top):
    rng = np.random.default_rng(top)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, top + 1, n).astype("<u4")
        parts = P.to_planes(ids, planes)
        assert np.array_equal(P.from_planes(parts, n, planes), ids)
        assert len(parts) <= (32 if planes == "bit" else 4)


def _brute(rows, library):
    out, at = [], 0
    for doc_id, ids in rows:
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library_on_whole_documents(spark, library):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()
    want = _brute([(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in rows], library)
    got = op12_token_planes(spark, d)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_edge_rows_files_and_spans(spark, library, planes):
    long = "many words of one long text " * 3000
    rows = [(5, "five"), (None, "no id"), (3, None), (3, ""), (3, "three"), (3, "three"), (9, long), (1, "one\n\n two")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, ids string, Key string")
    folder = tempfile.mkdtemp() + "/t"
    spark.dataSource.register(P.TokenPlanes)
    P.write_tokens(docs, folder, BYTE_TOKENIZER, 2, planes=planes, block=100, partitions=3)
    got = P.read_tokens(spark, folder).orderBy("start", "n_tokens").collect()
    assert [r["key"] for r in got] == [None, 1, 3, 3, 3, 3, 5, 9]
    whole = np.concatenate([np.frombuffer(r["ids"], dtype="<u4") for r in got])
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    texts = {i: sorted(np.frombuffer(r["ids"], dtype="<u4").tolist() for r in got if r["key"] == i) for i, _ in rows}
    for i, _ in rows:
        assert texts[i] == sorted(library.encode(t or "", add_special_tokens=False).ids + [2] for j, t in rows if j == i)
    with pytest.raises(Exception, match="written once"):
        P.write_tokens(docs, folder, BYTE_TOKENIZER, 2)
    for a, n in ((0, 1), (95, 10), (0, at), (at - 3, 10), (at, 5), (399, 201)):
        assert np.array_equal(P.read_span(folder, a, n), whole[a:a + n])


def test_one_hot_key_is_spread_and_files_roll(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("t "), "id").alias("text"))
    folder = tempfile.mkdtemp() + "/t"
    spark.dataSource.register(P.TokenPlanes)
    from tidemark.llm.token_ids import encode_ids
    rows = encode_ids(P.in_key_order(docs, "doc_id", "text", 4), BYTE_TOKENIZER, 2)
    rows.write.format("token_planes").option("fileids", "500").mode("append").save(folder)
    files = P._manifest(folder)["files"]
    assert len({f["part"] for f in files}) == 4 and len(files) > 8
    got = P.read_tokens(spark, folder)
    assert got.count() == 3000 and got.agg(F.sum("n_tokens")).first()[0] == P._manifest(folder)["n_ids"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = tempfile.mkdtemp() + "/t"
    P.write_tokens(docs, folder, BYTE_TOKENIZER, 2)
    assert P.read_tokens(spark, folder).count() == 0 and len(P.read_span(folder, 0, 9)) == 0
