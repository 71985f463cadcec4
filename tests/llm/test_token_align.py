"""Token alignment: the perfect hash, and the whole operator against a brute-force version on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import token_align as A
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, op13_token_alignment

PIECES = ["a", "B", " ", "  ", "\n", " \n", "\t", "'s", "9", ".", "é", "漢字", "\xa0", "　", "word", "The ", " tion",
          "<|endoftext|>", "<s>", "<0x41>", "🙂", "\x00", "ffi"]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    h = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert h.n == len(keys)
    assert np.array_equal(np.sort(h.number(keys)), np.arange(len(keys)))
    other = h.number(keys + np.uint64(2**63))
    assert ((other >= -1) & (other < max(1, h.n))).all()


def test_perfect_hash_lists_the_rest(monkeypatch):
    import tidemark.llm.perfect_hash as M
    monkeypatch.setattr(M, "LEVELS", 1)
    keys = np.arange(5000, dtype=np.uint64)
    h = PerfectHash.build(keys)
    assert len(h.rest) and np.array_equal(np.sort(h.number(keys)), keys.astype(np.int64))


def test_every_byte_has_a_character():
    table = A.byte_of_character()
    assert sorted(table.values()) == list(range(256)) and table["Ġ"] == 32 and table["A"] == 65


class Brute:
    """Whole texts through both libraries, places and counts from lists."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(BYTE_TOKENIZER)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        chars = A.byte_of_character()
        self.bytes_a = {i: bytes(chars[c] for c in t) for t, i in self.a.get_vocab().items() if i != 50256}

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        if any(b"".join(map(f, x)) != (" " + text).encode() for f, x in ((self.bytes_a.get, a), (self.piece, b))):
            return []
        ends = [np.cumsum([len(f(i)) for i in x]).tolist() for f, x in ((self.bytes_a.get, a), (self.piece, b))]
        out, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            to_i, to_j = ends[0].index(e) + 1, ends[1].index(e) + 1
            out.append((a[i:to_i], b[j:to_j]))
            i, j = to_i, to_j
        return out

    def table(self, texts):
        of = [self.groups(t) for t in texts]
        counts = Counter()
        for g in of:
            counts.update({(x, y) for a, b in g for x in a for y in b})
        most = Counter()
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        rows = []
        for g in of:
            links = [(x, y) for a, b in g for x in a for y in b]
            said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                         sum(counts[k] == most[k[0]] for k in links), sum(counts[k] for k in links),
                         hashlib.sha256(said.encode()).hexdigest() if g else "", said))
        return rows


def _texts():
    rng = random.Random(11)
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(30))) for _ in range(250)]
    return out + [None, "", " ", "x▁y and ▁", "same text here", "same text here", "a" * 3000, " " * 2000, "word " * 3000,
                  " \n lead", "\nfoo \nfoo", "漢" * 500,
                  "word, word. word! (word) wörd; ß: 9, a.b a., .. , x"]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("way", ["tasks", "join", "small batches"])
def test_equals_brute_force(spark, way, monkeypatch):
    texts = _texts()
    if way == "small batches":
        monkeypatch.setattr(A, "FAN_IN", 2)
        monkeypatch.setattr(A, "PAIRS_REMEMBERED", 20)
    docs = spark.createDataFrame([(i // 2 if i else None, t, "g", 3) for i, t in enumerate(texts)],
                                 "doc_id long, text string, groups string, pair long").repartition(7)
    got = A.align_tokens(docs, BYTE_TOKENIZER, PIECE_MODEL, broadcast_bytes=0 if way == "join" else A.BROADCAST_BYTES)
    assert got.columns == ["doc_id", *COLUMNS]
    want = [(i // 2 if i else None, *r) for i, r in enumerate(Brute().table(texts))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_query_equals_brute_force_on_documents(spark):
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").collect()
    want = {r["doc_id"]: w[:-1] for r, w in zip(rows, Brute().table([r["text"] for r in rows]), strict=True)}
    got = op13_token_alignment(spark, d)
    assert got.columns == ["doc_id", *COLUMNS[:-1]]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


def test_groups_of_very_many_tokens(monkeypatch):
    """Links of large groups go by distinct ids; sums and strings are those of all links."""
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 700), rng.integers(0, 300, 420)
    # parts of 3 groups: 2 x 1 tokens, 400 x 220 and 1 x 1; then the rest alone
    ends_a, ends_b = np.arange(1, 701) * 1000, np.zeros(420, dtype=np.int64)
    ends_b[0], ends_b[1:221], ends_b[221] = 2000, np.arange(1, 221) * 1 + 401_779, 403_000
    ends_b[220] = 402_000
    ends_b[222:] = np.sort(rng.choice(np.arange(403_001, 699_999), 198, replace=False) // 1000 * 1000 + np.arange(1, 199) % 999 + 1)
    ends_b[419] = 700_000
    found = A.Aligned(a, b, ends_a, np.sort(ends_b), np.array([403_000, 700_000]))
    assert found.cuts_at_stops and found.counts()[0] == [403, 297]
    keys, times, of = found.links(300)
    assert (np.diff(of) >= 0).all()
    want = Counter()
    for g in range(len(found.n_a)):
        for x in a[found.of_a == g]:
            for y in b[found.of_b == g]:
                want[int(x) * 300 + int(y), g] += 1
    got = Counter()
    for k, n, g in zip(keys.tolist(), times.tolist(), of.tolist(), strict=True):
        got[k, g] += n
    assert got == want and found.counts()[3] == [sum(n for (_, g), n in want.items() if g < 3), sum(n for (_, g), n in want.items() if g >= 3)]


@pytest.mark.parametrize("by_parts", [True, False])
def test_parts_of_texts(by_parts, monkeypatch):
    one = A.aligner(BYTE_TOKENIZER, PIECE_MODEL)
    monkeypatch.setattr(one, "by_parts", by_parts)
    texts = ["a b a", "", "  c", "a b a", " "]
    parts, of, offsets = one.parts(texts)
    got = [[parts[k] for k in of[x:y]] for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == ([["a", "b", "a"], [], ["  c"], ["a", "b", "a"], [" "]] if by_parts else [["a b a"], [], ["  c"], ["a b a"], [" "]])


def test_counts_of_a_pair_table(spark):
    texts = ["the cat", "the dog", "the cat the cat"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    table = A.pair_table(docs, BYTE_TOKENIZER, PIECE_MODEL)
    got = {(r["id_a"], r["id_b"]): r["n_docs"] for r in A.pair_rows(table, 32000).collect()}
    brute, counts = Brute(), Counter()
    for t in texts:
        counts.update({(x, y) for a, b in brute.groups(t) for x in a for y in b})
    assert got == counts


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert A.align_tokens(docs, BYTE_TOKENIZER, PIECE_MODEL).count() == 0
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert A.align_tokens(docs, BYTE_TOKENIZER, PIECE_MODEL).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "", "")


def test_a_table_of_other_documents_is_an_error(spark):
    docs = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    table = A.pair_table(docs, BYTE_TOKENIZER, PIECE_MODEL)
    assert A.align_tokens(docs, BYTE_TOKENIZER, PIECE_MODEL, table=table).first()["count_sum"] > 0
    with pytest.raises(Exception, match="does not hold a pair"):
        A.align_tokens(docs.selectExpr("doc_id", "'another text' as text"), BYTE_TOKENIZER, PIECE_MODEL, table=table).collect()
