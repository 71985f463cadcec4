"""SentencePiece encoding and decoding as a weighted transducer (operator 4).

The model's normaliser (blank to the blank mark, a mark in front), its pieces
and the byte fallback are compiled to one transducer from characters to piece
ids. A text is composed with it and the path of least weight in the tropical
semiring (weights add along a path, the least path counts) gives the ids.

For a unigram model the weight of an arc is the piece's negative log
probability. For a merge (BPE) model the arcs also carry the piece before:
two pieces may follow each other only if merging their joined text gives back
just these two; by that rule one path remains, and it is what the merges yield.

No piece goes on over a blank mark that follows another character (nor, in the
models in question, over the edge of a run of letters); a text is cut there, the
parts are independent, and frequent parts are looked up.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_batches

#: The blank mark.
MARK = "\u2581"
#: Weight of a byte arc: above any path of pieces.
_BYTE_WEIGHT = 1e6
#: Most parts of a text that a worker remembers, and the longest it does.
_MEMORY, _LONGEST = 600_000, 48


class PieceTransducer:
    """Compiled from the bytes of a SentencePiece model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, kind = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models whose normaliser keeps characters and escapes blanks are supported")
        if kind.model_type not in (kind.UNIGRAM, kind.BPE) or kind.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with blanks in front are supported")
        self.front = MARK if norm.add_dummy_prefix else ""
        self.merges = kind.model_type == kind.BPE
        self.pieces: dict[str, int] = {}
        self.score: dict[int, float] = {}
        self.byte_ids = [None] * 256
        self.surface: list[bytes] = []
        t = proto.SentencePiece
        for i, p in enumerate(proto.pieces):
            out = b""
            if p.type in (t.NORMAL, t.USER_DEFINED):
                self.pieces[p.piece] = i
                self.score[i] = p.score
                out = p.piece.replace(MARK, " ").encode()
            elif p.type == t.BYTE:
                value = int(p.piece[3:-1], 16)
                self.byte_ids[value] = i
                out = bytes([value])
            self.surface.append(out)
        if None in self.byte_ids:
            raise ValueError("the model has no byte fallback")
        self.text = {i: p for p, i in self.pieces.items()}
        self.longest = max(map(len, self.pieces), default=1)
        self.follows: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        # a part ends before a run of marks; no piece goes on over such a place
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces):
            raise ValueError("a piece holds a blank mark behind another character")
        if self.merges:      # a piece that merging its own characters does not give is on no path
            self.pieces = {p: i for p, i in self.pieces.items() if len(p) == 1 or self.merged(p) == [p]}
        self.size = {i: len(p) for p, i in self.pieces.items()}
        #: The longest piece that a piece begins with.
        self.shorter = {i: next((self.pieces[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.pieces), None)
                        for p, i in self.pieces.items()}
        # nor, in most models, from a letter to another character or back: then a text is cut there too
        letters = re.escape("".join(sorted({c for p in self.pieces for c in p if c.isalpha()})))
        letters, other = letters or "a", f"[^{letters or 'a'}{MARK}]"
        mixed = re.compile(f"[{letters}]{other}|{other}[{letters}]")
        self._split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if any(map(mixed.search, self.pieces)) else
                                 f"{MARK}*[{letters}]+|{MARK}*{other}+|{MARK}+")

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours (the leftmost of equals) until none forms a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.pieces.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _may_follow(self, a: int, b: int) -> bool:
        said = self.follows.get((a, b))
        if said is None:
            x, y = self.text[a], self.text[b]
            said = self.follows[a, b] = self.merged(x + y) == [x, y]
        return said

    def _path(self, s: str) -> list[int]:
        """The ids of the path of least weight over ``s``."""
        return self._merge_path(s) if self.merges else self._least_path(s)

    def _merge_path(self, s: str) -> list[int]:
        """The one path that the pair rule leaves, so the least; arcs of longer pieces are tried first.

        A state (place, piece before) from which the end was not reached is
        not entered again, so the work is at most the number of states.
        """
        n, longest, get, follows, shorter, size = (len(s), self.longest, self.pieces.get, self.follows,
                                                   self.shorter, self.size)
        starts, ids, dead = [], [], set()
        at, before, fresh, i = 0, -1, True, None
        while at < n:
            if fresh:
                end = at + longest if at + longest < n else n
                i = get(s[at:end])
                while i is None and end > at + 1:
                    end -= 1
                    i = get(s[at:end])
                if i is None:
                    i = -1
            while i is not None:
                if i < 0 or before < 0:
                    ok = True
                else:
                    ok = follows.get((before, i))
                    if ok is None:
                        ok = self._may_follow(before, i)
                if ok and not (dead and (at + (size[i] if i >= 0 else 1), i) in dead):
                    break
                i = shorter.get(i)
            if i is None:
                if not ids:     # scores that tie can leave no path: take the merges themselves
                    return [j for x in self.merged(s) for j in ([get(x)] if get(x) is not None else self._bytes(x))]
                dead.add((at, before))
                at, i = starts.pop(), shorter.get(ids.pop())
                before, fresh = ids[-1] if ids else -1, False
                continue
            starts.append(at)
            ids.append(i)
            at += size[i] if i >= 0 else 1
            before, fresh = i, True
        if -1 not in ids:
            return ids
        return [j for k, i in zip(starts, ids) for j in ([i] if i >= 0 else self._bytes(s[k]))]

    def _least_path(self, s: str) -> list[int]:
        """Tropical shortest path over the characters: weights add, the least (of equals the smallest id) is kept."""
        n, get = len(s), self.pieces.get
        best: list[tuple] = [(0.0, 0, -1)] + [(float("inf"), 0, -1)] * n
        for k in range(n):
            here = best[k][0]
            for end in range(k + 1, min(n, k + self.longest) + 1):
                i = get(s[k:end])
                if i is not None:
                    best[end] = min(best[end], (here - self.score[i], k, i))
                elif end == k + 1:
                    best[end] = min(best[end], (here + _BYTE_WEIGHT, k, -1))
        at, out = n, []
        while at > 0:
            _, start, i = best[at]
            out.append([i] if i >= 0 else self._bytes(s[start:at]))
            at = start
        return [j for x in reversed(out) for j in x]

    def _bytes(self, s: str) -> list[int]:
        return [self.byte_ids[b] for b in s.encode("utf-8", "surrogatepass")]

    def _part(self, s: str) -> bytes:
        """Ids (int32 bytes) of one part."""
        ids = array("i", self._path(s)).tobytes()
        if len(s) <= _LONGEST:
            if len(self.known) >= _MEMORY:
                self.known.clear()
            self.known[s] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian int32; a blank mark in the text itself goes by bytes."""
        if not text:
            return b""
        if MARK in text:
            pieces, own = [], np.array(self._bytes(MARK), dtype=np.int32).tobytes()
            for k, x in enumerate(text.split(MARK)):
                x = x.replace(" ", MARK)
                pieces += ([own] if k else []) + self._parts((self.front if not k else "") + x)
            return b"".join(pieces)
        return b"".join(self._parts(self.front + text.replace(" ", MARK)))

    def _parts(self, s: str) -> list[bytes]:
        known, part = self.known, self._part
        return [known.get(x) or part(x) for x in self._split.findall(s)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a path read from ids to characters."""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        if self.front and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "surrogatepass")


def load_transducer(model_path: str) -> PieceTransducer:
    """Compile the model file that the driver reads at ``model_path``."""
    with open(model_path, "rb") as f:
        return PieceTransducer(f.read())


def encode_pieces(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids (array of int), n_pieces and decodes (the ids give back the text);
    columns of those names are replaced.

    Encodes every whole text; null or empty texts have no pieces and decode.
    Extra columns pass, repeated rows are encoded each. The model is read on
    the driver and broadcast (its vocabulary, a few MB at most).
    """
    spark = docs.sparkSession
    python_batches(spark, 500)
    compiled = spark.sparkContext.broadcast(load_transducer(model_path))
    keep = [c for c in docs.columns if c.lower() not in ("ids", "n_pieces", "decodes")]
    docs = docs.select(*keep)
    schema = docs.limit(0).withColumns({"ids": F.lit(None).cast("array<int>"), "n_pieces": F.lit(0).cast("long"),
                                        "decodes": F.lit(True)}).schema
    at = keep.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = compiled.value
        for batch in batches:
            parts, right = [], []
            for text in batch.column(at).to_pylist():
                ids = codec.encode(text or "")
                parts.append(ids)
                right.append(codec.decode(np.frombuffer(ids, dtype=np.int32)) == (text or ""))
            n = np.array([len(x) // 4 for x in parts], dtype=np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(n), pa.array(right)],
                                             [*keep, "ids", "n_pieces", "decodes"])

    return docs.mapInArrow(encode, schema)


def decode_pieces(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with ``out_col``: the text of each id list (null for null)."""
    compiled = rows.sparkSession.sparkContext.broadcast(load_transducer(model_path))

    @F.pandas_udf("string")
    def decode(ids):
        codec = compiled.value
        return ids.map(lambda x: None if x is None else codec.decode(np.asarray(x, dtype=np.int64)))

    return rows.withColumn(out_col, decode(F.col(ids_col)))
