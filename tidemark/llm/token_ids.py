"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

A text is cut before blanks that every pre-token begins at, and the library's
ids of a cut are remembered in the worker: most cuts are words that come again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm.common import python_batches

#: Parts that a generation of a worker's memory holds, characters up to which a part is worth it,
#: and characters of texts that are cut and encoded at once.
REMEMBERED, LONGEST, AT_ONCE = 300_000, 48, 2_000_000

#: Marks that are a pre-token of their own between a letter and a blank.
MARKS = ".,;:!?"


def cut_at_blanks(text: str) -> list[str]:
    """The text, each blank that follows a character other than a blank and precedes
    one that is no white space begins a new part (which is given without that blank).

    Joined by single blanks the parts are the text again.
    """
    parts = text.split(" ")
    out, before = [parts[0]], parts[0]
    for p in parts[1:]:
        if p and before and not p[0].isspace():
            out.append(p)
        else:
            out[-1] += " " + p
        before = p
    return out


def distinct_parts(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``cut_at_blanks`` of every text: the distinct parts, the number of each text's parts among
    them, one text after the other, and where each text's begin and end in that."""
    if not texts:
        return [], np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    words, offsets = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
    parts = _strings(words.dictionary)
    odd = [k for k, p in enumerate(parts) if not p or p[0].isspace()]
    if odd:     # some blanks are no cuts; a text with one is cut in a loop
        is_odd = np.zeros(len(parts), dtype=bool)
        is_odd[odd] = True
        cut = cut.to_pylist()
        for k in np.flatnonzero(np.add.reduceat(is_odd[words.indices.to_numpy()], offsets[:-1])).tolist():
            cut[k] = cut_at_blanks(texts[k])
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
        words = pa.array([p for c in cut for p in c], pa.large_string()).dictionary_encode()
        parts = _strings(words.dictionary)
    return parts, words.indices.to_numpy().astype(np.int64), offsets


def _strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


def joined(of_parts: pa.Array, of: np.ndarray, offsets: np.ndarray, between: str | bytes = b"") -> pa.Array:
    """Of each text its parts' values one behind the other; ``of`` and ``offsets`` as ``distinct_parts`` gives them."""
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), of_parts.take(pa.array(of)))
    return pc.binary_join(lists, pa.scalar(between, of_parts.type))


class Memory:
    """Parts of texts and what was made of them: two generations, the older one goes when the newer is full.

    ``learn`` makes what is not known yet, ``new`` then holds all of it until ``forget``.
    """

    def __init__(self, make, remembered: int | None = None):
        self.make = make        # of a list of parts: a list of results
        self.remembered = remembered
        self.new: dict = {}
        self.old: dict = {}
        self.passing: list[str] = []

    def learn(self, parts: set[str]) -> dict:
        """``new``, with a result for each of ``parts``."""
        missing = parts - self.new.keys()
        again = missing & self.old.keys()
        self.new.update((p, self.old[p]) for p in again)
        missing = list(missing - again)
        if missing:
            self.new.update(zip(missing, self.make(missing), strict=True))
            self.passing = [p for p in missing if len(p) > LONGEST or p[:1].isspace()]
        return self.new

    def forget(self) -> None:
        """Drop long parts and parts that only begin a text, and the older generation when the newer is full."""
        for p in self.passing:
            del self.new[p]
        self.passing = []
        if len(self.new) > (self.remembered or REMEMBERED):
            self.old, self.new = self.new, {}

    def by_words(self, parts: list[str], make, of_mark: dict, add) -> list:
        """``make`` of ``parts``, of which a word (ending in a Latin letter) with a mark behind it is
        ``add`` of the word's result, known or made, and the mark's."""
        word = [p[:-1] if p[-1:] in of_mark and p[-2:-1].isalpha() and p[-2] < "\u0250" else None for p in parts]
        words = {w for w in word if w}
        known = {w: self.new[w] for w in words & self.new.keys()}
        known.update((w, self.old[w]) for w in (words - known.keys()) & self.old.keys())
        alone = list((words - known.keys()).union(p for p, w in zip(parts, word, strict=True) if w is None))
        known.update(zip(alone, make(alone) if alone else [], strict=True))
        return [add(known[w], of_mark[p[-1]]) if w else known[p] for p, w in zip(parts, word, strict=True)]


def slices(texts: list[str], at_once: int | None = None) -> Iterator[tuple[int, int]]:
    """Spans of texts of about ``at_once`` characters (by default ``AT_ONCE``)."""
    at_once = at_once or AT_ONCE
    begin = held = 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= at_once:
            yield begin, k + 1
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


class IdEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, equal to the library's ``encode`` of the whole text."""

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        spec = json.loads(self.tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        # parts may be encoded alone where nothing but the byte-level pattern decides what belongs together
        self.by_parts = (spec.get("normalizer") is None and spec.get("truncation") is None and spec.get("padding") is None
                         and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                         and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before.get("add_prefix_space", True))
        self.apart = [] if special_as_text else [t["content"] for t in spec.get("added_tokens", [])]
        vocab = self.tokenizer.get_vocab()
        # a byte-level entry has a character for each byte
        self.n_bytes = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)
        self.n_bytes[list(vocab.values())] = [len(t) for t in vocab]
        marks = dict(zip(MARKS, self.whole(list(MARKS)), strict=True))
        self.memory = Memory(lambda parts: self.memory.by_words(parts, self.of_parts, marks, bytes.__add__))

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def of_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each part behind a blank: all are one text to the library, and token lengths say where a part ends."""
        apart = [k for k, p in enumerate(parts) if p[:1].isspace() or not p or p[-1] == " "]
        joined = [p for p in parts if p and not p[0].isspace() and p[-1] != " "]
        if not self.by_parts:
            return self.whole([" " + p for p in parts])
        ids = np.frombuffer(self.whole([" " + " ".join(joined)])[0] if joined else b"", dtype="<u4")
        ends = np.cumsum(self.n_bytes[ids])
        stops = np.cumsum([len(p.encode()) + 1 for p in joined]) if joined else np.zeros(0, dtype=np.int64)
        cuts = np.searchsorted(ends, stops) + 1
        if len(cuts) and not (cuts[-1] == len(ids) and np.array_equal(ends[cuts - 1], stops)):
            return self.whole([" " + p for p in parts])
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        out = [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        for k, x in zip(apart, self.whole([" " + parts[k] for k in apart]) if apart else [], strict=True):
            out.insert(k, x)
        return out

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special strings: each distinct part of all of them is looked up once."""
        parts, of, offsets = distinct_parts(texts)
        # the part that begins a text has no blank before it
        first = self.whole([parts[k] for k in of[offsets[:-1]].tolist()])
        of = np.delete(of, offsets[:-1])
        used = np.flatnonzero(np.bincount(of, minlength=len(parts)))
        place = np.zeros(len(parts), dtype=np.int64)
        place[used] = np.arange(len(used))
        used = [parts[k] for k in used.tolist()]
        found = self.memory.learn(set(used))
        ids = pa.array(list(map(found.__getitem__, used)), pa.large_binary())
        self.memory.forget()
        rest = joined(ids, place[of], offsets - np.arange(len(offsets))).to_pylist()
        return [f + r for f, r in zip(first, rest, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self.by_parts and not any(s in t for s in self.apart)]
        for a, b in slices([texts[k] for k in plain]):
            for k, x in zip(plain[a:b], self._by_words([texts[k] for k in plain[a:b]]), strict=True):
                out[k] = x
        left = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(left, self.whole([texts[k] for k in left]) if left else [], strict=True):
            out[k] = x
        return out


@lru_cache(maxsize=2)
def encoder(path: str, special_as_text: bool = False) -> IdEncoder:
    """The worker's own: it outlives a task."""
    return IdEncoder(path, special_as_text)


def encode_ids(docs: DataFrame, tokenizer: str, end_id: int | None = None, text: str = "text",
               ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (binary: unsigned 32-bit integers, little-endian) in place of ``text``.

    Rows stay where and in the order they are. A null text counts as empty;
    ``end_id`` is appended to every document. An older column ``ids`` is replaced.
    """
    python_batches(docs.sparkSession, 500)
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), ids.lower())]
    schema = docs.select(*keep).schema.add(ids, "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out = [x + end for x in of.encode([t or "" for t in batch.column(text).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(out, pa.binary())], keep + [ids])
    return docs.select(*keep, docs[text]).mapInArrow(work, schema)
