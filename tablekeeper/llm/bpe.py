"""Byte-level BPE: merges by a priority queue over linked symbols, decoding by vocabulary strings."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

KEPT_WORDS, KEPT_CHARS = 1 << 18, 64
"""So many encoded words, of so many characters at most, are remembered by a worker; half of them are older ones."""
_DECODED_IDS = 1 << 18


def _split(space: str, letter: str, number: str) -> str:
    """Pattern of a word, of what is within the brackets of three classes of characters."""
    other = f"[^{space}{letter}{number}]"
    return rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?{other}+|[{space}]+(?![^{space}])|[{space}]+"


_CLASSES = r"\p{White_Space}", r"\p{L}", r"\p{N}"
_WORDS = regex.compile(_split(*_CLASSES)).findall
# the same for texts of the first 256 characters only, which the plain matcher goes through faster
_LATIN_WORDS = re.compile(_split(*["".join(rf"\x{c:02x}" for c in range(256) if regex.match(kind, chr(c))) for kind in _CLASSES])).findall


def split(text: str) -> list[str]:
    """The words of a text; together they are the text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORDS(text)
    return _LATIN_WORDS(text)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Kept(dict):
    """Ids of words, as bytes of 32-bit numbers; ``make`` gives those that are not there.

    When it has half of KEPT_WORDS its words become the older ones, and the older ones before them are forgotten. An older word that comes
    again is taken over, so frequent words stay.
    """

    def __init__(self, make: Callable[[bytes], list[int]]):
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = array("i", self.make(word.encode())).tobytes()
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


class Coder:
    """Encoder and decoder of a tokenizer file with a byte-level BPE model.

    ValueError for files with anything that changes the ids otherwise (normalizers, prefix spaces, dropout, ...).
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, pre, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        odd = [
            spec.get("normalizer"), model.get("type") != "BPE", pre.get("type") != "ByteLevel", not pre.get("use_regex", True),
            pre.get("add_prefix_space"), (spec.get("decoder") or {}).get("type") != "ByteLevel",
            *(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")),
            *(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")),
        ]
        letters, vocab = byte_letters(), model["vocab"]
        if any(odd) or not all(c in vocab for c in letters):
            raise ValueError("not a plain byte-level BPE tokenizer")
        self.first = [vocab[c] for c in letters]
        self.step = max(vocab.values()) + 1
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {vocab[a] * self.step + vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}

        self.added = {t["content"]: t["id"] for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.kept = Kept(self.merge)

        byte_of = {c: b for b, c in enumerate(letters)}
        names = {i: s for s, i in chain(vocab.items(), self.added.items())}
        size = max(names) + 1
        strings = [b""] * size
        for i, s in names.items():
            strings[i] = bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()
        self.length = np.fromiter(map(len, strings), np.int64, size)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one word.

        The queue holds (rank, place of the left symbol) of mergeable neighbours, so equal ranks go from left to right.
        A merge gives the left symbol its new id and takes the right one out of the list; entries whose symbols are no
        longer the pair of that rank are stale and skipped. n symbols take n log n steps, however long the word.
        """
        ids = [self.first[b] for b in data]
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        known, step = self.merges.get, self.step
        queue = [(found[0], i) for i in range(end - 1) if (found := known(ids[i] * step + ids[i + 1]))]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j == end or (found := known(ids[i] * step + ids[j])) is None or found[0] != rank:
                continue
            ids[i], ids[j], k = found[1], -1, after[j]
            after[i] = k
            if k < end:
                before[k] = i
                if found := known(ids[i] * step + ids[k]):
                    heappush(queue, (found[0], i))
            if (h := before[i]) >= 0 and (found := known(ids[h] * step + ids[i])):
                heappush(queue, (found[0], h))
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of added tokens in it are these tokens."""
        found, at, ids_of = [], 0, self.kept.__getitem__
        for mark in self.marks.finditer(text) if self.marks else ():
            found += map(ids_of, split(text[at : mark.start()]))
            found.append(array("i", [self.added[mark.group()]]).tobytes())
            at = mark.end()
        found += map(ids_of, split(text[at:] if at else text))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the vocabulary strings of the ids, one behind the other, and how many each id has."""
        known = (ids >= 0) & (ids < len(self.length))
        at = np.where(known, ids, 0)
        length = np.where(known, self.length[at], 0)
        return self.bytes[tx.ragged(self.start[at], length)], length


@lru_cache(maxsize=2)
def _coder(definition: str) -> Coder:
    return Coder(definition)


def _definition(tokenizer_path: str) -> str:
    with open(tokenizer_path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of each row: the token ids of its whole text, as an array of int.

    NULL and empty texts have no ids (an empty array). A NULL id stays NULL; rows that repeat an id, or whole rows, each
    give a row. An empty table gives an empty result; other columns are not read. Rows do not meet, so nothing is
    shuffled, and a lost task is computed anew from its rows alone. The vocabulary (one file, read here) goes along with
    the tasks; a worker remembers the ids of words, at most KEPT_WORDS.
    """
    definition = _definition(tokenizer_path)
    _coder(definition)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        coder = _coder(definition)
        for batch in batches:
            texts = tx.column(batch, "text")
            for a, b, _, _ in tx.slices(texts):
                found = [coder.encode(text) for text in texts.slice(a, b - a).to_pylist()]
                bounds = np.concatenate([[0], np.cumsum([len(ids) for ids in found])])
                lists = tx.lists(pa.array(np.concatenate(found)), bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids as ``text_col``, which is added last or replaces its like.

    The strings of the vocabulary are concatenated as bytes; what is no UTF-8 then becomes U+FFFD, one per broken
    sequence. NULL or empty ids give an empty text; NULL ids within a list, and ids outside the vocabulary, give nothing.
    Rows and all other columns stay as they are, in empty tables too.
    """
    definition = _definition(tokenizer_path)
    _coder(definition)
    kept = [c for c in encoded.columns if c != text_col or c == ids_col]
    if text_col == ids_col:
        raise ValueError("text_col must differ from ids_col")
    rows = encoded.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids_col}`").cast("array<int>").alias("the ids"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(text_col, T.StringType())])

    def run(batches):
        coder = _coder(definition)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(size)])
            first = 0
            while first < len(size):
                last = max(first + 1, int(np.searchsorted(at, at[first] + _DECODED_IDS, "right")) - 1)
                flat = lists.slice(first, last - first).flatten().fill_null(-1)
                raw, length = coder.decode(flat.to_numpy(zero_copy_only=False))
                ends = np.concatenate([[0], np.cumsum(length)])[at[first : last + 1] - at[first]]
                data = raw.tobytes()
                texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(ends[:-1], ends[1:], strict=True)]
                given = batch.slice(first, last - first).columns[:-1]
                yield pa.RecordBatch.from_arrays([*given, pa.array(texts, pa.string())], schema.names)
                first = last

    return rows.mapInArrow(run, schema)
