"""Vector bin packing of tokenized examples into sequences of fixed length."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import text as tx

END_ID = 1
MAX_TOKENS, MAX_SEGMENTS, MAX_LOSS = 2048, 256, 2048
OPEN_BINS = 16
_KEPT_WORDS, _AT_ONCE = 1 << 19, 500
_SLICE_BYTES = 1 << 18
NUL = "\0"
_INSIDE, _VALUES = tx.alphabet("nonspace", fold=False)
_FOLDED = tx.alphabet("nonspace")[1]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SALT = tx.U64(0x6A09E667F3BCC909)


def _byte_kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte tables for words of ASCII and U+00C0 to U+00FF: letters, signs, and bytes that no such word has."""
    b = np.arange(256)
    low = b | 32
    letter = (low >= 97) & (low <= 122) & (b < 128) | (b == 0xC3) | (b >= 128) & (b < 0xC0) & (b != 0x97) & (b != 0xB7)
    sign = (b > 32) & (b < 127) & ~letter & ~((b >= 48) & (b <= 57))
    return letter, sign, (b >= 0xC0) & (b != 0xC3)


_LETTER, _SIGN, _FOREIGN = _byte_kinds()


def cuts_known(definition: dict) -> bool:
    """Is it a tokenizer that lower-cases A-Z, tells ends of words by a suffix, and cuts words by _SPLIT alone?

    Then a word cuts between a letter and an ASCII sign, and between such a sign (but an apostrophe) and a letter, and
    runs of letters or of such signs are one part, with one suffix.
    """
    normalizer = definition["normalizer"] or {}
    steps = normalizer.get("normalizers", [normalizer])
    harmless = [
        {"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    ]
    split = {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
    levels = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    exact = not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in definition["added_tokens"])
    model = definition["model"]
    return (
        exact and {"type": "Lowercase"} in steps and all(x in harmless for x in steps)
        and definition["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [split, levels]}
        and model["type"] == "BPE" and bool(model["end_of_word_suffix"]) and not model["dropout"]
    )


class WordTokens:
    """Ids of a text from the ids of its words, for tokenizers that never join what white space parts.

    Each distinct word is tokenized once while it is remembered; the memory starts anew when it is full. If the
    tokenizer's cuts are known (see ``cuts_known``), words of ASCII and U+00C0 to U+00FF are cut further and remembered
    in lower case: most words that differ only in case or in a sign beside them are one.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        mark = self.tokenizer.encode(NUL, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        parsed = json.loads(definition)
        self.closing = None
        if cuts_known(parsed):
            suffix, vocabulary = parsed["model"]["end_of_word_suffix"], self.tokenizer.get_vocab()
            self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            self.added = [t["content"].encode() for t in parsed["added_tokens"]]
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, tx.U64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _words(self, raw: np.ndarray, bounds: np.ndarray):
        """Start, end and hash of every word, the rows' bounds in them, and which words are one part."""
        inside = _INSIDE[raw]
        start, end = tx.spans(inside, bounds)
        if self.closing is None or not len(start):
            hashes = tx.range_hash(tx.prefix_sums(_VALUES[raw]), start, end)
            return start, end, hashes, np.searchsorted(start, bounds), np.zeros(len(start), bool)
        foreign = _FOREIGN[raw]
        data = raw.tobytes() if self.added else b""
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                foreign[at] = True
                at = data.find(token, at + 1)
        values, fold = _FOLDED[raw], None
        if foreign.any():
            whole = np.logical_or.reduceat(foreign, start)  # white space behind a word is not foreign
            fold = np.zeros(len(raw), bool)
            fold[tx.ragged(start[~whole], (end - start)[~whole])] = True
            values = np.where(fold, values, _VALUES[raw])
        letter, sign = _LETTER[raw], _SIGN[raw]
        plain_sign = sign & (raw != 39)
        begins = letter.copy()
        begins[:-1] &= (raw[:-1] != 0xC3) | letter[1:]  # U+00D7 and U+00F7 are no letters
        cut = np.zeros(len(raw), bool)
        cut[1:] = letter[:-1] & sign[1:] | plain_sign[:-1] & begins[1:]
        if fold is not None:
            cut &= fold
        cut[bounds[:-1][bounds[:-1] < len(raw)]] = False
        extra = np.flatnonzero(cut)
        start, end = np.sort(np.concatenate([start, extra]), kind="stable"), np.sort(np.concatenate([end, extra]), kind="stable")
        hashes = tx.range_hash(tx.prefix_sums(values), start, end)
        one = np.zeros(len(start), bool)
        for kind in (letter, plain_sign):
            sums = np.concatenate([[0], np.cumsum(kind)])
            one |= sums[end] - sums[start] == end - start
        if fold is None:
            hashes ^= _SALT
        else:
            hashes[fold[start]] ^= _SALT
            one &= fold[start]
        return start, end, hashes, np.searchsorted(start, bounds), one

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one behind the other, and how many each has.

        The words go as one text, with a NUL between them as a word of its own whose id marks the ends.
        """
        if self.mark is None or any(NUL in w for w in words):
            ids = [x.ids for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)
        ids = self._encode(f" {NUL} ".join([*words, ""]))
        ends = np.flatnonzero(ids == self.mark)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _part_ids(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of one part: each ends with an id that ends a part."""
        length = end - start
        text = np.full(int(length.sum()) + len(length), 32, np.uint8)
        text[tx.ragged(np.cumsum(length + 1) - length - 1, length)] = raw[tx.ragged(start, length)]
        ids = self._encode(text.tobytes().decode())
        ends = np.flatnonzero(self.closing[ids])
        if len(ends) != len(start):
            return self._ids(text.tobytes().decode().split(" ")[:-1])
        return ids, np.diff(ends, prepend=-1)

    def _learn(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, one: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > _KEPT_WORDS:
            self._forget()
        found, order = [], np.argsort(~one, kind="stable")
        start, end, hashes, n_one = start[order], end[order], hashes[order], int(one.sum())
        for first, last in ((0, n_one), (n_one, len(order))):
            for at in range(first, last, _AT_ONCE):  # few at once: encodings are large
                a, b = start[at : min(at + _AT_ONCE, last)], end[at : min(at + _AT_ONCE, last)]
                if at < n_one:
                    found.append(self._part_ids(raw, a, b))
                else:
                    found.append(self._ids([raw[i:j].tobytes().decode() for i, j in zip(a, b, strict=True)]))
        new, length = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        place = len(self.pool) + np.cumsum(length) - length
        self.pool = np.concatenate([self.pool, new])
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every, kind="stable")  # runs that are sorted already
        self.hashes = every[order]
        self.start = np.concatenate([self.start, place])[order]
        self.length = np.concatenate([self.length, length])[order]

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one behind the other, and the rows' bounds in them."""
        start, end, hashes, by_row, one = self._words(raw, bounds)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        if not known.all():
            if len(self.hashes) + int((~known).sum()) > _KEPT_WORDS:
                known[:] = False  # all words of this slice are learnt anew
            fresh = first[~known]
            self._learn(raw, start[fresh], end[fresh], distinct[~known], one[fresh])
            at = np.searchsorted(self.hashes, distinct)
        at = at[which]
        length = self.length[at]
        ids = self.pool[tx.ragged(self.start[at], length)]
        sums = np.concatenate([[0], np.cumsum(length)])
        return ids, sums[by_row]


class Packer:
    """Places pieces into open bins with limits on tokens, segments and loss-bearing tokens.

    A piece goes to the bin, among those it fits, for which the dot product of its needs and the bin's room (each as a
    share of its limit) is largest. If it fits none and no more bins may be opened, the best bin takes as much of it as
    it has room for, so bins close full. What is open at the end is packed once more, and the last bin is split into
    bins whose token counts are powers of two.
    """

    def __init__(self, limits: tuple[int, int, int], open_bins: int = OPEN_BINS):
        self.limits = np.array(limits, float)
        self.most = open_bins
        self.room: list[np.ndarray] = []
        self.bins: list[list[tuple]] = []
        self.closed: list[list[tuple]] = []

    def add(self, key, start: int, length: int, loss_from: int) -> None:
        """A piece of example ``key``: ids [start, start + length); those from ``loss_from`` on bear loss."""
        while length:
            loss = np.array([length, 1, max(0, start + length - max(start, loss_from))], float)
            room = np.array(self.room) if self.room else np.zeros((0, 3))
            score = (room / self.limits) @ (loss / self.limits)
            fits = (room >= loss).all(1)
            if fits.any():
                k, take = int(np.argmax(np.where(fits, score, -1))), length
            elif len(self.bins) < self.most:
                self.room.append(self.limits.copy())
                self.bins.append([])
                k, take = len(self.bins) - 1, self._take(self.limits, start, length, loss_from)
            else:
                k = int(np.argmax(score))
                take = self._take(room[k], start, length, loss_from)
            used = np.array([take, 1, max(0, start + take - max(start, loss_from))], float)
            self.bins[k].append((key, start, take, loss_from))
            self.room[k] = self.room[k] - used
            if (self.room[k][:2] < 1).any() or (self.room[k][2] < 1):
                self.closed.append(self.bins.pop(k))
                self.room.pop(k)
            start, length = start + take, length - take

    def _take(self, room: np.ndarray, start: int, length: int, loss_from: int) -> int:
        free = max(0, loss_from - start)
        return int(min(length, room[0], free + room[2]))

    def taken(self) -> list[list[tuple]]:
        done, self.closed = self.closed, []
        return done

    def finish(self) -> list[list[tuple]]:
        """Close all bins."""
        rest = [x for b in self.bins for x in b]
        self.room, self.bins, self.most = [], [], 1
        for piece in rest:
            self.add(*piece)
        done = self.taken()
        if self.bins:
            done += self._split(self.bins[0])
            self.room, self.bins = [], []
        return done

    @staticmethod
    def _split(pieces: list[tuple]) -> Iterator[list[tuple]]:
        left = sum(x[2] for x in pieces)
        pieces = list(pieces)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            out = []
            while size:
                key, start, length, loss_from = pieces.pop(0)
                take = min(size, length)
                out.append((key, start, take, loss_from))
                size -= take
                if take < length:
                    pieces.insert(0, (key, start + take, length - take, loss_from))
            yield out


PIECES = (
    "start long, length long, n_loss long, doc_tokens long, sequence_id long, offset long, sequence_length long, ids binary"
)


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
    max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS,
) -> DataFrame:
    """Pack every row's ids into sequences with limits on tokens, segments and loss-bearing tokens.

    An example is the ids of ``prompt_col`` (if given; these bear no loss), those of ``text_col``, and END_ID. Each id
    is in exactly one piece. One row per piece: ``doc_id``, ``start`` (ids of its example before it), ``length``,
    ``n_loss``, ``doc_tokens`` (ids of the example), ``sequence_id``, ``offset`` (place in the sequence, gapless from
    0), ``sequence_length`` and ``ids`` (little-endian unsigned 32-bit).

    NULL texts are empty, so such a row is END_ID alone; rows that repeat are examples of their own; an id may be NULL.
    An empty table gives an empty result. Other columns are not read.

    The tokenizer must cut at white space, as word-level BPE does. There is no shuffle: each task packs the rows of its
    partition with a few open bins, in memory bounded by their ids and one slice of texts, and wastes nothing at its
    end (see ``Packer``). Sequence ids come from the partition's number, so a task that runs again gives the same ids.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    prompt = F.col(prompt_col) if prompt_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), prompt.alias("prompt"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        tokens = WordTokens(definition)
        packer = Packer((max_tokens, max_segments, max_loss))
        held: dict[int, tuple] = {}  # example -> (doc_id, ids) while some of its ids are in open bins
        left: dict[int, int] = {}
        number, sequence = 0, TaskContext.get().partitionId() << 40

        def written(sequences):
            nonlocal sequence
            columns: list[list] = [[] for _ in range(9)]
            for pieces in sequences:
                total, at = sum(x[2] for x in pieces), 0
                for key, start, length, loss_from in pieces:
                    doc_id, ids = held[key]
                    loss = max(0, start + length - max(start, loss_from))
                    row = (doc_id, start, length, loss, len(ids), sequence, at, total, ids[start : start + length].tobytes())
                    for values, x in zip(columns, row, strict=True):
                        values.append(x)
                    at += length
                    left[key] -= length
                    if not left[key]:
                        del held[key], left[key]
                sequence += 1
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:8]), pa.array(columns[8], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "n_loss", "doc_tokens", "sequence_id", "offset", "sequence_length", "ids"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            texts, prompts = tx.column(batch, "text"), tx.column(batch, "prompt")
            for a, b, raw, bounds in tx.slices(texts, _SLICE_BYTES):
                ids, at = tokens.encode(raw, bounds)
                before = [np.zeros(0, np.uint32)] * (b - a)
                for c, d, raw_p, bounds_p in tx.slices(prompts.slice(a, b - a)) if prompt_col else ():
                    ids_p, at_p = tokens.encode(raw_p, bounds_p)
                    before[c:d] = [ids_p[at_p[k] : at_p[k + 1]] for k in range(d - c)]
                doc_ids = batch.column(0).slice(a, b - a).to_pylist()
                for k in range(b - a):
                    own = np.concatenate([before[k], ids[at[k] : at[k + 1]], np.array([END_ID], np.uint32)]).astype("<u4")
                    held[number], left[number] = (doc_ids[k], own), len(own)
                    packer.add(number, 0, len(own), len(before[k]))
                    number += 1
                yield written(packer.taken())
        if number:
            yield written(packer.finish())

    return rows.mapInArrow(run, f"doc_id {kind}, {PIECES}")
