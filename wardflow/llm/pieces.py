"""SentencePiece encoding and decoding by suffix-array matching.

A text falls into units that pieces don't cross: a run of word-start marks with
the characters that follow it, and single characters that aren't in the
vocabulary. The distinct new units of a batch are concatenated and indexed by a
suffix array; every piece is binary-searched for the range of suffixes that
start with it. Those occurrences are the edges of a lattice, sorted by the
position where they end and relaxed in that order.

The vocabulary is one of merges, so the best path is the one the merges give.
Of a unit's prefix the merges give one last piece; an edge that starts where the
prefix ends is on the path if the merges keep the border between that last piece
and the edge's piece. That holds for exactly one edge per end position, so
relaxing sets each position once. ``Merges.keeps`` decides it by undoing, last
merge first, what happened on both sides of the border. The ids equal the
library's (tested), which is used to read the vocabulary file only.

Decoding joins the pieces' characters, takes bytes from byte pieces, and turns
word-start marks into blanks.

Memory in a task: the units of a batch (new ones in portions of ``portion``
characters), and a bounded store of units met before. Defined results: a null or
empty text has no ids; repeated rows are encoded alike; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import small_batches

MARK = "▁"
#: Stands before the first piece of a unit.
START = 0


def merged(symbols: list[str], ranks: dict[str, int]) -> list[str]:
    """Merge neighbours, best rank first and leftmost of equals, until none is left."""
    symbols = list(symbols)
    while True:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            rank = ranks.get(symbols[i] + symbols[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if at < 0:
            return symbols
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]


class Merges:
    """The vocabulary as arrays: characters, ranks, the last merge of each piece, and the pairs that merge."""

    def __init__(self, parts: tuple):
        (self.names, self.byte_base, self.rank, self.left, self.right, self.pair_keys, self.pair_ranks) = parts
        self.never = np.int64(1) << 40

    @staticmethod
    def parts(model: str) -> tuple:
        """Read from a model file (on the driver): plain lists and arrays for a broadcast."""
        import public_tokenizers as files
        import sentencepiece
        reader = sentencepiece.SentencePieceProcessor(model_file=files.path(model))
        size = reader.get_piece_size()
        names = [reader.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (reader.is_byte(i) or reader.is_control(i) or reader.is_unknown(i))]
        byte_base = next(i for i in range(size) if reader.is_byte(i))
        order = {score: k for k, score in enumerate(sorted({-reader.get_score(i) for i in plain}))}
        ranks = {names[i]: order[-reader.get_score(i)] for i in plain}
        ids = {names[i]: i for i in plain}
        rank, left, right = (np.full(size, -1, dtype=np.int64) for _ in range(3))
        pairs = {}
        for i in plain:
            name = names[i]
            for cut in range(1, len(name)):
                a, b = ids.get(name[:cut]), ids.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = ranks[name]
            if len(name) > 1:
                # The last merge: as the whole merges, but for the piece itself.
                own = ranks.pop(name)
                a, b = merged(list(name), ranks)
                ranks[name] = own
                rank[i], left[i], right[i] = own, ids[a], ids[b]
        keys = np.array(sorted(pairs), dtype=np.int64)
        return names, byte_base, rank, left, right, keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank at which a and b merge, ``never`` if they don't."""
        key = a * len(self.names) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.never)

    def keeps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges keep the border between pieces a and b."""
        out = np.ones(len(a), dtype=bool)
        x, y = a.astype(np.int64), b.astype(np.int64)
        until = np.full(len(a), self.never)  # the two stand side by side until a merge of this rank,
        right_side = np.zeros(len(a), dtype=bool)  # to the right of the border (at equal rank, the left goes first)
        todo = np.arange(len(a))
        while len(todo):
            across = self.cross(x, y)
            joins = (across < until) | (right_side & (across == until))
            out[todo[joins]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~joins & ((rx >= 0) | (ry >= 0))
            todo, x, y, rx, ry = todo[go], x[go], y[go], rx[go], ry[go]
            right_side = ry >= rx  # the later merge is undone first
            until = np.where(right_side, ry, rx)
            x, y = np.where(right_side, x, self.right[x]), np.where(right_side, self.left[y], y)
        return out


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` codes: by as many as fit in a word, then by doubling."""
    alphabet, key = np.unique(codes, return_inverse=True)
    bits = int(len(alphabet)).bit_length()
    first, reach = key.astype(np.int64) + 1, min(depth, 62 // bits)
    key = first.copy()
    for k in range(1, reach):
        key <<= bits
        key[:-k] |= first[k:]
    order = np.argsort(key, kind="stable")
    while reach < depth:
        ordered = key[order]
        rank = np.empty_like(key)
        rank[order] = np.concatenate(([1], 1 + np.cumsum(ordered[1:] != ordered[:-1])))
        key = rank * (len(codes) + 2)
        key[:-reach] += rank[reach:]
        order = np.argsort(key, kind="stable")
        reach *= 2
    return order


def occurrence_ranges(codes: np.ndarray, order: np.ndarray, patterns: np.ndarray, lengths: np.ndarray):
    """For each pattern (a row of codes, zero-filled), the range of ``order`` whose suffixes start with it."""
    low = np.zeros(len(patterns), dtype=np.int64)
    high = np.full(len(patterns), len(order), dtype=np.int64)
    padded = np.concatenate((codes, np.zeros(patterns.shape[1] + 1, dtype=codes.dtype)))

    def first(rows, lo, hi, depth, wanted, after: bool):
        """The first place in [lo, hi) whose code at ``depth`` is at least (more than, if ``after``) the one wanted."""
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) // 2
            code = padded[order[np.minimum(mid, len(order) - 1)] + depth]
            right = open_ & ((code <= wanted) if after else (code < wanted))
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)

    for depth in range(patterns.shape[1]):
        rows = np.nonzero((lengths > depth) & (low < high))[0]
        wanted = patterns[rows, depth]
        lo = first(rows, low[rows], high[rows], depth, wanted, False)
        hi = first(rows, lo, high[rows], depth, wanted, True)
        low[rows], high[rows] = lo, hi
    return low, np.maximum(low, high)


class Places(dict):
    """Numbers of units, given as they are met; ``new`` are the latest."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        self[unit] = number = len(self)
        return number


class UnitEncoder:
    """Ids of units; forgets the ones met before when it holds more than ``stored``."""

    def __init__(self, merges: Merges, portion: int = 1 << 19, stored: int = 300_000):
        self.merges, self.portion, self.stored = merges, portion, stored
        ids = [i for i in range(len(merges.names)) if not self._special(i)]
        self.piece_ids = np.array(ids, dtype=np.int64)
        self.lengths = np.array([len(merges.names[i]) for i in ids])
        self.by_piece = np.zeros(len(merges.names), dtype=np.int64)
        self.by_piece[self.piece_ids] = self.lengths
        self.patterns = np.zeros((len(ids), self.lengths.max()), dtype=np.int32)
        for row, i in enumerate(ids):
            self.patterns[row, :self.lengths[row]] = [ord(c) for c in merges.names[i]]
        known = {merges.names[i] for i in ids if len(merges.names[i]) == 1} - {MARK}
        chars = "".join(re.escape(c) for c in sorted(known))
        self.units = re.compile(f"{MARK}+[{chars}]*|[{chars}]+|[^{chars}{MARK}]", re.S).findall
        self.known = known | {MARK}
        self._forget()
        # Borders judged lately: a direct-mapped table of pairs.
        self.seen_pairs = np.full(1 << 20, -1, dtype=np.int64)
        self.seen_keeps = np.zeros(1 << 20, dtype=bool)

    def _forget(self) -> None:
        self.place, self.flat = Places(), np.zeros(0, dtype="<u4")
        self.begin = self.count = np.zeros(0, dtype=np.int64)

    def _special(self, i: int) -> bool:
        base = self.merges.byte_base
        return i < base + 256

    def keeps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.merges.names) + b
        slot = (key * 0x9E3779B1 >> 11) & ((1 << 20) - 1)
        out = self.seen_keeps[slot]
        new = np.nonzero(self.seen_pairs[slot] != key)[0]
        if len(new):
            distinct, back = np.unique(key[new], return_inverse=True)
            size = len(self.merges.names)
            kept = self.merges.keeps(distinct // size, distinct % size)
            out[new] = kept[back]
            at = (distinct * 0x9E3779B1 >> 11) & ((1 << 20) - 1)
            self.seen_pairs[at], self.seen_keeps[at] = distinct, kept
            # Of pairs that share a slot the last one stays, with its own verdict.
            mine = self.seen_pairs[at] == distinct
            self.seen_keeps[at[mine]] = kept[mine]
        return out

    def encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of known characters, one after the other, and where each unit's begin."""
        text = "\0" + "\0".join(units) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)
        order = suffix_array(codes, self.patterns.shape[1])
        low, high = occurrence_ranges(codes, order, self.patterns, self.lengths)
        n = high - low
        # Edges: each occurrence of each piece, by the offset in its unit at which it ends.
        piece = np.repeat(np.arange(len(n)), n)
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        start = order[rank]
        stop = start + self.lengths[piece]
        piece = self.piece_ids[piece]
        gaps = np.nonzero(codes == 0)[0]
        unit_start = np.zeros(len(codes), dtype=np.int64)
        unit_start[gaps[1:]] = np.diff(gaps)
        before = np.repeat(gaps[:-1], np.diff(gaps))  # the gap before each position
        offset = stop - before[np.minimum(start, len(before) - 1)]
        by_offset = np.argsort(offset, kind="stable")
        offset, start, stop, piece = offset[by_offset], start[by_offset], stop[by_offset], piece[by_offset]
        last = np.zeros(len(codes), dtype=np.int64)  # the last piece of the prefix that ends before a position
        bounds = np.searchsorted(offset, np.arange(offset[-1] + 2)) if len(offset) else np.zeros(1, dtype=int)
        for k in range(len(bounds) - 1):
            edge = slice(bounds[k], bounds[k + 1])
            if edge.start == edge.stop:
                continue
            p, prev = piece[edge], last[start[edge]]
            right = prev == START
            ask = np.nonzero(~right)[0]
            right[ask] = self.keeps(prev[ask], p[ask])
            last[stop[edge][right]] = p[right]
        # Back from the end of each unit.
        at, unit = gaps[1:].copy(), np.arange(len(units))
        found_unit, found_piece = [], []
        while len(at):
            p = last[at]
            found_unit.append(unit)
            found_piece.append(p)
            at = at - self.by_piece[p]
            going = codes[at - 1] != 0
            at, unit = at[going], unit[going]
        who, ids = np.concatenate(found_unit[::-1]), np.concatenate(found_piece[::-1])
        by_unit = np.argsort(who, kind="stable")
        counts = np.bincount(who, minlength=len(units))
        return ids[by_unit], np.concatenate(([0], np.cumsum(counts)))

    def learn(self, units: list[str]) -> None:
        """Take up the units numbered last."""
        count, flat = np.zeros(len(units), dtype=np.int64), []
        inside = [k for k, unit in enumerate(units) if unit[0] in self.known]
        outside = [k for k, unit in enumerate(units) if unit[0] not in self.known]
        held = np.cumsum([len(units[k]) + 1 for k in inside]) // self.portion
        for numbers in np.split(np.array(inside, dtype=np.int64), np.nonzero(np.diff(held))[0] + 1) if inside else []:
            found, starts = self.encoded([units[k] for k in numbers])
            flat.append(found)
            count[numbers] = np.diff(starts)
        for k in outside:  # characters that aren't in the vocabulary: their bytes
            flat.append(np.frombuffer(units[k].encode("utf-8", "replace"), np.uint8).astype(np.int64) + self.merges.byte_base)
            count[k] = len(flat[-1])
        order = np.array(inside + outside, dtype=np.int64)
        begin = np.zeros(len(units), dtype=np.int64)
        begin[order] = np.cumsum(count[order]) - count[order] + len(self.flat)
        self.begin, self.count = np.concatenate((self.begin, begin)), np.concatenate((self.count, count))
        self.flat = np.concatenate((self.flat, *[x.astype("<u4") for x in flat]))

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.place) > self.stored:
            self._forget()
        number = self.place.__getitem__
        split = []
        for text in texts:
            units = self.units(MARK + text.replace(" ", MARK)) if text else []
            split.append(np.fromiter(map(number, units), dtype=np.int64, count=len(units)))
        if self.place.new:
            self.learn(self.place.new)
            self.place.new = []
        out = []
        for at in split:
            begin, n = self.begin[at], self.count[at]
            total = np.cumsum(n)
            take = np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + n, n)
            out.append(self.flat[take])
        return out


def decoder(merges: Merges):
    """A function from ids to the text they stand for."""
    base = merges.byte_base
    pieces = [n.replace(MARK, " ").encode("utf-8", "replace") for n in merges.names]
    pieces[:base] = [b""] * base
    pieces[base:base + 256] = [bytes([b]) for b in range(256)]

    def decode(ids) -> str:
        text = b"".join(map(pieces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    return decode


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = "piece_bpe_32k.model",
           rows_at_once: int = 4000) -> DataFrame:
    """``doc_id, ids``: the ids as little-endian unsigned 32-bit integers."""
    small_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Merges.parts(model))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = UnitEncoder(Merges(vocabulary.value))
        for batch in batches:
            for k in range(0, len(batch), rows_at_once):
                rows = batch.iloc[k:k + rows_at_once]
                ids = encoder.texts([t if isinstance(t, str) else "" for t in rows["text"]])
                yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": [x.tobytes() for x in ids]})

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        task, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``doc_id, text`` of encoded rows (``doc_id, ids``)."""
    small_batches(encoded.sparkSession)
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Merges.parts(model))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back = decoder(Merges(vocabulary.value))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"],
                                "text": [back(np.frombuffer(x, "<u4").tolist()) for x in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(task, "doc_id long, text string")


def roundtrip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = "piece_bpe_32k.model",
              rows_at_once: int = 4000) -> DataFrame:
    """``doc_id, ids, same``: encoded rows, and whether decoding gives the text back (marks in it read as blanks)."""
    small_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Merges.parts(model))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges = Merges(vocabulary.value)
        encoder, back = UnitEncoder(merges), decoder(merges)
        for batch in batches:
            for k in range(0, len(batch), rows_at_once):
                rows = batch.iloc[k:k + rows_at_once]
                texts = [t if isinstance(t, str) else "" for t in rows["text"]]
                ids = encoder.texts(texts)
                same = [back(x.tolist()) == t.replace(MARK, " ") for x, t in zip(ids, texts)]
                yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": [x.tobytes() for x in ids], "same": same})

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        task, "doc_id long, ids binary, same boolean")
