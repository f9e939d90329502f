"""Sum-of-squares online packing of tokenised documents into fixed windows.

A document is its token ids followed by one end id. Whole windows are cut off
its front; what remains (shorter than a window) is an item. Each task tokenises the
rows it scans and writes windows and items. The items' sizes alone, some ``packer_items``
of them, are a packer's stream: ``levels[h]`` counts the open windows filled to
``h``, and an item goes where the sum of the squared counts after the move is
smallest (a new window is level 0, a full one counts as closed). So a packer sees
items of many tasks, and open windows live as long as its stream. When that ends,
or the packer holds ``max_open`` open windows, the open ones are levelled:
the emptiest are cut up to fill the gaps of the fullest, which leaves one
partly filled window. ``closed_by`` says which way a window was closed. Places go back
to the items' ids by a join.

Defined results: a null or empty text is one end id; repeated rows are packed
once each; an empty table gives no rows. Memory in a task: the rows of one Arrow
batch, or the sizes of a packer's open windows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import small_batches, stored

#: Whole windows have a sequence, items (remainders) a number.
CUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, item long"
PLACED = "item long, part long, length long, sequence_id long, offset long, closed_by string"
#: Sequences and items are numbered from the task's (or packer's) number times this; whole windows' sequences are negative.
PER_TASK = 1 << 40
LONG_WORD, LONG_GAP = 2_000, 1_000


class Encoder:
    """Ids of the byte-level vocabulary in the files ``json_name`` / ``ranks_name``.

    The rank file holds the same vocabulary as the json file and its reader is
    some five times as fast; it is slow on words of thousands of characters and
    on very long white space, so texts with those go to the other library. The
    ids are equal (tested).
    """

    def __init__(self, json_name: str, ranks_name: str):
        import public_tokenizers as files
        import tiktoken
        self._json = files.path(json_name)
        with open(files.path(ranks_name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self._fast = tiktoken.Encoding("ranks", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._careful = None

    def __call__(self, text: str) -> list[int]:
        if len(text) >= LONG_GAP:
            words = text.split()
            gaps = len(text) - sum(map(len, words)) - len(words)
            if gaps >= LONG_GAP - 1 or max(map(len, words), default=0) > LONG_WORD:
                return self.careful(text)
        return self._fast.encode_ordinary(text)

    def fast(self, text: str) -> list[int]:
        """For text without long words and long white space."""
        return self._fast.encode_ordinary(text)

    def careful(self, text: str) -> list[int]:
        if self._careful is None:
            from tokenizers import Tokenizer
            self._careful = Tokenizer.from_file(self._json)
            self._careful.encode_special_tokens = True
        return self._careful.encode(text, add_special_tokens=False).ids


class SumOfSquares:
    """A packer of items by size. ``place`` returns the parts of the windows it closed:
    (item, start in it, length, sequence, offset, closed by)."""

    def __init__(self, window: int, first_sequence: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]  # by level: windows, each a list of parts
        self.n_open = 0
        self.next_sequence = first_sequence

    def _close(self, parts: list[tuple], closed_by: str) -> list[tuple]:
        out, at = [], 0
        for item, start, length in parts:
            out.append((item, start, length, self.next_sequence, at, closed_by))
            at += length
        self.next_sequence += 1
        return out

    def best_level(self, size: int) -> int:
        """The level whose use gives the smallest sum of squared counts; ties go to the fullest."""
        levels, window = self.levels, self.window
        last = window - size
        cost = 2 * levels[size:window + 1] + 1  # a window more at h + size ...
        cost[last] = 0                          # ... unless that is full
        cost[1:] -= 2 * levels[1:last + 1] - 1  # a window less at h, unless it is new
        usable = levels[:last + 1] > 0
        usable[0] = True
        cost = np.where(usable, cost, np.iinfo(np.int64).max)
        return last - int(np.argmin(cost[::-1]))

    def place(self, item: int, size: int) -> list[tuple]:
        """Place an item shorter than a window."""
        out, level = [], self.best_level(size)
        parts = self.open[level].pop() if level else []
        parts.append((item, 0, size))
        if level:
            self.levels[level] -= 1
        else:
            self.n_open += 1
        if level + size == self.window:
            self.n_open -= 1
            out += self._close(parts, "placement")
        else:
            self.levels[level + size] += 1
            self.open[level + size].append(parts)
        if self.n_open > self.max_open:
            out += self.level_out()
        return out

    def level_out(self) -> list[tuple]:
        """Fill the fullest open windows with what the emptiest hold; keep the last partly filled one open."""
        queue = [(level, parts) for level in range(1, self.window) for parts in self.open[level]]
        self.levels[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.n_open = 0
        out, low, high = [], 0, len(queue) - 1
        while low < high:
            filled, target = queue[high]
            while filled < self.window and low < high:
                level, source = queue[low]
                item, start, length = source.pop()
                room = self.window - filled
                if length > room:  # cut: the front moves, the rest stays
                    source.append((item, start + room, length - room))
                    length = room
                target.append((item, start, length))
                filled += length
                queue[low] = (level - length, source)
                if not source:
                    low += 1
            queue[high] = (filled, target)
            if filled == self.window:
                out += self._close(target, "levelling")
                high -= 1
        if low == high:
            filled, parts = queue[low]
            if filled == self.window:
                out += self._close(parts, "levelling")
            else:
                self.levels[filled] += 1
                self.open[filled].append(parts)
                self.n_open = 1
        return out

    def finish(self) -> list[tuple]:
        out = self.level_out()
        for level in range(1, self.window):
            for parts in self.open[level]:
                out += self._close(parts, "levelling")
        return out


def cut_documents(docs: DataFrame, doc_id: str, text: str, window: int, end_id: int, json_name: str, ranks_name: str) -> DataFrame:
    """Whole windows and items of the documents, with ids as little-endian unsigned 32-bit integers."""
    columns = [part.split()[0] for part in CUT.split(", ")]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(json_name, ranks_name)
        number = TaskContext.get().partitionId() * PER_TASK
        sequence, pieces, held = -1 - number, [], 0
        for batch in batches:
            for key, body in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*(encode(body) if isinstance(body, str) and body else []), end_id], dtype="<u4")
                whole = len(ids) - len(ids) % window
                for start in range(0, whole, window):
                    pieces.append((key, start, window, ids[start:start + window].tobytes(), len(ids), sequence, None))
                    sequence -= 1
                if whole < len(ids):
                    pieces.append((key, whole, len(ids) - whole, ids[whole:].tobytes(), len(ids), None, number))
                    number += 1
                held += len(ids)
                if held > 2_000_000:
                    yield frame(pieces)
                    pieces, held = [], 0
        if pieces:
            yield frame(pieces)

    def frame(pieces: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(pieces, columns=columns)
        return out.astype({"sequence_id": "Int64", "item": "Int64"})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(task, CUT)


def place_items(items: DataFrame, packers: int, window: int, max_open: int) -> DataFrame:
    """Where the parts of ``items`` (``item, length``) go. A packer takes its items in order of their numbers."""
    columns = [part.split()[0] for part in PLACED.split(", ")]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, now, parts = None, None, []
        for batch in batches:
            for own, item, size in zip(batch["packer"].tolist(), batch["item"].tolist(), batch["length"].tolist()):
                if own != now:  # the next packer's stream begins
                    parts += packer.finish() if packer else []
                    packer, now = SumOfSquares(window, own * PER_TASK, max_open), own
                parts += packer.place(item, size)
            if len(parts) > 100_000:
                yield pd.DataFrame(parts, columns=columns)
                parts = []
        parts += packer.finish() if packer else []
        if parts:
            yield pd.DataFrame(parts, columns=columns)

    dealt = items.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(packers)).alias("packer"))
    return dealt.repartition(packers, "packer").sortWithinPartitions("packer", "item").mapInPandas(task, PLACED)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1,
         json_name: str = "byte_bpe_50k.json", ranks_name: str = "byte_bpe_50k.tiktoken",
         max_open: int = 1 << 18, packer_items: int = 200_000) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit integers), ``doc_tokens,
    sequence_id, offset, closed_by`` (whole, placement or levelling)."""
    small_batches(docs.sparkSession)
    cut = stored(cut_documents(docs, doc_id, text, window, end_id, json_name, ranks_name), "pack-cut")
    items = cut.filter("item is not null")
    packers = max(1, -(-items.count() // packer_items))
    places = stored(place_items(items, packers, window, max_open), "pack-places")
    laid = items.drop("sequence_id").withColumnRenamed("length", "whole").join(places, "item").select(
        "doc_id", (F.col("start") + F.col("part")).alias("start"), "length",
        F.expr("substring(ids, int(4 * part + 1), int(4 * length))").alias("ids"), "doc_tokens", "sequence_id", "offset", "closed_by")
    full = cut.filter("item is null").select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id",
                                             F.lit(0).cast("long").alias("offset"), F.lit("whole").alias("closed_by"))
    return full.unionByName(laid)


def closed_tokens(pieces: DataFrame) -> DataFrame:
    """``closed_by, sequences, tokens``: how many windows were closed in which way, and what they hold."""
    return pieces.groupBy("closed_by").agg(F.countDistinct("sequence_id").alias("sequences"), F.sum("length").alias("tokens"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
