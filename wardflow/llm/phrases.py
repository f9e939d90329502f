"""Phrase collocations from FM-indexes over word ids.

Each task cuts its documents into words and indexes shards of some million of
them: ids by order of first occurrence, a break (0) between pieces, and for the
rows of the text sorted by their next words the word *before* each (``prev``), for
those sorted by their earlier words the word *after* each (``next``). A phrase is
an interval of rows in either; the words before (after) an interval extend it to
the left (right), and what an extension does to one interval gives the other.

Phrases grow word by word: pairs by extending the intervals of single words to
the left, longer ones to the right. A round extends, in every shard, the
intervals whose phrase is frequent over all shards and whose extension starts
and ends with frequent phrases; a shuffle by (prefix, suffix) sums the shards'
counts, one entry per phrase and shard. So rare phrases end early, frequent words
are one entry per shard however often they occur, and no phrase is a string
before the last step. Indexes are written once, bucketed by shard, and meet the
phrases of a round without being shuffled. Entries travel as compressed columns
(``pack``): a shard's for one part of the phrases, or a part's for one shard.

Counts are exact: a shard holds whole documents, and every count of a frequent
phrase reaches the sum. Scores and comparisons use decimals.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count once each; an empty table gives no rows; other columns are not
read. Memory in a task: the index of one shard (``shard_words`` words, or the
document that passed that size).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.scratch import bucketed, small_batches, stored

#: A phrase's place: its shard times 2^28 plus the first row of its interval.
ROW_BITS = 28
SHARDS_PER_TASK = 1 << 12
BREAK = b"\xff"  # occurs in no UTF-8 text
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
BREAKS = b".,;:!?\n\x0b\x0c\r"
SHARD = "shard long, rows long, top long, prev binary, next binary, lang array<string>, word array<string>, n array<bigint>"
#: Packed columns for a part of the phrases, or for a shard.
PACKED = "part long, packed binary"
#: Of a part: its phrases (with their sums), and for each shard its entries of them (packed places, counts, ids).
COUNTED = "p long, s long, id long, total long, shard long, packed binary"


class Words(dict):
    """Ids of the words of one language; a new word takes the next id of ``names`` (and its language, by number, of
    ``langs``)."""

    def __init__(self, lang: int, langs: list[int], names: list[bytes]):
        super().__init__({BREAK: 0})
        self.lang, self.langs, self.names = lang, langs, names

    def __missing__(self, word: bytes) -> int:
        self.langs.append(self.lang)
        self.names.append(word)
        self[word] = len(self.names)
        return len(self.names)


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers, the first ascending, as bytes: differences of the first, bytes of a kind together, zstd."""
    rows = np.array(columns, dtype="<i8")
    rows[0, 1:] -= rows[0, :-1].copy()
    raw = np.ascontiguousarray(rows.view(np.uint8).reshape(*rows.shape, 8).transpose(0, 2, 1)).tobytes()
    return np.array(rows.shape, "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    c, n = np.frombuffer(packed[:16], "<i8").tolist()
    raw = np.frombuffer(pa.decompress(packed[16:], c * n * 8, codec="zstd", asbytes=True), np.uint8)
    rows = raw.reshape(c, 8, n).transpose(0, 2, 1).copy(order="C").view("<i8").reshape(c, n)
    rows[0] = np.cumsum(rows[0])
    return rows


def packed_parts(part: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """A row per value of ``part`` with its rows of ``columns``, in the order of these."""
    order = np.lexsort((*columns[::-1], part))
    part = part[order]
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    columns = [c[order] for c in columns]
    blobs = [pack([c[i:j] for c in columns]) for i, j in zip(first, [*first[1:], len(part)])]
    return pa.table([pa.array(part[first], pa.int64()), pa.array(blobs, pa.binary())], names=["part", "packed"])


def packed_by(key: str, names: list[str], rows_held: int = 1_000_000):
    """A task that packs its rows by ``key``, some ``rows_held`` at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows_held:
                yield from done(held)
                held, n = [], 0
        if held:
            yield from done(held)

    def done(held):
        table = pa.Table.from_batches(held)
        return packed_parts(*(lambda c: (c[0], c[1:]))([table[c].to_numpy() for c in [key, *names]])).to_batches()

    return task


def unpacked(packed) -> np.ndarray:
    """The columns of all rows of a packed column, one part after the other."""
    return np.concatenate([unpack(b.as_py()) for b in packed], axis=1)


def column_bytes(column: np.ndarray) -> bytes:
    return pa.compress(column.tobytes(), codec="zstd", asbytes=True)


def column_of(index: pa.Table, name: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(index[name][0].as_buffer(), index["rows"][0].as_py() * 4, codec="zstd"), np.int32)


def sorted_rows(columns: list[np.ndarray], top: int) -> np.ndarray:
    """Row numbers in the order of ``columns`` (values up to ``top``), packed into one key where they fit."""
    bits = int(top).bit_length()
    if bits * len(columns) > 63:
        return np.lexsort(columns[::-1])
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = (key << bits) | c
    return np.argsort(key, kind="stable")


def index_of(ids: np.ndarray, top: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``prev`` and ``next`` of a text of ids that starts and ends with a break, sorted to ``depth`` words."""
    n = len(ids)
    wide = np.concatenate([np.zeros(depth, ids.dtype), ids, np.zeros(depth, ids.dtype)])
    order = sorted_rows([wide[depth + k:depth + k + n] for k in range(depth)], top)
    prev = wide[depth - 1 + order]
    order = sorted_rows([wide[depth - k:depth - k + n] for k in range(depth)], top)
    return prev, wide[depth + 1 + order]


def starts_of(column: np.ndarray, top: int) -> np.ndarray:
    """The first row of each word's interval, and the end: the same in both orders."""
    return np.concatenate([[0], np.cumsum(np.bincount(column, minlength=top + 1))])


def extend(column: np.ndarray, lo: np.ndarray, size: np.ndarray, twin: np.ndarray, top: int):
    """Extend disjoint intervals by the words that ``column`` has in them.

    ``lo`` are their first rows in this order, ``twin`` in the other one. Returns which interval, the word, the count,
    and the new first rows in both orders.
    """
    n, offset = np.int64(len(column)), np.cumsum(size) - size
    which = np.repeat(np.arange(len(lo), dtype=np.int64), size)
    rows = np.repeat(lo - offset, size) + np.arange(int(size.sum()), dtype=np.int64)
    key = np.sort(which * (top + 1) + column[rows])
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    which, word = np.divmod(key[first], top + 1)
    new_twin = twin[which] + first - offset[which]  # words that come earlier in the interval stand before
    keep = word > 0
    which, word, count, new_twin = which[keep], word[keep], count[keep], new_twin[keep]
    occurrences = np.sort(column.astype(np.int64) * n + np.arange(n))
    return which, word, count, np.searchsorted(occurrences, word * n + lo[which]), new_twin


def inside(at: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each row the interval (sorted by ``lo``, disjoint) that holds it, -1 if none does."""
    k = np.searchsorted(lo, at, side="right") - 1
    return np.where((k >= 0) & (at < lo[np.maximum(k, 0)] + size[np.maximum(k, 0)]), k, -1) if len(lo) else np.full(len(at), -1)


def _shards(shard_words: int, depth: int):
    """A task: its documents' words as indexed shards."""

    def emit(shard, parts, langs, names, labels):
        ids = np.concatenate(parts)
        counts = np.bincount(ids, minlength=len(names) + 1)[1:]
        prev, after = map(column_bytes, index_of(ids, len(names), depth))
        words = pa.array(names, pa.binary()).cast(pa.string())
        tags = pa.DictionaryArray.from_arrays(pa.array(langs, pa.int32()), pa.array(labels, pa.string())).cast(pa.string())
        one = pa.array([0, len(names)], pa.int32())
        row = [pa.array([shard], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([len(names)], pa.int64()),
               pa.array([prev], pa.binary()), pa.array([after], pa.binary()),
               *[pa.ListArray.from_arrays(one, v) for v in (tags, words, pa.array(counts, pa.int64()))]]
        return pa.RecordBatch.from_arrays(row, [c.split()[0] for c in SHARD.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() * SHARDS_PER_TASK
        table = bytes.maketrans(UPPER + BREAKS, LOWER + BREAK * len(BREAKS))
        gap = np.zeros(1, np.int32)
        parts, held, langs, names, words = [gap], 0, [], [], {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if not text:
                    continue
                if lang not in words:
                    words[lang] = Words(len(words), langs, names)
                cut = text.translate(table).replace(BREAK, b" " + BREAK + b" ").split()
                parts += [np.fromiter(map(words[lang].__getitem__, cut), np.int32, len(cut)), gap]
                held += len(cut) + 1
                if held >= shard_words:
                    yield emit(shard, parts, langs, names, list(words))
                    shard += 1
                    parts, held, langs, names, words = [gap], 0, [], [], {}
        if held:
            yield emit(shard, parts, langs, names, list(words))

    return task


def _found(p, s, shard: int, at, n, parts: int) -> pa.Table:
    place = (shard << ROW_BITS) + np.asarray(at, np.int64)
    mixed = (p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (s.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    part = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(parts)
    return packed_parts(part.astype(np.int64), [p, s, place, n])


EMPTY = pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], names=["part", "packed"])


def _left(parts: int):
    """Pairs: the intervals of a shard's frequent words, extended to the left."""

    def pairs(key, index: pa.Table, words: pa.Table) -> pa.Table:
        if not len(index) or not len(words):
            return EMPTY
        column, top = column_of(index, "prev"), index["top"][0].as_py()
        starts = starts_of(column, top)
        place, word_ids = unpacked(words["packed"])
        local = place & ((1 << ROW_BITS) - 1)
        ids = np.full(top + 1, -1, np.int64)
        ids[local] = word_ids
        local = np.sort(local)
        which, word, count, _, after = extend(column, starts[local], starts[local + 1] - starts[local], starts[local], top)
        keep = ids[word] >= 0
        return _found(ids[word[keep]], ids[local[which[keep]]], key[0].as_py(), after[keep], count[keep], parts)

    return pairs


def _right(parts: int):
    """Longer phrases: the intervals of a shard's frequent phrases, extended to the right."""

    def longer(key, index: pa.Table, phrases: pa.Table) -> pa.Table:
        if not len(index) or not len(phrases):
            return EMPTY
        column = column_of(index, "next")
        place, size, ids = unpacked(phrases["packed"])
        order = np.argsort(place)
        lo, size, ids = (place & ((1 << ROW_BITS) - 1))[order], size[order], ids[order]
        which, _, count, new, _ = extend(column, lo, size, lo, index["top"][0].as_py())
        suffix = inside(new, lo, size)
        keep = suffix >= 0
        return _found(ids[which[keep]], ids[suffix[keep]], key[0].as_py(), new[keep], count[keep], parts)

    return longer


def _sums(min_count: int):
    """From the entries of one part of the phrases, those of phrases found ``min_count`` times in all. A phrase's id is its
    first place."""

    def sums(rows: pa.Table) -> pa.Table:
        p, s, at, n = unpacked(rows["packed"])
        order = np.lexsort((at, s, p))
        p, s, at, n = p[order], s[order], at[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])]))
        size = np.diff(np.append(first, len(p)))
        total = np.add.reduceat(n, first)
        often = total >= min_count
        keep = np.repeat(often, size)
        entries = packed_parts(at[keep] >> ROW_BITS, [at[keep], n[keep], np.repeat(at[first], size)[keep]])
        first, none = first[often], pa.nulls(len(entries), pa.int64())
        phrases = [p[first], s[first], at[first], total[often]]
        columns = [pa.chunked_array([pa.array(c), none]) for c in phrases]
        columns.append(pa.chunked_array([pa.nulls(len(first), pa.int64()), *entries["part"].chunks]))
        columns.append(pa.chunked_array([pa.nulls(len(first), pa.binary()), *entries["packed"].chunks]))
        return pa.table(columns, names=[c.split()[0] for c in COUNTED.split(", ")])

    return sums


def ngrams(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 30, max_words: int = 4,
           shard_words: int = 1 << 22, part_words: int = 1 << 20) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (``lang, n``), and for 1 to ``max_words`` words the phrases found ``min_count`` times or more:
    ``id, lang, words, total``, counts ``heads`` / ``tails`` of their first / last 1, 2, ... words, and from two words on
    the ids ``p`` and ``s`` of what is left without the last / first word. ``part_words`` bounds what one task sums: a part
    of the phrases has at most an entry for each of so many words, on average."""
    small_batches(docs.sparkSession)
    depth = max(max_words - 1, 1)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    index = bucketed(rows.mapInArrow(_shards(shard_words, depth), SHARD), "phrase-index", "shard")
    words = index.select("shard", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("local", "w"))
    words = words.select("w.lang", "w.word", "w.n", (F.shiftleft("shard", ROW_BITS) + F.col("local") + 1).alias("at"))
    sizes = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-words")
    same = Window.partitionBy("lang", "word")
    level = words.withColumns({"total": F.sum("n").over(same), "id": F.min("at").over(same)})
    level = stored(level.filter(F.col("total") >= min_count), "phrase-1")
    own = F.col("id") == F.col("at")
    total = F.array("total")
    found = [level.filter(own).select("id", "lang", F.array("word").alias("words"), "total", total.alias("heads"), total.alias("tails"))]
    parts = 1 + (index.agg(F.sum("rows")).first()[0] or 0) // part_words
    known = level.select(F.shiftright("at", ROW_BITS).alias("shard"), "at", "id").mapInArrow(packed_by("shard", ["at", "id"]), PACKED)
    known = known.withColumnRenamed("part", "shard")
    for size in range(2, max_words + 1):
        step, column = (_left(parts), "prev") if size == 2 else (_right(parts), "next")
        grown = (index.select("shard", "rows", "top", column).groupBy("shard")
                 .cogroup(known.groupBy("shard")).applyInArrow(step, PACKED))
        level = stored(grown.groupBy("part").applyInArrow(_sums(min_count), COUNTED), f"phrase-{size}")
        known = level.filter("shard is not null").select("shard", "packed")
        head = found[-1].select(F.col("id").alias("p"), "lang", "words", "heads")
        tail = found[-1].select(F.col("id").alias("s"), F.element_at("words", -1).alias("last"), "tails")
        both = level.filter("shard is null").select("id", "p", "s", "total").join(head, "p").join(tail, "s")
        found.append(stored(both.select("id", "p", "s", "lang", F.concat("words", F.array("last")).alias("words"), "total",
                                        F.concat("heads", total).alias("heads"), F.concat("tails", total).alias("tails")),
                            f"phrase-list-{size}"))
    return sizes, found


def _uncovered(phrases: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """``phrases`` without those that one word more keeps at ``percent`` of their count. (What stands inside a still longer
    phrase of such a count stands inside one of one word more, which is as frequent.)"""
    cover = longer.select(F.col("p").alias("id"), "total").union(longer.select("s", "total"))
    cover = cover.groupBy("id").agg(F.max("total").alias("cover"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    held = phrases.join(cover, "id", "left")
    return held.filter(F.col("cover").isNull() | (100 * wide("cover") < percent * wide("total"))).drop("cover")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 30, max_words: int = 4,
                 top: int = 2000, cover_percent: int = 80, scale: int = 2_000_000, salts: int = 64,
                 shard_words: int = 1 << 22, part_words: int = 1 << 20) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    sizes, found = ngrams(docs, text, lang, min_count, max_words, shard_words, part_words)
    parts = [_uncovered(p, found[k + 2], cover_percent) if k + 2 < len(found) else p for k, p in enumerate(found[1:])]
    rows = reduce(DataFrame.unionByName, parts)
    # Cut after k words: the first k words are among the heads, the rest among the tails.
    score = "cast(({scale} * cast(total as decimal(20,0))) div (cast({l} as decimal(20,0)) + {r}) as bigint)"
    cut = ("transform(sequence(1, size(words) - 1), k -> struct("
           + score.format(scale=scale, l="heads[k - 1]", r="tails[size(words) - k - 1]")
           + " as score, k, heads[k - 1] as l, tails[size(words) - k - 1] as r))")
    rows = rows.withColumn("cut", F.array_min(F.expr(cut)))
    rows = rows.select("lang", F.array_join("words", " ").alias("phrase"), F.col("total").alias("a"), "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # Each salt's first ones, then the first of those.
    near = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.join(sizes, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
