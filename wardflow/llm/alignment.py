"""Cross-tokenizer alignment and corpus-wide counts of linked id pairs.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B); byte
offsets where tokens of both end cut it into groups, and the tokens that end
there are linked. Neither vocabulary has tokens across a place between a character
that isn't white space and a blank, so the words cut there have ends and groups
that don't depend on their neighbours: a task encodes a word once, new words
one after the other as one text.

Counts of pairs: the first pass aligns the documents and writes each task's pairs
with their counts. The distinct pairs get a minimal perfect hash (levels of bits:
a key that is alone at its place of a level keeps it, the others go on; a key's
number is the count of bits before its own), with the keys themselves in an
array by number, so that a foreign pair is noticed. The tasks' counts become dense
vectors indexed by that hash, summed block by block up a tree. The second pass
aligns the documents again and looks the counts up.

The pairs don't grow with the corpus: two tokens that end together share their
last bytes, so one is the end of the other, and the vocabularies have a fixed
number of such pairs (``most_pairs`` computes it: some hundred thousand; ids
without text apart). So index and counts go to every task.

Defined results: a null or empty text, and one whose pieces don't give back a
blank and the text, has no tokens: zeros and an empty string. Repeated rows count
once each; an empty table gives no rows; other columns are not read. Memory in a
task: the words met (up to ``words_kept`` characters of them, then anew), the
pairs, one Arrow batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.packing import Encoder
from wardflow.llm.scratch import small_batches, stored

B_BITS = 32
MARK = "▁"
#: White space to some library, not to ``str.isspace``.
UNSURE = "\u180e\u200b\ufeff"
#: White space before a blank, in any library's sense; elsewhere a blank starts a word.
ODD = re.compile(r"[\s\x1c-\x1f\x85\u180e\u200b\ufeff] ")
WORD = re.compile(r"(?<![\s\x1c-\x1f\x85\u180e\u200b\ufeff])(?= )")
BLOCK = 4096  # slots of a count vector that travel together


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others in order
    from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_json: str, a_ranks: str, b_model: str):
        import json

        import public_tokenizers as files
        import sentencepiece
        self.encode_a = Encoder(a_json, a_ranks)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=files.path(b_model))
        self._mark = self._pieces.piece_to_id(MARK)
        letters = byte_characters()
        with open(files.path(a_json), encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        p = self._pieces
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(vocab.values()) + 1)], np.int64)
        self.b_bytes = {i: bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else
                        p.id_to_piece(i).replace(MARK, " ").encode() for i in range(p.get_piece_size())}
        self.b_sizes = np.array([len(self.b_bytes[i]) for i in range(p.get_piece_size())], np.int64)
        self.names = [str(i) for i in range(max(len(self.a_sizes), len(self.b_sizes)))]

    def align(self, word: str, groups: bool):
        """A word without the blank that it starts with, see ``align_all``. None if B's bytes aren't the word's."""
        text = " " + word
        b = self._pieces.encode(word, num_threads=1) if word else [self._mark]
        if b"".join([self.b_bytes[i] for i in b]) != text.encode():
            return None
        return self._linked([len(text.encode())], self.encode_a(text), b, groups)

    def align_all(self, words: list[str], groups: bool):
        """Words that end in a character that isn't white space, as one text: of each the numbers of A's and B's tokens and of
        linked pairs; all pairs; a string of groups for each word. None if B's bytes aren't the text's."""
        text = " " + " ".join(words)
        b = self._pieces.encode(text[1:], num_threads=1)
        if b"".join([self.b_bytes[i] for i in b]) != text.encode():
            return None
        return self._linked([len(w.encode()) + 1 for w in words], self.encode_a.fast(text), b, groups)

    def _linked(self, sizes: list[int], a: list[int], b: list[int], groups: bool):
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b, ends = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b]), np.cumsum(sizes)
        at_b = np.searchsorted(ends_b, ends_a)  # both end with the text
        at_a = np.flatnonzero(ends_b[at_b] == ends_a)
        at_b = at_b[at_a]
        keys = ids_a[at_a] << B_BITS | ids_b[at_b]
        upto = [np.searchsorted(x, ends, side="right") for x in (ends_a, ends_b, ends_a[at_a])]
        counts = np.array([np.diff(x, prepend=0) for x in upto])
        if not groups:
            return counts, keys, []
        names_a, names_b = [self.names[i] for i in a], [self.names[i] for i in b]
        at_a, at_b = (at_a + 1).tolist(), (at_b + 1).tolist()
        parts = [names_a[i] + "|" + names_b[j] if p - i == 1 and q - j == 1 else ",".join(names_a[i:p]) + "|" + ",".join(names_b[j:q])
                 for i, p, j, q in zip([0, *at_a], at_a, [0, *at_b], at_b)]
        first = [0, *upto[2].tolist()]
        return counts, keys, [parts[i] if j - i == 1 else ";".join(parts[i:j]) for i, j in zip(first, first[1:])]


def most_pairs(a_json: str = "byte_bpe_50k.json", a_ranks: str = "byte_bpe_50k.tiktoken", b_model: str = "piece_bpe_32k.model") -> int:
    """How many pairs of tokens have one that ends like the other: no corpus has more linked pairs."""
    v = Vocabularies(a_json, a_ranks, b_model)
    by_a, by_b = {}, {}
    for table, own in ((v.a_bytes, by_a), (v.b_bytes, by_b)):
        for t in table.values():
            own[t] = own.get(t, 0) + 1
    ends = lambda t: (t[k:] for k in range(len(t)))
    return (sum(n * by_b.get(e, 0) for t, n in by_a.items() for e in ends(t))
            + sum(n * by_a.get(e, 0) for t, n in by_b.items() for e in ends(t) if e != t))


class Numbers(dict):
    """Words to numbers; a new word takes the next one and is listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTable:
    """The words met, aligned once each: ``n_a``, ``n_b``, ``keys`` of all words in a row (``n_keys`` of each), ``groups``, and
    ``bad``: words whose bytes B doesn't give back."""

    def __init__(self, names: tuple[str, str, str], groups: bool):
        self._vocabularies, self._with_groups = Vocabularies(*names), groups
        self.clear()

    def clear(self) -> None:
        self._numbers, self.held = Numbers(), 0
        self.n_a, self.n_b, self.n_keys, self.keys = (np.zeros(0, np.int64) for _ in range(4))
        self.bad = np.zeros(0, bool)
        self.groups: list[str] = []

    def numbers(self, texts: list) -> list[np.ndarray | None]:
        """The words of each text, by their numbers here; None for a text without tokens."""
        known, out = self._numbers, []
        for text in texts:
            words = self._words(text) if isinstance(text, str) and text else None
            out.append(None if words is None else np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        new, known.new = known.new, []
        self._add(new)
        return [None if words is None or self.bad[words].any() else words for words in out]

    def _add(self, words: list[str], most: int = 20_000) -> None:
        """Align new words, neighbours of one kind together, some ``most`` characters at a time."""
        found, part, held = [], [], 0
        for word in words:
            if 0 < len(word) < 500 and not word[-1].isspace() and word[-1] not in UNSURE:
                part.append(word)
                held += len(word) + 1
                if held < most:
                    continue
                word = None
            if part:
                found += self._aligned(part)
                part, held = [], 0
            if word is not None:
                found += self._one(word)
        if part:
            found += self._aligned(part)
        self.held += sum(map(len, words)) + 8 * len(words)
        if found:
            counts = np.concatenate([f[0] for f in found], axis=1)
            self.n_a, self.n_b, self.n_keys = (np.append(x, y) for x, y in zip((self.n_a, self.n_b, self.n_keys), counts))
            self.keys = np.concatenate([self.keys, *[f[1] for f in found]])
            self.bad = np.append(self.bad, counts[2] == 0)
            for f in found:
                self.groups += f[2]

    def _aligned(self, words: list[str]) -> list[tuple]:
        found = self._vocabularies.align_all(words, self._with_groups)
        return [found] if found else [x for w in words for x in self._one(w)]

    def _one(self, word: str) -> list[tuple]:
        found = self._vocabularies.align(word, self._with_groups)
        return [found or (np.zeros((3, 1), np.int64), np.zeros(0, np.int64), [""] if self._with_groups else [])]

    @staticmethod
    def _words(text: str) -> list[str]:
        wide = " " + text
        return [w[1:] for w in WORD.split(wide) if w] if ODD.search(wide) else text.split(" ")


def portions(texts, most: int = 1_000_000) -> Iterator[list]:
    """Neighbouring texts, of some ``most`` characters together."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t) if isinstance(t, str) else 0
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of each key (finalizer of a multiply-and-shift hash)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2 ** 64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct keys: 0 to n - 1, each once. ``numbers`` verifies its keys."""

    def __init__(self, keys: np.ndarray, spare: float = 2.0):
        self.size, self.levels, left = len(keys), [], np.asarray(keys, np.int64)
        while len(left):
            width = max(64, int(spare * len(left)))
            place = (_mixed(left, len(self.levels)) % np.uint64(width)).astype(np.int64)
            alone = np.bincount(place, minlength=width) == 1
            self.levels.append(alone)
            left = left[~alone[place]]
        before, self.ranks = 0, []
        for bits in self.levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())
        self.keys = np.zeros(self.size, np.int64)
        self.keys[self._place(np.asarray(keys, np.int64))] = keys

    def _place(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            place = (_mixed(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[todo[hit]] = ranks[place[hit]]
            todo = todo[~hit]
        return out

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 for a key that isn't one of those hashed."""
        keys = np.asarray(keys, np.int64)
        out = self._place(keys)
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)


NAMES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")


def linked_pairs(docs: DataFrame, text: str = "text", names: tuple[str, str, str] = NAMES, words_kept: int = 20_000_000) -> DataFrame:
    """The first pass: ``key`` (A's id times 2^32, plus B's) and ``n``, a row per pair and task, or more."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, seen = WordTable(names, False), np.zeros(0, np.int64)

        def rows() -> pd.DataFrame:
            weights = np.append(seen, np.zeros(len(table.n_keys) - len(seen), np.int64))
            keys, at = np.unique(table.keys, return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, at, np.repeat(weights, table.n_keys))
            return pd.DataFrame({"key": keys[n > 0], "n": n[n > 0]})

        for batch in batches:
            for texts in portions(batch["text"]):
                found = [words for words in table.numbers(texts) if words is not None]
                seen = np.append(seen, np.zeros(len(table.n_keys) - len(seen), np.int64))
                seen += np.bincount(np.concatenate([np.zeros(0, np.int64), *found]), minlength=len(seen))
                if table.held > words_kept:
                    yield rows()
                    table.clear()
                    seen = np.zeros(0, np.int64)
        yield rows()

    small_batches(docs.sparkSession)
    return docs.select(F.col(text).alias("text")).mapInPandas(task, "key long, n long")


def summed(pairs: DataFrame, index, fan: int = 16) -> DataFrame:
    """``block, counts``: the counts of ``pairs`` as one dense vector (64-bit, little-endian) indexed by the broadcast hash,
    in blocks. Each task fills a vector; ``fan`` branches of the tree add up theirs, then the blocks of all branches."""

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        hashed, branch = index.value, TaskContext.get().partitionId() % fan
        vector = np.zeros(-(-max(hashed.size, 1) // BLOCK) * BLOCK, np.int64)
        for batch in batches:
            at = hashed.numbers(batch["key"].to_numpy())
            if (at < 0).any():
                raise ValueError("a pair that wasn't hashed: the documents changed between two reads")
            np.add.at(vector, at, batch["n"].to_numpy())
        blocks = vector.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pd.DataFrame({"block": used, "branch": branch, "counts": [blocks[k].tobytes() for k in used]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, "<i8") for c in rows["counts"]], axis=0)
        return pd.DataFrame({"block": rows["block"].iloc[:1], "branch": 0, "counts": [total.tobytes()]})

    schema = "block long, branch long, counts binary"
    branches = pairs.mapInPandas(dense, schema).groupBy("block", "branch").applyInPandas(add, schema)
    return branches.groupBy("block").applyInPandas(add, schema).select("block", "counts")


class PairCounts:
    """The index with its count vector and, by number, whether no pair of the same B id has more."""

    def __init__(self, index: PerfectHash, counts: np.ndarray):
        self.index, self.counts = index, counts
        b = index.keys & ((1 << B_BITS) - 1)
        most = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
        np.maximum.at(most, b, counts)
        self.best = counts == most[b]


def pair_counts(docs: DataFrame, text: str = "text", names: tuple[str, str, str] = NAMES, words_kept: int = 20_000_000) -> PairCounts:
    """The counts of all linked pairs. What reaches the driver are the distinct pairs, bounded by the vocabularies."""
    spark = docs.sparkSession
    pairs = stored(linked_pairs(docs, text, names, words_kept), "alignment-pairs")
    keys = pairs.select("key").distinct().toPandas()["key"].to_numpy()
    index = PerfectHash(np.sort(keys))
    shared = spark.sparkContext.broadcast(index)
    counts = np.zeros(-(-max(index.size, 1) // BLOCK) * BLOCK, np.int64)
    for row in summed(pairs, shared).collect():
        counts[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], "<i8")
    return PairCounts(index, counts[:index.size])


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", names: tuple[str, str, str] = NAMES,
            words_kept: int = 20_000_000, digest: bool = False) -> DataFrame:
    """Per row of ``docs``: numbers of tokens, groups and links, the links whose count is their B id's highest, the sum of
    the links' counts, and ``groups``: ids of A and B as ``a1,a2|b1;a3|b2,b3`` (or, with ``digest``, their SHA-256)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pair_counts(docs, text, names, words_kept))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted, table = shared.value, WordTable(names, True)
        sums = np.zeros((4, 0), np.int64)  # of each word: tokens, links of the highest count, counts

        def look_up() -> np.ndarray:
            """The sums of the words that are new in the table."""
            done = sums.shape[1]
            lengths = table.n_keys[done:]
            if not len(lengths):
                return sums
            at = counted.index.numbers(table.keys[len(table.keys) - int(lengths.sum()):])
            if (at < 0).any():  # a word of a text without tokens can hold a pair that wasn't counted
                best, n = np.where(at < 0, 0, counted.best[at]), np.where(at < 0, 0, counted.counts[at])
            else:
                best, n = counted.best[at], counted.counts[at]
            sum_of = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[np.concatenate([[0], np.cumsum(lengths)])])
            new = [table.n_a[done:], table.n_b[done:], sum_of(best), sum_of(n)]
            return np.concatenate([sums, np.array(new)], axis=1)

        for batch in batches:
            rows = []
            for texts in portions(batch["text"]):
                found = table.numbers(texts)
                sums = look_up()
                for words in found:
                    if words is None:
                        rows.append((0, 0, 0, 0, 0, 0, ""))
                        continue
                    n_a, n_b, n_best, total = sums[:, words].sum(axis=1).tolist()
                    n_links = int(table.n_keys[words].sum())
                    groups = ";".join(map(table.groups.__getitem__, words.tolist()))
                    groups = hashlib.sha256(groups.encode()).hexdigest() if digest else groups
                    rows.append((n_a, n_b, n_links, n_links, n_best, total, groups))
                if table.held > words_kept:
                    table.clear()
                    sums = np.zeros((4, 0), np.int64)
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in ALIGNED.split(", ")[1:]])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
            yield out

    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(task, ALIGNED)
