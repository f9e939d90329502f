"""Language by prediction by partial matching.

For each language, byte contexts of up to ``order`` bytes are counted with the
bytes that follow. A text's code length under a language is the sum over its
bytes of -log2 of their probability in the longest known context: the share
n/(n+d) of a seen byte (n occurrences of d different bytes), and for an unseen
one the escape probability d/(n+d) times its share among the unseen ones in the
context one byte shorter, down to all 256 bytes alike. Probabilities of a
context sum to one, counts are frozen after training, and the language with the
shortest code wins; the score is its share of 2^-length.

Training counts come from a bounded sample, about ``rows_per_language`` labelled
rows of each language, chosen by a hash of their id; Spark counts them. The
model is the ``max_contexts`` most frequent contexts (fewer if there are many
languages: ``max_cells`` table cells at most), so its size doesn't grow with the
corpus. Every text is then scored whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text when no row is labelled; ties go to the language first in
order; repeated rows are predicted alike; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import small_batches, stored

PAD = 10  # before its first byte, a text is taken to have line ends
UNKNOWN = "und"
MOST_LANGUAGES = 500
CHUNK = 1 << 20


def context_codes(data: np.ndarray, order: int) -> np.ndarray:
    """Per byte, the ``order`` bytes before it as a number, the nearest lowest."""
    padded = np.concatenate((np.full(order, PAD, np.uint8), data)).astype(np.int64)
    codes = np.zeros(len(data), dtype=np.int64)
    for k in range(1, order + 1):
        codes |= padded[order - k:order - k + len(data)] << (8 * (k - 1))
    return codes


def context_counts(docs: DataFrame, order: int) -> DataFrame:
    """``lang, depth, context, byte, n`` over the texts of ``docs`` (``lang, text``)."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                data = [np.frombuffer(t.encode(), np.uint8) for t in part["text"]]
                for depth in range(order + 1):
                    codes = np.concatenate([context_codes(d, depth) << 8 | d for d in data])
                    codes, n = np.unique(codes, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "depth": depth, "context": codes >> 8, "byte": codes & 255, "n": n})

    rows = docs.select("lang", "text").mapInPandas(task, "lang string, depth int, context long, byte int, n long")
    return rows.groupBy("lang", "depth", "context", "byte").agg(F.sum("n").alias("n"))


class ContextTrees:
    """All languages' trees over the union of their contexts.

    ``steps[node, byte]`` is the context one byte longer to the left, or the
    node's stopped twin (number + ``size``) if that isn't known; ``costs[node *
    256 + byte]`` has the code length of the byte under each language, in bits.
    """

    def __init__(self, languages: list[str], order: int, size: int, steps: np.ndarray, costs: np.ndarray):
        self.languages, self.order, self.size, self.steps, self.costs = languages, order, size, steps, costs

    def parts(self) -> tuple:
        """What the constructor takes; plain enough for a broadcast."""
        return self.languages, self.order, self.size, self.steps, self.costs

    @classmethod
    def built(cls, languages: list[str], counts: pd.DataFrame, order: int) -> ContextTrees:
        keys = sorted({(0, 0), *zip(counts["depth"].tolist(), counts["context"].tolist())})
        node = {key: i for i, key in enumerate(keys)}
        size = len(keys)
        seen = np.zeros((size, len(languages), 256))
        at = counts[["depth", "context"]].apply(tuple, axis=1).map(node).to_numpy(dtype=int)
        who = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)
        np.add.at(seen, (at, who, counts["byte"].to_numpy(dtype=int)), counts["n"].to_numpy())
        probability = np.empty_like(seen)
        stopped = np.arange(size, 2 * size, dtype=np.int32)
        steps = np.repeat(np.concatenate((stopped, stopped))[:, None], 256, axis=1)
        for i, (depth, context) in enumerate(keys):
            shorter = np.full((len(languages), 256), 1 / 256)
            if depth:
                newest = context & ((1 << 8 * (depth - 1)) - 1)
                parent = node[depth - 1, newest]
                shorter = probability[parent]
                steps[parent, context >> 8 * (depth - 1)] = i
            probability[i] = cls.blended(seen[i], shorter)
        costs = -np.log2(probability).transpose(0, 2, 1).reshape(-1, len(languages))
        return cls(languages, order, size, steps, np.ascontiguousarray(costs, dtype=np.float32))

    @staticmethod
    def blended(seen: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Per language, byte probabilities: seen ones by their share, the escape shared out among the rest."""
        n, d = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        rest = np.where(seen > 0, 0, shorter)
        left = rest.sum(axis=1, keepdims=True)
        d = np.where(left > 0, d, 0)  # nothing to escape to
        mixed = seen / np.maximum(n + d, 1) + d / np.maximum(n + d, 1) * rest / np.where(left > 0, left, 1)
        return np.where(n > 0, mixed, shorter)

    def lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code lengths of the texts that begin at ``starts`` in ``data``, each after ``order`` pad bytes."""
        n = len(data) - self.order
        flat, node = self.steps.ravel(), np.zeros(n, dtype=np.int64)
        for k in range(1, self.order + 1):
            node = flat[node * 256 + data[self.order - k:self.order - k + n]].astype(np.int64)
        node -= self.size * (node >= self.size)
        bits = self.costs[node * 256 + data[self.order:]]
        return np.add.reduceat(bits, starts, axis=0, dtype=np.float64)

    def text_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths per text and language; long texts in slices that begin with the bytes before them."""
        out = np.zeros((len(texts), len(self.languages)))
        pad = bytes([PAD]) * self.order
        pieces, owner, held = [], [], 0

        def flush() -> None:
            nonlocal pieces, owner, held
            # Each piece brings ``order`` bytes of context, whose own costs are left out.
            data = np.frombuffer(pad + b"".join(pieces), np.uint8)
            sizes = np.array([len(p) for p in pieces])
            ends = np.cumsum(sizes)
            bounds = np.stack((ends - sizes, ends - sizes + self.order), axis=1).ravel()
            got = self.lengths(data, bounds)[1::2]
            np.add.at(out, owner, got)
            pieces, owner, held = [], [], 0

        for i, text in enumerate(texts):
            for start in range(0, len(text), CHUNK):
                before = text[max(0, start - self.order):start]
                pieces.append(pad[len(before):] + before + text[start:start + CHUNK])
                owner.append(i)
                held += len(pieces[-1])
                if held >= CHUNK:
                    flush()
        if pieces:
            flush()
        return out


def learn(docs: DataFrame, order: int, rows_per_language: int, max_contexts: int, max_cells: int,
          seed: int) -> ContextTrees | None:
    """Trees from a sample of ``docs`` (``doc_id, text, lang``); None if nothing is labelled."""
    rows = docs.filter("lang is not null and text is not null and text != ''")
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(known)
    if not languages:
        return None
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MOST_LANGUAGES} can be told apart")
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows_per_language / known[lang]))])
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.filter(hashed < share[F.col("lang")]).select("lang", "text")
    counts = stored(context_counts(sample, order), "ppm-counts")
    most = max(1, min(max_contexts, max_cells // (256 * len(languages))))
    # A context occurs at most as often as its shorter ones, which come first in this order.
    best = counts.groupBy("depth", "context").agg(F.sum("n").alias("total")).orderBy(
        F.desc("total"), "depth", "context").limit(most).select("depth", "context")
    return ContextTrees.built(languages, counts.join(F.broadcast(best), ["depth", "context"]).toPandas(), order)


def predict(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            order: int = 5, rows_per_language: int = 500, max_contexts: int = 6000, max_cells: int = 8_000_000,
            seed: int = 3) -> DataFrame:
    """``doc_id, lang_pred, score`` of every text; learns from the rows that ``training`` holds for."""
    spark = docs.sparkSession
    small_batches(spark)
    trees = learn(docs.filter(training).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                                               F.col(lang).alias("lang")),
                  order, rows_per_language, max_contexts, max_cells, seed)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if trees is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    model = spark.sparkContext.broadcast(trees.parts())

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = ContextTrees(*model.value)
        names = np.array([*trees.languages, UNKNOWN], dtype=object)
        for batch in batches:
            letters = batch["letters"].to_numpy(dtype=bool)
            bits = trees.text_lengths([t.encode() if ok else b"" for t, ok in zip(batch["text"], letters)])
            best = bits.argmin(axis=1)
            odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names[np.where(letters, best, -1)],
                                "score": np.where(letters, 1 / odds, 0.0)})

    return rows.mapInPandas(task, "doc_id long, lang_pred string, score double")
