"""Near-duplicate documents by ProbMinHash.

A document is its distinct shingles of five words (all its words, if fewer),
weighted by 1 or by how often they occur. Every shingle is a Poisson process of
rate its weight: hashes of the shingle give the exponential gaps between its
arrivals and the signature component that each arrival falls in. A component
holds the shingle that arrives first. Two documents agree in a component with
probability equal to their probability Jaccard similarity (plain Jaccard where
all weights are 1). Arrivals later than the last component's first one cannot
matter, so a shingle's process ends there.

Documents that agree in all rows of one of the bands are candidates. Of each
bucket, every member is verified on whole shingle sets against the one that
shares most buckets with others, its star; links are joined into components.
Members that are then in another component than a star of theirs are compared
with everything their buckets connect them to, in blocks of a matrix product
that return only links that join components. So no candidate pair is left
undecided, and no group of copies is written out in pairs.

With ``bands`` 28 of ``rows`` 4, a pair at similarity 0.8 is a candidate with
probability 1 - 4e-7.

Defined results: documents with the same words in order are one class from the
start; a document without words (null text included) is a class of its own, and
so is each row with a null id, whose class is null; rows that repeat an id are
judged by their own texts; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.blocks import compared
from wardflow.llm.components import connected_components
from wardflow.llm.scratch import small_batches, stored

_ODD = tuple((0x9E3779B97F4A7C15 * (2 * k + 1) | 1) % (1 << 64) for k in range(64))
#: Ids up to this many (at some 50 bytes, with the fingerprint) are sent to all executors; more are joined by a shuffle.
BROADCAST_IDS = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    limit = 400_000

    def __missing__(self, word: str) -> int:
        import xxhash
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < self.limit:
            self[word] = value
        return value


def shingles(words: list[str], hashes: WordHashes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and how often each occurs."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ids = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += mixed(ids[k:k + n] ^ np.uint64(_ODD[k])) * np.uint64(_ODD[k + 20])
    return np.unique(mixed(total), return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """Per component, the element that arrives first."""
    first = np.full(size, np.inf)
    holder = np.zeros(size, dtype=np.uint64)
    # As many arrivals at a time as fill the components in one go, mostly.
    block = max(1, math.ceil(1.5 * size * math.log(size) / max(1, len(elements))))
    now = np.zeros(len(elements))
    done = 0
    while len(elements):
        steps = np.arange(done, done + block, dtype=np.uint64) * np.uint64(_ODD[1])
        bits = mixed(elements[:, None] + mixed(steps)[None, :])
        gaps = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53) / weights[:, None]
        times = now[:, None] + np.cumsum(gaps, axis=1)
        slots = (mixed(bits ^ np.uint64(_ODD[2])) % np.uint64(size)).astype(np.intp)
        early = times < first.max()
        t, s = times[early], slots[early]
        np.minimum.at(first, s, t)
        won = first[s] == t
        holder[s[won]] = np.broadcast_to(elements[:, None], times.shape)[early][won]
        now = times[:, -1]
        going = now < first.max()  # early termination: what comes later can't be first anywhere
        elements, weights, now = elements[going], weights[going], now[going]
        done += block
    return holder


def band_keys(holder: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = holder.reshape(bands, rows)
    total = np.arange(bands, dtype=np.uint64) * np.uint64(_ODD[3])
    for k in range(rows):
        total = mixed(total + parts[:, k] * np.uint64(_ODD[k + 4]))
    return total.view(np.int64)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum over j of max(wa_j / wa_i, wb_j / wb_i)."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    ratio = x / y
    order = np.argsort(-ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    more_x = np.concatenate(([0.0], np.cumsum(x)))
    more_y = np.concatenate(([0.0], np.cumsum(y)))
    only_a, only_b = float(wa.sum()) - more_x[-1], float(wb.sum()) - more_y[-1]
    # Elements of a larger ratio than i's count by their weight in a, the others by that in b.
    larger = np.searchsorted(-ratio, -ratio, side="left")
    total = (only_a + more_x[larger]) / x + (only_b + more_y[-1] - more_y[larger]) / y
    return float((1.0 / total).sum())


def fingerprint(words: list[str]) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def _weights(counts: np.ndarray, weighting: str) -> np.ndarray:
    return counts.astype(float) if weighting == "count" else np.ones(len(counts))


def sketches(docs: DataFrame, width: int, bands: int, rows: int, weighting: str) -> DataFrame:
    """``doc_id``, fingerprint of the words (null without words) and band keys."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            prints, keys = [], []
            for body in batch["text"]:
                words = body.split() if isinstance(body, str) else []
                if words:
                    elements, counts = shingles(words, hashes, width)
                    prints.append(fingerprint(words))
                    keys.append(band_keys(signature(elements, _weights(counts, weighting), bands * rows), bands, rows))
                else:
                    prints.append(None)
                    keys.append([])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": prints, "keys": keys})

    return docs.select("doc_id", "text").mapInPandas(task, "doc_id long, fp binary, keys array<long>")


def shingle_sets(docs: DataFrame, width: int, weighting: str) -> DataFrame:
    """``node`` with its shingles and, as 32-bit floats, their weights; of ``docs`` (``node, fp, text``) the rows
    whose words have the fingerprint ``fp``."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for node, fp, body in zip(batch["node"], batch["fp"], batch["text"]):
                words = body.split()
                if fingerprint(words) == bytes(fp):
                    h, counts = shingles(words, hashes, width)
                    out.append((node, h.view(np.int64), _weights(counts, weighting).astype(np.float32)))
            yield pd.DataFrame(out, columns=["node", "h", "w"])

    return docs.select("node", "fp", "text").mapInPandas(task, "node long, h array<long>, w array<float>")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose probability Jaccard similarity reaches ``threshold``."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = [probability_jaccard(*row) >= threshold - 1e-9
                    for row in zip(batch["ha"], batch["wa"], batch["hb"], batch["wb"])]
            yield batch.loc[near, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("h").alias("ha"), F.col("w").alias("wa"))
    right = sets.select(F.col("node").alias("b"), F.col("h").alias("hb"), F.col("w").alias("wb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "wa", "hb", "wb").mapInPandas(
        task, "a long, b long")


def _indicators(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """0/1 matrices of both sides over the elements that occur more than once, some columns at a time."""
    sides = [*left, *right]
    sizes = [len(x) for x in sides]
    elements, column, times = np.unique(np.concatenate(sides), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    use = times[column] > 1
    row, column = np.repeat(np.arange(len(sides)), sizes)[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 8192
    for start in range(0, int((times > 1).sum()), width):
        part = slice(*np.searchsorted(column, (start, start + width)))
        matrix = np.zeros((len(sides), width), dtype=np.float32)
        matrix[row[part], column[part] - start] = 1
        yield matrix[:len(left)], matrix[len(left):]


def block_links(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float,
                unit: bool) -> Iterator[pd.DataFrame]:
    """Links between rows of different components, at least one of them apart, without those that join what is joined."""
    other = left if right is None else right
    common = np.zeros((len(left), len(other)), dtype=np.float64)
    for a, b in _indicators(list(left["h"]), [] if right is None else list(right["h"])):
        common += a @ (a if right is None else b).T
    sizes = left["h"].map(len).to_numpy()[:, None], other["h"].map(len).to_numpy()[None, :]
    # With unit weights the counts decide; with others, elements in common are needed to begin with.
    near = common / (sizes[0] + sizes[1] - common) >= threshold - 1e-9 if unit else common > 0
    ca, cb = left["c"].to_numpy(), other["c"].to_numpy()
    near &= (ca[:, None] != cb[None, :]) & (left["apart"].to_numpy()[:, None] | other["apart"].to_numpy()[None, :])
    if right is None:
        near = np.triu(near, 1)
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    links = []
    a, b = left["node"].to_numpy(), other["node"].to_numpy()
    for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
        x, y = find(ca[i]), find(cb[j])
        if x != y and (unit or probability_jaccard(left["h"].iloc[i], left["w"].iloc[i], other["h"].iloc[j],
                                                   other["w"].iloc[j]) >= threshold - 1e-9):
            root[x] = y
            links.append((a[i], b[j]))
    yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                    threshold: float = 0.8, bands: int = 28, rows: int = 4, weighting: str = "unit",
                    block: int = 512) -> DataFrame:
    """``doc_id``, ``class_id`` (the smallest id of its class) and ``kept``, one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    rows_in = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sk = stored(sketches(rows_in, width, bands, rows, weighting), "pmh-sketches")
    # A node is a text: its words' fingerprint, as a number.
    alike = sk.filter("fp is not null and doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"))
    texts = stored(alike.withColumn("node", F.xxhash64("fp")), "pmh-texts")
    member = texts.select("node", F.posexplode("keys").alias("band", "key"))
    bucket = member.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    member = stored(member.join(bucket, ["band", "key"]), "pmh-shared")
    # The star of a bucket is its member that shares most buckets with others.
    company = member.groupBy("node").agg(F.sum("n").alias("company"))
    star = member.join(company, "node").groupBy("band", "key").agg(
        F.max(F.struct("company", "node"))["node"].alias("star"))
    member = stored(member.join(star, ["band", "key"]).select("node", "star"), "pmh-buckets")

    # Shingle sets of the texts that share a bucket.
    wanted = texts.select("doc_id", "fp", "node").join(member.select("node").distinct(), "node")
    wanted = stored(wanted, "pmh-wanted")
    few = wanted.count() <= BROADCAST_IDS
    chosen = rows_in.filter("text is not null").join(F.broadcast(wanted) if few else wanted, "doc_id")
    sets = stored(shingle_sets(chosen, width, weighting).dropDuplicates(["node"]), "pmh-shingles")

    pairs = stored(member.filter("node <> star").select(F.col("node").alias("a"), F.col("star").alias("b")).distinct(),
                   "pmh-pairs")
    links = stored(verified(pairs, sets, threshold), "pmh-links")
    found = stored(connected_components(links, "pmh-1"), "pmh-components")

    # Members that a star of theirs doesn't reach are apart; they are compared with all that buckets connect them to.
    placed = (pairs.join(found.select(F.col("node").alias("a"), F.col("component").alias("c")), "a", "left")
              .join(found.select(F.col("node").alias("b"), F.col("component").alias("sc")), "b", "left"))
    apart = placed.filter(F.coalesce("c", "a") != F.coalesce("sc", "b")).select(F.col("a").alias("node")).distinct()
    apart = stored(apart.withColumn("apart", F.lit(True)), "pmh-apart")
    if not apart.isEmpty():
        clusters = stored(connected_components(pairs, "pmh-reach").withColumnRenamed("component", "cluster"), "pmh-clusters")
        open_ = clusters.join(apart, "node").select("cluster").distinct()
        rows = clusters.join(open_, "cluster", "left_semi").join(apart, "node", "left").join(found, "node", "left").select(
            "cluster", "node", F.coalesce("component", "node").alias("c"), F.coalesce("apart", F.lit(False)).alias("apart"))
        unit = weighting == "unit"
        more = compared(stored(rows, "pmh-open"), sets, "cluster", "node", block, "a long, b long",
                        lambda left, right: block_links(left, right, threshold, unit))
        found = connected_components(links.union(stored(more, "pmh-more-links")), "pmh-2")

    joined = texts.select("fp", "node", "doc_id").join(found, "node", "left").select(
        "fp", "doc_id", F.coalesce("component", "node").alias("component"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    classes = joined.select("fp", "component").join(least, "component").select("fp", "class_id")
    return sk.select("doc_id", "fp").join(classes, "fp", "left").select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")).withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("class_id")))
