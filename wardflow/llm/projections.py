"""Embedding near-duplicates by sorted projection passes.

In each pass a vector's key is the concatenation of ``bits`` random projection
signs, taken after the mean of its label was subtracted; all vectors of a label
are put in the order of that key, and each is compared with the ``window`` that
follow it. Vectors at a small angle share long key prefixes and so come close in
most passes. Pairs that reach the threshold are united across passes into
components.

The number of passes follows each label's size and closeness (``label_plans``):
from a sample of the label it is estimated how often one pass brings a pair at
the threshold within the window, and as many passes are made as leave at most
``1 - recall`` of such pairs apart, ``passes`` at least. A label for which that
costs as much as all its pairs is compared in full, in blocks.

The plan says only how much of the work is done by passes; the sample may know
nothing of a dense spot. What the passes did is judged for every vector by the
orders themselves (``open_nodes``): a vector whose links at the threshold they
may have missed with more than ``1 - recall`` is compared with its whole label.

The order of all passes is one range-partitioned sort. Rows get their global
rank from the sizes of the partitions, and blocks of ``block`` ranks, each with
the ``window`` rows that follow, are compared by a matrix product; a block
returns only the links that join something new.

A window is no cap on links: each component is afterwards compared in full,
in products of blocks, and only the number of links of each vector is returned.
A component of one block's size or less is one product; larger ones are dealt
into slots, and each pair of slots is a task of its own.

Defined results: equal vectors of a label are one node that counts as often as
it occurs; a null label or id, and a vector that is null, empty, zero, or holds
null or non-finite numbers, has no links and is its own component; vectors of
other lengths aren't compared; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.blocks import compared
from wardflow.llm.components import connected_components
from wardflow.llm.scratch import small_batches, stored

#: Tables of a row per label go to all executors up to this number of rows.
BROADCAST_LABELS = 20_000


def unit_rows(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def passes_needed(x: np.ndarray, n: int, threshold: float, window: int, bits: int, least: int, recall: float) -> int:
    """Passes that bring the share ``recall`` of the pairs at the threshold close, in a label of ``n`` vectors with
    the sample ``x`` (unit length). A value of ``n`` or more means that no such number is below ``n``.

    Two vectors share a sign with the probability 1 - angle / pi, after the mean is subtracted. A pair of one key
    prefix is close if those that share it are no more than a window; else by chance, window to their number. Where a
    vector has more links, each of them is a chance to join it to its component.
    """
    if n <= window + 1 or len(x) < 2:
        return least
    y = x - x.mean(axis=0)
    length = np.sqrt((y * y).sum(axis=1))
    y = y / np.maximum(length, 1e-12)[:, None]
    pair = pair_share(length, threshold)
    shared = 1 - np.arccos(np.clip(y @ y.T, -1, 1)) / np.pi
    np.fill_diagonal(shared, 0)
    links = ((x @ x.T >= threshold).sum(axis=1) - 1) * (n - 1) / (len(x) - 1)
    hit, prefix = np.zeros(len(x)), np.ones_like(shared)
    np.fill_diagonal(prefix, 0)
    for k in range(bits + 1):
        others = prefix.sum(axis=1) * (n - 1) / (len(x) - 1)
        hit = np.maximum(hit, pair ** k * np.minimum(1, window / np.maximum(others, 1e-300)))
        prefix *= shared
    gain = np.log1p(-np.minimum(hit, 1 - 1e-12)) * np.maximum(links, 1)
    low, high = least - 1, max(least, n)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if np.exp(middle * gain).mean() <= 1 - recall else (middle, high)
    return high


def label_plans(nodes: DataFrame, threshold: float, passes: int, window: int, bits: int, recall: float, sample: int,
                seed: int) -> DataFrame:
    """``label, dim, center, passes``: the mean of each label's unit vectors and its number of passes (0: compare all
    pairs), from some ``sample`` vectors of the label."""
    sizes = stored(nodes.groupBy("label", "dim").agg(F.count("*").alias("n")), "proj-sizes")
    drawn = nodes.select("node", "label", "dim", "v").join(_small(sizes), ["label", "dim"])
    drawn = drawn.filter(F.pmod(F.xxhash64("node", F.lit(seed)), F.col("n")) < sample)

    def plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x, n = unit_rows(rows.sort_values("node")["v"]), int(rows["n"].iloc[0])
        need = passes_needed(x, n, threshold, window, bits, passes, recall)
        all_pairs = need > passes and 2 * need * window >= n
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "center": [x.mean(axis=0)], "passes": [0 if all_pairs else need]})

    found = drawn.groupBy("label", "dim").applyInPandas(plan, "label string, dim int, center array<double>, passes int")
    zero = F.array_repeat(F.lit(0.0), F.col("dim"))  # no vector was drawn: possible in labels larger than the sample only
    found = sizes.select("label", "dim").join(found, ["label", "dim"], "left")
    return stored(found.select("label", "dim", F.coalesce("center", zero).alias("center"),
                               F.coalesce("passes", F.lit(passes)).alias("passes")), "proj-plans")


def _small(by_label: DataFrame) -> DataFrame:
    """Sent to all executors up to ``BROADCAST_LABELS`` rows, so that a large label's vectors stay where they are."""
    return F.broadcast(by_label) if by_label.count() <= BROADCAST_LABELS else by_label


def pair_share(length: np.ndarray, threshold: float) -> np.ndarray:
    """The probability that a pair at the threshold has the same sign in a random projection, by the length that is left of
    its unit vectors after the center was subtracted."""
    return 1 - np.arccos(np.clip(1 - (1 - threshold) / np.maximum(length, 1e-12) ** 2, -1, 1)) / np.pi


def shared_bits(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """How many of their first bits two keys have in common."""
    apart = a ^ b
    high, low = apart >> 30, apart & ((1 << 30) - 1)  # floats hold either of them exactly
    return bits - np.where(high > 0, 30 + np.frexp(high.astype(float))[1], np.frexp(low.astype(float))[1])


def _keys(nodes: DataFrame, bits: int, seed: int, threshold: float) -> DataFrame:
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = np.left_shift(np.int64(1), np.arange(bits - 1, -1, -1, dtype=np.int64))
        for batch in batches:
            for (dim, passes), part in batch.groupby(["dim", "passes"]):
                x = unit_rows(part["v"]) - np.stack(part["center"].to_list())
                keys = np.empty((len(part), passes), dtype=np.int64)
                for k in range(passes):
                    if (dim, k) not in planes:
                        planes[dim, k] = np.random.default_rng([seed, int(dim), k]).standard_normal((int(dim), bits))
                    keys[:, k] = (x @ planes[dim, k] >= 0) @ weights
                pair = pair_share(np.sqrt((x * x).sum(axis=1)), threshold)
                yield pd.DataFrame({"node": part["node"], "label": part["label"], "dim": dim, "pair": pair, "keys": list(keys)})

    return nodes.select("node", "label", "dim", "v", "center", "passes").mapInPandas(
        task, "node long, label string, dim int, pair double, keys array<long>")


def _window_links(rows: pd.DataFrame, window: int, threshold: float) -> list[tuple[int, int]]:
    """Links within the window in one run of rows, without those that join what is joined."""
    x, ids, n = unit_rows(rows["v"]), rows["node"].to_numpy(), len(rows)
    root = list(range(n))
    out = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for start in range(0, n, 256):
        end = min(n, start + 256)
        near = x[start:end] @ x[start:end + window].T >= threshold
        i, j = np.nonzero(near)
        fits = (j > i) & (j - i <= window)
        for p, q in zip((i[fits] + start).tolist(), (j[fits] + start).tolist()):
            a, b = find(p), find(q)
            if a != b:
                root[a] = b
                out.append((ids[p], ids[q]))
    return out


def all_links(nodes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links ``a, b`` that span those of all pairs of a label, in products of blocks."""

    def compare(left: pd.DataFrame, right: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
        rows = left if right is None else pd.concat([left, right])
        yield pd.DataFrame(_window_links(rows, len(rows), threshold), columns=["a", "b"], dtype="int64")

    members = nodes.select("node", F.xxhash64("label", "dim").alias("group"))
    return compared(members, nodes.select("node", "v"), "group", "node", block, "a long, b long", compare)


def pass_links(nodes: DataFrame, plans: DataFrame, threshold: float, window: int, block: int, bits: int,
               seed: int) -> DataFrame:
    """Verified links ``a, b`` that span what the passes find (``pass`` -1), and what each vector may miss: rows of a node
    ``a``, a ``pass`` and the logarithm ``miss`` of the probability that a link of it at the threshold isn't in its window.

    All that share more bits with a vector than the first one beyond its window, to either side, are inside the window.
    A side without any beyond it misses nothing, and has no row.
    """
    block = max(block, window + 2)  # a block and what follows it reach beyond its rows' windows
    order = ["pass", "label", "dim", "key", "node"]
    planned = nodes.select("node", "label", "dim", "v").join(_small(plans.filter("passes > 0")), ["label", "dim"])
    keys = _keys(planned, bits, seed, threshold).select("node", "label", "dim", "pair", F.posexplode("keys").alias("pass", "key"))
    ranked = keys.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, "pair", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mono"))
    ranked = stored(ranked, "proj-order")
    sizes = ranked.groupBy("part").agg(F.count("*").alias("n"))  # a row per partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("mono").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ranked.join(F.broadcast(offsets), "part").select(*order, "pair", rank.alias("rank"))
    home = F.floor(F.col("rank") / block)
    blocks = F.when((F.col("rank") % block <= window) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    dealt = ranked.withColumns({"home": home, "block": F.explode(blocks)}).join(nodes.select("node", "v"), "node")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank", kind="stable")
        out = []
        for (k, _, _), run in rows.groupby(["pass", "label", "dim"], sort=False):
            out.append(pd.DataFrame(_window_links(run, window, threshold), columns=["a", "b"], dtype="int64").assign(miss=0.0, **{"pass": -1}))
            at = np.flatnonzero((run["home"] == run["block"]).to_numpy()[:max(0, len(run) - window - 1)])
            key, pair, node = (run[c].to_numpy() for c in ("key", "pair", "node"))
            same = shared_bits(key[at], key[at + window + 1], bits)
            for i in (at, at + window + 1):
                hit = np.where(same < bits, np.maximum(pair[i], 0) ** (same + 1.0), 0)
                out.append(pd.DataFrame({"a": node[i], "b": node[i], "miss": np.log1p(-np.minimum(hit, 1 - 1e-12)), "pass": k}))
        return pd.concat(out)

    return dealt.groupBy("block").applyInPandas(compare, "a long, b long, miss double, pass int")


def open_nodes(nodes: DataFrame, plans: DataFrame, found: DataFrame, recall: float) -> DataFrame:
    """``node, label, dim`` of the vectors that may have been missed in all their passes with more than ``1 - recall``."""
    by_pass = found.filter("pass >= 0").groupBy("a", "pass").agg(F.max("miss").alias("miss"))
    missed = by_pass.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("seen"), F.sum("miss").alias("miss"))
    missed = missed.filter(F.col("miss") > math.log(max(1 - recall, 1e-300)))
    labelled = nodes.select("node", "label", "dim").join(missed, "node").join(_small(plans.select("label", "dim", "passes")), ["label", "dim"])
    return labelled.filter("seen = passes").select("node", "label", "dim")


def open_links(nodes: DataFrame, opened: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links ``a, b`` that span those of ``opened`` vectors with all of their labels: a block of either in a task."""
    slots = lambda n: F.greatest(F.ceil(F.col(n) / block), F.lit(1)).cast("long")
    opens = opened.groupBy("label", "dim").agg(F.count("*").alias("_opens"))
    sizes = nodes.join(_small(opens), ["label", "dim"]).groupBy("label", "dim").agg(F.count("*").alias("_n"), F.first("_opens").alias("_opens"))
    sizes = stored(sizes.select("label", "dim", slots("_opens").alias("_left"), slots("_n").alias("_right")), "proj-open-sizes")
    own = F.xxhash64("node", F.lit(1))

    def dealt(rows: DataFrame, mine: str, other: str, left: bool) -> DataFrame:
        rows = rows.select("node", "label", "dim", "v").join(_small(sizes), ["label", "dim"])
        rows = rows.withColumn(mine, F.pmod(own, F.col(mine)))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).withColumn("_open", F.lit(left))

    both = dealt(nodes.join(opened.select("node"), "node", "left_semi"), "_left", "_right", True).unionByName(
        dealt(nodes, "_right", "_left", False))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["_open"]], rows[~rows["_open"]]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["a", "b"], dtype="int64")
        a, b = left["node"].to_numpy(), right["node"].to_numpy()
        near = unit_rows(left["v"]) @ unit_rows(right["v"]).T >= threshold
        i, j = np.nonzero(near)
        return _spanning(zip(a[i].tolist(), b[j].tolist()))

    return both.groupBy("label", "dim", "_left", "_right").applyInPandas(lambda rows: compare(rows), "a long, b long")


def _spanning(pairs) -> pd.DataFrame:
    """The pairs without those that join what is joined."""
    root: dict[int, int] = {}
    out = []

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p, q in pairs:
        a, b = find(p), find(q)
        if a != b:
            root[a] = b
            out.append((p, q))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def found_links(nodes: DataFrame, threshold: float, passes: int, window: int, block: int, bits: int, recall: float,
                sample: int, seed: int) -> DataFrame:
    """Verified links ``a, b`` that span the components: of passes and of all pairs of what the passes may have missed, or of
    all pairs where passes cost as much."""
    plans = label_plans(nodes, threshold, passes, window, bits, recall, sample, seed)
    found = stored(pass_links(nodes, plans, threshold, window, block, bits, seed), "proj-found")
    links = found.filter("pass < 0").select("a", "b")
    opened = stored(open_nodes(nodes, plans, found, recall), "proj-open")
    if not opened.isEmpty():
        links = links.union(open_links(nodes, opened, threshold, block))
    whole = plans.filter("passes = 0").select("label", "dim")
    if whole.isEmpty():
        return links
    return links.union(all_links(nodes.join(_small(whole), ["label", "dim"]), threshold, block))


def link_counts(nodes: DataFrame, components: DataFrame, threshold: float, block: int) -> DataFrame:
    """``node, links``: how many vectors of its component, each as often as it occurs, reach the threshold with it."""

    def count(left: pd.DataFrame, right: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
        x = unit_rows(left["v"])
        near = x @ (x if right is None else unit_rows(right["v"])).T >= threshold
        if right is None:
            np.fill_diagonal(near, False)
            right = left
        else:
            yield pd.DataFrame({"node": right["node"], "links": left["copies"].to_numpy() @ near})
        yield pd.DataFrame({"node": left["node"], "links": near @ right["copies"].to_numpy()})

    found = compared(components, nodes.select("node", "v", "copies"), "component", "node", block, "node long, links long", count)
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def embedding_duplicates(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                         threshold: float = 0.98, passes: int = 10, window: int = 64, block: int = 1024,
                         bits: int = 60, seed: int = 20, recall: float = 0.995, sample: int = 1024) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``table``."""
    small_batches(table.sparkSession)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                        F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
              & finite & F.exists("v", lambda x: x != 0))
    rows = rows.select("vec_id", "label", "v", F.coalesce(usable, F.lit(False)).alias("usable"))
    node = F.xxhash64("label", "v").alias("node")
    nodes = rows.filter("usable").groupBy("label", "v").agg(F.min("vec_id").alias("first_id"),
                                                            F.count("*").alias("copies"))
    nodes = stored(nodes.select(node, "label", F.size("v").alias("dim"), "v", "first_id", "copies"), "proj-nodes")
    links = found_links(nodes, threshold, passes, window, block, bits, recall, sample, seed)
    components = stored(connected_components(links, "proj"), "proj-components")
    counts = link_counts(nodes, components, threshold, block)
    placed = nodes.select("node", "first_id", "copies").join(components, "node", "left").join(counts, "node", "left")
    placed = stored(placed.select("node", F.coalesce("component", "node").alias("component"), "first_id",
                                  (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "proj-placed")
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = placed.join(least, "component").select("node", "n_links", "component_id")
    out = rows.select("vec_id", F.when(F.col("usable"), F.xxhash64("label", "v")).alias("node")).join(placed, "node", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                     F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))
