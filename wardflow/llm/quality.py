"""Quality rules: fixed base rules, then robust multivariate outliers.

Per language and source, a minimum-covariance-determinant estimate of location
and scatter is made over transformed text statistics; documents far from it in
Mahalanobis distance are rejected. DataFrame functions only.

An estimate has two deterministic starts: medians and median deviations, and mean
and covariance of all rows. Each takes concentration steps (distances, the share
``keep_share`` of a group's rows with the smallest ones, mean and covariance of
those) until no group's determinant falls any more; the start that ends at the
lesser determinant is the group's estimate. There is one for each language and
source, for each language and for all rows. A language's is shrunk towards that of
all rows and a language and source's towards its language's, with the weight of
``shrink_rows`` rows: so every document has a verdict, a large group's estimate is
its own, and a small one's mostly its language's. Each document's distance
has floors from its own length under the spread of repeated lines and words.

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources are groups of their own; repeated rows are judged
once each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored

SPACE, NOT_SPACE = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("x0", "x1", "x2", "x3", "x4")
#: Rows of a group are spread over so many tasks when joined.
SALTS = 64
#: Least standard deviation of each transformed statistic in a group: what is nearly constant there doesn't reject.
FLOORS = (0.5, 0.5, 0.05, 0.02, 0.02)
#: Each document's own floors for x3 and x4, see ``_own_floors``.
OWN = {3: "f3", 4: "f4"}


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple = ()) -> DataFrame:
    """``doc_id``, the five statistics, ``n_lines`` and the columns in ``carry``, one row per document."""
    empty = F.array().cast("array<bigint>")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry,
                       F.array_remove(F.split(body, SPACE), "").alias("w"),
                       F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
                       F.length(F.regexp_replace(body, NOT_SYMBOL, "")).cast("long").alias("n_symbols"))
    rows = rows.select("doc_id", *carry, "n_symbols", "w",
                       F.size("w").cast("long").alias("n_words"),
                       F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                       F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    keep = ["doc_id", *carry, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # The hash of the three words from each position on; in texts with equal windows, the
    # hashes are sorted with their positions and neighbours compared.
    window = F.transform(F.sequence(F.lit(0), F.size("w") - 3),
                         lambda i: F.xxhash64(F.col("w")[i], F.col("w")[i + 1], F.col("w")[i + 2]))
    rows = rows.select(*keep, F.when(F.col("n_words") >= 3, window).otherwise(empty).alias("h"))
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.select(*keep, F.when(F.size(F.array_distinct("h")) < F.size("h"), placed).alias("s"))
    again = F.transform("s", lambda x, i: F.when(
        ((i > 0) & (F.get("s", i - 1)["h"] == x["h"])) | ((i < F.size("s") - 1) & (F.get("s", i + 1)["h"] == x["h"])),
        x["i"]))
    rows = rows.select(*keep, F.when(F.col("s").isNotNull(), F.filter(again, lambda i: i.isNotNull())).alias("p"))
    covered = F.array_distinct(F.concat("p", F.transform("p", lambda i: i + 1), F.transform("p", lambda i: i + 2)))
    return rows.select(*keep, F.when(F.col("p").isNotNull(), F.size(covered)).otherwise(0).cast("long")
                       .alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _features() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [F.log1p("n_words"), F.col("word_chars") / words, F.sqrt(F.col("n_symbols") / chars),
            F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / words)]


def _own_floors() -> list[Column]:
    """A third of what one repeated line changes in x3 and x4 of a document of this length: one line of a group without
    any adds 9 to the squared distance by its share of the lines and 9 by that of the words (both its copies), and
    three reject. A window is six words. In x4 at most what lets 40 % repeated words reject alone."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    line = F.when(F.col("n_lines") > 1, 2 * words / lines).otherwise(F.lit(0.0))
    return [F.sqrt(1 / lines) / 3, F.sqrt(F.least(F.greatest(line, F.lit(6.0)) / words / 9, F.lit(0.4 / 25)))]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _moments(rows: DataFrame) -> DataFrame:
    """Per group: mean and covariance (lower triangle) of the rows given, with the floors added."""
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(FEATURES)]
    sums += [F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}{j}") for i, j in _pairs()]
    out = rows.groupBy("g").agg(*sums)
    return out.select("g", *[f"m{i}" for i in range(len(FEATURES))], *[
        (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (FLOORS[i] ** 2 if i == j else 0)).alias(f"c{i}{j}")
        for i, j in _pairs()])


def _cholesky(groups: DataFrame) -> DataFrame:
    """The lower-triangular factor of each group's covariance, column after column; the last two of the covariance
    itself are kept, for documents with floors of their own."""
    n = len(FEATURES)
    for j in range(n):
        inner = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        groups = groups.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - inner, F.lit(FLOORS[j] ** 2 / 4))))
        groups = groups.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum(
            (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
            for i in range(j + 1, n)})
    return groups.select("g", *[f"m{i}" for i in range(n)], *[f"l{i}{j}" for i, j in _pairs()],
                         *[f"c{i}{j}" for i in OWN for j in OWN if j <= i])


def _with_own_floors(rows: DataFrame) -> DataFrame:
    """The last factors of each row's covariance, with the row's own floors added to it."""
    for j, floor in OWN.items():
        inner = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        spread = F.greatest(F.col(f"c{j}{j}") - inner, F.lit(FLOORS[j] ** 2 / 4))
        rows = rows.withColumn(f"l{j}{j}", F.sqrt(spread + F.col(floor) ** 2))
        rows = rows.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum(
            (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
            for i in OWN if i > j})
    return rows


def _spread(groups: DataFrame) -> DataFrame:
    """A row per group and salt: rows of a large group meet their estimate in many tasks."""
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _distances(rows: DataFrame, groups: DataFrame, own_floors: bool = False) -> DataFrame:
    """``rows`` with ``d``, the squared Mahalanobis distance to the estimate of their group (null without one)."""
    kept = rows.columns
    out = rows.join(_spread(_cholesky(groups)), ["g", "salt"], "left")
    out = _with_own_floors(out) if own_floors else out
    for i in range(len(FEATURES)):
        inner = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", (F.col(FEATURES[i]) - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    return out.select(*kept, sum((F.col(f"z{i}") ** 2 for i in range(len(FEATURES))), F.lit(0.0)).alias("d"))


def _first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and squared median deviations as a diagonal covariance."""
    median = rows.groupBy("g").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(FEATURES)])
    spread = rows.join(_spread(median), ["g", "salt"]).groupBy("g").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(FEATURES))],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 1000).alias(f"s{i}") for i, x in enumerate(FEATURES)])
    return spread.select("g", *[f"m{i}" for i in range(len(FEATURES))], *[
        ((1.4826 * F.col(f"s{i}")) ** 2 + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i, j in _pairs()])


def _determined(groups: DataFrame) -> DataFrame:
    """``groups`` with ``det``, the logarithm of the covariance's determinant."""
    dets = _cholesky(groups).select("g", sum((2 * F.log(f"l{i}{i}") for i in range(len(FEATURES))), F.lit(0.0)).alias("det"))
    return groups.join(dets, "g")


def concentrated(rows: DataFrame, start: DataFrame, keep_share: float, most_steps: int, settled: float = 1e-3) -> DataFrame:
    """Per group the estimate after concentration steps from ``start``, until no determinant changes by more than ``settled``
    (as a logarithm) or ``most_steps`` are taken, with that logarithm ``det``. One number a step reaches the driver."""
    now = stored(start.withColumn("det", F.lit(float("inf"))), "mcd-start")
    for k in range(most_steps):
        near = _distances(rows, now)
        cut = near.groupBy("g").agg(F.percentile_approx("d", keep_share, 1000).alias("cut"))
        before, found = now, _moments(near.join(_spread(cut), ["g", "salt"]).filter("d <= cut"))
        now = stored(_determined(stored(found, "mcd-moments")), f"mcd-{k}")
        fell = now.join(before.select("g", F.col("det").alias("was")), "g").agg(F.max(F.abs(F.col("was") - F.col("det")))).first()[0]
        if fell is None or fell <= settled:
            break
    return now


def estimates(rows: DataFrame, keep_share: float, most_steps: int) -> DataFrame:
    """Per group ``g``: the minimum-covariance-determinant estimate, the lesser of two starts, and ``n`` rows."""
    starts = F.explode(F.array(F.lit("a"), F.lit("b")))
    both = rows.withColumn("start", starts).withColumn("g", F.concat("start", "g")).drop("start")
    named = lambda df, name: df.withColumn("g", F.concat(F.lit(name), "g"))
    start = named(_first_estimate(rows), "a").unionByName(named(_moments(rows), "b"))
    found = concentrated(both, start, keep_share, most_steps)
    best = found.groupBy(F.substring("g", 2, 1 << 30).alias("g")).agg(F.min_by(F.struct(*_values(), "det"), "det").alias("e"))
    return best.select("g", "e.*").join(rows.groupBy("g").agg(F.count("*").alias("n")), "g")


def _values() -> list[str]:
    return [*[f"m{i}" for i in range(len(FEATURES))], *[f"c{i}{j}" for i, j in _pairs()]]


def shrunk(found: DataFrame, towards: DataFrame, key: str, rows: int) -> DataFrame:
    """``found`` (with ``n``) mixed with the estimates ``towards`` of its ``key``, which weigh ``rows`` rows."""
    other = towards.select(F.col("g").alias(key), *[F.col(c).alias(f"t_{c}") for c in _values()])
    weight = F.col("n") / (F.col("n") + rows)
    kept = [c for c in found.columns if c not in _values()]
    return found.join(other, key).select(*kept, *[(weight * F.col(c) + (1 - weight) * F.col(f"t_{c}")).alias(c) for c in _values()])


def group_estimates(good: DataFrame, keep_share: float, most_steps: int, shrink_rows: int) -> DataFrame:
    """Estimates of the groups ``g`` (a language and source) of ``good`` (``g, g_language`` and features)."""
    levels = good.withColumn("g", F.explode(F.array(F.lit("all"), F.concat(F.lit("language"), "g_language"), F.concat(F.lit("own"), "g"))))
    found = stored(estimates(levels.select("g", "salt", *FEATURES), keep_share, most_steps), "mcd-found")
    languages = found.filter("g like 'language%'").withColumn("up", F.lit("all"))
    languages = stored(shrunk(languages, found.filter("g = 'all'"), "up", shrink_rows), "mcd-languages")
    up = good.select(F.concat(F.lit("own"), "g").alias("g"), F.concat(F.lit("language"), "g_language").alias("up")).distinct()
    own = shrunk(found.filter("g like 'own%'").join(up, "g"), languages, "up", shrink_rows)
    return stored(own.select(F.substring("g", 4, 1 << 30).alias("g"), *_values()), "mcd-groups")


def _group(language: Column, source: Column) -> Column:
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c.cast("string")))
    return F.to_json(F.array(part(language), part(source)))


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang",
                     source: str = "source", keep_share: float = 0.75, most_steps: int = 12, shrink_rows: int = 100,
                     cut: float = 25.0, carry: tuple = ()) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``distance`` (null in a group of failed documents only) and ``kept``.

    ``cut`` is the squared distance above which a document is rejected (25: one in
    several thousand, were the statistics normal).
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *carry,
                        _group(F.col(language), F.col(source)).alias("g"),
                        _group(F.col(language), F.lit("*")).alias("g_language"))
    stats = text_statistics(named, carry=(*carry, "g", "g_language"))
    rows = stored(stats.withColumns({"base_failed": base_failed(), "salt": F.pmod(F.hash("doc_id", "n_words"), F.lit(SALTS))})
                  .withColumns(dict(zip([*FEATURES, *OWN.values()], [*_features(), *_own_floors()]))), "quality-statistics")
    found = group_estimates(rows.filter("not base_failed"), keep_share, most_steps, shrink_rows)
    out = _distances(rows, found, own_floors=True)
    return out.select("doc_id", *carry, *STATS, "base_failed", F.col("d").alias("distance"),
                      (~F.col("base_failed") & (F.coalesce(F.col("d"), F.lit(0.0)) <= cut)).alias("kept"))


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang",
                   source: str = "source", **parameters) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were. Rows of one id and text stay or go together."""
    key = F.xxhash64(F.col(text))
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(language).alias("lang"),
                        F.col(source).alias("source"), key.alias("body"))
    kept = quality_verdicts(named, carry=("body",), **parameters).filter("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("body").alias("kept_body")).distinct()
    return docs.join(kept, docs[doc_id].eqNullSafe(kept["kept_id"]) & (key == kept["kept_body"]), "left_semi")
