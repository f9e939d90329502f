"""Cross-site boilerplate lines, by the spread of each line over distinct sites.

Every line of enough words is hashed; per hash, a HyperLogLog sketch of its
sites is built and merged by aggregation. Lines whose estimate is clearly at or
above ``min_sites`` are boilerplate, those clearly below aren't, and those near
the threshold get an exact distinct count. Boilerplate lines go from every
document but the first that has them (smallest id, then position). DataFrame
functions only.

Lines of fewer words stay, as in the SQL of ``op5_lines``, unless ``short_sites``
is given: then every non-blank line is sketched, and short ones are boilerplate
at that many sites. There, letters of scripts without blanks count as words.

Sketches are combined map-side, so a line on a third of all rows is one sketch
per task; the rows that hold boilerplate are found by a join that splits such
lines. Documents are shuffled once, to meet the positions to leave out.

Defined results: a null text stays null; an empty text has no line of enough
words; a null site is a site of its own; a null id comes after all others, and
rows that repeat an id and text are treated alike; a document of boilerplate
only becomes empty; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored

LAST_ID = (1 << 63) - 1


def enough_words(least: int) -> str:
    """A line of at least ``least`` words, parted by blanks or tabs."""
    return r"[^ \t]+[ \t]+" * (least - 1) + r"[^ \t]"


def enough_letters(least: int) -> str:
    """A line of at least ``least`` letters of scripts that put no blanks between words."""
    scripts = "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
    return rf"([{scripts}][^{scripts}]*){{{least}}}"


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(LAST_ID))


def boilerplate(lines: DataFrame, sketch_bits: int, margin: float) -> DataFrame:
    """``h, first_doc, first_pos`` of the lines (``h, asked, site, doc, pos``) on at least ``asked`` sites."""
    spread = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(sketch_bits)).alias("sketch"),
                                    F.min(F.struct("doc", "pos")).alias("first"), F.max("asked").alias("asked"))
    spread = spread.select("h", "asked", F.hll_sketch_estimate("sketch").alias("sites"), F.col("first.doc").alias("first_doc"),
                           F.col("first.pos").alias("first_pos"))
    slack = F.greatest(F.lit(1.0), margin * F.col("asked"))
    spread = stored(spread.filter(F.col("sites") >= F.col("asked") - slack), "line-spread")
    near = spread.filter(F.col("sites") <= F.col("asked") + slack)
    exact = (lines.join(near.select("h"), "h", "left_semi").select("h", "asked", "site").distinct()
             .groupBy("h", "asked").agg(F.count("*").alias("n")).filter(F.col("n") >= F.col("asked")).select("h"))
    sure = spread.filter(F.col("sites") > F.col("asked") + slack).select("h")
    return spread.join(sure.union(exact), "h", "left_semi").select("h", "first_doc", "first_pos")


def drop_boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                     min_sites: int = 3, min_words: int = 3, sketch_bits: int = 10, margin: float = 0.2,
                     short_sites: int | None = None) -> DataFrame:
    """``docs`` with boilerplate lines left out of ``text`` and ``n_removed``, how many those were.

    A line of fewer than ``min_words`` words is boilerplate on ``short_sites`` sites, by default never.
    ``margin`` is the part of the sites asked on either side within which lines
    are counted exactly: several standard errors of a sketch of 2^``sketch_bits``.
    """
    body = F.xxhash64(F.col(text))
    rows = docs.select(_order(F.col(doc_id).cast("long")).alias("doc"), body.alias("body"),
                       F.xxhash64(F.col(site).isNull(), F.col(site)).alias("site"),
                       F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    key, asked = F.trim("line"), F.lit(min_sites)
    searched = enough_words(min_words)
    if short_sites is not None:
        long = key.rlike(enough_words(min_words)) | key.rlike(enough_letters(2 * min_words))
        asked, searched = F.when(long, min_sites).otherwise(short_sites), r"[^\x20\x09-\x0D]"
    lines = rows.filter(F.col("line").rlike(searched)).select(
        "doc", "body", "site", "pos", asked.alias("asked"), F.xxhash64(key).alias("h"))
    lines = stored(lines, "lines")
    found = stored(boilerplate(lines, sketch_bits, margin), "line-boilerplate")
    first = (F.col("doc") == F.col("first_doc")) & (F.col("pos") == F.col("first_pos"))
    out = (lines.join(found, "h").filter(~first).groupBy("doc", "body")
           .agg(F.collect_set("pos").alias("_out")))
    out = out.select(F.col("doc").alias("_doc"), F.col("body").alias("_body"), "_out")
    # The row as one column, so that no name of its columns clashes with those made here.
    row = docs.select(F.struct(*docs.columns).alias("_row"))
    own = F.col("_row")[text]
    held = row.join(out, (_order(F.col("_row")[doc_id].cast("long")) == F.col("_doc"))
                    & (F.xxhash64(own) == F.col("_body")), "left")
    # Positions kept, by hashing; the lines at them.
    kept = held.select("_row", "_out", F.when(F.col("_out").isNotNull(), F.split(own, "\n")).alias("_parts"))
    kept = kept.withColumn("_kept", F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), "_out"))
    clean = F.array_join(F.transform("_kept", lambda i: F.col("_parts")[i]), "\n")
    clean = F.when(F.col("_out").isNotNull(), clean).otherwise(own)
    return kept.select(*[(clean if c == text else F.col("_row")[c]).alias(c) for c in docs.columns if c != "n_removed"],
                       F.coalesce(F.size("_out"), F.lit(0)).cast("long").alias("n_removed"))
