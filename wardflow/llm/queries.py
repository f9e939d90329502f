"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import alignment, language, linededup, mixing, packing, phrases, pieces, pii, probminhash, projections, quality, toolcalls, warc
from wardflow.llm.scratch import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(read_table(spark, sf_dir, "documents")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = language.predict(docs, training=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.roundtrip(read_table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), "same")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_boilerplate(read_table(spark, sf_dir, "documents"), short_sites=6)
    return out.select("doc_id", "n_removed", "text")


TOOLS = {"search": {"query": ("string", True), "limit": ("integer", True), "after": ("string", False)},
         "lookup": {"query": ("string", True), "limit": ("number", False)},
         "measure": {"query": ("string", True), "limit": ("integer", False), "after": ("string", True)}}


def tool_transcripts(conversations: DataFrame) -> DataFrame:
    """The conversations with tool messages made from them (the table has none): before each assistant turn stand a
    call that asks for its whole text and the call's result, all its lines. A call uses the result of the one two
    turns earlier. Lengths of texts decide on the tool, and on faults: wrong types, results that miss or come twice."""
    n = F.coalesce(F.length("text"), F.lit(0))
    own = F.concat(F.lit("c"), F.col("turn").cast("string"))
    before = F.concat(F.lit("c"), (F.col("turn") - 2).cast("string"))
    tool = F.element_at(F.array(*map(F.lit, [*TOOLS, "paint"])), (n % 13 % 4 + 1).cast("int"))
    query = F.coalesce("text", F.lit(""))
    limit = F.when(n % 11 == 0, F.lit('"many"')).otherwise((n % 20).cast("string"))
    after = F.when(F.col("turn") >= 3, F.to_json(F.struct(before.alias("$result"))))
    quoted = lambda c: F.to_json(F.array(c))
    bare = lambda c: F.expr("substring(q, 2, length(q) - 2)")
    rows = conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", n.alias("n"), own.alias("own"), tool.alias("tool"), limit.alias("limit"), after.alias("after"),
        quoted(query).alias("q"), F.to_json(F.split(query, "\n")).alias("lines"))
    arguments = F.concat(F.lit('{"query":'), bare("q"), F.lit(',"limit":'), F.col("limit"),
                         F.coalesce(F.concat(F.lit(',"after":'), F.col("after")), F.lit("")), F.lit("}"))
    call = F.concat(F.lit('{"tool_calls":[{"name":"'), F.col("tool"), F.lit('","id":"'), F.col("own"),
                    F.lit('","arguments":'), arguments, F.lit("}]}"))
    result = F.concat(F.lit('{"tool_call_id":"'), F.col("own"), F.lit('","content":{"lines":'), F.col("lines"), F.lit("}}"))
    calls = rows.select("conv_id", "turn", F.lit("assistant").alias("role"), call.alias("text"))
    results = rows.filter("n % 17 <> 0").select("conv_id", "turn", F.lit("tool").alias("role"), result.alias("text"))
    twice = rows.filter("n % 19 = 0").select("conv_id", "turn", F.lit("tool").alias("role"), result.alias("text"))
    own_rows = conversations.select("conv_id", "turn", "role", "text")
    return own_rows.unionByName(calls).unionByName(results).unionByName(twice)


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.link_tool_calls(tool_transcripts(read_table(spark, sf_dir, "conversations")), TOOLS)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_verdicts(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality.STATS, "base_failed", "kept")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_roundtrip(read_table(spark, sf_dir, "pages"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.embedding_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.detect(read_table(spark, sf_dir, "documents")))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("source")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.aligned(read_table(spark, sf_dir, "documents"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_probminhash, op2_pack, op3_language, op4_pieces, op5_lines, op6_tool_calls, op7_quality, op8_warc, op9_embeddings, op10_pii, op11_alignment, op12_phrases, op13_mix)}
