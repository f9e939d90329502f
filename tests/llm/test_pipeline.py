import random

from llm_rows import edge_docs, no_docs, prose

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"


def test_order_and_columns(spark):
    assert [n for n, _ in C.STAGES] == ["quality", "lines", "near_duplicates", "personal_data", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, SF), "test-pipeline")
        assert docs.columns == list(C.COLUMNS)
        assert docs.filter("n_chars <> length(text)").isEmpty()
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] / 2
    pieces = C.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == sizes[-1]


def test_run_equals_the_stages(spark):
    got = C.run(spark, SF)
    total = got.groupBy().sum("length").first()[0]
    assert total == got.select("doc_id", "doc_tokens").distinct().groupBy().sum("doc_tokens").first()[0]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def ids(frame):
    return sorted((r["doc_id"] for r in frame.collect()), key=str)


def test_near_duplicates_keep_one(spark):
    base = prose(1, 100)
    rows = [(1, base, "a"), (2, base, "b"), (3, base + " more", "c"), (4, prose(2, 90), "a"), (4, prose(2, 90), "a"),
            (None, base, "a"), (5, None, "a"), (6, "", "a")]
    assert ids(C.near_dedup(spark, table(spark, rows), SF)) == [1, 4, 5, 6, None]


def test_lines_drop_documents_of_boilerplate_only(spark):
    line = prose(1, 12)
    rows = [(i, line + "\n" + prose(10 + i, 60), f"s{i}") for i in range(4)] + [(9, line, "s9"), (10, "", "s1"), (11, None, "s1")]
    out = C.line_dedup(spark, table(spark, rows), SF)
    assert ids(out) == [0, 1, 10, 11, 2, 3]
    assert {r["doc_id"]: r["n_chars"] for r in out.collect()}[1] == len("\n".join([prose(11, 60)]))


def test_short_lines_and_lines_without_blanks_go(spark):
    cjk, short, chance = "请阅读我们的隐私政策和使用条款", "Read more", "Yes."
    rows = [(i, "\n".join([prose(10 + i, 60), *[cjk] * (i < 3), *[chance] * (i < 5), short]), f"s{i}") for i in range(6)]
    got = {r["doc_id"]: r["text"].split("\n")[1:] for r in C.line_dedup(spark, table(spark, rows), SF).collect()}
    assert got == {0: [cjk, chance, short], 1: [chance], 2: [chance], 3: [chance], 4: [chance], 5: []}


def test_personal_data_goes(spark):
    out = C.personal_data(spark, table(spark, [(1, "write to a@b.com now", "x"), (2, "nothing", "x")]), SF)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "write to <email> now", 2: "nothing"}


def test_quality_keeps_clean_documents(spark):
    rnd = random.Random(1)
    rows = [(i, prose(i, rnd.randint(60, 300)), "s") for i in range(150)] + [(900, "too short", "s")]
    assert ids(C.quality_rules(spark, table(spark, rows), SF)) == sorted(range(150), key=str)


def test_every_stage_takes_edge_rows_and_empty_tables(spark):
    for make in (edge_docs, no_docs):
        docs = make(spark)
        for name, stage in C.STAGES:
            out = stage(spark, docs.select(*C.COLUMNS), SF)
            assert out.count() >= 0, name
