import random
import re

from llm_rows import edge_docs, no_docs, prose

from wardflow.llm import linededup


def brute(rows, min_sites=3, least=3):
    """(id, text, site) -> removed and text, by sets."""
    sites, first = {}, {}
    for i, text, site in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for pos, line in enumerate((text or "").split("\n")) if text is not None else []:
            if len(re.findall(r"[^ \t]+", line)) >= least:
                key = line.strip(" ")
                sites.setdefault(key, set()).add(site)
                first.setdefault(key, (i, pos))
    out = []
    for i, text, site in rows:
        if text is None:
            out.append((i, 0, None))
            continue
        kept = [line for pos, line in enumerate(text.split("\n"))
                if not (len(re.findall(r"[^ \t]+", line)) >= least and len(sites[line.strip(" ")]) >= min_sites
                        and first[line.strip(" ")] != (i, pos))]
        out.append((i, len(text.split("\n")) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **parameters):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = linededup.drop_boilerplate(docs, **parameters)
    return sorted(((r["doc_id"], r["n_removed"], r["text"]) for r in out.collect()), key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(1)
    shared = [prose(100 + k, 6) for k in range(12)] + ["one two", "short"]
    rows = []
    for i in range(150):
        lines = [prose(i * 7 + k, rnd.randint(1, 12)) for k in range(rnd.randint(1, 5))]
        lines += [rnd.choice(["", " "]) + x for x in rnd.sample(shared, rnd.randint(0, 3))]
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines), rnd.choice(["s1", "s2", "s3", "s4", None])))
    rows += [(200, None, "s1"), (201, "", "s1"), (202, "\n\n", "s2"), (203, shared[0] + "\n" + shared[0], "s5")]
    for sites in (2, 3, 5):
        assert run(spark, rows, min_sites=sites) == brute(rows, sites)


def test_far_from_the_threshold_sketches_decide(spark):
    line, few = prose(1, 8), prose(2, 8)
    rows = [(i, line + "\n" + prose(50 + i, 9), f"site{i}") for i in range(400)]
    rows += [(1000 + i, few + "\n" + prose(500 + i, 9), f"site{i % 40}") for i in range(60)]
    assert run(spark, rows, min_sites=100, margin=0.2) == brute(rows, 100)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    out = linededup.drop_boilerplate(docs, min_sites=2)
    assert out.columns == [*docs.columns, "n_removed"] and out.count() == docs.count()
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in out.collect()}
    assert got[2] == (1, "") and got[1][0] == 0 and got[4] == (0, None) and got[10] == (0, "\n\n\n")
    assert linededup.drop_boilerplate(no_docs(spark)).count() == 0
