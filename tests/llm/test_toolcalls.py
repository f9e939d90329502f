import json
import random

from wardflow.llm import queries, toolcalls

TOOLS = {"search": {"q": ("string", True), "n": ("integer", False), "x": ("number", False), "deep": ("boolean", False)},
         "list": {"items": ("array", True), "where": ("object", False)}}


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def run(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, json string, step int")
    return toolcalls.link_tool_calls(frame.repartition(2), TOOLS).collect()


def row(conv, turn, role, text):
    return (conv, turn, role, text, "clash", 7)


def test_linking_order_and_validation(spark):
    rows = [
        row(1, 0, "user", 'say "hi"\n'), row(1, 1, "assistant", call(("a", "search", {"q": "x", "n": 3, "deep": True}),
                                                                ("b", "search", {"q": {"$result": "a"}, "x": 1.5}))),
        row(1, 2, "tool", result("b", {"z": 1, "a": [1, "é"]})), row(1, 3, "tool", result("a", "text")),
        row(1, 4, "tool", result("a", "again")), row(1, 5, "tool", result("zz", None)),
        row(1, 6, "assistant", call(("c", "list", {"items": {"$result": "b"}, "where": {"k": 1}}))),
        row(1, 7, "assistant", call(("a", "search", {"q": "second"}))),
        row(2, 0, "assistant", call(("p", "search", {"q": {"$result": "r"}}), ("r", "search", {"q": {"$result": "p"}}))),
        row(2, 1, "assistant", call(("s", "search", {"q": {"$result": "nowhere"}}))),
        row(2, 2, "assistant", call(("t", "paint", {}), ("u", "search", {"n": "many", "size": 1, "big": 2}), ("v", "list", [1]))),
        row(2, 3, "assistant", '{"tool_calls": broken'), row(2, 4, "assistant", None), row(None, 0, "user", "x"),
        row(2, 5, None, "no role"), row(2, 5, None, "no role"),
    ]
    got = run(spark, rows)
    of = {(r["conv_id"], r["kind"], r["call_id"], r["turn"]): r for r in got}
    step = {k[2]: r["step"] for k, r in of.items() if k[1] == "call" and k[3] != 7}
    assert (step["a"], step["b"], step["c"]) == (0, 1, 2)
    assert step["p"] == step["r"] == step["s"] == toolcalls.BLOCKED
    status = {(k[1], k[2], k[3]): r["status"] for k, r in of.items() if k[2]}
    assert status["call", "a", 1] == status["call", "b", 1] == status["result", "b", 2] == status["result", "a", 3] == "linked"
    assert status["result", "a", 4] == "repeated" and status["result", "zz", 5] == "orphan"
    assert status["call", "c", 6] == "unanswered" and status["call", "a", 7] == "repeated" and status["call", "p", 0] == "blocked"
    errors = {k[2]: r["errors"] for k, r in of.items() if k[1] == "call"}
    assert errors["b"] == errors["c"] == [] and errors["t"] == ["unknown tool"]
    assert errors["u"] == ["missing q", "n is no integer", "unknown big", "unknown size"]
    assert errors["v"] == ["arguments are no object"]
    for r in got:  # canonical: keys in order, no blanks
        assert r["json"] == json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(of[1, "result", "b", 2]["json"]) == {"call_id": "b", "content": {"a": [1, "é"], "z": 1},
                                                          "name": "search", "role": "tool"}
    assert json.loads(of[1, "text", None, 0]["json"]) == {"content": 'say "hi"\n', "role": "user"}
    assert sum(r["kind"] == "text" for r in got) == 6
    # A call never comes before one whose result it uses.
    assert sorted((r["step"], r["turn"], r["part"]) for r in got if r["call_id"] == "a" and r["kind"] == "call")[0][0] == 0


def test_long_chain(spark):
    rows = [row(1, k, "assistant", call((f"c{k}", "search", {"q": {"$result": f"c{k + 1}"} if k < 39 else "end"})))
            for k in range(40)]
    assert {r["call_id"]: r["step"] for r in run(spark, rows)} == {f"c{k}": 39 - k for k in range(40)}


def test_steps_equal_the_longest_paths(spark):
    """Random references, cycles and unknown ids among them, against rounds in Python."""
    rnd = random.Random(1)
    rows, uses = [], {}
    for conv in range(12):
        n = rnd.randint(1, 25)
        for k in range(n):
            own = rnd.sample(range(n + (rnd.random() < .1)), min(n, rnd.choice([0, 1, 1, 1, 2, 3])))
            if rnd.random() < .9:
                own = sorted({*[u for u in own if u < k], *([k - 1] if k and rnd.random() < .5 else [])})
            uses[conv, f"c{k}"] = {f"c{u}" for u in own}
            arguments = {"q": "x", **{f"p{u}": {"$result": f"c{u}"} for u in own}}
            rows.append(row(conv, rnd.randint(0, 9), "assistant", call((f"c{k}", "search", arguments))))
    steps = {}
    for _ in range(40):
        for (conv, own), needed in uses.items():
            if all((conv, u) in steps for u in needed):
                steps[conv, own] = max((steps[conv, u] + 1 for u in needed), default=0)
    got = {(r["conv_id"], r["call_id"]): r["step"] for r in run(spark, rows)}
    assert got == {k: steps.get(k, toolcalls.BLOCKED) for k in uses}
    assert len(steps) < len(uses) and max(steps.values()) > 4


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_against_brute_force(spark):
    """The query's calls and results, worked out row by row in Python."""
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = queries.op6_tool_calls(spark, sf).collect()
    messages = queries.tool_transcripts(spark.read.parquet(f"{sf}/conversations.parquet")).collect()
    assert len(got) == len(messages)
    calls = {(r["conv_id"], r["call_id"]): r for r in got if r["kind"] == "call"}
    answers = {}
    for r in got:
        if r["kind"] == "result":
            answers.setdefault((r["conv_id"], r["call_id"]), []).append(r)
    assert answers
    turns = {(r["conv_id"], r["turn"]) for r in rows if r["role"] == "assistant"}
    assert set(calls) == {(c, f"c{t}") for c, t in turns}
    for r in rows:
        if r["role"] != "assistant":
            continue
        own, n = calls[r["conv_id"], f"c{r['turn']}"], len(r["text"])
        before = (r["conv_id"], r["turn"] - 2)
        step, at = 0, r["turn"]
        while at >= 3:
            at -= 2
            step = step + 1 if (r["conv_id"], at) in turns else toolcalls.BLOCKED
        assert own["step"] == min(step, toolcalls.BLOCKED), (r["conv_id"], r["turn"], before)
        if own["step"] < toolcalls.BLOCKED:
            assert own["status"] == ("unanswered" if n % 17 == 0 and n % 19 else "linked")
        tool = [*queries.TOOLS, "paint"][n % 13 % 4]
        arguments = json.loads(own["json"])["arguments"]
        assert arguments["query"] == r["text"]  # the whole text
        for answer in answers.get((r["conv_id"], f"c{r['turn']}"), []):
            assert json.loads(answer["json"])["content"] == {"lines": r["text"].split("\n")}
        wrong = ["unknown tool"] if tool == "paint" else []
        if tool != "paint" and n % 11 == 0:
            wrong.append(f"limit is no {queries.TOOLS[tool]['limit'][0]}")
        if tool == "measure" and "after" not in arguments:
            wrong.append("missing after")
        if tool == "lookup" and "after" in arguments:
            wrong.append("unknown after")
        assert own["errors"] == wrong
