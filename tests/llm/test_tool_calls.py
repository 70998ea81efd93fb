from __future__ import annotations

import json

from renewlens.llm import catalog
from renewlens.llm.tool_calls import Argument, link

SCHEMAS = {
    "search": {"q": Argument("string", least=1), "n": Argument("integer", False, least=1)},
    "mode": {
        "kind": Argument("string", choices=("a", "b")),
        "on": Argument("boolean", False),
        "x": Argument("number", False),
    },
}
CALLS = (
    "conv_id long, turn long, call_id string, tool string, arguments string, "
    "uses array<string>, status string, stage int, mark long, json string"
)
RESULTS = "conv_id long, turn long, call_id string, content string, answer string"


def linked(spark, calls, results=()):
    full = [(*c, *((None,) * (6 - len(c))), "s", 1, 2, "j") for c in calls]
    left = spark.createDataFrame(full, CALLS)
    right = spark.createDataFrame([(*r, "z") for r in results], RESULTS)
    return link(left, right, SCHEMAS).collect()


def statuses(rows):
    return {(r.conv_id, r.turn): r.status for r in rows}


def test_linking_and_canonical_json(spark):
    text = '{ "q" : "é \\"x\\"\\n/", "n" : 3 }'
    row, late = sorted(
        linked(
            spark,
            [(1, 0, "a", "search", text)],
            [(1, 2, "a", "late"), (1, 1, "a", "found\t"), (2, 1, "a", "elsewhere")][:2],
        ),
        key=lambda r: r.turn,
    )
    assert (late.status, late.result_turn) == ("extra_result", 2)
    assert (row.status, row.stage, row.result_turn) == ("ok", 0, 1)
    want = {"arguments": json.loads(text), "id": "a", "name": "search", "result": "found\t"}
    assert row.json == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_statuses(spark):
    ok = '{"q":"x"}'
    calls = [
        (1, 0, "a", "search", ok),
        (1, 3, "a", "search", ok),
        (1, 4, "b", "nothing", ok),
        (1, 5, "c", "search", '{"n":1}'),
        (1, 6, "d", "search", "no json"),
        (1, 7, "e", "search", '{"q":"x","n":0}'),
        (1, 8, "f", "search", '{"q":"x","more":1}'),
        (1, 9, "g", "search", '{"q":7}'),
        (1, 10, "h", "search", "[1]"),
        (1, 11, "i", "search", None),
        (1, 12, "j", "mode", '{"kind":"c"}'),
        (1, 13, "k", "mode", '{"kind":"b","on":true,"x":1.5}'),
        (1, 14, "l", "mode", '{"kind":"b","on":"yes"}'),
        (1, 15, "m", None, ok),
        (1, 16, "n", "search", '{"q":""}'),
        (None, 17, "o", "search", ok),
        (1, 18, None, "search", ok),
    ]
    results = [(1, 1, "a", "r"), (1, 19, "k", None), (2, 0, "a", "lost"), (None, 1, "o", "r"), (1, 2, None, "r")]
    found = statuses(linked(spark, calls, results))
    assert found == {
        (1, 0): "ok", (1, 3): "duplicate", (1, 4): "unknown_tool", (1, 5): "invalid",
        (1, 6): "invalid", (1, 7): "invalid", (1, 8): "invalid", (1, 9): "invalid",
        (1, 10): "invalid", (1, 11): "invalid", (1, 12): "invalid", (1, 13): "ok",
        (1, 14): "invalid", (1, 15): "unknown_tool", (1, 16): "invalid", (None, 17): "unanswered",
        (1, 18): "unanswered", (2, 0): "orphan", (None, 1): "orphan", (1, 2): "orphan",
    }


def test_no_row_is_lost(spark):
    """Calls, results that answer none, and other turns: each comes out once."""
    ok = '{"q":"x"}'
    calls = [(1, 0, "a", "search", ok), (1, 5, "a", "search", ok), (1, 6, "b", "search", ok)]
    results = [(1, 2, "a", "second"), (1, 1, "a", "first"), (1, 1, "a", "first"), (1, 7, "c", None)]
    left = spark.createDataFrame([(*c, None, "s", 1, 2, "j") for c in calls], CALLS)
    right = spark.createDataFrame([(*r, "z") for r in results], RESULTS)
    others = spark.createDataFrame(
        [(1, 3, "system", "be \"kind\"", "x"), (None, None, None, None, "x")],
        "conv_id long, turn long, role string, content string, status string",
    )
    rows = link(left, right, SCHEMAS, others).collect()
    found = sorted((r.status, r.turn, r.result_turn) for r in rows if r.turn is not None)
    assert found == [
        ("duplicate", 5, None), ("extra_result", 1, 1), ("extra_result", 2, 2), ("ok", 0, 1),
        ("orphan", 7, 7), ("other", 3, None), ("unanswered", 6, None),
    ]
    spoken = [json.loads(r.json) for r in rows if r.status == "other"]
    assert {"content": 'be "kind"', "role": "system"} in spoken
    assert {"content": None, "role": None} in spoken and len(spoken) == 2
    assert "second" in {json.loads(r.json)["result"] for r in rows if r.status == "extra_result"}


def test_numbers_have_one_text(spark):
    schema = {"t": {"n": Argument("integer", False), "x": Argument("number", False), "s": Argument("string", False)}}

    def made(arguments):
        calls = spark.createDataFrame([(1, 0, "a", "t", arguments, None, "s", 1, 2, "j")], CALLS)
        row = link(calls, spark.createDataFrame([], RESULTS), schema).first()
        return row.status, row.json

    alike = {made(f'{{"n":{n}}}') for n in ("100", "1e2", "100.0", "1.0E+2", "10000e-2")}
    assert len(alike) == 1
    status, text = alike.pop()
    assert status == "unanswered" and '{"n":100}' in text
    assert made('{"n":1.5}')[0] == "invalid" and made('{"x":1.50}') == made('{"x":15e-1}')
    assert '{"x":1.5}' in made('{"x":1.50}')[1]
    kept = 'a:1.0,\\"[2.0]\\\\'
    assert f'"s":"{kept}"' in made(f'{{"s":"{kept}","x":[1.0,{{"y":2e0}}]}}')[1]
    assert '"x":[1,{"y":2}]' in made(f'{{"s":"{kept}","x":[1.0,{{"y":2e0}}]}}')[1]


def test_order(spark):
    ok = '{"q":"x"}'
    calls = [
        # In order already.
        (1, 0, "a", "search", ok, []),
        (1, 2, "b", "search", ok, ["a", "missing"]),
        # A later call is used by an earlier one.
        (2, 0, "p", "search", ok, ["r"]),
        (2, 1, "q", "search", ok, ["p", "r"]),
        (2, 2, "r", "search", ok, None),
        # A circle, and one behind it.
        (3, 0, "x", "search", ok, ["y"]),
        (3, 1, "y", "search", ok, ["x"]),
        (3, 2, "z", "search", ok, ["y"]),
        (3, 3, "free", "search", ok, []),
    ]
    rows = linked(spark, calls, [(c[0], 9, c[2], "r") for c in calls])
    placed = {(r.conv_id, r.call_id): (r.stage, r.turn) for r in rows}
    for conv, _, call, *_, uses in calls:
        for used in uses or []:
            if conv < 3 and (conv, used) in placed:
                assert placed[conv, used] < placed[conv, call]
    by_id = {r.call_id: r.status for r in rows if r.conv_id == 3}
    assert by_id == {"x": "circular", "y": "circular", "z": "circular", "free": "ok"}


def test_repeats_long_texts_and_no_rows(spark):
    ok = json.dumps({"q": "x" * 200_000})
    rows = linked(spark, [(1, 0, "a", "search", ok)] * 3, [(1, 1, "a", "y" * 200_000)] * 2)
    assert sorted(r.status for r in rows) == ["duplicate", "duplicate", "extra_result", "ok"]
    assert linked(spark, []) == []


def test_native(spark):
    found = catalog.op3_tool_call_linking(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
