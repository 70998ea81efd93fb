from __future__ import annotations

from collections import defaultdict

from frames_llm import documents, empty_documents, words
from pyspark.sql import functions as F
from renewlens.llm import mixing



def levels():
    return {"domain": F.substring("source", 1, 1), "lang": F.col("lang"), "source": F.col("source")}


def poured(nodes, budget):
    """{name: (weight, supply)} -> {name: share}, by filling the fullest again and again."""
    full: set = set()
    while True:
        left = budget - sum(nodes[n][1] for n in full)
        open_ = {n: w for n, (w, _) in nodes.items() if n not in full and w > 0}
        total = sum(open_.values())
        over = {n for n, w in open_.items() if nodes[n][1] * total <= w * left}
        if not over:
            return {
                n: nodes[n][1] if n in full else (int(w * left / total) if w and total else 0)
                for n, (w, _) in nodes.items()
            }
        full |= over


def budgets_by_hand(leaves, mix, weight):
    """{path: tokens} -> {path: budget}"""

    def share(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        below = defaultdict(int)
        for path, tokens in leaves.items():
            if path[:depth] == prefix:
                below[path[: depth + 1]] += tokens
        nodes = {p: (weight(p), usable(p)) for p in below}
        out = {}
        for p, part in poured(nodes, budget).items():
            out |= share(p, part)
        return out

    def usable(prefix):
        """Tokens below a node on paths whose nodes all have a weight, over all epochs."""
        depth = len(prefix)
        return mix.max_epochs * sum(
            tokens
            for path, tokens in leaves.items()
            if path[:depth] == prefix
            and all(weight(path[:d]) > 0 for d in range(depth + 1, 4))
        )

    return share((), int(sum(leaves.values()) * mix.budget_share))


def rows_for(sizes):
    rows, k = [], 0
    for (source, lang), texts in sizes.items():
        for n in texts:
            rows.append((k, " ".join(f"w{j}" for j in range(n)), lang, source))
            k += 1
    return rows


SIZES = {
    ("a1", "en"): [5, 9, 30, 2, 2],
    ("a1", "de"): [3],
    ("a2", "en"): [50] * 8,
    ("b1", "en"): [4, 4],
    ("b1", None): [7, 1],
    ("c9", "fr"): [100, 1, 1, 1],
    (None, "fr"): [6],
}


def check(spark, mix, weight):
    rows = rows_for(SIZES) + [(900, None, "en", "a1"), (901, " ", "en", "a1"), (902, "", None, None)]
    docs = documents(spark, rows)
    chosen, plan = mixing.select(docs, levels(), mix)
    leaves = defaultdict(int)
    for _, text, lang, source in rows:
        if words(text):
            leaves[(source[0] if source else None, lang, source)] += len(words(text))
    budgets = {(r.domain, r.lang, r.source): r.budget for r in plan.collect()}
    want = budgets_by_hand(leaves, mix, weight)
    assert set(budgets) == set(want)
    assert all(abs(budgets[p] - want[p]) <= 1 for p in want)
    got = defaultdict(list)
    for r in chosen.collect():
        got[(r.domain, r.lang, r.source)].append(r)
    tokens = {i: len(words(t)) for i, t, *_ in rows}
    for path, budget in budgets.items():
        reads = got[path]
        assert sum(r.take_tokens for r in reads) == budget
        whole = budget // leaves[path]
        by_epoch = defaultdict(dict)
        for r in reads:
            assert r.doc_id not in by_epoch[r.epoch]
            by_epoch[r.epoch][r.doc_id] = r.take_tokens
        assert set(by_epoch) <= set(range(whole + 1)) and whole <= mix.max_epochs
        for epoch, docs_read in by_epoch.items():
            cut = [i for i, n in docs_read.items() if n != tokens[i]]
            assert not cut if epoch < whole else len(cut) <= 1
    return chosen


def test_equal_weights(spark):
    check(spark, mixing.Mix(budget_share=1.0, max_epochs=3), lambda p: 1.0)


def test_given_weights_and_shortage_higher_up(spark):
    weights = {("a",): 0.0, ("b",): 9.0, ("c", "fr"): 2.0, ("b", "en", "b1"): 5.0}
    mix = mixing.Mix(budget_share=0.4, max_epochs=2, weights=weights)
    check(spark, mix, lambda p: weights.get(p, 1.0))


def test_leaves_without_weight_hold_no_budget(spark):
    """What a(3) cannot take, as one of its leaves has no weight, goes to b(1)."""
    text = "w " * 100
    rows = [(1, text, "en", "a1"), (2, text, "en", "a2"), (3, text, "en", "b1")]
    weights = {("a",): 3.0, ("a", "en", "a1"): 0.0}
    mix = mixing.Mix(budget_share=2 / 3, max_epochs=1, weights=weights)
    _, plan = mixing.select(documents(spark, rows), levels(), mix)
    assert {r.source: r.budget for r in plan.collect()} == {"a1": 0, "a2": 100, "b1": 100}
    check(spark, mixing.Mix(budget_share=0.9, max_epochs=2, weights=weights), lambda p: weights.get(p, 1.0))


def test_everything_is_short(spark):
    check(spark, mixing.Mix(budget_share=5.0, max_epochs=2), lambda p: 1.0)


def test_runs_repeat_and_seeds_differ(spark):
    docs = documents(spark, rows_for(SIZES))

    def chosen(seed):
        mix = mixing.Mix(budget_share=0.5, max_epochs=1, seed=seed)
        return {(r.doc_id, r.take_tokens) for r in mixing.select(docs, levels(), mix)[0].collect()}

    assert chosen(1) == chosen(1)
    assert len({frozenset(chosen(s)) for s in range(4)}) > 1


def test_slots_cut_a_large_leaf(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_ROWS", 2)
    check(spark, mixing.Mix(budget_share=0.7, max_epochs=3), lambda p: 1.0)


def test_no_rows_and_repeated_rows(spark):
    chosen, plan = mixing.select(empty_documents(spark), levels(), mixing.Mix())
    assert chosen.collect() == [] and plan.collect() == []
    same = documents(spark, [(1, "a b c", "en", "a1")] * 4)
    chosen, _ = mixing.select(same, levels(), mixing.Mix(budget_share=0.5, max_epochs=1))
    assert sum(r.take_tokens for r in chosen.collect()) == 6


def test_native(spark):
    chosen, _ = mixing.select(documents(spark, rows_for(SIZES)), levels(), mixing.Mix())
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
