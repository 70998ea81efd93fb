from __future__ import annotations

import dataclasses
import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frames_llm import documents, empty_documents
from renewlens.llm import catalog, pieces

TEXTS = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab", "▁▁", "c"]
SMALL = pieces.Vocabulary(
    tuple(["<unk>"] + [f"<0x{b:02X}>" for b in range(256)] + TEXTS),
    tuple([0.0] * 257 + [-9.0, -5.0, -5.0, -6.0, -4.0, -7.0, -6.5, -8.0, -9.0, -3.0]),
    frozenset(range(257)),
    tuple(range(1, 257)),
)


def best_weight(machine, text):
    """The least weight over all ways to write the text."""
    weights = {t: 0 - s for t, s in zip(SMALL.pieces[257:], SMALL.scores[257:])}

    def ways(rest):
        if not rest:
            yield 0.0
            return
        for t, w in weights.items():
            if rest.startswith(t):
                yield from (w + more for more in ways(rest[len(t) :]))
        cost = machine.byte_weight * len(rest[0].encode())
        yield from (cost + more for more in ways(rest[1:]))

    return min(ways(text))


def test_shortest_path_equals_all_paths():
    machine = pieces.Transducer(SMALL)
    for n in range(1, 6):
        for letters in itertools.product("ab x", repeat=n):
            text = "".join(letters)
            ids, weight = machine.encode(text)
            assert weight == pytest.approx(best_weight(machine, "▁" + text.replace(" ", "▁")))
            assert machine.decode(ids.tolist()) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_round_trip_of_any_text(text):
    machine = _machine()
    ids, weight = machine.encode(text)
    assert machine.decode(ids.tolist()) == pieces.normalised(text)
    assert weight == pytest.approx(machine.shortest_path("▁" + text.replace(" ", "▁"))[1] if text else 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab c▁\n é🙂", max_size=70), max_size=8))
def test_many_chains_at_a_time_equal_one_by_one(texts):
    machine = pieces.Transducer(SMALL)
    for text, (ids, weight, same) in zip(texts, machine.encode_all(texts)):
        chain = machine.normaliser.compose(text, pieces.Normaliser.BEGIN)
        path, least = machine.shortest_path(chain)
        assert same and weight == pytest.approx(least)
        written = machine.decode(ids.tolist())
        assert written == machine.decode(path) == pieces.normalised(text)


def test_ids_equal_one_by_one():
    machine = _machine()
    texts = ["Überall naïve words, déjà vu", "a" * 47 + " " + "b" * 300, "x\n\n y  z▁ \t", "日本 🙂"]
    for text, (ids, _, _) in zip(texts, machine.encode_all(texts)):
        begin, *rest = machine.segments(text)
        want = machine.shortest_path("▁" + pieces.Normaliser(dict(SMALL.changes)).compose(begin, 1))[0]
        for segment in rest:
            want += machine.shortest_path(machine.normaliser.compose(segment, 1))[0]
        assert ids.tolist() == want


def changed(*changes):
    return pieces.Transducer(dataclasses.replace(SMALL, changes=changes))


def test_a_changed_normaliser_changes_the_path():
    named = [SMALL.pieces[i] for i in changed((" ", "▁")).encode("aB b")[0]]
    assert named == ["▁a", "<0x42>", "▁", "b"]
    lower = changed((" ", "▁"), ("B", "b"))
    assert [SMALL.pieces[i] for i in lower.encode("aB b")[0]] == ["▁ab", "▁", "b"]
    assert lower.decode(lower.encode("aB b")[0].tolist()) == "ab b"
    # Without a change of blanks, they are written by their byte.
    assert [SMALL.pieces[i] for i in changed().encode("a b")[0]] == ["▁a", "<0x20>", "b"]


@pytest.mark.parametrize("changes", [
    ((" ", "▁"), ("x", "")), ((" ", "▁"), ("x", "a▁")), ((" ", "▁"), ("x", "ab")), (("▁", "b"),), (),
])
def test_any_normaliser_composes_whole_texts(changes):
    """Texts are cut only where no path is lost, whatever the normaliser writes."""
    machine = changed(*changes)
    for letters in itertools.product("ab x▁", repeat=4):
        text = "".join(letters)
        symbols = "▁" + "".join(dict(changes).get(c, c) for c in text)
        assert machine.encode(text)[1] == pytest.approx(best_weight(machine, symbols))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    machine = pieces.Transducer(SMALL)
    for low in range(0, 400, 10):
        texts = [f"a b{i} c{i % 7} {'ab' * 40}{i}" for i in range(low, low + 10)]
        found = machine.encode_all(texts)
        assert all(same for _, _, same in found)
        assert len(machine.memory) < 80 and max(map(len, machine.memory)) <= 48


_kept = []


def _machine():
    if not _kept:
        _kept.append(pieces.Transducer(pieces.Vocabulary.load()))
    return _kept[0]


def test_ties_take_the_longest_last_piece():
    vocabulary = pieces.Vocabulary(
        SMALL.pieces[:257] + ("▁", "a", "aa"), SMALL.scores[:257] + (-1.0, -1.0, -2.0),
        SMALL.special, SMALL.byte_ids,
    )
    machine = pieces.Transducer(vocabulary)
    assert [vocabulary.pieces[i] for i in machine.encode("aaa")[0]] == ["▁", "a", "aa"]


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "a  b\n\tc ▁"), (None, "日本🙂"), (4, "xyz " * 30_000), (3, "a  b\n\tc ▁")]
    docs = documents(spark, rows)
    vocabulary = pieces.Vocabulary.load()
    encoded = pieces.encode(docs, vocabulary)
    found = encoded.collect()
    assert len(found) == 6 and all(r.round_trip for r in found)
    assert {r.doc_id: r.n_pieces for r in found}[1] == 0
    assert all(r.n_pieces == len(r.ids) for r in found)
    back = {(r.doc_id, r.text) for r in pieces.decode(encoded, vocabulary).collect()}
    assert back == {(i, pieces.normalised(t or "")) for i, t in rows}
    assert pieces.encode(empty_documents(spark), vocabulary).collect() == []


def test_query_round_trips(spark):
    rows = catalog.op6_sentencepiece_transducer(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.round_trip for r in rows)
