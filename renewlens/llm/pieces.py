"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three machines are compiled from a vocabulary:

* the normaliser reads characters and writes symbols. Its first state also writes the
  word-begin mark; in the second one every character is changed or copied.
* the pieces: a letter tree over symbols, whose accepting states write a piece, weigh
  its negative score and lead back to the root.
* byte fallback reads one symbol and writes the pieces of its UTF-8 bytes, each weighing
  more than any piece. Its arcs are compiled when a symbol first comes up, as its
  alphabet is all of Unicode.

A text is composed with the normaliser, which gives a chain of symbols, and the chain
with the union of the other two. The composition is walked from left to right, only
through states that can be reached; its shortest path in the tropical semiring (weights
add, the least wins) is the encoding. Of equal paths the one with the longest last piece
is taken, at every point. Short chains are walked many at a time, with the arcs of the
pieces in arrays; long ones one by one.

Weights are a piece's rank for vocabularies made by merging, so the path differs
from replaying merges; decoding gives the text back either way.

Where no piece can span a place in the text, the shortest path is the
concatenation of the shortest paths on both sides. Texts are cut at such places
(before what becomes a word-begin mark, around line ends), and the paths of short
segments are remembered in a table of bounded size. Texts are encoded whole, with any
length. A text comes back whole if each of its segments does, as written bytes are
strung together.

NULL and empty texts have no pieces. A word-begin mark in the text itself decodes
as a blank, as in the library this vocabulary format comes from. Repeated rows
give repeated results, and an empty table gives an empty one.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm import blocks

MARK = "▁"
REMEMBERED = 300_000  # segments per task, beside those of a run of texts
LONGEST_REMEMBERED = 48
SIDE_BY_SIDE = 16_384  # chains walked at a time
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_BYTE_MARGIN = 10


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``byte_ids[b]`` is the piece of byte ``b``.

    ``changes`` are the characters that the normaliser does not copy, with what it writes.
    """

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    special: frozenset[int]  # never written by the pieces machine
    byte_ids: tuple[int, ...]
    changes: tuple[tuple[str, str], ...] = ((" ", MARK),)

    @staticmethod
    def load(path: str = DEFAULT_MODEL) -> Vocabulary:
        """From a model file; read on the driver only, tasks get its content."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        ids = range(size)
        bytes_of = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
        special = frozenset(
            i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
        )
        return Vocabulary(
            tuple(model.id_to_piece(i) for i in ids),
            tuple(model.get_score(i) for i in ids),
            special,
            tuple(bytes_of[f"<0x{b:02X}>"] for b in range(256)),
        )


class Copying(dict):
    """Arcs that copy what has none yet."""

    def __missing__(self, symbol: str) -> str:
        self[symbol] = symbol
        return symbol


class Normaliser:
    """A deterministic transducer; ``arcs[state][c]`` is what ``c`` writes there.

    Every arc leads to the state ``INSIDE``. A character without an arc is copied, behind
    a word-begin mark in the state ``BEGIN``.
    """

    BEGIN, INSIDE = 0, 1

    def __init__(self, changes: Mapping[str, str]) -> None:
        self.arcs = ({c: MARK + out for c, out in changes.items()}, dict(changes))
        self._inside = Copying(self.arcs[self.INSIDE]).__getitem__

    def compose(self, text: str, state: int) -> str:
        """The chain of symbols that the composition with ``text`` writes."""
        inside = "".join(map(self._inside, text))
        return MARK + inside if state == self.BEGIN and text else inside


class ByteFallback(dict):
    """Arcs by symbol: the weight and the pieces of its bytes."""

    def __init__(self, byte_ids: Sequence[int], weight: float) -> None:
        self.byte_ids, self.weight = byte_ids, weight

    def __missing__(self, symbol: str) -> tuple[float, tuple[int, ...]]:
        ids = tuple(self.byte_ids[b] for b in symbol.encode("utf-8", "surrogatepass"))
        arc = self[symbol] = (self.weight * len(ids), ids)
        return arc


def piece_tree(words: Sequence[tuple[str, int, float]]) -> tuple:
    """The root of the tree of (text, piece, weight): a state is its arcs by symbol, the
    weight of accepting there (infinite if it does not) and the piece written then."""
    far = float("inf")
    best: dict[str, tuple[float, tuple[int, ...]]] = {}
    for text, i, weight in words:
        if text not in best or weight < best[text][0]:
            best[text] = (weight, (i,))
    states: dict[str, tuple] = {"": ({}, far, ())}
    for text in sorted(best):
        for n in range(1, len(text) + 1):
            if text[:n] not in states:
                state = states[text[:n]] = ({}, *best.get(text[:n], (far, ())))
                states[text[: n - 1]][0][text[n - 1]] = state
    return states[""]


class ArcTables:
    """The tree of pieces in arrays, to walk from many places at a time."""

    def __init__(self, root: tuple) -> None:
        states, keys, targets = [root], [], []
        for at, (arcs, _, _) in enumerate(states):  # grows while walked: breadth first
            for symbol, state in arcs.items():
                keys.append(at << 21 | ord(symbol))
                targets.append(len(states))
                states.append(state)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.targets = np.append(np.array(targets, np.int64)[order], 0)
        self.weight = np.array([weight for _, weight, _ in states])
        self.piece = np.array([ids[0] if ids else -1 for _, _, ids in states])

    def arcs(self, symbols: np.ndarray, room: np.ndarray):
        """All pieces in chains of symbols: where each begins, its length, weight and id.
        ``room`` is the number of symbols left in the chain, at each symbol."""
        found = []
        at, state, size = np.arange(len(symbols)), np.zeros(len(symbols), np.int64), 0
        while len(at):
            key = state << 21 | symbols[at + size].astype(np.int64)
            arc = np.searchsorted(self.keys, key)
            hit = self.keys[arc] == key
            at, state, size = at[hit], self.targets[arc[hit]], size + 1
            accepts = np.isfinite(self.weight[state])
            ends = state[accepts]
            found.append((at[accepts], np.full(len(ends), size), self.weight[ends], self.piece[ends]))
            more = room[at] > size
            at, state = at[more], state[more]
        return [np.concatenate(column) for column in zip(*found)]


class Transducer:
    """The compiled machines, with the memory of recent segments."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        words = [
            (text, i, -vocabulary.scores[i])
            for i, text in enumerate(vocabulary.pieces)
            if i not in vocabulary.special and text
        ]
        self.byte_ids = vocabulary.byte_ids
        self.byte_weight = max([w for _, _, w in words], default=0.0) + _BYTE_MARGIN
        self.normaliser = Normaliser(dict(vocabulary.changes))
        self.pieces = piece_tree(words)
        self.fallback = ByteFallback(vocabulary.byte_ids, self.byte_weight)
        longer = [text for text, _, _ in words if len(text) > 1]
        self.segments = re.compile(self._cuts(longer), re.S).findall
        self.memory: dict[str, tuple[bytes, float, bool]] = {}
        self.tables = ArcTables(self.pieces)
        self.written = [
            bytes([b]) if b is not None else text.replace(MARK, " ").encode()
            for text, b in zip(vocabulary.pieces, self._bytes_by_id(len(vocabulary.pieces)))
        ]
        for i in vocabulary.special - set(self.byte_ids):
            self.written[i] = b""
        self.written_length = np.array([len(w) for w in self.written])

    def _cuts(self, longer: list[str]) -> str:
        """Pattern of segments that no piece reaches beyond, given the longer pieces."""
        arcs = self.normaliser.arcs[Normaliser.INSIDE]
        copied = [c for c in f"\n\r\t{MARK}" if c not in arcs]
        lone = [c for c in copied if c != MARK and not any(c in text for text in longer)]
        ends = "".join(map(re.escape, lone))
        begins = "".join(re.escape(c) for c in copied if c == MARK) + "".join(
            re.escape(c) for c, out in arcs.items() if out == MARK
        )
        # A cut before a blank is one if neither a piece nor a change crosses it.
        crossed = any(MARK in text.lstrip(MARK) for text in longer) or any(
            out != MARK and (not out or MARK in out) for out in arcs.values()
        )
        if crossed or not begins:
            return f"[{ends}]|[^{ends}]+" if ends else ".+"
        return f"[{begins}]*[^{begins}{ends}]+|[{begins}]+" + (f"|[{ends}]" if ends else "")

    def _bytes_by_id(self, size: int) -> list[int | None]:
        out: list[int | None] = [None] * size
        for b, i in enumerate(self.byte_ids):
            out[i] = b
        return out

    def shortest_path(self, symbols: str) -> tuple[list[int], float]:
        """Piece ids and weight of the best way through the composition with ``symbols``."""
        n = len(symbols)
        weight = [0.0] + [float("inf")] * n
        origin = [0] * (n + 1)
        written: list[tuple[int, ...]] = [()] * (n + 1)
        root, fallback = self.pieces[0], self.fallback
        for i in range(n):
            here, arcs, j = weight[i], root, i
            while j < n:
                state = arcs.get(symbols[j])
                if state is None:
                    break
                j += 1
                arcs, cost, ids = state
                cost += here
                if cost < weight[j]:
                    weight[j], origin[j], written[j] = cost, i, ids
            cost, ids = fallback[symbols[i]]
            if here + cost < weight[i + 1]:
                weight[i + 1], origin[i + 1], written[i + 1] = here + cost, i, ids
        path = []
        j = n
        while j:
            path.append(written[j])
            j = origin[j]
        return [i for ids in reversed(path) for i in ids], weight[n]

    def _side_by_side(self, chains: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shortest paths of short chains: all ids, their ends by chain, weights."""
        length = np.array([len(c) for c in chains])
        text = "".join(chains)
        symbols = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        # A chain has one place more than symbols; places are numbered through.
        chain = np.repeat(np.arange(len(chains)), length)
        place = np.arange(len(symbols)) + chain
        last = np.cumsum(length + 1) - 1
        first = last - length
        local = place - first[chain]
        origin, size, cost, ids = self.tables.arcs(symbols, length[chain] - local)
        # Byte fallback comes after the pieces from the same place.
        different, which = np.unique(symbols, return_inverse=True)
        bytes_cost = np.array([self.fallback[chr(c)][0] for c in different])
        origin = np.concatenate([origin, np.arange(len(symbols))])
        size = np.concatenate([size, np.ones(len(symbols), np.int64)])
        cost = np.concatenate([cost, bytes_cost[which]])
        ids = np.concatenate([ids, np.full(len(symbols), -1)])
        turn = local[origin] * (int(size.max()) + 1) + size
        order = np.argsort(turn, kind="stable")
        # A turn's arcs come from different chains, hence lead to different places, except
        # that fallback may follow a piece of one symbol.
        turn = turn * 2 + (ids < 0)
        turn, origin, size, cost, ids = (v[order] for v in (turn, origin, size, cost, ids))
        origin = place[origin]
        target = origin + size
        best = np.full(last[-1] + 1, np.inf)
        best[first] = 0
        source, label = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
        edges = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(turn)]
        for low, high in itertools.pairwise(edges):
            to, total = target[low:high], best[origin[low:high]] + cost[low:high]
            less = total < best[to]
            to = to[less]
            best[to] = total[less]
            source[to], label[to] = origin[low:high][less], ids[low:high][less]
        taken = np.zeros(len(best), bool)
        at, start = last, first
        while len(at):
            more = at > start
            at, start = at[more], start[more]
            taken[at] = True
            at = source[at]
        at = np.flatnonzero(taken)
        found, lone = label[at], np.flatnonzero(label[at] < 0)
        spelled = [
            self.fallback[chr(symbols[p - c])][1]
            for p, c in zip(source[at[lone]], np.searchsorted(last, at[lone]))
        ]
        times = np.ones(len(at), np.int64)
        times[lone] = [len(ids) for ids in spelled]
        flat = np.repeat(found, times)
        flat[flat < 0] = [i for ids in spelled for i in ids]
        ends = np.concatenate([[0], np.cumsum(times)])[np.searchsorted(at, last, side="right")]
        return flat.astype(np.int32), ends, best[last]

    def _paths(self, chains: list[str]) -> list[tuple[bytes, float, bool]]:
        """For each chain its ids, its weight and whether the ids write it again."""
        found: list = [None] * len(chains)
        short = [k for k, c in enumerate(chains) if 0 < len(c) <= LONGEST_REMEMBERED]
        for low in range(0, len(short), SIDE_BY_SIDE):
            rows = short[low : low + SIDE_BY_SIDE]
            own = [chains[k] for k in rows]
            ids, ends, weights = self._side_by_side(own)
            want = [c.replace(MARK, " ").encode("utf-8", "replace") for c in own]
            sums = np.concatenate([[0], np.cumsum(self.written_length[ids])])[ends]
            back = b"".join([self.written[i] for i in ids.tolist()])
            same = np.diff(sums, prepend=0) == [len(w) for w in want]
            if back != b"".join(want):
                edges = [0, *sums.tolist()]
                same &= [back[a:b] == w for a, b, w in zip(edges, edges[1:], want)]
            raw, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
            cut = zip(rows, edges, edges[1:], weights.tolist(), same.tolist())
            for k, a, b, weight, good in cut:
                found[k] = (raw[a:b], weight, good)
        for k, chain in enumerate(chains):
            if found[k] is None:
                path, weight = self.shortest_path(chain)
                back = b"".join([self.written[i] for i in path])
                good = back == chain.replace(MARK, " ").encode("utf-8", "replace")
                found[k] = (np.array(path, np.int32).tobytes(), weight, good)
        return found

    def encode_all(self, texts: Sequence[str]) -> list[tuple[np.ndarray, float, bool]]:
        """For each whole text its ids, their weight and whether they decode to it."""
        cut = [self.segments(text) for text in texts]
        used = {s for segments in cut for s in segments[1:]}
        new = [s for s in used if s not in self.memory]
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory = {s: path for s, path in self.memory.items() if s in used}
        compose = self.normaliser.compose
        chains = [compose(s, Normaliser.INSIDE) for s in new]
        chains += [compose(segments[0], Normaliser.BEGIN) for segments in cut if segments]
        paths = self._paths(chains)
        memory = self.memory
        memory.update(zip(new, paths))
        begins = iter(paths[len(new) :])
        out = []
        for segments in cut:
            if not segments:
                out.append((np.zeros(0, np.int32), 0.0, True))
                continue
            own = [next(begins), *map(memory.__getitem__, segments[1:])]
            ids, weights, same = zip(*own)
            out.append((np.frombuffer(b"".join(ids), np.int32), sum(weights), all(same)))
        for s in new:
            if len(s) > LONGEST_REMEMBERED:
                del memory[s]
        return out

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        """Ids and weight of a whole text."""
        return self.encode_all([text])[0][:2]

    def decode(self, ids: Sequence[int]) -> str:
        """The text; bytes that are no UTF-8 become the replacement character."""
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def normalised(text: str, changes: Sequence[tuple[str, str]] = Vocabulary.changes) -> str:
    """What decoding gives back."""
    return Normaliser(dict(changes)).compose(text, Normaliser.INSIDE).replace(MARK, " ")


def _shared(docs: DataFrame, vocabulary: Vocabulary):
    return docs.sparkSession.sparkContext.broadcast(vocabulary)


def _rows(batch: pa.RecordBatch, column: str, texts: int = 512) -> Iterator[tuple[int, list]]:
    """Rows in runs of bounded size: (first row, texts)."""
    values = blocks.string_column(batch, column)
    for first, end, _, _ in blocks.blocks(values):
        for at in range(first, end, texts):
            yield at, values.slice(at, min(texts, end - at)).to_pylist()


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns, ``ids``, ``n_pieces``, ``n_bytes``, ``weight``, ``round_trip``.

    ``n_bytes`` counts pieces written by byte fallback; ``round_trip`` says whether
    the ids decode to the (normalised) text.
    """
    source = docs.select(
        *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), F.col(text_col).alias("__text")
    )
    shared = _shared(docs, vocabulary)

    def run(batches):
        machine = Transducer(shared.value)
        is_byte = np.zeros(len(shared.value.pieces), bool)
        is_byte[list(shared.value.byte_ids)] = True
        for batch in batches:
            for first, texts in _rows(batch, "__text"):
                found = machine.encode_all([text or "" for text in texts])
                arrays, weights, same = zip(*found)
                ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
                values = np.concatenate(arrays)
                marked = np.concatenate([[0], np.cumsum(is_byte[values])])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(first, len(texts)) for k in range(len(keep))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.array((marked[ends[1:]] - marked[ends[:-1]]).astype(np.int64)),
                        pa.array(weights, pa.float64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=[*keep, "ids", "n_pieces", "n_bytes", "weight", "round_trip"],
                )

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(
        run,
        f"{kept}, ids array<int>, n_pieces long, n_bytes long, weight double, round_trip boolean",
    )


def decode(
    encoded: DataFrame,
    vocabulary: Vocabulary,
    keep: tuple[str, ...] = ("doc_id",),
    ids_col: str = "ids",
) -> DataFrame:
    """``keep`` columns and ``text``; NULL ids give NULL, ids out of range are an error."""
    source = encoded.select(
        *(F.col(c).alias(f"__{k}") for k, c in enumerate(keep)), F.col(ids_col).alias("__ids")
    )
    shared = _shared(encoded, vocabulary)

    def run(batches):
        machine = Transducer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = part.column(len(keep)).to_pylist()
                texts = [None if i is None else machine.decode(i) for i in ids]
                columns = [part.column(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string())], names=[*keep, "text"]
                )

    kept = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{kept}, text string")
