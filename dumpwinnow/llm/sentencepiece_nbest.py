"""N-best segmentation into the pieces of a SentencePiece model, and decoding.

The lattice of a text has a node between any two characters and an edge for every piece.  A
forward Viterbi pass gives each node the best score of reaching it.  An A* search then runs
backwards from the end: a partial path's promise is its own score plus the Viterbi score of
the node it has come to.  As that heuristic is exact, complete paths leave the agenda in order
of score, and no path outside the N best is ever finished.

No piece of the usual models crosses from a character to a following space mark, so the
lattice falls into units, each a word with the space marks before it, or a line break that no
longer piece holds.  The best path of a text
is that of its units.  Only the N - 1 units with the smallest loss between their best and
second path can differ in the N best of the text; their N best paths become the edges of a
small lattice for the same search.  A model with other pieces is searched text by text.

The files at hand hold a BPE model, whose scores are merge ranks.  By default a piece of rank r
gets the probability 1 / ((r + 1) H) of Zipf's law; `rule="file"` takes the scores as they are,
as for unigram models.  Scores are kept in millionths as integers, so sums and ties are exact.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .rows import by_value, quoted, releasing, value_of
from .text import STEP, U64, expand, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
#: Units whose result a task remembers; beyond it the memory starts anew.
REMEMBERED = 600_000
#: Units whose N best paths a task remembers.
REMEMBERED_PATHS = 150_000
SPACE = "▁"
#: White space that ends a unit and is one itself, where no longer piece holds it.
BREAKS = "\t\n\x0b\f\r"
MILLION = 1_000_000
#: Loss of a unit that has one path only.
NONE = 1 << 62

Edge = tuple[int, int, bytes]  # begin, score, ids


def text_digest(text: str) -> int:
    """64-bit polynomial of the code points, as `analysed_codes` computes it for columns."""
    digest = 0
    for char in text:
        digest = (digest * STEP + ord(char) + 1) % (1 << 64)
    return digest


class PrefixTable:
    """All beginnings of pieces by digest, in a table of slots that its mixed high bits name.

    Nearly every lookup takes one step; only where beginnings share a slot is a digest searched.
    """

    SLOT_BITS = 20

    def __init__(self, pieces: dict[str, tuple[int, int]]):
        heads = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})
        digests = np.array([text_digest(h) for h in heads], U64) * U64(STEP)
        order = np.argsort(digests)
        none = (-1, 0)
        found = [pieces.get(h, none) for h in heads]
        # one more, for what is absent
        self.digests = np.append(digests[order], U64(0))
        self.ids = np.append(np.array([i for i, _ in found], np.int32)[order], np.int32(-1))
        self.scores = np.append(np.array([s for _, s in found], np.int64)[order], 0)
        self.absent = len(heads)
        slot = self.slot(digests[order])
        self.slots = np.full(1 << self.SLOT_BITS, self.absent, np.int32)
        self.slots[slot] = np.arange(len(heads))
        again = slot[1:][slot[1:] == slot[:-1]]
        self.slots[again] = -1  # digests are sorted by slot

    def slot(self, digests: np.ndarray) -> np.ndarray:
        return (digests >> U64(64 - self.SLOT_BITS)).astype(np.int64)

    def look_up(self, digests: np.ndarray) -> np.ndarray:
        """Place of each digest, `absent` for those that begin no piece."""
        digests = digests * U64(STEP)
        place = self.slots[self.slot(digests)]
        crowded = np.flatnonzero(place < 0)
        if len(crowded):
            near = np.searchsorted(self.digests[:-1], digests[crowded])
            place[crowded] = np.minimum(near, self.absent)
        place[self.digests[place] != digests] = self.absent
        return place


class Vocabulary:
    """Pieces with integer scores; bounded by the model's size."""

    def __init__(self, pieces: dict[str, tuple[int, int]], bytes_ids: list[int], spelled: list[bytes]):
        self.pieces = {p: (score, array("i", [i]).tobytes()) for p, (i, score) in pieces.items()}
        self.heads = {p[:k] for p in pieces for k in range(1, len(p) + 1)}
        self.bytes_ids = bytes_ids
        self.byte_pieces = np.array(bytes_ids, np.int32)
        self.spelled = spelled
        self.unknown = min((s for _, s in pieces.values()), default=0) - 10 * MILLION
        self.splits = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        longer = set().union(*[p for p in pieces if len(p) > 1])
        lone = "".join(c for c in BREAKS if c not in longer)
        self.breaks = np.array([ord(c) for c in lone], np.uint32)
        self.longest = max(map(len, pieces), default=1)
        self.table = PrefixTable(pieces)

    def spell(self, char: str) -> bytes:
        """Byte pieces of a character that is no piece."""
        return array("i", [self.bytes_ids[b] for b in char.encode("utf-8", "surrogatepass")]).tobytes()

    def begins(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the units of texts begin: a text, a break, what follows it, marks after others."""
        fresh = np.zeros(len(codes) + 1, bool)
        if self.splits:
            mark = codes == ord(SPACE)
            fresh[1:-1] = mark[1:] & ~mark[:-1]
            low = np.flatnonzero(codes <= ord(max(BREAKS)))
            low = low[np.isin(codes[low], self.breaks)]
            fresh[low] = fresh[low + 1] = True
        fresh[offsets] = True
        return np.flatnonzero(fresh[:-1])

    def edges(self, text: str) -> list[list[Edge]]:
        """For each node the edges that end there."""
        n = len(text)
        found: list[list[Edge]] = [[] for _ in range(n + 1)]
        pieces, heads = self.pieces, self.heads
        for i in range(n):
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in heads:
                    break
                piece = pieces.get(part)
                if piece is not None:
                    found[j].append((i, *piece))
            if text[i] not in pieces:
                found[i + 1].append((i, self.unknown, self.spell(text[i])))
        return found


def load_vocabulary(model: str = MODEL, rule: str = "zipf") -> Vocabulary:
    """Read a model file on the driver."""
    import sentencepiece

    source = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = range(source.vocab_size())
    plain = [
        i for i in ids if not (source.is_byte(i) or source.is_control(i) or source.is_unknown(i) or source.is_unused(i))
    ]
    if rule == "file":
        scores = {i: round(source.get_score(i) * MILLION) for i in plain}
    else:
        harmonic = sum(1 / (r + 1) for r in range(len(plain)))
        scores = {i: round(-math.log((r + 1) * harmonic) * MILLION) for r, i in enumerate(plain)}
    names = [source.id_to_piece(i) for i in ids]
    spelled = [
        b""
        if source.is_control(i)
        else bytes([int(names[i][3:5], 16)])
        if source.is_byte(i)
        else names[i].replace(SPACE, " ").encode()
        for i in ids
    ]
    by_byte = {spelled[i][0]: i for i in ids if source.is_byte(i)}
    unknown = source.unk_id()
    return Vocabulary(
        {names[i]: (i, scores[i]) for i in plain},
        [by_byte.get(b, unknown) for b in range(256)],
        spelled,
    )


def viterbi(edges: list[list[Edge]]) -> tuple[list[int], list[Edge | None]]:
    """Best score of reaching each node, and the edge it ends with (the longest of equals)."""
    best = [0] + [-NONE] * (len(edges) - 1)
    last: list[Edge | None] = [None] * len(edges)
    for j in range(1, len(edges)):
        top, chosen = -NONE, None
        for edge in edges[j]:
            score = best[edge[0]] + edge[1]
            if score > top:
                top, chosen = score, edge
        best[j], last[j] = top, chosen
    return best, last


def best_paths(edges: list[list[Edge]], count: int) -> list[tuple[int, list[Edge]]]:
    """The `count` best paths with their scores, best first, by backward A* search."""
    best, _ = viterbi(edges)
    end = len(edges) - 1
    agenda = [(-best[end], 0, 0, end, None)]  # promise, order of entry, own score, node, path
    entered, found = 1, []
    while agenda and len(found) < count:
        _, _, own, node, path = heapq.heappop(agenda)
        if node == 0:
            steps = []
            while path is not None:
                steps.append(path[0])
                path = path[1]
            found.append((own, steps))
            continue
        for edge in edges[node]:
            if best[edge[0]] > -NONE:
                score = own + edge[1]
                heapq.heappush(agenda, (-(score + best[edge[0]]), entered, score, edge[0], (edge, path)))
                entered += 1
    return found


def analysed(vocabulary: Vocabulary, unit: str) -> tuple[bytes, int, int]:
    """Ids and score of the best path, and the loss of the second best."""
    edges = vocabulary.edges(unit)
    best, last = viterbi(edges)
    n = len(edges) - 1
    steps, on_path, node = [], set(), n
    while node:
        edge = last[node]
        steps.append(edge[2])
        on_path.add((edge[0], node))
        node = edge[0]
    # the second path has an edge that the best one has not
    ahead = [-NONE] * n + [0]
    second = -NONE
    for j in range(n, 0, -1):
        after = ahead[j]
        if after == -NONE:
            continue
        for begin, score, _ in edges[j]:
            rest = after + score
            if rest > ahead[begin]:
                ahead[begin] = rest
            if (begin, j) not in on_path and best[begin] + rest > second:
                second = best[begin] + rest
    steps.reverse()
    return b"".join(steps), best[n], best[n] - second if second > -NONE else NONE


class Analysed(NamedTuple):
    """Best paths of some units: their ids end to end, pieces of each, score, loss of the second best."""

    ids: np.ndarray
    pieces: np.ndarray
    scores: np.ndarray
    losses: np.ndarray

    def where(self, some: np.ndarray) -> Analysed:
        return Analysed(self.ids[np.repeat(some, self.pieces)], *[column[some] for column in self[1:]])


def analysed_codes(vocabulary: Vocabulary, codes: np.ndarray) -> tuple[Analysed, np.ndarray]:
    """`analysed` for a column of code points for each unit, and where a character is no piece.

    The ids of the latter units hold -1.  Each node keeps the two best scores of reaching it, so
    one pass forward tells the best path and the second.
    """
    n, count = codes.shape
    width = min(n, vocabulary.longest)
    worst = -(1 << 60)
    best, second = np.full((n + 1, count), worst), np.full((n + 1, count), worst)
    # by node: where the best path's last edge begins, and its piece
    last, piece = np.zeros((n + 1, count), np.int64), np.full((n + 1, count), -1, np.int32)
    best[0] = 0
    table = vocabulary.table
    raised = codes + U64(1)
    rows = np.arange(count)
    for i in range(n):
        live, digest = rows, np.zeros(count, U64)
        for k in range(min(width, n - i)):
            digest = digest * U64(STEP) + raised[i + k, live]
            place = table.look_up(digest)
            ids = table.ids[place]
            if k == 0:
                own = table.scores[place]
                unknown = np.flatnonzero(ids < 0)
                own[unknown] = vocabulary.unknown
                unknown = unknown[codes[i, unknown] < U64(128)]  # one byte, one id
                ids[unknown] = vocabulary.byte_pieces[codes[i, unknown].astype(np.int64)]
                having = rows
            else:
                whole = np.flatnonzero(ids >= 0)
                having, ids, own = live[whole], ids[whole], table.scores[place[whole]]
            j = i + k + 1
            if len(having):
                reached, held = best[i][having] + own, best[j][having]
                behind = np.maximum(second[j][having], second[i][having] + own)
                second[j][having] = np.maximum(behind, np.minimum(reached, held))
                better = np.flatnonzero(reached > held)
                having = having[better]
                best[j][having] = reached[better]
                last[j][having] = i
                piece[j][having] = ids[better]
            stay = np.flatnonzero(place < table.absent)
            live, digest = live[stay], digest[stay]
            if not len(live):
                break
    on_path = np.zeros((count, n), bool)
    live, node = rows, np.full(count, n)
    while len(live):
        on_path[live, node - 1] = True
        node = last[node, live]
        live, node = live[node > 0], node[node > 0]
    chosen = piece[1:].T
    loss = np.where(second[n] > worst // 2, best[n] - second[n], NONE)
    found = Analysed(chosen[on_path], on_path.sum(axis=1), best[n], loss)
    return found, (on_path & (chosen < 0)).any(axis=1)


def analysed_together(vocabulary: Vocabulary, units: list[str]) -> list[tuple[bytes, int, int] | None]:
    """`analysed` for many units of one length at once; None where a character is no piece."""
    codes = code_points("".join(units)).reshape(len(units), -1).T.astype(U64)
    found, spelled = analysed_codes(vocabulary, codes)
    cuts = np.cumsum(found.pieces)[:-1]
    rows = zip(np.split(found.ids, cuts), found.scores.tolist(), found.losses.tolist(), spelled, strict=True)
    return [None if alone else (ids.tobytes(), score, loss) for ids, score, loss, alone in rows]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def unit_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each unit, a character of all units at a time."""
    size = (end - begin).astype(np.int16)
    order = np.argsort(-size, kind="stable")
    place = begin[order]
    longer = len(order) - np.cumsum(np.bincount(size))  # by length
    hashes = mix(size[order].astype(U64))
    for k, count in enumerate(longer[:-1].tolist()):
        some = hashes[:count]
        some ^= codes[place[:count] + k]
        some *= U64(STEP)
        some ^= some >> U64(29)
    found = np.empty_like(hashes)
    found[order] = mix(hashes)
    return found


#: Longer units are analysed one by one, and others this many at a time.
LONG_UNIT = 24
TOGETHER = 4096


class Units(NamedTuple):
    """Some texts with their marks, end to end: text r has units first[r] to first[r + 1]."""

    marked: str
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    number: np.ndarray

    def unit(self, k: int) -> str:
        return self.marked[self.begin[k] : self.end[k]]


class Encoder:
    """Segments texts; remembers units."""

    def __init__(self, vocabulary: Vocabulary, count: int):
        self.vocabulary, self.count = vocabulary, count
        self.paths_of: dict[str, list[tuple[int, bytes]]] = {}
        self.forget()

    def forget(self) -> None:
        self.long: dict[str, int] = {}  # number of each long unit
        # of the others by hash, in order
        self.hashes, self.numbers = np.zeros(0, U64), np.zeros(0, np.int64)
        # by number
        self.known = Analysed(np.zeros(0, np.int32), *[np.zeros(0, np.int64)] * 3)
        self.place = np.zeros(0, np.int64)  # where the ids begin

    def remember(self, found: list[Analysed]) -> np.ndarray:
        """Numbers given to units."""
        low = len(self.known.pieces)
        self.known = Analysed(*map(np.concatenate, zip(self.known, *found, strict=True)))
        self.place = np.cumsum(self.known.pieces) - self.known.pieces
        return np.arange(low, len(self.known.pieces))

    def analysed(self, units: list[str]) -> Analysed:
        """Units one by one."""
        found = [analysed(self.vocabulary, unit) for unit in units]
        ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
        return Analysed(ids, *np.array([(len(f[0]) // 4, *f[1:]) for f in found], np.int64).reshape(-1, 3).T)

    def n_best(self, unit: str) -> list[tuple[int, bytes]]:
        """Score and ids of the unit's best paths."""
        found = self.paths_of.get(unit)
        if found is None:
            if len(self.paths_of) >= REMEMBERED_PATHS:
                self.paths_of.clear()
            paths = best_paths(self.vocabulary.edges(unit), self.count)
            found = self.paths_of[unit] = [(s, b"".join([e[2] for e in steps])) for s, steps in paths]
        return found

    def learn(self, texts: list[str]) -> Units:
        """Units of some texts, of which new ones are analysed together."""
        # a space mark in front, spaces as marks; nothing for an empty text
        marked = "".join([SPACE + text for text in texts if text]).replace(" ", SPACE)
        codes = code_points(marked)
        offsets = np.cumsum([0, *[len(text) + 1 if text else 0 for text in texts]])
        begin = self.vocabulary.begins(codes, offsets)
        end = np.append(begin[1:], len(codes))
        if len(self.known.pieces) >= REMEMBERED:
            self.forget()
        units = Units(marked, begin, end, np.searchsorted(begin, offsets), np.zeros(len(begin), np.int64))
        long = (end - begin > LONG_UNIT) | (not self.vocabulary.splits)
        self.number_long(units, np.flatnonzero(long))
        self.number_short(units, np.flatnonzero(~long), codes)
        return units

    def number_long(self, units: Units, at: np.ndarray) -> None:
        names = [units.unit(k) for k in at.tolist()]
        new = list(set(names).difference(self.long))
        if new:
            self.long.update(zip(new, self.remember([self.analysed(new)]).tolist(), strict=True))
        units.number[at] = [self.long[name] for name in names]

    def number_short(self, units: Units, at: np.ndarray, codes: np.ndarray) -> None:
        if not len(at):
            return
        hashes, which = np.unique(unit_hashes(codes, units.begin[at], units.end[at]), return_inverse=True)
        found = np.searchsorted(self.hashes, hashes)
        known = found < len(self.hashes)
        known[known] = self.hashes[found[known]] == hashes[known]
        numbers = np.zeros(len(hashes), np.int64)
        numbers[known] = self.numbers[found[known]]
        new = np.flatnonzero(~known)
        if len(new):
            one = np.zeros(len(hashes), np.int64)
            one[which] = at  # some unit of each hash
            numbers[new] = self.analyse(units, one[new], codes)
            every = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(every, kind="stable")
            self.hashes = every[order]
            self.numbers = np.concatenate([self.numbers, numbers[new]])[order]
        units.number[at] = numbers[which]

    def analyse(self, units: Units, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Numbers of new short units."""
        begin, size = units.begin[at], units.end[at] - units.begin[at]
        found, rows, alone = [], [], []
        for n in np.unique(size).tolist():
            same = np.flatnonzero(size == n)
            for low in range(0, len(same), TOGETHER):
                part = same[low : low + TOGETHER]
                columns = codes[begin[part] + np.arange(n)[:, None]].astype(U64)
                paths, spelled = analysed_codes(self.vocabulary, columns)
                if spelled.any():
                    alone.append(part[spelled])
                    paths, part = paths.where(~spelled), part[~spelled]
                found.append(paths)
                rows.append(part)
        if alone:
            rows += alone
            found.append(self.analysed([units.unit(k) for k in at[np.concatenate(alone)].tolist()]))
        numbers = np.zeros(len(at), np.int64)
        numbers[np.concatenate(rows)] = self.remember(found)
        return numbers

    def encode(self, text: str) -> tuple[bytes, int, list[tuple[int, list[tuple[int, int, bytes]]]]]:
        """Ids and score of the best path; further paths as score and edits of the ids."""
        ids, _, scores, more = self.encode_all([text])
        return ids.tobytes(), int(scores[0]), more[0]

    def encode_all(
        self, texts: list[str]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[tuple[int, list[tuple[int, int, bytes]]]]]]:
        """Ids of all texts end to end, where each text's begin, scores, further paths.

        An edit (begin, end, ids) puts ids in place of those from begin to end.
        """
        units = self.learn(texts)
        low, pieces = self.place[units.number], self.known.pieces[units.number]
        ids = self.known.ids[expand(low, low + pieces - 1)[0]]
        ends = np.concatenate([[0], np.cumsum(pieces)])
        scores = self.known.scores[units.number]
        sums = np.concatenate([[0], np.cumsum(scores)])[units.first]
        losses = self.known.losses[units.number]
        more = []
        for a, b in zip(units.first[:-1].tolist(), units.first[1:].tolist(), strict=True):
            chosen = a + smallest(losses[a:b], self.count - 1)
            more.append(self.further(units, chosen, ids, ends, a, scores) if len(chosen) else [])
        totals = np.diff(sums)
        for row, paths in enumerate(more):
            more[row] = [(int(totals[row]) + gain, edits) for gain, edits in paths]
        return ids, ends[units.first], totals, more

    def further(
        self, units: Units, chosen: np.ndarray, ids: np.ndarray, ends: np.ndarray, first: int, scores: np.ndarray
    ) -> list[tuple[int, list[tuple[int, int, bytes]]]]:
        """Gain in score and edits of a text's next best paths, which differ in the chosen units."""
        base = int(scores[chosen].sum())
        own_ids = [ids[a:b].tobytes() for a, b in zip(ends[chosen].tolist(), ends[chosen + 1].tolist(), strict=True)]
        places = (ends[chosen] - ends[first]).tolist()
        lattice: list[list[Edge]] = [[]]
        for place, k in enumerate(chosen.tolist()):
            lattice.append([(place, s, found) for s, found in self.n_best(units.unit(k))])
        more = []
        for own, steps in best_paths(lattice, self.count)[1:]:
            edits = []
            for old, place, (_, _, new) in zip(own_ids, places, steps, strict=True):
                if new != old:
                    edits.append((place, place + len(old) // 4, new))
            more.append((own - base, edits))
        return more


def smallest(losses: np.ndarray, count: int) -> np.ndarray:
    """Places of the `count` smallest losses that are none, the first of equal ones, in order."""
    if count < 1:
        return np.zeros(0, np.int64)
    if len(losses) > count:
        limit = np.partition(losses, count - 1)[count - 1]
        below = np.flatnonzero(losses < limit)
        tied = np.flatnonzero(losses == limit)[: count - len(below)]
        found = np.sort(np.concatenate([below, tied]))
    else:
        found = np.arange(len(losses))
    return found[losses[found] < NONE]


ENCODED = (
    "doc_id long, ids array<int>, score double, "
    "more array<struct<score double, edits array<struct<begin int, end int, ids array<int>>>>>"
)
MORE = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            (
                "edits",
                pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32()))])),
            ),
        ]
    )
)
#: Texts turned into one batch of rows.
ROWS = 800


def numbers(ids: bytes) -> list[int]:
    return np.frombuffer(ids, np.int32).tolist()


def encode_rows(shared: Broadcast, count: int):
    """Task: texts to ids, score and further paths."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(value_of(shared), count)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                texts = part["text"].to_pylist()
                ids, ends, scores, found = encoder.encode_all(texts)
                more = [
                    [
                        {
                            "score": s / MILLION,
                            "edits": [{"begin": a, "end": b, "ids": numbers(new)} for a, b, new in edits],
                        }
                        for s, edits in paths
                    ]
                    for paths in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                        pa.array(scores / MILLION),
                        pa.array(more, MORE),
                    ],
                    ["doc_id", "ids", "score", "more"],
                )

    return task


def decode_rows(shared: Broadcast):
    """Task: add the text that ids spell."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = value_of(shared).spelled
        for batch in batches:
            texts = []
            for row in batch["ids"]:
                raw = b"".join(map(spelled.__getitem__, row.values.to_numpy().tolist())) if row.is_valid else b""
                # the first space mark is the one that encoding put in front
                texts.append(raw.removeprefix(b" ").decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return task


def shared_vocabulary(spark: SparkSession, model: str = MODEL, rule: str = "zipf") -> Broadcast:
    """Bounded by the model file: some ten thousand pieces."""
    return by_value(spark.sparkContext, load_vocabulary(model, rule))


def encode(
    docs: DataFrame,
    vocabulary: Broadcast,
    doc_id: str = "doc_id",
    text: str = "text",
    count: int = BEST,
) -> DataFrame:
    """Per row: doc_id, ids and score of the best segmentation, more (the next best ones).

    `more` has up to count - 1 entries, best first, each with its score and its edits of ids.
    A null or empty text has no ids, score 0 and no more.  Of equal scores the path whose last
    pieces are longer comes first.  A character that is no piece is spelled in byte pieces; a
    space mark in the text counts as a space.  Ids may be null or repeat.  Columns other than
    the two named are ignored.
    """
    rows = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text")
    )
    return rows.mapInArrow(releasing(encode_rows(vocabulary, count)), ENCODED)


def decode(encoded: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """Add the text of column `ids` as `decoded`; null ids give an empty text."""
    columns = StructType([*encoded.schema, StructField("decoded", StringType())])
    return encoded.mapInArrow(releasing(decode_rows(vocabulary)), columns)
