"""SentencePiece encoding and decoding as shortest paths through weighted transducers.

A model is compiled into states and weighted arcs over characters: the normaliser (a space becomes the escape sign, one
more goes before the text), the pieces, whose ends lead back to the start at the piece's weight, and byte fallback, an arc
for any character at a weight above all pieces. Composed with a text, the machine has a state per place; the best
segmentation is the shortest path in the tropical semiring. In unigram models a piece weighs its negative score. In BPE
models all pieces weigh nothing, and one more machine gives infinite weight to two neighbours that merging in order of
the scores would not leave side by side; one path of finite weight is left, which is the model's own result.

No piece may contain the escape sign after another character (checked when a model is compiled), so a text falls
into segments that are solved one by one, and the paths of common segments are remembered.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refrain.llm.common import as_bytes, map_rows, with_columns

#: The sign that stands for a space, kinds of pieces and of models in the file format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
#: Segments (twice, for two generations) and neighbours that a worker remembers, and the length from which a segment isn't
#: remembered; some 100 MB in all.
CACHED_SEGMENTS, CACHED_PAIRS, LONG = 250_000, 400_000, 48
#: What byte fallback weighs more than the heaviest piece.
PENALTY = 10.0
#: The arc of byte fallback, which has no piece; what ids beyond the vocabulary decode to.
FALLBACK, NO_PIECE = -1, "\ufffd".encode()
#: Fixed value: what the unknown piece decodes to.
UNKNOWN_SIGN = " ⁇ ".encode()

_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Transducer:
    """The machines of one model, composed segment by segment."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int):
        self.kind = kind
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.weights = {p: -s for p, s, t in pieces if t == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece goes beyond the end of a word")
        self.names = [p for p, _, _ in pieces]
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.fallback = max(self.weights.values()) + PENALTY
        self.costs = [self.weights.get(p, self.fallback) for p in self.names]
        self.arcs, self.ends = self._compiled()
        self.output = [self._bytes(p, t) for p, _, t in pieces]
        self.segments: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _compiled(self) -> tuple[list[dict[str, int]], list[int]]:
        """The states of the pieces: arcs by character, and the piece that ends in a state, if one does."""
        arcs: list[dict[str, int]] = [{}]
        ends = [FALLBACK]
        for piece, number in self.ids.items():
            state = 0
            for letter in piece:
                following = arcs[state].get(letter)
                if following is None:
                    following = arcs[state][letter] = len(arcs)
                    arcs.append({})
                    ends.append(FALLBACK)
                state = following
            ends[state] = number
        none: dict[str, int] = {}
        return [a or none for a in arcs], ends

    @staticmethod
    def _bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return UNKNOWN_SIGN
        return piece.replace(SPACE, " ").encode() if kind == NORMAL else b""

    def __getstate__(self):
        return self.__dict__ | {"segments": {}, "earlier": {}, "pairs": {}}

    def neighbours(self, a: int, b: int) -> bool:
        """May piece ``b`` follow piece ``a``? Merging the text of both, the pair of the best score first and the leftmost of
        equals, must never join a part of one with a part of the other."""
        key = a * len(self.names) + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(self.names[a], self.names[b])
        return known

    def _stay_apart(self, a: str, b: str) -> bool:
        weights, never = self.weights, float("inf")
        parts, border = [*a, *b], len(a) - 1  # the pair at the border is the last part of a with the first of b
        costs = [weights.get(x + y, never) for x, y in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best == never:
                break
            i = costs.index(best)
            if i == border:
                return False
            border -= i < border
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = weights.get(parts[i - 1] + parts[i], never)
            if i < len(costs):
                costs[i] = weights.get(parts[i] + parts[i + 1], never)
        return len(parts) == 2

    def path(self, segment: str) -> list[str]:
        """Pieces and unknown characters on the shortest path."""
        out, at = [], 0
        for number in self._path(segment):
            out.append(segment[at] if number == FALLBACK else self.names[number])
            at += len(out[-1])
        return out

    def _path(self, segment: str) -> list[int]:
        return self._finite_path(segment) if self.kind == BPE else self._lightest_path(segment)

    def leaving(self, segment: str, at: int) -> list[tuple[int, int]]:
        """The arcs of the composed machine from a place on: pieces, shorter ones first, and where they end."""
        arcs, ends, state, found = self.arcs, self.ends, 0, []
        for end in range(at, len(segment)):
            state = arcs[state].get(segment[end])
            if state is None:
                break
            number = ends[state]
            if number >= 0:
                found.append((number, end + 1))
        return found if found and found[0][1] == at + 1 else [(FALLBACK, at + 1), *found]

    def _lightest_path(self, segment: str) -> list[int]:
        """Place by place; of paths of equal weight that with fewer, then longer last pieces."""
        best: list[tuple[float, int, int, int]] = [(0.0, 0, 0, FALLBACK), *[(float("inf"), 0, 0, FALLBACK)] * len(segment)]
        for at in range(len(segment)):
            weight, n = best[at][:2]
            for number, end in self.leaving(segment, at):
                cost = self.fallback if number == FALLBACK else self.costs[number]
                best[end] = min(best[end], (weight + cost, n + 1, at, number))
        out, at = [], len(segment)
        while at:
            out.append(best[at][3])
            at = best[at][2]
        return out[::-1]

    def _finite_path(self, segment: str) -> list[int]:
        """All weights are zero or infinite, so the first path that comes through is the shortest.

        Longer pieces are tried first. What has been read up to a place ends in one way only, so a place that leads
        nowhere is never entered again.
        """
        size, pairs, width = len(segment), self.pairs, len(self.names)
        arcs, ends = self.arcs, self.ends
        out: list[int] = []
        places: list[int] = []
        choices: list[list[tuple[int, int]]] = []
        at, before, dead = 0, FALLBACK, set()
        while at < size:
            if len(choices) == len(out):  # a new place
                state, end, found = 0, at, []
                for letter in segment[at:]:
                    state = arcs[state].get(letter)
                    if state is None:
                        break
                    end += 1
                    if ends[state] >= 0:
                        found.append((ends[state], end))
                choices.append(found or [(FALLBACK, at + 1)])
            tried = choices[-1]
            while tried:
                number, end = tried.pop()
                if dead and end in dead:
                    continue
                if before >= 0 and number >= 0:
                    apart = pairs.get(before * width + number)
                    if not (self.neighbours(before, number) if apart is None else apart):
                        continue
                out.append(number)
                places.append(at)
                at, before = end, number
                break
            else:
                if not out:
                    raise ValueError(f"no path for {segment!r}")
                dead.add(at)
                choices.pop()
                out.pop()
                at = places.pop()
                before = out[-1] if out else FALLBACK
        return out

    def __getitem__(self, segment: str) -> bytes:
        """Ids of the pieces of ``segment`` as 32-bit integers; remembered by the two latest generations."""
        known = self.segments.get(segment)
        if known is None:
            known = self.earlier.get(segment)
            if known is None:
                known = self._solved(segment)
            if len(segment) < LONG:
                if len(self.segments) >= CACHED_SEGMENTS:
                    self.earlier, self.segments = self.segments, {}
                self.segments[segment] = known
        return known

    def _solved(self, segment: str) -> bytes:
        """Cut where no piece can lie across, unless all are letters; then by the shortest path."""
        if not segment[1:].isalpha():
            cuts = [i for i in range(1, len(segment)) if segment[i - 1 : i + 1] not in self.inside]
            if cuts:
                return b"".join(self[segment[a:b]] for a, b in zip([0, *cuts], [*cuts, len(segment)]))
        found = self._path(segment)
        if FALLBACK in found:
            ids: list[int] = []
            at = 0
            for number in found:
                ids += [number] if number >= 0 else [self.byte_ids[b] for b in segment[at].encode()]
                at += len(self.names[number]) if number >= 0 else 1
            found = ids
        return array("i", found).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        get, solve = self.segments.get, self.__getitem__
        found = _SEGMENT.findall(SPACE + text.replace(" ", SPACE))
        return b"".join([get(x) or solve(x) for x in found])

    def decode(self, ids: list[int]) -> bytes:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        return decoded(ids, self.output)


def decoded(ids: list[int], output: list[bytes]) -> bytes:
    """The bytes of pieces without the space before the text; ids outside of the vocabulary give a replacement character."""
    if ids and (min(ids) < 0 or max(ids) >= len(output)):
        parts = [output[i] if 0 <= i < len(output) else NO_PIECE for i in ids]
    else:
        parts = list(map(output.__getitem__, ids))
    out = b"".join(parts)
    return out[1:] if out[:1] == b" " and next(filter(None, parts)) != UNKNOWN_SIGN else out


def load(path: str) -> Transducer:
    """Compile the model file at ``path``, which the driver reads; its vocabulary is what tasks get."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
        raise ValueError("only models that normalise nothing but spaces can be compiled")
    if model.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be compiled")
    if other := [p.piece for p in model.pieces if p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE)]:
        raise ValueError(f"user-defined and unused pieces can't be compiled, as {other[0]!r}")
    return Transducer([(p.piece, p.score, p.type) for p in model.pieces], model.trainer_spec.model_type)


def encode(docs: DataFrame, model: str, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """``docs`` plus ``tokens``, the ids of the pieces of the whole text, in order.

    A null text gives null, an empty one no ids. A column named like the new one is replaced, all others are passed
    on. Repeated rows are encoded one by one; an empty table gives no rows. Nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load(model))
    chosen = docs.drop(tokens)

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        encoded, ends = bytearray(), [0]
        for value in batch[text]:
            if value.is_valid:
                encoded += sent.value.encode(value.as_py())
            ends.append(len(encoded) // 4)
        ids = pa.array(np.frombuffer(encoded, np.int32))
        return batch | {tokens: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids, mask=batch[text].is_null())}

    return map_rows(chosen, with_columns(chosen, f"`{tokens}` array<int>"), rows)


def decode(docs: DataFrame, model: str, tokens: str = "tokens", text: str = "text") -> DataFrame:
    """``docs`` plus ``text``, the text of ``tokens``; the inverse of ``encode`` but for escape signs in the text.

    Null tokens give null, none an empty text, control pieces and null ids nothing, the unknown piece its sign, and ids
    that the vocabulary doesn't have a replacement character each. A column named like the new one is replaced. Tasks get
    the bytes of each piece and none of the machines.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load(model).output)
    chosen = docs.drop(text)

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        out = []
        for value in batch[tokens]:
            ids = value.values.drop_null().to_numpy().tolist() if value.is_valid else None
            out.append(None if ids is None else decoded(ids, sent.value).decode("utf-8", "replace"))
        return batch | {text: out}

    return map_rows(chosen, with_columns(chosen, f"`{text}` string"), rows)
