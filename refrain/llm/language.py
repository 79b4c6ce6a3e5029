"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import LOWER_CASE, as_bytes, drawn, map_rows, stretch, with_columns

#: Bytes of the longest context.
ORDER = 4
#: Training texts of a language, characters that are taken of a text, and of all texts together: the bound of what is
#: learned from, and so of what the driver holds.
TEXTS, CHARACTERS, ALL_CHARACTERS = 400, 20_000, 100_000_000
#: More languages than this are taken for a mistake.
LANGUAGES = 500
#: Bytes that are scored at a time.
CHUNK = 1 << 20
UNKNOWN = "und"

_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(data: bytes) -> bool:
    """Has the text any letter, of whatever script?"""
    return bool(_ASCII_LETTER.search(data)) or any(c.isalpha() for c in data.decode("utf-8", "replace"))


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the ``size`` bytes that end at each byte from the ``ORDER``-th on, with their length."""
    out = np.full(len(data) - ORDER, size + 1, np.uint64)
    for i in range(size):
        out = (out << np.uint64(8)) | data[ORDER - size + 1 + i : len(data) - size + 1 + i]
    return out


def padded(data: bytes) -> bytes:
    """Lower-cased, after a context of line feeds that every text begins with."""
    return b"\n" * ORDER + data.translate(LOWER_CASE)


class HashTable:
    """Numbers to rows, by open addressing, for many at a time."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):
            free = self.rows[slots] < 0
            self.rows[slots[free]] = left[free]  # of several for one slot the last stays
            self.keys[slots[free]] = keys[left[free]]
            lost = self.rows[slots] != left
            left, slots = left[lost], (slots[lost] + 1) & (len(self.rows) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each number, or -1."""
        slots = self._slots(keys)
        out = self.rows[slots]
        left = np.flatnonzero((out >= 0) & (self.keys[slots] != keys))
        while len(left):
            slots[left] = (slots[left] + 1) & (len(self.rows) - 1)
            now = self.rows[slots[left]]
            out[left] = now
            left = left[(now >= 0) & (self.keys[slots[left]] != keys[left])]
        return out


class Models:
    """One context tree per language, with frozen counts, as two tables for all of them.

    In a context with n bytes seen of q kinds, a byte seen c times costs log2((n + q) / c) bits. An unseen one costs an
    escape, log2((n + q) / q), and goes on in the context that is a byte shorter; below the empty context all 256
    bytes are equally likely. A context never seen costs nothing and passes on. ``costs`` holds, for every string of up
    to ``ORDER`` + 1 bytes that any language has seen, the bits its last byte costs each language after the others;
    ``escapes`` holds the bits of the escape for every context. A byte whose longest string no language knows costs
    the escape there plus what it costs after the shorter context.
    """

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        counts = [self._counts(samples[x]) for x in self.languages]
        n, size = len(self.languages), ORDER + 1
        self.costs, self.escapes, self.cost_rows, self.escape_rows = [], [], [], []
        shorter: dict[int, np.ndarray] = {}
        self.floor = np.full(n, 8.0)
        for length in range(1, size + 1):
            known = sorted(set().union(*(c[length] for c in counts)))
            contexts = sorted({self._context(g, length) for g in known})
            place = {c: i for i, c in enumerate(contexts)}
            total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            for j, of in enumerate(counts):
                for gram, count in of[length].items():
                    i = place[self._context(gram, length)]
                    total[i, j] += count
                    kinds[i, j] += 1
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
            cost = np.empty((len(known), n))
            for row, gram in enumerate(known):
                i = place[self._context(gram, length)]
                below = shorter[self._shorter(gram, length)] if length > 1 else self.floor
                seen = np.array([of[length].get(gram, 0) for of in counts], float)
                with np.errstate(divide="ignore"):
                    cost[row] = np.where(seen > 0, np.log2((total[i] + kinds[i]) / np.maximum(seen, 1)), escape[i] + below)
            shorter = dict(zip(known, cost))
            self.costs.append(cost.astype(np.float32))
            self.escapes.append(escape.astype(np.float32))
            self.cost_rows.append(HashTable(np.array(known, np.uint64)))
            self.escape_rows.append(HashTable(np.array(contexts, np.uint64)))

    @staticmethod
    def _counts(texts: list[bytes]) -> list[dict[int, int]]:
        """Counts of the strings of each length in ``texts``."""
        out: list[dict[int, int]] = [{}]
        arrays = [np.frombuffer(padded(t), np.uint8).astype(np.uint64) for t in texts]
        for length in range(1, ORDER + 2):
            all_of = np.concatenate([grams(a, length) for a in arrays] or [np.zeros(0, np.uint64)])
            out.append(dict(zip(*(x.tolist() for x in np.unique(all_of, return_counts=True)))))
        return out

    @staticmethod
    def _context(gram: int, length: int) -> int:
        """All but the last byte."""
        return ((gram >> 8) & ((1 << (8 * (length - 1))) - 1)) | (length << (8 * (length - 1)))

    @staticmethod
    def _shorter(gram: int, length: int) -> int:
        """All but the first byte."""
        return (gram & ((1 << (8 * (length - 1))) - 1)) | (length << (8 * (length - 1)))

    def bits(self, data: np.ndarray) -> np.ndarray:
        """What each byte after the first ``ORDER`` costs each language."""
        out = np.zeros((len(data) - ORDER, len(self.languages)), np.float32)
        left = np.arange(len(out))
        for length in range(ORDER + 1, 0, -1):
            keys = grams(data, length) if len(left) == len(out) else self._some(data, left, length)
            rows = self.cost_rows[length - 1].find(keys)
            known = rows >= 0
            out[left[known]] += self.costs[length - 1][rows[known]]
            left, keys = left[~known], keys[~known]
            if not len(left):
                return out
            mask = np.uint64((1 << (8 * (length - 1))) - 1)
            contexts = ((keys >> np.uint64(8)) & mask) | np.uint64(length << (8 * (length - 1)))
            rows = self.escape_rows[length - 1].find(contexts)
            out[left[rows >= 0]] += self.escapes[length - 1][rows[rows >= 0]]
        out[left] += self.floor.astype(np.float32)
        return out

    @staticmethod
    def _some(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        out = np.full(len(places), size + 1, np.uint64)
        for i in range(size):
            out = (out << np.uint64(8)) | data[places + ORDER - size + 1 + i]
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """The code length in bits of every text under every language."""
        out = np.zeros((len(texts), len(self.languages)))
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            whole = padded(text)
            for start in range(0, len(whole) - ORDER, CHUNK):  # a part begins with the context of its first byte
                part = whole[start : start + CHUNK + ORDER]
                held.append((i, part))
                size += len(part)
                if size >= CHUNK:
                    self._add(out, held)
                    held, size = [], 0
        self._add(out, held)
        return out

    def _add(self, out: np.ndarray, parts: list[tuple[int, bytes]]) -> None:
        if not parts:
            return
        data = np.frombuffer(b"".join(p for _, p in parts), np.uint8).astype(np.uint64)
        bits = np.concatenate((np.zeros((ORDER, out.shape[1]), np.float32), self.bits(data)))
        ends = np.cumsum([len(p) for _, p in parts])
        starts = ends - [len(p) for _, p in parts]
        inner = np.stack((starts + ORDER, ends), axis=1).ravel()[:-1]
        sums = np.add.reduceat(bits, inner, axis=0, dtype=np.float64)[::2]
        np.add.at(out, [i for i, _ in parts], sums)


def train(labelled: DataFrame, text: str, lang: str, key: Column, texts: int = TEXTS, characters: int = CHARACTERS) -> Models:
    """Models of every language in ``labelled``, from ``texts`` texts each.

    Texts are drawn by ``key``, whatever their length; of one of more than ``characters`` a drawn stretch of so many is taken,
    and of all texts of very many languages shorter stretches, so that the driver gets no more than twice
    ``ALL_CHARACTERS``. A text or language that is null, and a key that is, count for nothing. More than ``LANGUAGES`` languages
    end the job with an error.
    """
    usable = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & key.isNotNull())
    usable = usable.select(F.col(lang).alias("lang"), drawn(key).alias("draw"), key.alias("key"), F.col(text).alias("text"))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"{lang} has more than {LANGUAGES} values")
    samples: dict[str, list[bytes]] = {}
    if sizes:
        shares = labelled.sparkSession.createDataFrame([(r.lang, 2 * texts / r.n) for r in sizes], "lang string, share double")
        characters = min(characters, max(1, ALL_CHARACTERS // (texts * len(sizes))))
        some = usable.join(F.broadcast(shares), "lang").filter("draw <= share")
        some = some.select("lang", "draw", stretch(F.col("text"), F.col("key"), characters).alias("text"))
        for row in sorted(some.collect(), key=lambda r: (r.lang, r.draw, r.text)):
            own = samples.setdefault(row.lang, [])
            if len(own) < texts:
                own.append(row.text.encode())
    return Models(samples)


def predict(docs: DataFrame, models: Models, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` plus the language whose model gives the whole text the shortest code, and its posterior probability.

    The probability is that of equal priors; equal code lengths go to the first language by name. A null text, one
    without a letter, or a model without languages gives ``und`` and 0. Columns named like the new ones are replaced,
    all others passed on. Repeated rows are judged one by one; an empty table gives no rows. Nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)
    chosen = docs.drop(*names)

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        own = sent.value
        texts = [b"" if x is None else x for x in as_bytes(batch[text])]
        readable = np.array([has_letter(t) for t in texts], bool) & bool(own.languages)
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        places = np.flatnonzero(readable)
        if len(places):
            lengths = own.lengths([texts[i] for i in places])
            best = lengths.argmin(axis=1)
            least = lengths.min(axis=1, keepdims=True)
            scores[places] = 1 / np.exp2(np.maximum(least - lengths, -1000)).sum(axis=1)
            for i, j in zip(places.tolist(), best.tolist()):
                langs[i] = own.languages[j]
        return batch | {names[0]: langs, names[1]: scores}

    return map_rows(chosen, with_columns(chosen, f"`{names[0]}` string, `{names[1]}` double"), rows)
