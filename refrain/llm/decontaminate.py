"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refrain.llm.common import as_bytes, map_rows
from refrain.sources.scratch import settle

#: Consecutive words of an item that may not occur in a document.
WINDOW = 13
#: Items are worked through in blocks of about so many words; one automaton of a block is sent to the tasks.
BLOCK_WORDS = 100_000

#: Bytes of words. A-Z are lowered; white space, signs and control characters separate.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over word numbers: its states are the sets of end positions of item substrings."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = []
        for item, words in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            numbered.append((item, numbers))
            last = 0
            for number in numbers:
                last = self._extend(last, number)
        self.shortest = min((min(window, len(n)) for _, n in numbered if n), default=0)
        size = len(self.vocabulary) + 1
        self.pairs = np.unique(np.array([a * size + b for _, n in numbered for a, b in zip(n, n[1:])], np.int64))
        self._mark(numbered)

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._copy(last, symbol, known)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = state
            at = self.link[at]
        if at >= 0:
            known = self.next[at][symbol]
            fits = self.length[known] == self.length[at] + 1
            self.link[state] = known if fits else self._copy(at, symbol, known)
        return state

    def _state(self, length: int, steps: dict[int, int], link: int) -> int:
        self.next.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _copy(self, at: int, symbol: int, known: int) -> int:
        """The shorter strings of ``known`` get a state of their own."""
        state = self._state(self.length[at] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = state
        while at >= 0 and self.next[at].get(symbol) == known:
            self.next[at][symbol] = state
            at = self.link[at]
        return state

    def _holding(self, state: int, length: int) -> int:
        """The state of the last ``length`` symbols of a match in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _mark(self, numbered) -> None:
        """Note at each state the items whose windows, or whole short texts, it stands for."""
        full: dict[int, set[str]] = {}
        short: dict[int, set[tuple[int, str]]] = {}
        for item, numbers in numbered:
            state, size = 0, len(numbers)
            for i, number in enumerate(numbers):
                state = self._holding(self.next[state][number], min(i + 1, self.window))
                if i + 1 >= self.window:
                    full.setdefault(state, set()).add(item)
            if 0 < size < self.window:
                short.setdefault(state, set()).add((size, item))
        self.full, self.short = full, short
        self.upper = [0] * len(self.next)  # the next state up the links that stands for a short item
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.upper[state] = up if up in short else self.upper[up]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items of those windows."""
        hit, found = np.zeros(len(words), bool), set()
        if not self.shortest or len(words) < self.shortest:
            return hit, found
        get = self.vocabulary.get
        numbers = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        for start, end in self._stretches(numbers):
            state = length = 0
            for i, number in enumerate(numbers[start:end].tolist(), start):
                while state and number not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                step = self.next[state].get(number)
                state, length = (step, length + 1) if step is not None else (0, 0)
                if length >= self.window:
                    state = self._holding(state, self.window)
                    length = self.window
                    hit[i + 1 - self.window : i + 1] = True
                    found |= self.full[state]
                at = state if state in self.short else self.upper[state]
                while at:
                    for size, item in self.short[at]:
                        if size <= length:
                            hit[i + 1 - size : i + 1] = True
                            found.add(item)
                    at = self.upper[at]
        return hit, found

    def _stretches(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """Stretches in which every two neighbours are neighbours in an item too; nothing matches beyond their ends."""
        known = numbers > 0
        both = np.flatnonzero(known[:-1] & known[1:])
        linked = np.zeros(len(numbers) - 1, bool)
        if len(self.pairs) and len(both):
            values = numbers[both] * (len(self.vocabulary) + 1) + numbers[both + 1]
            place = np.minimum(np.searchsorted(self.pairs, values), len(self.pairs) - 1)
            linked[both] = self.pairs[place] == values
        cuts = np.flatnonzero(~linked) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(numbers)]))
        keep = (ends - starts >= self.shortest) & known[starts]
        return list(zip(starts[keep].tolist(), ends[keep].tolist()))


def runs(mask: np.ndarray) -> list[int]:
    """Starts and ends of the runs of true values, alternating."""
    return np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))).tolist()


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``hit_runs`` (word numbers, start and end alternating) and ``hit_items`` (sorted).

    Words are lower-cased in A-Z. A word is hit if it lies in an occurrence of ``window`` consecutive words of an
    item, or of a whole item of fewer words. The items are read in blocks of about ``block_words``; each block costs
    one pass over the documents, without a shuffle, so neither table has to fit anywhere.

    A null or empty text has no words and no hits; an empty item hits nothing; a null item id counts as ''; items
    with one id count as one item; an empty item table hits nothing. Repeated documents are judged one by one.
    Columns of ``docs`` that have one of the new names are replaced.
    """
    new = ("n_words", "hit_runs", "hit_items")
    chosen = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    size = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = chosen.filter("text IS NOT NULL").agg(F.sum(size)).first()[0] or 0
    blocks = -(-total // block_words) or 1
    chosen = chosen.filter("text IS NOT NULL").withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    found = docs.drop(*new).withColumns(
        {"n_words": F.lit(0).cast("long"), "hit_runs": F.array().cast("array<long>"), "hit_items": F.array().cast("array<string>")}
    )
    for block in range(blocks):
        rows = chosen.filter(F.col("block") == block).select("item", "text").collect()
        automaton = Automaton(sorted((r.item, words_of(r.text.encode())) for r in rows), window)
        found = _one_block(found, automaton, text)
        if block + 1 < blocks:
            found = settle(found, "hits")
    return found


def _one_block(docs: DataFrame, automaton: Automaton, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(automaton)

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        sizes, all_runs, all_items = [], [], []
        before = zip(batch["hit_runs"].to_pylist(), batch["hit_items"].to_pylist())
        for data, (old_runs, old_items) in zip(as_bytes(batch[text]), before):
            words = words_of(data)
            hit, found = sent.value.scan(words)
            for a, b in zip(old_runs[::2], old_runs[1::2]):
                hit[a:b] = True
            sizes.append(len(words))
            all_runs.append(runs(hit) if hit.any() else [])
            all_items.append(sorted(found.union(old_items)))
        return batch | {"n_words": sizes, "hit_runs": all_runs, "hit_items": all_items}

    return map_rows(docs, docs.schema, rows)


def is_contaminated(share: int = 20):
    """At least one in ``share`` words of a document is hit."""
    hits = hit_words()
    return (hits > 0) & (F.lit(share) * hits >= F.col("n_words"))


def hit_words():
    """Number of hit words."""
    return F.aggregate(
        F.transform("hit_runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x
    )


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", share: int = 20, **options) -> DataFrame:
    """``docs`` without those of which one in ``share`` words or more is hit, and without the hit spans of the rest.

    A span goes from the first to the last byte of a run of hit words. Documents without a hit stay as they are.
    Nulls, empty texts and clashing names as in ``find_items``.
    """
    held = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = find_items(held, items, **options).filter(~is_contaminated(share)).select("row", "text", "hit_runs")

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        cut = []
        for data, spans in zip(as_bytes(batch["text"]), batch["hit_runs"].to_pylist()):
            cut.append(without(data, spans) if spans else data)
        return batch | {"text": pa.array(cut, pa.binary()).cast(pa.string())}

    cleaned = map_rows(found, found.schema, rows)
    return cleaned.select(*(F.col("text" if c == text else f"row.`{c}`").alias(c) for c in docs.columns))


def without(data: bytes, spans: list[int]) -> bytes:
    """``data`` without the words that lie in the runs ``spans``."""
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    kept, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        kept.append(data[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, data[at:]])
