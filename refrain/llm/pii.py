"""Personal data: fixed patterns, and a skip-chain conditional random field that adds what resembles their finds.

The field's nodes are the tokens with a digit or an at sign; all others are outside. Neighbouring nodes are linked, and
so is every token with the next one that is repeated or similar, however far apart. Tokens inside a find of the
patterns are observed. Loopy message passing then makes labels agree across the document.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import drawn, map_rows, stretch, with_columns

KINDS = ("email", "ip", "card", "phone")
#: Texts that the weights are learned from, and characters that are taken of a text.
TEXTS, CHARACTERS = 4000, 20_000
#: Rows of the weights (features are hashed), steps of learning, rounds of messages, probability of an added label.
FEATURES, STEPS, ROUNDS, SURE = 1 << 12, 150, 30, 0.9

#: How much the fit holds the weights of links back, so that a few coincidences make no certainty.
LINK_PENALTY = 1e-4

# The patterns. Where a match of the original can't begin inside a run, a look-behind says so.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")

_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'(),.;:!?[]{}<>|"
_OUT = len(KINDS)
_CERTAIN = 60.0

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Does the check digit fit?"""
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def small(number: str) -> bool:
    """At most 255?"""
    number = number.lstrip("0") or "0"
    return len(number) <= 3 and int(number) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    out, done = [], 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            out.append((start, match.end()))
            done = match.end()
    return out


def base_spans(text: str) -> list[Span]:
    """Kind, start and end (code points) of what the patterns find, by kind, then start."""
    if not _HINT.search(text):
        return []
    out: list[Span] = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(small(x) for x in m.groups())]
    for match in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", match[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *match.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return out


def written(spans: list[Span]) -> str:
    """``kind:start:end`` of each, by kind as listed, then start."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


class Tokens:
    """The nodes of a text: spans without the signs around them, features, and links (two nodes and a type)."""

    def __init__(self, text: str):
        self.spans: list[tuple[int, int]] = []
        self.order: list[int] = []
        around: list[tuple[str, str]] = []
        matches = list(_TOKEN.finditer(text))
        for i, match in enumerate(matches):
            word = match[0]
            if _HINT.search(word):
                a = match.start() + len(word) - len(word.lstrip(_EDGES))
                b = match.end() - (len(word) - len(word.rstrip(_EDGES)))
                self.spans.append((a, max(a, b)))
                self.order.append(i)
                around.append(tuple(matches[j][0].lower() if 0 <= j < len(matches) else "" for j in (i - 1, i + 1)))
        self.words = [matches[i][0] for i in self.order]
        self.features = [features(w, *x) for w, x in zip(self.words, around)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours (type 0), next token of the same short (1) or long (2) key."""
        found: dict[tuple[int, int], int] = {}
        latest: dict[str, int] = {}
        for i, word in enumerate(self.words):
            if i and self.order[i] == self.order[i - 1] + 1:
                found[i - 1, i] = 0
            for key in keys(word):
                before = latest.get(key)
                if before is not None:
                    found.setdefault((before, i), 2 if len(key) > 6 else 1)
                latest[key] = i
        u, v = np.array(list(found) or np.zeros((0, 2)), np.int64).reshape(-1, 2).T
        return u, v, np.array(list(found.values()), np.int64)

    def kinds(self, base: list[Span]) -> np.ndarray:
        """The kind of the find that each token overlaps, or outside."""
        out = np.full(len(self.spans), _OUT)
        starts = np.array([a for a, _ in self.spans], np.int64)
        ends = np.array([b for _, b in self.spans], np.int64)
        for kind, a, b in base:
            first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
            out[first:last] = kind
        return out


def keys(word: str) -> set[str]:
    """What repeated and similar tokens share: letters and digits, and all digits if there are four or more."""
    plain = "".join(c for c in word.lower() if c.isalnum())
    digits = "".join(c for c in word if "0" <= c <= "9")
    return {f"w:{plain}"} | ({f"d:{digits}"} if len(digits) > 3 else set())


def features(word: str, before: str, after: str) -> list[int]:
    """Numbers of the features of a token."""
    digits, letters = sum("0" <= c <= "9" for c in word), sum(c.isalpha() for c in word)
    shape = re.sub("9+", "9", re.sub("a+", "a", "".join("9" if "0" <= c <= "9" else "a" if c.isalpha() else c for c in word[:64])))
    names = [
        f"digits {digits if digits < 20 else 20}",
        f"letters {min(letters, 4)}",
        f"shape {shape}",
        f"before {before[:24]}",
        f"after {after[:24]}",
        *(f"has {c} {min(word.count(c), 4)}" for c in "@.+-()=\""),
    ]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


class Field:
    """A skip-chain field: weights of features, and of the labels of two linked tokens for each type of link.

    All weights are fitted together, by pseudo-likelihood: each token's label given its features and the labels of all
    tokens that it is linked to.
    """

    def __init__(self, texts: list[str], steps: int = STEPS):
        nodes, labels, links = [], [], []
        for text in texts:
            tokens = Tokens(text)
            links += [(len(nodes) + a, len(nodes) + b, kind) for a, b, kind in zip(*tokens.links())]
            nodes += tokens.features
            labels += tokens.kinds(base_spans(text)).tolist()
        self.links = np.zeros((3, _OUT + 1, _OUT + 1))
        self.weights = np.zeros((FEATURES, _OUT + 1))
        self.weights[:, _OUT] = 0.05
        if nodes:
            self._fit(np.array(nodes), np.array(labels), np.array(links or np.zeros((0, 3)), np.int64).T, steps)

    def _fit(self, nodes: np.ndarray, labels: np.ndarray, links: np.ndarray, steps: int) -> None:
        wanted = np.eye(_OUT + 1)[labels]
        u, v, kind = links
        rates, link_rates = np.full(FEATURES, 1e-9), np.full(self.links.shape, 1e-9)
        for _ in range(steps):
            scores = self.weights[nodes].sum(axis=1)
            np.add.at(scores, v, self.links[kind, labels[u]])
            np.add.at(scores, u, self.links[kind, :, labels[v]])
            chances = np.exp(scores - scores.max(axis=1, keepdims=True))
            chances /= chances.sum(axis=1, keepdims=True)
            missed = chances - wanted
            slope = 1e-4 * len(nodes) * self.weights
            np.add.at(slope, nodes, missed[:, None, :])
            rates += (slope**2).sum(axis=1)
            self.weights -= 0.3 * slope / np.sqrt(rates)[:, None]
            across = LINK_PENALTY * len(nodes) * self.links
            np.add.at(across, (kind, labels[u]), missed[v])
            np.add.at(across.transpose(0, 2, 1), (kind, labels[v]), missed[u])
            across[1:] = (across[1:] + across[1:].transpose(0, 2, 1)) / 2  # skip links have no direction
            link_rates += across**2
            self.links -= 0.3 * across / np.sqrt(link_rates)

    def chances(self, tokens: Tokens, observed: np.ndarray) -> np.ndarray:
        """Probability of each label of each token, by loopy message passing."""
        alone = self.weights[np.array(tokens.features)].sum(axis=1)
        alone[observed < _OUT] = -_CERTAIN
        alone[np.flatnonzero(observed < _OUT), observed[observed < _OUT]] = _CERTAIN
        u, v, kind = tokens.links()
        n = len(u)
        source, target = np.concatenate((u, v)), np.concatenate((v, u))
        back = np.concatenate((np.arange(n, 2 * n), np.arange(n)))
        between = np.concatenate((self.links[kind], self.links[kind].transpose(0, 2, 1)))
        messages = np.zeros((2 * n, _OUT + 1))
        for _ in range(ROUNDS if n else 0):
            belief = alone.copy()
            np.add.at(belief, target, messages)
            cavity = (belief[source] - messages[back])[:, :, None] + between
            top = cavity.max(axis=1)
            new = top + np.log(np.exp(cavity - top[:, None, :]).sum(axis=1))
            new = 0.5 * (new - new.max(axis=1, keepdims=True)) + 0.5 * messages
            moved = np.abs(new - messages).max()
            messages = new
            if moved < 1e-3:
                break
        belief = alone.copy()
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def added(self, text: str, base: list[Span], sure: float = SURE) -> list[Span]:
        """Spans that the patterns don't find; neighbours of one kind become one."""
        if not _HINT.search(text):
            return []
        tokens = Tokens(text)
        observed = tokens.kinds(base)
        if (observed < _OUT).all():
            return []
        chances = self.chances(tokens, observed)
        labels = np.where((observed == _OUT) & (chances[:, :_OUT].max(axis=1) >= sure), chances[:, :_OUT].argmax(axis=1), _OUT)
        out: list[Span] = []
        for i, (kind, (a, b)) in enumerate(zip(labels.tolist(), tokens.spans)):
            if kind == _OUT or a == b:
                continue
            if out and i and labels[i - 1] == kind and tokens.order[i] == tokens.order[i - 1] + 1:
                out[-1] = (kind, out[-1][1], b)
            else:
                out.append((kind, a, b))
        return out


def train(docs: DataFrame, key: Column, text: str = "text", texts: int = TEXTS, characters: int = CHARACTERS) -> Field:
    """A field from ``texts`` texts, drawn by ``key`` from those with a digit or at sign.

    Of a text of more than ``characters`` a drawn stretch of so many is taken. Where no text has a digit or at sign, the
    field learns nothing and adds nothing.
    """
    usable = docs.filter(F.col(text).rlike("[0-9@]"))
    usable = usable.select(drawn(key).alias("draw"), stretch(F.col(text), key, characters).alias("text"))
    share = 2 * texts / max(1, usable.count())  # so few come to the driver, however many tasks there are
    found = usable.filter(F.col("draw") <= share).orderBy("draw", "text").limit(texts).collect()
    return Field([row.text for row in found])


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` plus ``base`` and ``added``: arrays of kind (a number), start and end (code points), three per span.

    ``base`` is what the patterns find, by kind, then start; ``added`` what the field adds, never overlapping these.
    A null text is empty and has none. Columns named like the new ones are replaced, all others passed on. Repeated
    rows are searched one by one; an empty table gives no rows. Nothing is shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    chosen = docs.drop("base", "added")

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        base, added = [], []
        for value in batch[text].to_pylist():
            found = base_spans(value or "")
            base.append([x for span in found for x in span])
            added.append([x for span in sent.value.added(value or "", found) for x in span])
        return batch | {"base": base, "added": added}

    return map_rows(chosen, with_columns(chosen, "base array<long>, added array<long>"), rows)


def spans_text(*columns: str) -> Column:
    """The spans of some such columns, written as ``kind:start:end`` by kind, then start, comma-joined."""
    whole = F.concat(*columns)
    numbers = F.sequence(F.lit(0), F.floor(F.size(whole) / 3).cast("int") - 1)
    spans = F.transform(numbers, lambda i: F.slice(whole, 3 * i + 1, 3))
    names = F.array(*map(F.lit, KINDS))
    said = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s[0].cast("int")), s[1], s[2]))
    return F.when(F.size(whole) == 0, "").otherwise(F.array_join(said, ","))
