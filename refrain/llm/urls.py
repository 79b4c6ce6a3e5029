"""URL rules as globs, matched by a bit-parallel automaton that follows all patterns at once."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import as_bytes, map_rows, with_columns

#: Urls whose state vectors are held at a time.
CHUNK = 4096


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``site`` (a host and all its subdomains) whose path starts with ``path``; a star in them is a star."""

    verdict: str
    site: str
    path: str

    @property
    def name(self) -> str:
        return self.site + self.path

    @property
    def globs(self) -> tuple[str, str]:
        plain = re.sub(r"([*\\])", r"\\\1", self.name)
        return f"{plain}**", f"*.{plain}**"


#: Globs of the method's own verdict, for urls that no rule fits: ``*`` stands for any characters but ``/``, ``**`` for any,
#: and a backslash takes the meaning from the character after it.
BLOCKED = ("**.exe", "**.zip", "**/wp-login*", "**/admin/**")


class ShiftAnd:
    """All globs in one bit vector of 64-bit words; a glob of m literals and stars takes m + 1 bits at most.

    Bit i of a glob is set after its first i literals have been read. A step shifts the vector, keeps the bits whose
    literal is the byte read, and adds those that stay put under a star.
    """

    def __init__(self, globs: list[str]):
        self.globs = globs
        starts, finals, moves, stays = [], [], [[] for _ in range(256)], [[] for _ in range(256)]
        bit = 0
        for glob in globs:
            data, i = glob.encode(), 0
            starts.append(bit)
            while i < len(data):
                if data[i] == 42:
                    deep = data[i + 1 : i + 2] == b"*"
                    for byte in range(256):
                        if deep or byte != 47:
                            stays[byte].append(bit)
                    i += 1 + deep
                else:
                    i += data[i] == 92 and i + 1 < len(data)
                    bit += 1
                    moves[data[i]].append(bit)
                    i += 1
            finals.append(bit)
            bit += 1
        self.words = -(-bit // 64)
        self.start, self.finals = self._mask(starts), finals
        self.moves = np.array([self._mask(x) for x in moves])
        self.stays = np.array([self._mask(x) for x in stays])

    def _mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for bit in set(bits):
            out[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return out

    def match(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text, a column for each glob: does the whole text match?"""
        out = np.zeros((len(texts), len(self.globs)), bool)
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        for first in range(0, len(texts), CHUNK):
            rows = order[first : first + CHUNK]
            state = self._run([texts[r] for r in rows], lengths[rows])
            for j, bit in enumerate(self.finals):
                out[rows, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) > 0
        return out

    def _run(self, texts: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """``texts`` from the longest to the shortest; those that have ended keep their state."""
        flat = np.frombuffer(b"".join(texts), np.uint8)
        places = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        state = np.tile(self.start, (len(texts), 1))
        for i in range(int(lengths.max(initial=0))):
            alive = int(np.searchsorted(-lengths, -i, side="left"))
            now, byte = state[:alive], flat[places[:alive] + i]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:alive] = (moved & self.moves[byte]) | (now & self.stays[byte])
        return state


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    after = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), url.substr(F.length(after) + 4, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"(?s)\A([^/?#]*)([^?#]*)", group), F.lit(""))


def judge(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    id: str = "page_id",
    blocked: tuple[str, ...] = BLOCKED,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    The longest rule that fits decides (of two as long, one that blocks, then the first by name). Where none fits,
    ``rule`` is null and the verdict is ``block`` if one of the globs ``blocked`` matches host and path, else ``allow``.
    A null url, or one without ``://``, has an empty host and path. Repeated rows are judged one by one; an empty
    table gives no rows; other columns are ignored. Rules and globs are a fixed list that every task gets.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    automaton = ShiftAnd([*(g for r in ranked for g in r.globs), *blocked])
    names = np.array([r.name for r in ranked] + [None], object)
    verdicts = np.array([r.verdict for r in ranked] + ["allow", "block"], object)
    chosen = pages.select(F.col(id).alias(id), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def rows(batch: dict[str, pa.Array]) -> dict[str, object]:
        urls = [a + b for a, b in zip(as_bytes(batch["host"]), as_bytes(batch["path"]))]
        found = automaton.match(urls)
        fits = found[:, : 2 * len(ranked)].reshape(len(urls), len(ranked), 2).any(axis=2)
        fits = np.concatenate((fits, np.ones((len(urls), 1), bool)), axis=1)
        first = fits.argmax(axis=1)
        own = (first == len(ranked)) & found[:, 2 * len(ranked) :].any(axis=1)
        return batch | {"rule": names[first].tolist(), "verdict": verdicts[first + own].tolist()}

    return map_rows(chosen, with_columns(chosen, "rule string, verdict string"), rows)
