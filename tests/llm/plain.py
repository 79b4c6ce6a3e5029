"""The operators' results in plain Python, for small inputs."""

import collections
import math
import re

SPACE = "[^\x20\x09-\x0d]+"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(SPACE, text or "")


def benchmark_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))


def drop_lines(rows):
    """Texts of (id, text) rows after line dedup; rows that agree are one document."""
    first = {}
    for key in sorted(set(rows), key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        lines = (key[1] or "").split("\n")
        full = [i for i, line in enumerate(lines) if words(line)]
        for a, b, c in zip(full, full[1:], full[2:]):
            first.setdefault((lines[a], lines[b], lines[c]), (key, a))
    out = []
    for key in rows:
        if key[1] is None:
            out.append((None, 0, 0))
            continue
        lines = key[1].split("\n")
        full = [i for i, line in enumerate(lines) if words(line)]
        gone = set()
        for a, b, c in zip(full, full[1:], full[2:]):
            if first[lines[a], lines[b], lines[c]] != (key, a):
                gone |= {a, b, c}
        out.append(("\n".join(line for i, line in enumerate(lines) if i not in gone), len(lines), len(gone)))
    return out


def shingles(text, width):
    found = words(lowered(text))
    if not found:
        return frozenset()
    width = min(width, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def near_components(rows, width, percent=80):
    """Smallest reachable row number of every row."""
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(rows))], sets


def contamination(text, items, window=13):
    """Number of words, the hit ones, and the items."""
    found = benchmark_words(text)
    hit, ids = set(), set()
    for item, item_text in items:
        of = benchmark_words(item_text)
        size = min(window, len(of))
        parts = {tuple(of[i : i + size]) for i in range(len(of) - size + 1)} if of else set()
        for i in range(len(found) - size + 1):
            if tuple(found[i : i + size]) in parts:
                hit |= set(range(i, i + size))
                ids.add(item or "")
    return len(found), hit, sorted(ids)


def without_words(text, hit):
    places = [m.span() for m in re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))]
    out, at = [], 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out.append(text[at : places[i][0]])
        at = places[i][1]
    return "".join([*out, text[at:]])


def repeated_words(found):
    seen = collections.defaultdict(list)
    for i in range(len(found) - 2):
        seen[tuple(found[i : i + 3])].append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)})


def quality(rows, least=20, share=0.002, copy=0.8, left=0.3):
    """(kept, text after the rules) of (id, host, text) rows."""

    def norm(line):
        return " ".join(words(lowered(line)))

    docs, texts = collections.Counter(), {}
    for host, text in {(h, t) for _, h, t in rows}:
        docs[host] += 1
        texts[host, text] = [norm(x) for x in (text or "").split("\n") if words(x)]

    def above(signature):
        found = collections.defaultdict(set)
        for (host, text), lines in texts.items():
            for line in lines:
                found[host, line].add(signature(host, text, lines))
        return {(h, x) for (h, x), at in found.items() if len(at) > least and len(at) > share * docs[h]}

    often = above(lambda host, text, lines: text)

    def signature(host, text, lines):
        shared = [x for x in lines if (host, x) in often]
        is_copy = sum(len(words(x)) for x in shared) >= copy * len(words(text))
        return ("begins with", shared[0]) if shared and is_copy else ("is", text)

    frequent = above(signature) & often
    out = []
    for _, host, text in rows:
        own = words(text)
        failed = len(own) < 50 or 100 * repeated_words(own) > 50 * len(own)
        gone = sum(len(words(x)) for x in (text or "").split("\n") if (host, norm(x)) in frequent)
        kept = not failed and len(own) - gone >= left * len(own)
        lines = [x for x in (text or "").split("\n") if not words(x) or (host, norm(x)) not in frequent]
        out.append((kept, "\n".join(lines)))
    return out


def removed_bytes(texts, length=200):
    """Per text: removed bytes, spans, and what is left."""
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if counts[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def code_length(text, samples, order):
    """Bits of a text under one language: the escape method with counts of all contexts, byte by byte."""
    tables = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    lower = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
    for sample in samples:
        data = b"\n" * order + sample.translate(lower)
        for i in range(order, len(data)):
            for k in range(order + 1):
                tables[k][data[i - k : i]][data[i]] += 1
    bits, data = 0.0, b"\n" * order + text.translate(lower)
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = tables[k].get(data[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits += math.log2(total / seen[data[i]])
                break
            bits += math.log2(total / len(seen))
        else:
            bits += 8
    return bits
