"""The class-based language model against plain Python: counts, classes, probabilities, and odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from refrain.llm import classes
from refrain.llm.common import LOWER_CASE

SCHEMA = "doc_id long, text string"
CLASHING = ("id", "chunk", "bucket", "trained", "score", "words", "classes")


def grammar(seed, n):
    """Sentences of an article, an adjective, a noun, a verb, of words that occur often and of rare ones."""
    rng = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(30)] for k in ("det", "adj", "noun", "verb")]
    out = []
    for _ in range(n):
        out += [rng.choice(kind) if rng.random() > 0.02 else f"rare{rng.randrange(10**6)}" for kind in kinds]
    return " ".join(out)


def rows(n=60):
    texts = [(i, grammar(i, 5 + i % 40)) for i in range(n)]
    texts += [(200, None), (201, ""), (202, " \t\n"), (203, "Äpfel ÄPFEL Det1\x1cdet1 DET1"), (204, "x " * 3000), (None, "det1 adj2"), (None, None)]
    return texts + [texts[3], texts[3], (3, "det2 noun2")]


def is_trained(i):
    return i is not None and i % 4 != 1


def tokens(text):
    return (text or "").encode().translate(LOWER_CASE).split()


TRAINED = "doc_id % 4 <> 1"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3).withColumns({c: F.lit("own") for c in CLASHING})


def learned(spark, df):
    """The count and the class of every word, as the operator learns them."""
    chunks = classes.settle(classes.chunked(df, "text", "doc_id", F.expr(TRAINED)), "chunks")
    lexicon, _ = classes.gathered_lexicon(classes.slices(chunks, 4), chunks.count())
    seeds, done = classes.exchange(lexicon, classes.CLASSES, classes.ROUNDS)
    found = {}
    for batch in lexicon.toArrow().to_batches():
        for i in range(batch.num_rows):
            row = classes.Entry(batch, i)
            found |= {w: (int(n), int(c)) for w, n, c in zip(row.words.tolist(), row.counts, row.all_classes(seeds, done))}
    return found, lexicon, seeds, done


def of(word):
    return xxhash.xxh3_64_intdigest(word)


def test_scores_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(classes, "CHUNK", 300)
    data = rows()
    found, *_ = learned(spark, frame(spark, data))
    counts = Counter(w for i, t in data if is_trained(i) for w in tokens(t))
    assert {of(w): n for w, n in counts.items()} == {w: n for w, (n, _) in found.items() if n}
    n_docs = sum(is_trained(i) for i, _ in data)
    size, types = sum(counts.values()) + n_docs, len(counts) + 1
    n = classes.CLASSES + 1 + classes.SPELLINGS

    steps = np.zeros((n, n))
    for i, t in data:
        if is_trained(i):
            line = [0, *(found[of(w)][1] for w in tokens(t)), 0]
            for a, b in zip(line, line[1:]):
                steps[a, b] += 1
    alone = (steps.sum(axis=0) + 1) / (steps.sum() + n)
    kinds = np.maximum((steps > 0).sum(axis=1), 1)
    follows = [[(steps[a, b] + kinds[a] * alone[b]) / (steps[a].sum() + kinds[a]) for b in range(n)] for a in range(n)]
    in_class, seen = [[c for c, k in found.values() if k == j and c] for j in range(n)], Counter()

    def emitted(word):
        c, k = found[of(word)]
        members, total = in_class[k], sum(in_class[k])
        if k <= classes.CLASSES:
            return c / total
        once, twice = members.count(1), members.count(2)
        discount = min(0.95, max(0.05, once / (once + 2 * twice) if once + twice else 0.5))
        if not total:
            return 1.0
        return (c - discount) / total if c else discount * len(members) / total

    wanted = []
    for i, t in data:
        words = tokens(t)
        base = sum(math.log10((c + 0.5) / (size + 0.5 * (types + 1))) for c in [*(counts[w] for w in words), n_docs])
        line = [0, *(found[of(w)][1] for w in words), 0]
        score = sum(math.log10(follows[a][b]) for a, b in zip(line, line[1:])) + sum(math.log10(emitted(w)) for w in words)
        wanted.append((str(i), len(words) + 1, sum(w in counts for w in words) + 1, size, round(base, 6), round(score, 6)))
    scored = classes.score(frame(spark, data), F.expr(TRAINED))
    assert scored.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in scored.collect()]
    assert sorted(got) == sorted(wanted)


def test_chunks_and_buckets_do_not_matter(spark, monkeypatch):
    data = rows()

    def scored():
        return sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in classes.score(frame(spark, data), F.expr(TRAINED)).collect())

    whole = scored()
    monkeypatch.setattr(classes, "CHUNK", 64)
    monkeypatch.setattr(classes, "IN_BUCKET", 8)
    assert scored() == whole
    monkeypatch.setattr(classes, "GROUP", 5)  # groups of chunks are gathered first
    assert scored() == whole


def test_probabilities_sum_to_one(spark):
    found, lexicon, seeds, done = learned(spark, frame(spark, rows()))
    model = classes.emissions(lexicon, seeds, done)
    mass = Counter()
    for n, c in found.values():
        if n:
            mass[c] += 10 ** model.log10(np.array([n]), np.array([c]))[0]
    for c in {c for n, c in found.values() if n}:
        unseen = 10 ** model.log10(np.array([0]), np.array([c]))[0] if c > classes.CLASSES else 0.0
        assert mass[c] + unseen == pytest.approx(1.0)
    counts = np.random.default_rng(1).integers(0, 5, size=(7, 7))
    assert classes.smoothed(counts * (np.arange(7) != 3)[:, None]).sum(axis=1) == pytest.approx(np.ones(7))


def test_exchange_gathers_words_of_a_kind(spark, monkeypatch):
    """Words that stand in the same places end in the same classes, and the model then beats single tokens on new texts."""
    data = [(4 * i, grammar(i, 60)) for i in range(60)] + [(4 * i + 1, grammar(1000 + i, 60)) for i in range(20)]
    found, *_ = learned(spark, frame(spark, data))
    kinds = {}
    for kind in ("det", "adj", "noun", "verb"):
        kinds[kind] = Counter(found[of(f"{kind}{i}".encode())][1] for i in range(30))
    assert all(c <= classes.CLASSES for k in kinds.values() for c in k)
    shared = [sum((a & b).values()) for x, a in kinds.items() for y, b in kinds.items() if x < y]
    assert sum(shared) <= 12
    new = [r for r in classes.score(frame(spark, data), F.expr(TRAINED)).collect() if r.doc_id % 4 == 1]
    assert all(r.score > r.base_score + 50 for r in new)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in new)


def test_contexts_equal_plain_python():
    rng = np.random.default_rng(2)
    words = np.sort(rng.integers(0, 1 << 63, 40).astype(np.uint64))
    lengths = np.array([0, 5, 1, 0, 300, 2, 0])
    trained = np.array([True, True, True, False, True, False, True])
    texts = np.split(rng.integers(0, 40, lengths.sum()), np.cumsum(lengths)[:-1])
    wanted, edge = Counter(), classes.CONTEXTS - 1
    for text, known in zip(texts, trained):
        line = [edge, *((words[text] >> np.uint64(8)) % np.uint64(edge)).tolist(), edge]
        for i, w in enumerate(text.tolist(), 1):
            if known:
                wanted[w * 2 * classes.CONTEXTS + line[i - 1]] += 1
                wanted[w * 2 * classes.CONTEXTS + classes.CONTEXTS + line[i + 1]] += 1
    pairs, times = classes.context_pairs(np.concatenate(texts), lengths, trained, words)
    assert dict(zip(pairs.tolist(), times.tolist())) == wanted


def test_without_texts_or_training(spark):
    assert classes.score(spark.createDataFrame([], SCHEMA), F.expr(TRAINED)).collect() == []
    for trained in (F.lit(False), F.lit(None).cast("boolean")):
        found = classes.score(frame(spark, [(1, "a b"), (2, None)]), trained).orderBy("doc_id").collect()
        assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found] == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
        assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    only_empty = classes.score(frame(spark, [(4, ""), (8, None)]), F.expr(TRAINED)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in only_empty] == [(1, 1, 2)] * 2


def test_spelling_is_by_the_last_bytes():
    assert classes.spelling(b"xing") == zlib.crc32(b"ing") % classes.SPELLINGS == classes.spelling(b"ming")
