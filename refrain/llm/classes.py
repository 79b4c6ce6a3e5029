"""Scores of texts under a class-based n-gram model: Brown's classes, found by exchange clustering.

A text is as probable as its sequence of word classes, by class-to-class transitions, times each word given its class.
All counts come from all training texts. They are kept packed, since a row per token would be many times the texts:

- Texts are cut into chunks of about ``CHUNK`` tokens, always between two texts, and written as numbers of the chunk's own
  words, in the order of the words' hashes. So the words of a bucket (the first bits of a hash) are one slice of a chunk.
- A bucket gathers its slices from all chunks: the lexicon, with each word's count and the contexts, before and behind,
  that it was seen in. A common word has a slice in every chunk, so of very many chunks groups of at most ``GROUP`` are
  gathered first, and then the groups.
- Exchange rounds run over the lexicon where it lies; only sums per class and context meet.
- The lexicon sends each chunk the counts and classes of its words, and no task ever holds the whole vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from refrain.llm.common import LOWER_CASE, as_bytes, give_back, pieces, to_arrow
from refrain.sources.scratch import settle

#: Classes that words are exchanged between, and classes by spelling for words too rare for that and for unseen ones.
CLASSES, SPELLINGS = 64, 16
#: Words seen less often than this in training stay in the class of their spelling.
LEAST = 8
#: Exchange rounds: one for all words but the seeds, then rounds that each let one half of the words move.
ROUNDS = 3
#: Contexts on each side of a word: hashes of the neighbour, and the border of the text as the last one.
CONTEXTS = 128
#: Tokens of a chunk, and words of all chunks in a bucket of the lexicon, about.
CHUNK, IN_BUCKET = 1 << 19, 1 << 17
#: Chunks whose slices of a bucket meet in one task.
GROUP = 4096
#: Of the stored tables, whose rows are large.
CODEC = "zstd"
#: What a class is thought to have been seen in all contexts, together, before counting.
PRIOR = 20.0

#: The class of the end of a text; those of words follow, then those of spellings.
END = 0

_CHUNK = "n_words int, trained array<boolean>, lengths array<int>, words binary, counts binary, spelled binary, tokens binary"
_SLICE = "bucket int, chunk long, words binary, counts binary, spelled binary, sizes binary, contexts binary, times binary"
_LEXICON = (
    "bucket int, words binary, counts binary, spelled binary, frequent binary, sizes binary, contexts binary, times binary, "
    "chunks array<long>, places array<binary>"
)


class Numbers(dict):
    """Words by the order in which they first came."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def spelling(word: bytes) -> int:
    """One of ``SPELLINGS`` by the last three bytes."""
    return zlib.crc32(word[-3:]) % SPELLINGS


def array_of(column: pa.Array, row: int, kind: type) -> np.ndarray:
    value = column[row]
    return np.frombuffer(value.as_buffer(), kind) if value.is_valid and len(value.as_buffer()) else np.zeros(0, kind)


def compact(tokens: np.ndarray, n: int) -> np.ndarray:
    return tokens.astype(np.uint16 if n <= 1 << 16 else np.uint32)


def one_row(schema: pa.Schema, **values: object) -> pa.RecordBatch:
    found = {k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in values.items()}
    return pa.RecordBatch.from_arrays([pa.array([found[f.name]], f.type) for f in schema], schema=schema)


def chunked(docs: DataFrame, text: str, id: str, trained: Column) -> DataFrame:
    """``chunk``, ``ids`` and the columns of ``_CHUNK``: a row for each chunk of texts."""
    known = F.coalesce(trained, F.lit(False)).alias("trained")
    chosen = docs.select(F.col(id).alias("id"), known, F.coalesce(F.col(text), F.lit("")).alias("text"))
    ddl = f"chunk long, ids array<{chosen.schema['id'].dataType.simpleString()}>, {_CHUNK}"
    schema = to_arrow(ddl)

    def finished(chunk: int, numbers: Numbers, parts: list, docs: list[tuple]) -> pa.RecordBatch:
        ids, known, lengths = (list(x) for x in zip(*docs))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
        spelled = np.fromiter(map(spelling, numbers), np.uint8, len(numbers))
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        tokens = place[np.concatenate(parts)] if parts else place[:0]
        counts = np.bincount(tokens[np.repeat(np.array(known, bool), lengths)], minlength=len(order)).astype(np.uint32)
        return one_row(
            schema, chunk=chunk, ids=ids, n_words=len(order), trained=known, lengths=lengths, words=hashes[order], counts=counts,
            spelled=spelled[order], tokens=compact(tokens, len(order)),
        )

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, numbers, parts, docs = TaskContext.get().partitionId() << 32, 0, Numbers(), [], []
        for batch in source:
            for id_, known, data in zip(batch.column("id").to_pylist(), batch.column("trained").to_pylist(), as_bytes(batch.column("text"))):
                length = 0
                for piece in pieces(data.translate(LOWER_CASE)):
                    words = piece.split()
                    parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                    length += len(words)
                docs.append((id_, known, length))
                size += length + 1
                if size >= CHUNK:
                    yield finished(chunk, numbers, parts, docs)
                    chunk, size, numbers, parts, docs = chunk + 1, 0, Numbers(), [], []
                    give_back()
        if docs:
            yield finished(chunk, numbers, parts, docs)
        del numbers, parts, docs
        give_back()

    return chosen.mapInArrow(batches, ddl)


def context_pairs(tokens: np.ndarray, lengths: np.ndarray, trained: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word * 2 * CONTEXTS + context`` in order, and how often; contexts behind a word follow those before it."""
    of_word = ((words >> np.uint64(8)) % np.uint64(CONTEXTS - 1)).astype(np.int64)
    used = np.repeat(trained, lengths)
    ends = np.cumsum(lengths)
    contexts = of_word[tokens]
    before, behind = (np.full(len(tokens), CONTEXTS - 1) for _ in range(2))
    before[1:], behind[:-1] = contexts[:-1], contexts[1:]
    before[(ends - lengths)[lengths > 0]] = behind[ends[lengths > 0] - 1] = CONTEXTS - 1
    base = tokens[used].astype(np.int64) * (2 * CONTEXTS)
    return np.unique(np.concatenate((base + before[used], base + CONTEXTS + behind[used])), return_counts=True)


def slices(chunks: DataFrame, bits: int) -> DataFrame:
    """What each chunk knows of the words of each bucket: counts and contexts."""
    schema = to_arrow(_SLICE)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for i, (chunk, n) in enumerate(zip(columns["chunk"].to_pylist(), columns["n_words"].to_pylist())):
                if not n:
                    continue
                words, counts, spelled = (array_of(columns[c], i, k) for c, k in (("words", np.uint64), ("counts", np.uint32), ("spelled", np.uint8)))
                tokens = array_of(columns["tokens"], i, np.uint16 if n <= 1 << 16 else np.uint32)
                lengths, trained = (np.array(columns[c][i].as_py(), k) for c, k in (("lengths", np.int64), ("trained", bool)))
                pairs, times = context_pairs(tokens, lengths, trained, words)
                # Times are bytes, so a pair seen more often than 255 times takes several entries.
                entries = (times + 254) // 255
                times = np.repeat(times, entries) - 255 * (np.arange(entries.sum()) - np.repeat(np.cumsum(entries) - entries, entries))
                times, pairs = np.minimum(times, 255).astype(np.uint8), np.repeat(pairs, entries)
                of_pair = pairs // (2 * CONTEXTS)
                sizes = np.bincount(of_pair, minlength=n).astype(np.uint32)
                contexts = (pairs % (2 * CONTEXTS)).astype(np.uint8)
                buckets = (words >> np.uint64(64 - bits)).astype(np.int64)
                starts = np.flatnonzero(np.diff(buckets, prepend=-1))
                for a, b in zip(starts, [*starts[1:], n]):
                    p, q = np.searchsorted(of_pair, (a, b))
                    yield one_row(
                        schema, bucket=int(buckets[a]), chunk=chunk, words=words[a:b], counts=counts[a:b], spelled=spelled[a:b],
                        sizes=sizes[a:b], contexts=contexts[p:q], times=times[p:q],
                    )
                give_back()

    return chunks.drop("ids").mapInArrow(batches, _SLICE)


def gathered(bucket: int, slices: pa.Table, schema: pa.Schema, least: int, counts: type = np.uint32, times: type = np.uint8) -> pa.Table:
    """One row of the lexicon from the slices of a bucket; contexts of words seen less often than ``least`` are left out."""

    def whole(name: str, kind: type) -> np.ndarray:
        column = slices.column(name).combine_chunks()
        return np.concatenate([array_of(column, i, kind) for i in range(len(column))])

    parts = whole("words", np.uint64)
    words, place = np.unique(parts, return_inverse=True)
    total = np.bincount(place, whole("counts", counts), len(words)).astype(np.int64)
    spelled = np.zeros(len(words), np.uint8)
    spelled[place] = whole("spelled", np.uint8)
    frequent = np.flatnonzero(total >= least).astype(np.int32)
    number = np.full(len(words), -1)
    number[frequent] = np.arange(len(frequent))
    of_entry = np.repeat(number[place], whole("sizes", np.uint32))
    used = of_entry >= 0
    pairs, inverse = np.unique(of_entry[used] * (2 * CONTEXTS) + whole("contexts", np.uint8)[used], return_inverse=True)
    often = np.bincount(inverse, whole("times", times)[used], len(pairs)).astype(np.int64)
    sizes = np.bincount(pairs // (2 * CONTEXTS), minlength=len(frequent)).astype(np.uint32)
    lengths = [len(x) // 8 for x in slices.column("words").to_pylist()]
    places = [x.astype(np.int32).tobytes() for x in np.split(place, np.cumsum(lengths)[:-1])]
    return pa.Table.from_batches([
        one_row(
            schema, bucket=bucket, words=words, counts=total, spelled=spelled, frequent=frequent, sizes=sizes,
            contexts=(pairs % (2 * CONTEXTS)).astype(np.uint8), times=often, chunks=slices.column("chunk").to_pylist(), places=places,
        )
    ])


def gathered_lexicon(slices: DataFrame, n_chunks: int, least: int = LEAST) -> tuple[DataFrame, DataFrame | None]:
    """The lexicon, a row for each bucket; and the rows for each bucket and group of chunks, if there are several groups."""
    schema = to_arrow(_LEXICON)
    groups = max(1, -(-n_chunks // GROUP))

    def of_chunks(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        row = gathered(key[0].as_py(), found, schema, least if groups == 1 else 0)
        give_back()
        return row

    def of_groups(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        row = gathered(key[0].as_py(), found, schema, least, np.int64, np.int64)
        give_back()
        return row

    dealt = slices.withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(groups)))
    first = settle(dealt.groupBy("bucket", "group").applyInArrow(of_chunks, _LEXICON), "lexicon", CODEC)
    if groups == 1:
        return first, None
    # A group is known by one of its chunks.
    named = first.withColumn("chunk", F.array_min("chunks"))
    kept = named.select("bucket", "chunk", "words", "counts", "spelled", "sizes", "contexts", "times")
    return settle(kept.groupBy("bucket").applyInArrow(of_groups, _LEXICON), "lexicon", CODEC), named


class Entry:
    """A row of the lexicon."""

    KINDS = {
        "words": np.uint64, "counts": np.int64, "spelled": np.uint8, "frequent": np.int32, "sizes": np.uint32,
        "contexts": np.uint8, "times": np.int64,
    }

    def __init__(self, batch: pa.RecordBatch, row: int):
        for name, kind in self.KINDS.items():
            setattr(self, name, array_of(batch.column(name), row, kind))

    def vectors(self, block: int = 4096) -> Iterator[tuple[slice, np.ndarray]]:
        """The context counts of the frequent words, some words at a time."""
        ends = np.cumsum(self.sizes, dtype=np.int64)
        for start in range(0, len(self.frequent), block):
            stop = min(len(self.frequent), start + block)
            a, b = (ends[start] - int(self.sizes[start]), ends[stop - 1])
            keys = np.repeat(np.arange(stop - start), self.sizes[start:stop]) * (2 * CONTEXTS) + self.contexts[a:b]
            found = np.zeros((stop - start) * 2 * CONTEXTS)
            found[keys] = self.times[a:b]
            yield slice(start, stop), found.reshape(stop - start, -1)

    def classes(self, seeds: dict[int, int], rounds: list[np.ndarray]) -> np.ndarray:
        """The classes of the frequent words after the given rounds, each by its sums per class and context; -1 is none."""
        names = self.words[self.frequent]
        own = np.fromiter((seeds.get(int(w), -1) for w in names), np.int64, len(names))
        seeded = own >= 0
        half = (names >> np.uint64(4)) & np.uint64(1)
        for n, sums in enumerate(rounds):
            moving = ~seeded if n == 0 else half == n % 2
            for rows, found in self.vectors():
                best = exchanged(found, own[rows], sums)
                own[rows] = np.where(moving[rows], best, own[rows])
        return own

    def all_classes(self, seeds: dict[int, int], rounds: list[np.ndarray]) -> np.ndarray:
        """Of all words: 1 and on for those that were exchanged, ``CLASSES + 1`` and on for spellings."""
        found = self.spelled.astype(np.int64) + CLASSES + 1
        own = self.classes(seeds, rounds)
        found[self.frequent[own >= 0]] = own[own >= 0] + 1
        return found


def exchanged(found: np.ndarray, own: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The class under which each word's contexts are most probable, the word itself left out of its own class."""
    usual = sums.sum(axis=0) + 1.0
    usual *= PRIOR / usual.sum()
    sizes = sums.sum(axis=1)
    gain = found @ (np.log(sums + usual) - np.log(sizes + PRIOR)[:, None]).T
    held = np.flatnonzero(own >= 0)
    rest = np.maximum(sums[own[held]] - found[held], 0.0)
    size = np.maximum(sizes[own[held]] - found[held].sum(axis=1), 0.0)
    gain[held, own[held]] = (found[held] * (np.log(rest + usual) - np.log(size + PRIOR)[:, None])).sum(axis=1)
    return gain.argmax(axis=1)


def seed_words(lexicon: DataFrame, classes: int) -> dict[int, int]:
    """The most frequent words of all, each with a class of its own."""
    ddl = "word long, n long"
    schema = to_arrow(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                words, counts = (array_of(batch.column(c), i, Entry.KINDS[c]) for c in ("words", "counts"))
                top = np.lexsort((words, -counts))[:classes]
                top = top[counts[top] >= LEAST]
                yield pa.RecordBatch.from_arrays([pa.array(words[top].view(np.int64)), pa.array(counts[top])], schema=schema)

    top = lexicon.select("words", "counts").mapInArrow(batches, ddl).orderBy(F.col("n").desc(), "word").limit(classes)
    return {row["word"] % (1 << 64): i for i, row in enumerate(top.collect())}


def summed(lexicon: DataFrame, values, width: int) -> np.ndarray:
    """Sums over the lexicon of ``values(entry)``, an array of ``width`` numbers."""
    schema = to_arrow("place int, value double")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in source:
            for i in range(batch.num_rows):
                total += values(Entry(batch, i))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], schema=schema)

    sums = lexicon.select(*Entry.KINDS).mapInArrow(batches, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = np.zeros(width)
    for row in sums.collect():
        found[row["place"]] = row["value"]
    return found


def exchange(lexicon: DataFrame, classes: int, rounds: int) -> tuple[dict[int, int], list[np.ndarray]]:
    """The seeds and, for each round, the sums per class and context that its moves are judged by."""
    seeds, done = seed_words(lexicon, classes), []

    def by_class(entry: Entry) -> np.ndarray:
        own = entry.classes(seeds, done)
        total = np.zeros((classes, 2 * CONTEXTS))
        for rows, found in entry.vectors():
            held = own[rows] >= 0
            np.add.at(total, own[rows][held], found[held])
        return total.ravel()

    for _ in range(rounds if seeds else 0):
        done.append(summed(lexicon, by_class, classes * 2 * CONTEXTS).reshape(classes, -1))
    return seeds, done


class Emissions:
    """Sums per class, from which a word's probability in its class follows.

    Words of exchanged classes have their share of the class. In the classes of spellings each word gives up the discount
    of that class, as its words seen once and twice suggest; unseen words of the spelling, taken as one, get what is given up.
    """

    def __init__(self, tokens: np.ndarray, types: np.ndarray, once: np.ndarray, twice: np.ndarray):
        self.tokens, self.types = tokens, types
        self.discount = np.where(once + twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        self.discount = np.clip(self.discount, 0.05, 0.95)
        self.discount[: CLASSES + 1] = 0.0

    def log10(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        size, discount = self.tokens[classes], self.discount[classes]
        share = np.where(counts > 0, counts - discount, discount * self.types[classes])
        return np.log10(np.where(size > 0, share / np.maximum(size, 1), 1.0))


def emissions(lexicon: DataFrame, seeds: dict[int, int], rounds: list[np.ndarray]) -> Emissions:
    n = CLASSES + 1 + SPELLINGS

    def by_class(entry: Entry) -> np.ndarray:
        classes, counts = entry.all_classes(seeds, rounds), entry.counts
        kinds = (counts, counts > 0, counts == 1, counts == 2)
        return np.concatenate([np.bincount(classes, k.astype(np.float64), n) for k in kinds])

    return Emissions(*np.split(summed(lexicon, by_class, 4 * n), 4))


def sent_back(lexicon: DataFrame, groups: DataFrame | None, seeds: dict[int, int], rounds: list[np.ndarray]) -> DataFrame:
    """Counts and classes of the words of each chunk, a row for each bucket; by way of the groups, if there are any."""
    ddl = "chunk long, bucket int, counts binary, classes binary"
    schema = to_arrow(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                entry, bucket = Entry(batch, i), batch.column("bucket")[i].as_py()
                classes = entry.all_classes(seeds, rounds).astype(np.uint8)
                places = batch.column("places")[i].values
                for j, chunk in enumerate(batch.column("chunks")[i].as_py()):
                    own = array_of(places, j, np.int32)
                    yield one_row(schema, chunk=chunk, bucket=bucket, counts=entry.counts[own], classes=classes[own])
                give_back()

    def spread(group: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        if group.num_rows and found.num_rows:
            counts, classes = (np.frombuffer(found.column(c)[0].as_py(), k) for c, k in (("counts", np.int64), ("classes", np.uint8)))
            bucket, chunks, places = (group.column(c)[0].as_py() for c in ("bucket", "chunks", "places"))
            for chunk, place in zip(chunks, places):
                own = np.frombuffer(place, np.int32)
                rows.append(one_row(schema, chunk=chunk, bucket=bucket, counts=counts[own], classes=classes[own]))
        return pa.Table.from_batches(rows, schema)

    back = lexicon.mapInArrow(batches, ddl)
    if groups is None:
        return back
    held = groups.select("bucket", "chunk", "chunks", "places")
    return held.groupBy("bucket", "chunk").cogroup(back.groupBy("bucket", "chunk")).applyInArrow(spread, ddl)


def classed(chunks: DataFrame, back: DataFrame, model: Emissions, train_tokens: int, types: int, train_docs: int) -> DataFrame:
    """A row for each text: ``id``, ``trained``, counts, ``base_score``, ``emission`` (log10) and the ``classes`` of its words."""
    id_type = chunks.schema["ids"].dataType.elementType.simpleString()
    ddl = f"id {id_type}, trained boolean, n_tokens long, n_known long, base_score double, emission double, classes binary"
    schema = to_arrow(ddl)

    def base(counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (train_tokens + 0.5 * (types + 1)))

    def scored(chunk: pa.Table, words: pa.Table) -> pa.Table:
        give_back()
        if not chunk.num_rows:
            return schema.empty_table()
        words = words.sort_by("bucket")
        counts, classes = (
            np.concatenate([np.zeros(0, k), *(np.frombuffer(x, k) for x in words.column(c).to_pylist())])
            for c, k in (("counts", np.int64), ("classes", np.uint8))
        )
        ids, trained, lengths = (chunk.column(c).combine_chunks().values for c in ("ids", "trained", "lengths"))
        tokens = np.frombuffer(chunk.column("tokens")[0].as_py(), np.uint16 if len(counts) <= 1 << 16 else np.uint32)
        sizes = lengths.to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)
        end = base(np.array([train_docs]))[0]

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(doc, values[tokens], len(sizes))

        of_token = classes[tokens].tobytes()
        parts = [of_token[b - n : b] for b, n in zip(ends.tolist(), sizes.tolist())]
        known = total((counts > 0).astype(np.float64)).astype(np.int64) + (train_docs > 0)
        out = [ids, trained, pa.array(sizes + 1), pa.array(known), pa.array(total(base(counts)) + end), pa.array(total(model.log10(counts, classes.astype(np.int64)))), pa.array(parts, pa.binary())]
        return pa.table([c.cast(f.type) for c, f in zip(out, schema)], schema=schema)

    chunks = chunks.select("chunk", "ids", "trained", "lengths", "tokens")
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(scored, ddl)


def steps(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``from * n + to`` of all class transitions in a batch, its texts begun and ended by ``END``; and the text of each."""
    column = batch.column("classes")
    sizes = np.array([len(x.as_buffer()) for x in column], np.int64)
    ends = np.cumsum(sizes + 1)
    line = np.full(int(ends[-1]) + 1 if len(ends) else 1, END, np.int64)
    inside = np.ones(len(line), bool)
    inside[0] = False
    inside[ends] = False
    line[inside] = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return line[:-1] * n + line[1:], np.repeat(np.arange(len(sizes)), sizes + 1)


def transitions(texts: DataFrame) -> np.ndarray:
    """How often each class follows each in the training texts."""
    n = CLASSES + 1 + SPELLINGS
    schema = to_arrow("step int, n long")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n, np.int64)
        for batch in source:
            total += np.bincount(steps(batch, n)[0], minlength=n * n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], schema=schema)

    counted = texts.filter("trained").select("classes").mapInArrow(batches, "step int, n long").groupBy("step").agg(F.sum("n").alias("n"))
    found = np.zeros(n * n)
    for row in counted.collect():
        found[row["step"]] = row["n"]
    return found.reshape(n, n)


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Probability of each class after each, by Witten and Bell: mixed with that of the class alone."""
    alone = (counts.sum(axis=0) + 1) / (counts.sum() + len(counts))
    kinds = np.maximum((counts > 0).sum(axis=1, keepdims=True), 1)
    return (counts + kinds * alone) / (counts.sum(axis=1, keepdims=True) + kinds)


def score(
    docs: DataFrame,
    trained: Column,
    text: str = "text",
    id: str = "doc_id",
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Tokens are the words between ASCII white space, A-Z lowered, and one end per text. ``n_known`` of them occur in the
    texts where ``trained`` is true, which hold ``train_tokens``. ``base_score`` is the log10 probability under single
    tokens, 0.5 added to each count; ``score`` that under the class model, and ``perplexity`` the model's per token.

    A null text is an empty one: its end alone. Where ``trained`` is null or false a text is not learned from; without
    training texts all words are unseen. Repeated rows count and are scored one by one, an empty table gives no rows, and
    columns other than text and id are ignored, whatever their names. A word is known by 64 bits of its hash. The jobs that
    count and classify run and are written when this is called.
    """
    chunks = settle(chunked(docs, text, id, trained), "chunks", CODEC)
    size = chunks.agg(F.sum("n_words").alias("words"), F.count(F.lit(1)).alias("n")).first()
    bits = max(4, int(np.ceil(np.log2(max(1, (size["words"] or 0) / IN_BUCKET)))))
    lexicon, groups = gathered_lexicon(slices(chunks, bits), size["n"])
    seeds, done = exchange(lexicon, CLASSES, rounds)
    model = emissions(lexicon, seeds, done)
    learned = chunks.select(F.explode("trained").alias("trained")).filter("trained").count()
    train_tokens, types = int(model.tokens.sum()) + learned, int(model.types.sum()) + (learned > 0)
    texts = settle(classed(chunks, sent_back(lexicon, groups, seeds, done), model, train_tokens, types, learned), "classed", CODEC)
    n = CLASSES + 1 + SPELLINGS
    logs = np.log10(smoothed(transitions(texts))).ravel()
    kept = ["id", "n_tokens", "n_known", "base_score"]
    ddl = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in kept) + ", score double"
    result = to_arrow(ddl)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            step, of = steps(batch, n)
            total = np.bincount(of, logs[step], batch.num_rows) + batch.column("emission").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(total)], schema=result)

    found = texts.select(*kept, "emission", "classes").mapInArrow(batches, ddl)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found.select(
        F.col("id").alias(id), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        perplexity.alias("perplexity"),
    )
