"""Each operator on small inputs: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from refrain.llm import chat, common, decontaminate, graph, language, lines, near, pieces, pii, quality, substrings, urls
from refrain.llm.queries import MODEL, URL_RULES
from tests.llm import plain

DOCS = "doc_id long, text string, lang string, source string"
#: Names that operators use themselves.
CLASHING = ("key", "key_1", "key_2", "row", "gone", "open", "of_1", "frequent", "kept", "n_words", "hit_runs", "base", "packed", "lines")


def frame(spark, rows, schema=DOCS, clashing=False):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.withColumns({c: F.lit("own") for c in CLASHING}) if clashing else df


def prose(seed, n, vocabulary=4000):
    chooser = random.Random(seed)
    return " ".join(f"w{chooser.randrange(vocabulary)}" for _ in range(n))


def story(seed, n_lines, n=12):
    return "\n".join(prose(seed * 1000 + i, n) for i in range(n_lines))


# line dedup


def line_rows():
    shared = story(1, 4)
    return [
        (1, shared + "\n" + story(2, 3), "en", "a"),
        (2, story(3, 2) + "\n" + shared, "en", "b"),
        (3, "a\n\nb\nc\n \nd\na\nb\nc\nd", "en", None),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, "x\nx\nx\nx\nx", "en", "a"),
        (None, shared, "en", "a"),
        (7, "one\r\ntwo\r\nthree", "en", "a"),
        (2, story(3, 2) + "\n" + shared, "en", "b"),
        (8, "\n".join(f"row {i % 700}" for i in range(3000)), "en", "a"),
    ]


def test_lines(spark):
    rows = line_rows()
    found = lines.drop_repeated(frame(spark, rows, clashing=True), counts=("n_lines", "n_removed"))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "", r.n_lines, r.n_removed) for r in found.collect())
    wanted = plain.drop_lines([(r[0], r[1]) for r in rows])
    assert got == sorted((r[0] is not None, r[0] or 0, t or "", n, m) for r, (t, n, m) in zip(rows, wanted))
    assert set(CLASHING) <= set(found.columns)
    assert {r.gone for r in found.collect()} == {"own"}


def test_lines_plan_splits_a_text_once(spark):
    """Not for each line, which it would be if it moved into the functions that are called for each."""
    plan = lines.drop_repeated(frame(spark, line_rows()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 2


# quality


def quality_rows():
    footer = "All rights reserved by the site"
    rows = [(i, story(50 + i, 6) + "\n" + footer + "\n" + prose(900 + i, 8), "en", "a") for i in range(40)]
    rows += [(100 + i, "\n".join([footer] * 40 + [prose(i, 10)]), "en", "a") for i in range(3)]
    rows += [(200 + i, story(7, 8), "en", "a") for i in range(60)]
    near_copy = story(8, 8)
    rows += [(300 + i, near_copy.replace("w1", f"w{i}x", 1), "en", "b") for i in range(60)]
    rows += [(400, None, "en", "a"), (401, "", "en", None), (402, prose(4, 49), "en", None), (403, prose(4, 50), "en", None)]
    rows += [(404, "a b c " * 40, "en", None), (None, prose(5, 60), "en", None), (None, prose(5, 60), "en", None)]
    return rows


def test_quality(spark):
    rows = quality_rows()
    wanted = plain.quality([(r[0], r[3], r[1]) for r in rows])
    judged = quality.judge(frame(spark, rows, clashing=True)).collect()
    assert len(judged) == len(rows)
    kept = {r.doc_id for r in judged if r.kept}
    assert kept == {r[0] for r, (keep, _) in zip(rows, wanted) if keep}
    assert set(range(40)) | set(range(200, 260)) | set(range(300, 360)) <= kept  # copies aren't boilerplate
    assert not kept & {100, 101, 102, 400, 401, 402, 404}
    by_id = {r.doc_id: r for r in judged}
    assert by_id[404].n_repeat_words == 120 and by_id[400].n_words == 0 and by_id[100].frequent_words == 240
    cleaned = quality.apply_rules(frame(spark, rows, clashing=True))
    got = sorted((r.doc_id or -1, r.text) for r in cleaned.collect())
    assert got == sorted((r[0] or -1, text) for r, (keep, text) in zip(rows, wanted) if keep)
    assert {r.row for r in cleaned.collect()} == {"own"}


def test_quality_takes_blocks_of_lines(spark):
    """Inner lines of a block always stand between the same lines; so do those of near-copies, which stay."""
    footer = ["All rights reserved by the site", "Terms of use and privacy", "Contact the webmaster here"]
    menu = [f"menu entry number {i} of the site" for i in range(12)]
    rows = [(i, "\n".join([story(3000 + i, 5), *footer]), "en", "hot") for i in range(200)]
    rows += [(300 + i, "\n".join([*menu, prose(7000 + i, 26)]), "en", "hot") for i in range(30)]
    copied = story(9, 20).split("\n")
    rows += [(400 + i, "\n".join(x + f" own{i}" * (k == i % 20) for k, x in enumerate(copied)), "en", "hot") for i in range(60)]
    judged = {r.doc_id: r for r in quality.judge(frame(spark, rows)).collect()}
    assert {judged[i].frequent_words for i in range(200)} == {15}
    assert {judged[300 + i].frequent_words for i in range(30)} == {84}
    assert {judged[400 + i].frequent_words for i in range(60)} == {0}
    assert {i for i, r in judged.items() if r.kept} == set(range(200)) | set(range(400, 460))
    cleaned = {r.doc_id: r.text for r in quality.apply_rules(frame(spark, rows)).collect()}
    assert all(cleaned[i] == story(3000 + i, 5) for i in range(200))
    assert all(cleaned[r[0]] == r[1] for r in rows if r[0] >= 400)


def test_quality_counts_a_large_group_of_near_copies_once(spark):
    """Two edits of its own in each copy, anywhere, make no line of a group a frequent one; a hot host's footer is one."""
    chooser = random.Random(11)
    copied = story(12, 30).split("\n")
    rows = []
    for i in range(600):
        own = chooser.sample(range(30), 2)
        rows.append((i, "\n".join(f"{x} own{i}" if k in own else x for k, x in enumerate(copied)), "en", "hot"))
    footer = "One footer of a hot host\nand its second line\nand its third line"
    rows += [(1000 + i, story(5000 + i, 6) + "\n" + footer, "en", "hot") for i in range(900)]
    judged = {r.doc_id: r for r in quality.judge(frame(spark, rows)).collect()}
    assert {judged[i].frequent_words for i in range(600)} == {0}
    assert {judged[1000 + i].frequent_words for i in range(900)} == {14}
    assert all(r.kept for r in judged.values())


def test_quality_counts():
    data = "é* a\n \né* a\nb|c".encode()
    n_words, chars, symbols, repeated, again, hashes, counts = quality.measures(data)
    assert (n_words, chars, symbols, repeated, again) == (5, 9, 3, 1, 0)
    assert len(hashes) == 2 and counts == [4, 1]
    chooser = random.Random(3)
    for _ in range(200):
        found = [chooser.choice("abc") for _ in range(chooser.randrange(30))]
        assert quality.repeated_words(common.word_hashes(" ".join(found).encode())) == plain.repeated_words(found)


# decontamination


def test_decontaminate(spark):
    items = [("b", prose(1, 40)), ("a", prose(1, 40)), ("c", "Short Item, here"), (None, prose(2, 13)), ("d", ""), ("e", None), ("f", "x x x x")]
    part = " ".join(prose(1, 40).split()[5:25])
    texts = [
        prose(9, 300) + " " + part.upper().replace(" ", ", ") + " " + prose(8, 30),
        prose(9, 30) + " " + part,
        "a short! item here. " + prose(7, 100),
        None,
        "",
        prose(2, 13),
        "x x x x x x " + prose(3, 400),
        " ".join(prose(1, 40).split()[:12]),
        prose(6, 5000) + " short item here " + prose(5, 5000),
    ]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(2, texts[2], "en", "a")]
    docs, table = frame(spark, rows, clashing=True), frame(spark, items, "item_id string, text string")
    wanted = {i: plain.contamination(t, items) for i, t, _, _ in rows}
    for block in (100_000, 30):
        found = decontaminate.find_items(docs, table, block_words=block).select(
            "doc_id", "n_words", "hit_runs", "hit_items", decontaminate.hit_words().alias("n"), decontaminate.is_contaminated().alias("bad")
        )
        got = found.collect()
        assert len(got) == len(rows)
        for r in got:
            n, hit, ids = wanted[r.doc_id]
            assert (r.n_words, r.n, r.hit_items, r.bad) == (n, len(hit), ids, bool(hit) and 20 * len(hit) >= n)
    cleaned = decontaminate.decontaminate(docs, table)
    assert cleaned.columns == docs.columns
    stay = {i: plain.without_words(t, wanted[i][1]) if t else t for i, t, _, _ in rows if 20 * len(wanted[i][1]) < wanted[i][0] or not wanted[i][1]}
    assert {r.doc_id: r.text for r in cleaned.collect()} == stay
    empty = decontaminate.find_items(docs, table.limit(0))
    assert all(not r.hit_items for r in empty.collect())


def test_automaton_against_search():
    chooser = random.Random(11)
    for _ in range(150):
        items = [(str(i), " ".join(chooser.choice("abcd") for _ in range(chooser.randrange(9)))) for i in range(5)]
        text = " ".join(chooser.choice("abcde") for _ in range(60))
        machine = decontaminate.Automaton([(i, decontaminate.words_of(t.encode())) for i, t in items], 4)
        hit, found = machine.scan(decontaminate.words_of(text.encode()))
        n, wanted, ids = plain.contamination(text, items, 4)
        assert set(np.flatnonzero(hit)) == wanted and sorted(found) == ids


# near-duplicates


def edited(text, seed, n):
    chooser, found = random.Random(seed), text.split()
    for _ in range(n):
        found[chooser.randrange(len(found))] = f"e{chooser.randrange(10**6)}"
    return " ".join(found)


def near_rows():
    rows = []
    for group in range(6):
        base = prose(group, 120)
        rows += [(100 * group + i, edited(base, 100 * group + i, i % 7), "en", "a") for i in range(40)]
    rows += [(900 + i, prose(77, 60), "en", "a") for i in range(30)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, " \n", "en", "a"), (1003, "one", "en", "a"), (1004, "One", "en", "a")]
    rows += [(1005, "p q r s t", "en", "a"), (1006, "q r s t u", "en", "a"), (1007, "p q r s t u v", "en", "a")]
    rows += [(1008, prose(5, 20_000, 10**6), "en", "a"), (1009, edited(prose(5, 20_000, 10**6), 1, 40), "en", "a")]
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rows = near_rows()
    first, sets = plain.near_components([(r[0], r[1]) for r in rows], width)
    found = near.near_duplicates(frame(spark, rows, clashing=True), width=width).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert got == {r[0]: (len(s), rows[f][0], rows[f][0] == r[0]) for r, f, s in zip(rows, first, sets)}


def test_near_duplicates_of_odd_rows(spark):
    text = prose(3, 80)
    rows = [(5, text, "en", "a"), (5, text, "en", "a"), (None, text, "en", "a"), (5, prose(4, 80), "en", "a"), (None, None, "en", "a")]
    docs = frame(spark, rows, clashing=True)
    found = near.near_duplicates(docs).collect()
    assert len(found) == 5
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(5, 5, True), (None, 5, False), (None, None, True)}
    left = near.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted([(5, text), (5, rows[3][1]), (0, "")])


@pytest.mark.parametrize("rounds", [0, 2])
def test_buckets_lose_no_link(spark, rounds):
    """All sets in one bucket, many just above or below the limit; with no round the prefix filter finds all links."""
    chooser = np.random.default_rng(12)
    base = chooser.integers(0, 2**62, 60).astype(np.uint64)
    other = np.concatenate((base[:40], chooser.integers(0, 2**62, 25).astype(np.uint64)))
    found = []
    for i in range(70):
        of = (base, other)[i % 2]
        kept = of[chooser.random(len(of)) > 0.06 * (i % 5)]
        found.append(np.unique(np.concatenate((kept, chooser.integers(0, 2**62, i % 9).astype(np.uint64)))))
    found.append(np.unique(base[:7]))
    nodes = [bytes([i]) for i in range(len(found))]
    members = frame(spark, [(1, n, len(s)) for n, s in zip(nodes, found)], "bucket long, node binary, n long")
    sets = frame(spark, list(zip(nodes, (bytearray(s.tobytes()) for s in found))), "node binary, shingles binary")
    labels = {r.node[0]: r.label[0] for r in near.links(members, sets, 80, rounds).collect()}
    near_by = [[j for j, t in enumerate(found) if 100 * near.common(s, t) >= 80 * (len(s) + len(t) - near.common(s, t))] for s in found]
    for i in range(len(found)):
        reached, front = {i}, [i]
        while front:
            front = [j for x in front for j in near_by[x] if j not in reached and not reached.add(j)]
        assert labels.get(i, i) == min(reached)


def test_band_hashes_use_both_ends():
    chooser = np.random.default_rng(1)
    met = 0
    for _ in range(300):
        both = chooser.integers(0, 2**63, 900, dtype=np.int64).astype(np.uint64)
        one, two = np.unique(both[:850]), np.unique(both[50:])  # similarity 800 / 900
        met += bool(set(near.band_hashes(one)) & set(near.band_hashes(two)))
    assert met == 300


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (11, 10), (7, 7)] + [(100 + i, 101 + i) for i in range(60)] + [(500, 600 + i) for i in range(50)]
    found = graph.components(frame(spark, links, "a long, b long")).collect()
    labels = {r.node: r.label for r in found}
    assert {labels[i] for i in range(100, 161)} == {100} and {labels[600 + i] for i in range(50)} == {500}
    assert labels[3] == 1 and labels[11] == 10 and 7 not in labels
    more = graph.merged(graph.components(frame(spark, links, "a long, b long")), frame(spark, [(160, 3), (7, 8), (8, 640), (1, 2)], "a long, b long"))
    labels = {r.node: r.label for r in more.collect()}
    assert {labels[i] for i in (1, 2, 3, *range(100, 161))} == {1} and {labels[i] for i in (7, 8, 500, 601)} == {7}
    assert labels[11] == 10 and more.count() == len(labels)


# repeated strings


def string_rows():
    shared = prose(1, 90)
    texts = [
        "x" * 1500,
        "x" * 199 + "y",
        "ab" * 400,
        prose(2, 50) + shared + prose(3, 50),
        shared[7:] + prose(4, 30),
        prose(5, 30) + shared[:-90],
        prose(5, 30) + shared[20:260] + "é" * 150,
        None,
        "",
        "é" * 100,
        "é" * 99,
        prose(6, 40),
        prose(6, 40),
        prose(6, 40)[:-1] + "#",
        shared[:199],
        prose(9, 30) + prose(9, 30),
    ]
    for i in range(25):  # copies with an edit each
        found = list(shared)
        found[(i * 37) % len(found)] = "~"
        texts.append("".join(found))
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


@pytest.mark.parametrize("chunk", [None, 300])
def test_repeated_strings(spark, monkeypatch, chunk):
    if chunk:  # long texts in many parts; the workers get the function with what it uses
        monkeypatch.setattr(substrings, "CHUNK", chunk)
        for part in ("first_level",):
            monkeypatch.setattr(getattr(substrings, part), "__module__", "__main__")
    rows = string_rows() + [(3, string_rows()[3][1], "en", "a"), (None, prose(6, 40), "en", "a")]
    wanted = plain.removed_bytes([r[1] for r in rows])
    found = substrings.remove_repeated(frame(spark, rows, clashing=True), keep_text=True).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert got == sorted(
        (r[0] is not None, r[0] or 0, len((r[1] or "").encode()), n, s, left) for r, (n, s, left) in zip(rows, wanted)
    )


def test_runs_cover_every_string_once():
    chooser = random.Random(2)
    for _ in range(40):
        texts = [bytes(chooser.choice(b"ab ") for _ in range(chooser.randrange(700))) for _ in range(5)]
        ends = np.cumsum([len(t) for t in texts])
        lo, hi, place, _ = substrings.runs_of(b"".join(texts), ends)
        found = [p for a, b in zip(lo, hi) for p in range(a, b + 1)]
        starts = ends - [len(t) for t in texts]
        assert sorted(found) == [p for s, e in zip(starts, ends) for p in range(s, e - substrings.LENGTH + 1)]
        assert (place >= hi).all() and (place + substrings.Q <= lo + substrings.LENGTH).all()


# urls


def test_stars_in_rules_are_literal(spark):
    rules = [urls.Rule("block", "a.com", "/x*y/"), urls.Rule("block", "b.com", "/\\d*/")]
    seen = {1: "http://a.com/x*y/z", 2: "http://a.com/xQy/z", 3: "http://w.b.com/\\d*/", 4: "http://b.com/\\d7/", 5: "http://b.com/d*/"}
    found = urls.judge(spark.createDataFrame(list(seen.items()), "page_id long, url string"), rules)
    assert {r.page_id: (r.rule, r.verdict) for r in found.collect()} == {
        1: ("a.com/x*y/", "block"), 2: (None, "allow"), 3: ("b.com/\\d*/", "block"), 4: (None, "allow"), 5: (None, "allow")
    }
    assert urls.ShiftAnd(["a\\*b*", "c\\"]).match([b"a*bc", b"axbc", b"c\\"]).tolist() == [[True, False], [False, False], [False, True]]


def test_urls(spark):
    given = [
        "http://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "http://org.net/es/1", "http://xnet/es/1", "http://m.net/fr",
        "http://example.org/files/a.exe", "http://example.org/admin/x", "http://com", "http://com/", "http://a.org?u=http://b.com/x",
        "ftp://x.org#/admin/", "no scheme.com/en/", None, "", "://", "http://é.com/" + "p" * 5000, "http://example.com/en",
        "http://evil.org/.example.com/en/", "x://y://z.com/",
    ]
    rows = [(i, u) for i, u in enumerate(given)] + [(0, given[0])]
    pages = frame(spark, rows, "page_id long, url string").withColumns({"rule": F.lit(1), "host": F.lit(2), "html": F.lit(3)})

    def plain_rule(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = plain.lowered(host)
        fits = [r for r in URL_RULES if (host == r.site or host.endswith("." + r.site)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        bad = path.endswith((".exe", ".zip")) or "/admin/" in path
        return host, path, best and best.name, best.verdict if best else "block" if bad else "allow"

    found = urls.judge(pages, URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == plain_rule(given[r.page_id]), given[r.page_id]
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def test_automaton_against_regular_expressions():
    chooser = random.Random(4)
    for _ in range(120):
        globs = ["".join(chooser.choice(["a", "b", "/", "*", "**", "ab"]) for _ in range(chooser.randrange(1, 25))) for _ in range(9)]
        texts = ["".join(chooser.choice("ab/") for _ in range(chooser.randrange(20))).encode() for _ in range(30)]
        found = urls.ShiftAnd(globs).match(texts)
        for j, glob in enumerate(globs):
            pattern = re.sub(r"\*\*|\*", lambda m: ".*" if m[0] == "**" else "[^/]*", glob)
            assert [bool(re.fullmatch(pattern, t.decode())) for t in texts] == found[:, j].tolist(), glob


# language


def test_code_lengths_against_plain_python():
    samples = {"aa": [b"the cat sat on the mat", b"The hat"], "bb": [b"le chat est sur la table", "été".encode()], "cc": [b"x"]}
    models = language.Models(samples)
    texts = [b"the chat", b"", b"zzz", "été à la table THE".encode(), b"at " * 300]
    got = models.lengths(texts)
    for i, text in enumerate(texts):
        for j, name in enumerate(models.languages):
            assert got[i, j] == pytest.approx(plain.code_length(text, samples[name], language.ORDER), rel=1e-5)


def test_long_texts_are_scored_whole(monkeypatch):
    models = language.Models({"aa": [b"the cat sat on the mat"], "bb": [b"le chat est sur la table"]})
    texts = [b"the table " * 500, b"le mat", b"x"]
    whole = models.lengths(texts)
    monkeypatch.setattr(language, "CHUNK", 64)
    assert np.allclose(models.lengths(texts), whole)


def test_hash_table():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**62, 5000).astype(np.uint64))
    table = language.HashTable(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), np.arange(len(keys)) + 1, -1)).all()


def test_language_of_odd_rows(spark):
    rows = [(i, f"the cat sat on mat {i}", "en", "a") for i in range(20)] + [(50 + i, f"der hund sitzt da {i}", "de", "a") for i in range(20)]
    rows += [(100, None, "en", "a"), (101, "", None, "a"), (102, "123 !?", "de", "a"), (103, "дом", None, "a"), (None, "the cat", None, "a"), (None, "the cat", None, "a")]
    docs = frame(spark, rows, clashing=True).withColumn("score", F.lit("own"))
    models = language.train(docs, "text", "lang", F.col("doc_id"))
    found = language.predict(docs, models)
    got = {r.doc_id: r.lang_pred for r in found.collect()}
    assert [got[i] for i in (0, 50, 100, 101, 102, None)] == ["en", "de", "und", "und", "und", "en"] and got[103] in ("en", "de")
    assert found.count() == len(rows) and dict(found.dtypes)["score"] == "double"
    nothing = language.predict(docs, language.train(docs.limit(0), "text", "lang", F.col("doc_id")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_a_language_of_long_texts_only_is_learned(spark):
    """Of each a drawn stretch of bounded length; the driver's bytes are bounded over all languages together."""
    words = {"en": "the cat and the hat sat there with this thing", "de": "der hund und die katze sitzen nicht auf dem dach"}
    chooser = random.Random(4)
    rows = []
    for i in range(16):
        lang = "de" if i % 2 else "en"
        n = 6000 if lang == "de" else 40
        rows.append((i, " ".join(chooser.choice(words[lang].split()) for _ in range(n)), lang, "a"))
    docs = frame(spark, rows)
    assert all(len(r[1]) > 21_000 for r in rows if r[2] == "de")
    for options in ({}, {"texts": 3, "characters": 500}):
        models = language.train(docs, "text", "lang", F.col("doc_id"), **options)
        assert models.languages == ["de", "en"]
        assert {r.doc_id: r.lang_pred for r in language.predict(docs, models).collect()} == {r[0]: r[2] for r in rows}
    assert language.predict(docs.limit(0), models).collect() == []


def test_predictions_equal_plain_python(spark):
    chooser = random.Random(5)
    letters = {"en": "the an on ", "fr": "le ou en é "}
    rows = [(i, "".join(chooser.choice(letters["fr" if i % 3 else "en"]) for _ in range(30)) + "x", "fr" if i % 3 else "en", "a") for i in range(12)]
    docs = frame(spark, rows)
    models = language.train(docs, "text", "lang", F.col("doc_id"))
    samples = {x: [r[1].encode() for r in rows if r[2] == x] for x in ("en", "fr")}
    for row in language.predict(docs, models).collect():
        bits = {x: plain.code_length(row.text.encode(), samples[x], language.ORDER) for x in samples}
        assert row.lang_pred == min(bits, key=bits.get)
        assert row.score == pytest.approx(1 / sum(2 ** (min(bits.values()) - b) for b in bits.values()), rel=1e-3)


def test_stretches_are_of_bounded_length(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, "abc"), (3, ""), (4, None), (None, "abcdefghij")], "k long, t string")
    found = {r.k: r.s for r in df.select("k", common.stretch(F.col("t"), F.col("k"), 4).alias("s")).collect()}
    assert len(found[1]) == 4 and found[1] in "abcdefghij" and (found[2], found[3], found[4]) == ("abc", "", None)


# personal data


def plain_spans(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            check = sum(int(d) if i % 2 == 0 else 2 * int(d) - 9 * (int(d) > 4) for i, d in enumerate(digits[::-1]))
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and check % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_against_the_patterns():
    chooser = random.Random(8)
    for _ in range(20_000):
        text = "".join(chooser.choice("ab@@..-+% 0123 ()5é\n") for _ in range(chooser.randrange(45)))
        assert pii.written(pii.base_spans(text)) == ",".join(plain_spans(text))
    assert pii.written(pii.base_spans("4539 1488 0343 6467, 1.2.3.4 " + "0" * 9000 + ".1.2.3")) == "ip:21:28,ip:29:9035,card:0:19"


def test_field_makes_labels_agree():
    filler = "on the one hand and 12 on the other"
    texts = [f"call +1 (476) 555-{i:04d} now, item {i}. mail a{i}@b.org {filler}" for i in range(300)]
    field = pii.Field(texts)
    text = "call +1 (476) 555-5473 now " + "and so on " * 50 + "then 555-5473 again, chapter 12 and 7"
    base = pii.base_spans(text)
    added = [(pii.KINDS[k], text[a:b]) for k, a, b in field.added(text, base)]
    assert added == [("phone", "555-5473")]
    assert field.added("no data here", []) == [] and field.added("", []) == []


def test_messages_against_enumeration():
    """On a chain and one skip link that closes no loop, passing messages is exact."""
    field = pii.Field(["call +1 (476) 555-0000 now", "mail a1@b.org and 12"], steps=20)
    tokens = pii.Tokens("12 a1@b.org word 555-0000 word 12")
    observed = tokens.kinds([])
    u, v, kind = tokens.links()
    alone = field.weights[np.array(tokens.features)].sum(axis=1)
    n = len(alone)
    total = np.zeros((n, 5))
    for state in np.ndindex(*([5] * n)):
        weight = np.exp(sum(alone[i, s] for i, s in enumerate(state)) + sum(field.links[k, state[a], state[b]] for a, b, k in zip(u, v, kind)))
        for i, s in enumerate(state):
            total[i, s] += weight
    assert np.allclose(field.chances(tokens, observed), total / total.sum(axis=1, keepdims=True), atol=2e-3)


def test_field_finds_masked_spans():
    """Half of the finds are hidden from the field; it adds most of them again, and little else."""
    chooser = random.Random(12)

    def text(i):
        number = f"+1 ({chooser.randrange(200, 999)}) 555-{chooser.randrange(10**4):04d}"
        mail = f"{prose(i, 1)}{i}@site{chooser.randrange(99)}.org"
        parts = [f"call {number} today", f"write to {mail} please", f"server 10.0.{chooser.randrange(255)}.{chooser.randrange(255)} is up"]
        parts += [f"chapter {chooser.randrange(99)} of {chooser.randrange(2000)}", f"costs {chooser.randrange(99)}.{chooser.randrange(99):02d}", f"reply to {mail}"]
        return ". ".join(chooser.sample(parts, 5)) + " " + prose(i, 20)

    field = pii.Field([text(i) for i in range(400)])
    masked = hit = elsewhere = 0
    for i in range(400, 600):
        said = text(i)
        base = pii.base_spans(said)
        hidden = [s for s in base if chooser.random() < 0.5]
        added = field.added(said, [s for s in base if s not in hidden])
        masked += len(hidden)
        hit += sum(any(k == kind and a < d and c < b for k, a, b in added) for kind, c, d in hidden)
        elsewhere += sum(not any(a < d and c < b for _, c, d in hidden) for _, a, b in added)
    assert masked > 200 and hit >= 0.95 * masked and elsewhere <= 0.05 * masked


def test_field_is_fitted_as_a_whole():
    """At the fitted weights the labels are more probable, each given its neighbours, than without the links."""
    texts = [f"order {i:05d} for a{i % 7}@b.org. then order {i:05d} came back. 10.0.0.{i % 200} and 10.0.0.{i % 200} again" for i in range(150)]
    field, bare = pii.Field(texts), pii.Field(texts)
    bare.links = np.zeros_like(bare.links)

    def surprise(field):
        total = 0.0
        for text in texts:
            tokens = pii.Tokens(text)
            kinds = tokens.kinds(pii.base_spans(text))
            scores = field.weights[np.array(tokens.features)].sum(axis=1)
            for a, b, kind in zip(*tokens.links()):
                scores[b] += field.links[kind, kinds[a]]
                scores[a] += field.links[kind, :, kinds[b]]
            total += (np.log(np.exp(scores).sum(axis=1)) - scores[np.arange(len(kinds)), kinds]).sum()
        return total

    assert field.links[1:].any() and np.allclose(field.links[1:], field.links[1:].transpose(0, 2, 1))
    assert surprise(field) < surprise(bare)


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "é a@b.co 10.0.0.1", "en", "a"), (3, "é a@b.co 10.0.0.1", "en", "a"), (None, "9" * 50_000 + "x@" * 20_000, "en", "a")]
    docs = frame(spark, rows, clashing=True)
    found = pii.find(docs, pii.train(docs, F.col("doc_id"))).select("doc_id", pii.spans_text("base").alias("said"), "added", "row")
    got = {r.doc_id: r.said for r in found.collect()}
    assert got == {1: "", 2: "", 3: "email:2:8,ip:9:17", None: ""} and found.count() == 5
    assert pii.find(docs.limit(0), pii.Field([])).count() == 0


# pieces


def test_pieces_against_the_library():
    model, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.load(MODEL)
    chooser = random.Random(6)
    alphabet = "ab the tion\n\t  日本é😀.,1  \x00{}()==//ü"
    texts = ["".join(chooser.choice(alphabet) for _ in range(chooser.randrange(40))) for _ in range(4000)]
    texts += [" " * n + "x" + " " * n for n in range(40)] + ["", " ", "\n", "a" * 3000, "tion" * 500, "▁", "a▁ b"]
    for text in texts:
        ids = np.frombuffer(own.encode(text), np.int32).tolist()
        assert ids == model.encode(text), repr(text)
        assert own.decode(ids).decode() == text.replace("▁", " ").removeprefix("" if text[:1] != "▁" else "")


def test_pieces_decode_any_ids(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for ids in ([0], [1, 2], [0, 300, 0], [300, 0], [450, 2, 451]):
        assert pieces.load(MODEL).decode(ids).decode() == model.decode(ids)
    rows = [(1, [-1, 450, 10**6]), (2, [None, 450]), (3, None), (4, [])]
    back = pieces.decode(spark.createDataFrame(rows, "doc_id long, tokens array<int>"), MODEL)
    known = model.id_to_piece(450).replace("▁", " ")
    assert {r.doc_id: r.text for r in back.collect()} == {1: f"\ufffd{known}\ufffd", 2: known.removeprefix(" "), 3: None, 4: ""}


@pytest.mark.parametrize("kind", [4, 5])
def test_other_kinds_of_pieces_are_refused(tmp_path, kind):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.pieces[-1].type = kind
    (tmp_path / "own.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="can't be compiled"):
        pieces.load(str(tmp_path / "own.model"))


def test_unigram_path_is_the_shortest():
    chooser = random.Random(9)
    letters = [(c, -3.0 - i, 1) for i, c in enumerate("abc▁")]
    more = {"".join(chooser.choice("abc") for _ in range(chooser.randrange(2, 5))) for _ in range(14)}
    given = [("<unk>", 0.0, 2), *((f"<0x{i:02X}>", 0.0, 6) for i in range(256)), *letters, *((p, -chooser.randrange(2, 12) * 1.0, 1) for p in more)]
    own = pieces.Transducer(given, pieces.UNIGRAM)

    def all_paths(text):
        if not text:
            yield ()
        for i in range(1, len(text) + 1):
            if text[:i] in own.weights or i == 1:
                for rest in all_paths(text[i:]):
                    yield (text[:i], *rest)

    for _ in range(150):
        text = "".join(chooser.choice("abcz") for _ in range(chooser.randrange(1, 9)))
        best = min(sum(own.weights.get(p, own.fallback) for p in path) for path in all_paths(text))
        assert sum(own.weights.get(p, own.fallback) for p in own.path(text)) == best


def test_pieces_of_odd_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "Hello  world\n", "en", "a"), (3, "Hello  world\n", "en", "a"), (4, "x" * 100_000, "en", "a")]
    encoded = pieces.encode(frame(spark, rows, clashing=True).withColumn("tokens", F.lit("own")), MODEL)
    back = pieces.decode(encoded.withColumnRenamed("text", "given"), MODEL)
    got = back.collect()
    assert len(got) == 5 and all(r.text == r.given for r in got)
    assert {r.doc_id: r.tokens and len(r.tokens) for r in got}[1] is None
    assert pieces.encode(frame(spark, rows).limit(0), MODEL).count() == 0


# chat


def chat_rows():
    rows = [(1, i, ("system", "user", "assistant")[min(i, 1 + i % 2)], prose(i, 60)) for i in range(60)]
    rows += [(2, 0, "user", "<|turn|>a<|says|>b<|end|>\n\\<[ $1 \\$"), (2, 1, "assistant", "[INST]</s>\\n<|end|>"), (2, 1, "assistant", "[INST]</s>\\n<|end|>")]
    rows += [(3, 0, None, None), (3, None, "assistant", ""), (4, 0, "assistant", prose(1, 3000)), (4, 1, "user", "x"), (None, 0, "us\ner", "y")]
    rows += [(5, i, "assistant", f"t{i}") for i in range(700)]
    return rows


def test_chat(spark):
    rows = chat_rows()
    turns = frame(spark, rows, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(1), "window": F.lit(2)})
    made = chat.windows(turns)
    back = {}
    for r in chat.read_back(made).collect():
        back.setdefault(r.conv_id, []).append(r)
    windows = {}
    for r in made.collect():
        windows.setdefault(r.conv_id, {})[r.window] = r
    assert set(back) == {r[0] for r in rows}
    for conv, parts in back.items():
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        parts.sort(key=lambda p: p.window)
        assert [(t.role, t.text) for p in parts for t in p.turns] == [(r, x) for _, _, r, x in own]
        assert [x for p in parts for x in p.targets] == [x for _, _, r, x in own if r == "assistant"]
        for p in parts:
            window = windows[conv][p.window]
            assert window.n_turns == window.n_repeated + len(p.turns) == window.formatted.count(chat.TURN)
            assert p.chars == len(window.formatted)
    long = windows[1]
    assert len(long) > 5 and all(w.formatted.startswith(chat.TURN + "system" + chat.SAYS) for w in long.values())
    assert all(len(plain.words(w.formatted)) + 2 * w.n_turns <= chat.BUDGET + 62 for w in long.values())
    assert all(w.n_repeated > 1 for n, w in long.items() if n)
    assert chat.windows(turns.limit(0)).count() == 0


def test_escapes_are_reversed(spark):
    chooser = random.Random(7)
    texts = ["".join(chooser.choice("\\<[|/a\n$") for _ in range(chooser.randrange(12))) for _ in range(500)]
    df = frame(spark, [(t,) for t in texts], "text string").withColumn("escaped", chat.escaped(F.col("text")))
    for r in df.select("text", "escaped", chat.unescaped(F.col("escaped")).alias("back")).collect():
        assert r.back == r.text and not re.search(r"<[|/s]|\[I|\[/", r.escaped)


# all


def test_empty_tables(spark):
    docs = frame(spark, line_rows(), clashing=True).limit(0)
    assert lines.drop_repeated(docs).count() == 0
    assert quality.apply_rules(docs).count() == 0
    assert quality.judge(docs).count() == 0
    assert near.drop_near_duplicates(docs).count() == 0
    assert substrings.remove_repeated(docs).count() == 0
    items = frame(spark, [("a", "b")], "item_id string, text string")
    assert decontaminate.decontaminate(docs, items).count() == 0


def test_words_of_long_texts(monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 50)
    text = "\n".join([prose(1, 30), "y" * 70_000, prose(2, 30)]).encode()
    assert b" ".join(p for x in common.pieces(text) for p in x.split()) == b" ".join(text.split())
    assert len(common.word_hashes(text)) == 61
