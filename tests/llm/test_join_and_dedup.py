"""N-gram join, signature trees, components and substring dedup against brute force."""

import random
import re

import numpy as np
import pytest

from farelens.llm import line_dedup, ngram_join
from farelens.llm.components import components
from farelens.llm.shingles import shingle_sets
from farelens.llm.signature_tree import WIDE, Entry, bitmap, build, reached
from tests.llm import data

SCHEMA = "doc_id BIGINT, text STRING, n BIGINT, component STRING"


def docs(spark, texts):
    """Extra columns clash with names used inside."""
    return spark.createDataFrame([(i, t, 7, "x") for i, t in texts.items()], SCHEMA)


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_shingle_sets_have_the_right_size():
    texts = data.random_texts(80, 1)
    assert [len(s) for s in shingle_sets(texts)] == [len(data.shingles(t)) for t in texts]
    assert np.array_equal(next(shingle_sets(["A b\tC d E f"])), next(shingle_sets(["a  b c D e F"])))


@pytest.mark.parametrize("block,least", [(512, 64), (4, 3)])
def test_join_equals_brute_force(spark, monkeypatch, block, least):
    """Also with lists in many blocks and frequent shingles in many parts."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", least)
    if block < 512:
        monkeypatch.setattr(ngram_join, "PER_TASK", 3)
    texts = dict(enumerate(data.random_texts(160, 2)))
    got = found(ngram_join.near_duplicates(docs(spark, texts).repartition(3)))
    assert got == data.components(texts)


def test_join_of_one_large_group_of_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = {}
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(120)] = f"e{rng.randrange(10_000)}"
        texts[i] = " ".join(copy)
    assert found(ngram_join.near_duplicates(docs(spark, texts))) == data.components(texts)


def test_join_of_nothing_and_of_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.near_duplicates(empty).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, None), (None, "x y"),
            (5, "p q r s t u v"), (5, "k l m n o p"), (6, "k l m n o p")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted((r.doc_id is not None and r.doc_id, r.n_shingles, r.component_id)
                 for r in ngram_join.near_duplicates(df).collect())
    assert got == [(False, 1, None), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (5, 2, 5),
                   (5, 3, 5), (6, 2, 5)]


def test_trees_keep_every_pair_that_links():
    sets = [s for s in shingle_sets(data.random_texts(150, 4)) if len(s)]
    entries = [Entry(i, i, len(s), int.from_bytes(bitmap(s), "little")) for i, s in enumerate(sets)]

    def links(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    def pairs(left, right=None):
        """Every entry is a component of its own, so a component is an entry."""
        sizes = {e.component: 1 for e in entries}
        return {tuple(sorted(p)) for p in reached(left, right, sizes, 75)}

    kept = pairs(build(entries))
    wanted = {(j, i) for i in range(len(sets)) for j in range(i) if links(i, j)}
    assert wanted <= kept and len(kept) < len(sets) ** 2 / 8
    half = len(entries) // 2
    assert {p for p in wanted if p[0] < half <= p[1]} <= pairs(build(entries[:half]), build(entries[half:]))
    one = [e._replace(component=1) for e in entries]
    assert not list(reached(build(one), None, {1: len(one)}, 75))
    two = [e._replace(component=i % 2) for i, e in enumerate(entries)]
    found_ = set(reached(build(two), None, {0: 9, 1: 10}, 75))
    assert {(i if i % 2 == 0 else j, 1) for j, i in wanted if i % 2 != j % 2} <= found_
    assert all(name % 2 == 0 and component == 1 for name, component in found_)


def test_wide_bitmaps_tell_texts_with_one_common_passage_apart():
    """None of them links; the pairs that the bounds leave do not grow with the square."""
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
    for count in (128, 256, 512):
        sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 63, 60, dtype=np.uint64)]))
                for _ in range(count)]
        entries = []
        for i, own in enumerate(sets):
            bits = bitmap(own, WIDE)
            entries.append(Entry(i, i, len(own), int.from_bytes(bits, "little"), 8 * len(bits)))
        left = list(reached(build(entries), None, {i: 1 for i in range(count)}, 75))
        assert len(left) <= count / 8


def test_join_of_texts_with_one_common_passage(spark, monkeypatch):
    """A list of many components, in wide bitmaps and in blocks; some of its texts link."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10_000)}"
    passage = [word() for _ in range(60)]
    texts = {}
    for i in range(70):
        own = [word() for _ in range(40)]
        texts[i] = " ".join(passage + own)
        if i % 10 == 0:
            texts[100 + i] = " ".join(passage + own[:-1] + [word()])
    tables = {t.name for t in spark.catalog.listTables()}
    assert found(ngram_join.near_duplicates(docs(spark, texts))) == data.components(texts)
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 199)]
    got = {r.id: r.component for r in components(
        spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 140)}, 199: 199, 200: 199}


def brute_dedup(texts, min_words=8):
    first, out = {}, {}
    for i in sorted(texts):
        for start, _, _, digest in line_dedup.units(texts[i] or ""):
            first.setdefault(digest, (i, start))
    for i, text in texts.items():
        gone, run = [], []
        for start, stop, words, digest in [*line_dedup.units(text or ""), (0, 0, 0, None)]:
            if digest is not None and first[digest] != (i, start):
                run.append((start, stop, words))
                continue
            enough = sum(r[2] for r in run) >= min_words
            lines = [m.span() for m in re.finditer(r"[^\n]+", text or "")]
            gone += [r[:2] for r in run if enough or r[:2] in lines]
            run = []
        out[i] = gone
    return out


def test_dedup_equals_brute_force(spark):
    texts = dict(enumerate(data.random_texts(120, 5)))
    rows = line_dedup.deduplicate(docs(spark, texts).repartition(3)).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "n", "component", "removed"}
    expected = brute_dedup(texts)
    assert any(expected.values())
    for row in rows:
        assert [(r.start, r.stop) for r in row.removed] == expected[row.doc_id]
        for r in row.removed:
            kept = texts[r.kept_doc_id][r.kept_start:].lower()
            gone = texts[row.doc_id][r.start:r.stop].lower().strip()
            assert line_dedup.WORD.findall(kept)[:3] == line_dedup.WORD.findall(gone)[:3]
        if not row.removed:
            assert row.text == texts[row.doc_id]


def test_dedup_finds_a_passage_inside_lines(spark):
    passage = "The first part of it goes here. Then comes a second part with many more words! And a third."
    texts = {1: f"Own opening words.\n{passage}\nOwn end.", 2: f"Other words before. {passage} Other words after.",
             3: "Clean. Clean text of its own that nobody else has. Or.", 4: "Or. Clean."}
    rows = {r.doc_id: r for r in line_dedup.deduplicate(docs(spark, texts)).collect()}
    assert rows[1].text == texts[1] and rows[3].text == texts[3] and rows[4].text == texts[4]
    assert rows[2].text.split() == "Other words before. Other words after.".split()
    assert [texts[2][r.start:r.stop].strip() for r in rows[2].removed] == [
        "The first part of it goes here.", "Then comes a second part with many more words!", "And a third."]


def test_dedup_removes_later_whole_lines_of_any_length(spark):
    texts = {1: "All rights reserved.\nThis opening line belongs to the first document alone, yes.\nStop. Go.",
             2: "Another opening line that stands in the second document and nowhere else.\n  all rights reserved \nStop.",
             3: "stop... GO\nMy words. Stop. Go. These are the words of the third document itself.\n\nStop.\nGo. Stop.",
             4: "All rights reserved."}
    rows = {r.doc_id: r.text for r in line_dedup.deduplicate(docs(spark, texts).repartition(2)).collect()}
    assert rows == {
        1: texts[1], 4: "",
        2: "Another opening line that stands in the second document and nowhere else.\nStop.",
        3: "My words. Stop. Go. These are the words of the third document itself.\n\nGo. Stop."}


def test_dedup_finds_passages_wherever_they_stand(spark):
    """Planted in the middle of sentences, against all windows of 50 words."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    own = lambda n: " ".join(word() for _ in range(n))
    long, short, other = own(60), own(49), own(200)
    texts = {1: f"{own(30)} {long} {own(20)} {other}", 2: f"{own(7)} {long.upper()} {own(9)}",
             3: f"{own(30)} {short}\n{own(3)}", 4: f"{own(11)} {short} {own(80)}",
             5: f"{own(40)} {' '.join(other.split()[20:150])}, {own(5)} {long}. {own(4)}"}
    rows = {r.doc_id: r for r in line_dedup.deduplicate(
        docs(spark, texts).repartition(3), passage_words=50).collect()}
    seen = set()
    for i in sorted(texts):
        words = texts[i].lower().replace(",", "").replace(".", "").split()
        gone = set()
        for at in range(len(words) - 49):
            window = tuple(words[at:at + 50])
            gone |= set(range(at, at + 50)) if window in seen else set()
            seen.add(window)
        left = [w for n, w in enumerate(words) if n not in gone]
        assert line_dedup.WORD.findall(rows[i].text.lower()) == left
        assert bool(rows[i].removed) == (i in (2, 5)) == bool(gone)
        for r in rows[i].removed:
            kept, cut = texts[r.kept_doc_id][r.kept_start:].lower(), texts[i][r.start:r.stop].lower()
            assert kept.split()[:9] == cut.split()[:9]


def test_dedup_of_nothing(spark):
    assert line_dedup.deduplicate(spark.createDataFrame([], SCHEMA)).collect() == []
    same = "many words make up this one line of text that is repeated"
    df = spark.createDataFrame([(1, None), (2, ""), (3, same), (4, same), (None, same)],
                               "doc_id BIGINT, text STRING")
    rows = {r.doc_id: r.text for r in line_dedup.deduplicate(df).collect()}
    assert rows == {1: None, 2: "", 3: same, 4: "", None: same}


def test_dedup_keeps_what_only_one_text_of_an_id_has(spark):
    """Two texts of one doc_id: what is repeated in one is not cut out of the other."""
    line = "This whole sentence of many words stands in both documents here."
    first = f"{line} And here goes something that nobody else has said so far."
    other = "Some words that are the opening. And more of it follows after that first part of the text."
    rows = [(1, line), (2, first), (2, other), (2, first), (None, line)]
    got = sorted((str(r.doc_id), r.text.strip()) for r in line_dedup.deduplicate(
        spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), passage_words=50).collect())
    cut = "And here goes something that nobody else has said so far."
    assert got == sorted([("1", line), ("2", cut), ("2", cut), ("2", other), ("None", line)])


def brute_passages(texts, size, units_gone):
    """Spans of all windows of ``size`` words that stand earlier, and the units' spans."""
    first, out = {}, {}
    for i in sorted(texts):
        words = [(m.group().lower(), *m.span()) for m in line_dedup.WORD.finditer(texts[i] or "")]
        gone = [False] * len(texts[i] or "")
        for at in range(len(words) - size + 1):
            window = tuple(w[0] for w in words[at:at + size])
            if first.setdefault(window, (i, at)) != (i, at):
                gone[words[at][1]:words[at + size - 1][2]] = [True] * (words[at + size - 1][2] - words[at][1])
        for start, stop in units_gone[i]:
            gone[start:stop] = [True] * (stop - start)
        out[i] = gone
    return out


def test_units_and_passages_together_equal_brute_force(spark):
    """As registered, where passages overlap units that go and stand across line ends; with
    one very long text."""
    rng = random.Random(17)
    texts = dict(enumerate(data.random_texts(80, 18)))
    long = [t for t in texts.values() if t and len(t.split()) > 70]
    for i in range(200, 230):
        one = rng.choice(long).split(" ")
        at = rng.randrange(max(1, len(one) - 60))
        texts[i] = " ".join(["own" + str(i), "words,", *one[at:at + rng.randrange(40, 70)], "end", f"x{i}."])
    texts[300] = " ".join(f"w{rng.randrange(9000)}" for _ in range(60_000)) + " " + rng.choice(long)
    rows = line_dedup.deduplicate(docs(spark, texts).repartition(3), passage_words=50).collect()
    wanted = brute_passages(texts, 50, brute_dedup(texts))
    seen = 0
    for row in rows:
        gone = [False] * len(texts[row.doc_id] or "")
        for r in row.removed:
            gone[r.start:r.stop] = [True] * (r.stop - r.start)
        # what stands between words that go may stay
        words = [m.span() for m in line_dedup.WORD.finditer(texts[row.doc_id] or "")]
        assert [gone[a:b] for a, b in words] == [wanted[row.doc_id][a:b] for a, b in words], row.doc_id
        seen += any(gone)
    assert seen > 30


@pytest.mark.parametrize("ids", [[0, 5, 1 << 40, -3, -(1 << 62), (1 << 63) - 1, -(1 << 63)]])
def test_places_are_in_order(ids):
    rng = random.Random(1)
    parts = [(i, rng.randrange(1 << 31), rng.randrange(1 << 31)) for i in ids for _ in range(5)]
    columns = [np.array(c) for c in zip(*parts)]
    packed = line_dedup.places(*columns)
    assert [tuple(p) for p in zip(*(c.tolist() for c in line_dedup.parts_of(packed)))] == parts
    assert [p for _, p in sorted(zip(packed.to_pylist(), parts))] == sorted(parts)
    assert [tuple(p) for p in zip(*(c.tolist() for c in line_dedup.parts_of(packed.slice(3, 4))))] == parts[3:7]
