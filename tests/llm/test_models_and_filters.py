"""Language ID, language-model scoring, fingerprints, URL filters and neighbours."""

import fnmatch
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from farelens import session
from farelens.llm import ann_forest, fingerprint, langid, lm_scoring, queries, url_filter
from tests.llm import data
from tests.oracle import compare, connect


def test_language_id_on_held_out_documents(spark, medium):
    rows = queries.language_id(spark, medium).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_language_id_of_odd_rows(spark):
    train = [(i, " ".join(w * (i % 3 + 1) for w in ("alpha", "beta") * 4), "aa") for i in range(40)]
    train += [(100 + i, " ".join(w * (i % 3 + 1) for w in ("xyz", "quux") * 4), "bb") for i in range(40)]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 !? \n", None), (903, "alphab", None),
           (904, "quuxx xy", None), (903, "alphab", None), (None, "xyz", None)]
    df = spark.createDataFrame(train + odd, "doc_id BIGINT, text STRING, lang STRING")
    got = sorted((str(r.doc_id), r.lang_pred) for r in langid.identify(df).collect() if r.doc_id is None or r.doc_id > 800)
    assert got == [("900", "und"), ("901", "und"), ("902", "und"), ("903", "aa"), ("903", "aa"),
                   ("904", "bb"), ("None", "bb")]
    kept = langid.with_language(df.withColumn("score", df.doc_id), into=None)
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.count() == 84
    assert {r.lang_pred for r in langid.identify(df.filter("lang IS NULL")).collect()} == {"und"}
    assert langid.identify(df.limit(0)).collect() == []


def test_language_id_learns_from_words_seen_once(spark):
    """Every word of a language stands once; its n-grams still tell it."""
    rows = [(1, "alpha beta alpha beta", "aa"), (2, "xyzzy quuxel zyxquu", "bb"), (3, "xyzquux", None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2))
    assert {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}[3] == "bb"


def test_backoff_goes_to_shorter_grams():
    model = langid.LanguageModel([("a", "known", 0, 5), ("b", "other", 0, 5), ("a", "kno", 3, 4),
                                  ("b", "now", 3, 4), ("a", "k", 1, 9), ("b", "z", 1, 9)])
    assert model.word_score("known")[0] > model.word_score("known")[1]
    assert np.array_equal(model.gram_score("know", 4), (model.gram_score("kno", 3) + model.gram_score("now", 3)) / 2)
    assert np.array_equal(model.gram_score("q", 1), np.zeros(2))


def brute_losses(texts, target):
    """Loss per token of each text under the models of ``target`` and of all texts."""
    def counts(rows):
        return (Counter(w for t in rows for w in lm_scoring.tokens(t)),
                Counter(p for t in rows for p in zip(["^"] + named(t), named(t))))

    words = Counter(w for t in [*texts, *target] for w in lm_scoring.tokens(t))
    vocabulary = {w for w, n in words.items() if n >= 2}

    def named(text):
        return [w if w in vocabulary else "?" for w in lm_scoring.tokens(text)]

    pairs = Counter(p for t in [*texts, *target] for p in zip(["^"] + named(t), named(t)))
    out = []
    for rows in (target, texts):
        single = Counter(w for t in rows for w in named(t))
        both = {p: n for p, n in counts(rows)[1].items() if pairs[p] >= 2}
        total, size = sum(single.values()), len(vocabulary) + 2
        after, kinds = Counter(), Counter()
        for (left, _), n in both.items():
            after[left] += n
            kinds[left] += 1
        losses = []
        for text in texts:
            own = named(text)
            sums = 0.0
            for left, right in zip(["^"] + own, own):
                p = (single[right] + 1) / (total + size)
                if after[left]:
                    p = (both.get((left, right), 0) + kinds[left] * p) / (after[left] + kinds[left])
                sums -= math.log(p)
            losses.append(sums / len(own) if own else None)
        out.append(losses)
    return out


def test_scores_equal_brute_force(spark):
    texts = data.random_texts(60, 7)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, score INT")
    good = spark.createDataFrame([(i,) for i in range(0, 60, 3)] + [(999,)], "doc_id BIGINT")
    rows = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(df.repartition(3), good).collect()}
    target, background = brute_losses(texts, texts[::3])
    for i, text in enumerate(texts):
        row = rows[i]
        assert row.n_tokens == len(lm_scoring.tokens(text))
        if not row.n_tokens:
            assert row.score is None and row.target_loss is None
            continue
        assert row.target_loss == pytest.approx(target[i], abs=1e-4)
        assert row.background_loss == pytest.approx(background[i], abs=1e-4)
        assert row.score == pytest.approx(row.target_loss - row.background_loss)


def test_scores_without_target_and_without_rows(spark):
    df = spark.createDataFrame([(1, "a b a b"), (2, None), (1, "a b a b")], "doc_id BIGINT, text STRING")
    none = spark.createDataFrame([], "doc_id BIGINT")
    rows = lm_scoring.cross_entropy_difference(df, none).collect()
    assert len(rows) == 3 and all(r.score is None or r.score > 0 for r in rows)
    assert lm_scoring.cross_entropy_difference(df.limit(0), none).collect() == []


def check_scores(spark, texts, target_ids, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    good = spark.createDataFrame([(i,) for i in target_ids], "doc_id BIGINT")
    target, background = brute_losses(texts, [texts[i] for i in target_ids])
    got = lm_scoring.cross_entropy_difference(df, good, **options).collect()
    assert len(got) == len(texts)
    for row in got:
        assert row.target_loss == pytest.approx(target[row.doc_id], abs=1e-4)
        assert row.background_loss == pytest.approx(background[row.doc_id], abs=1e-4)


def test_scores_keep_rare_words_of_a_large_corpus(spark):
    """A share of the corpus as the least count would drop all words but two."""
    texts = ["dull words " * 400_000, *["alpha beta gamma", "beta gamma delta", "dull alpha"] * 2]
    check_scores(spark, texts, [1, 4])
    check_scores(spark, texts, [1, 4], chunk_words=5)


def test_scores_keep_rare_pairs_of_common_words(spark):
    """All words are common; the target's pairs occur once there, and fewer times than one
    in 2**20 of all pairs. What follows a left word sums to one."""
    texts = ["left main a b " * 600_000, "a left b a", "b main", "main left", "b main"]
    check_scores(spark, texts, [1, 2])


def test_pairs_travel_in_short_blocks():
    """Half a million pairs of a chunk, most of them once: 5 bytes each at most, 40 as rows."""
    rng = np.random.default_rng(3)
    left = np.sort(rng.integers(0, 200_000, 500_000)) + (7 << 33)
    right = rng.integers(0, 24, 500_000) * (1 << 33) + rng.integers(0, 8_000, 500_000)
    count = rng.geometric(0.9, 500_000)
    data = lm_scoring.block(left, right, count, count // 2)
    assert len(data) < 5 * 500_000
    assert all(np.array_equal(*pair) for pair in zip(lm_scoring.unblock(data, 4), (left, right, count, count // 2)))
    none = np.zeros(0, np.int64)
    assert lm_scoring.unblock(lm_scoring.block(none, none), 2).shape == (2, 0)


def test_scores_of_pairs_dealt_to_many_shares(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARE_PAIRS", 300)
    texts = [t for t in data.random_texts(60, 11) if lm_scoring.tokens(t)]
    check_scores(spark, texts, range(0, len(texts), 4), chunk_words=200)


def test_scores_of_words_and_pairs_in_many_shares(spark, monkeypatch):
    """Words below one in twenty keep their pairs in one share, the others do not."""
    for name, value in (("SHARE_WORDS", 40), ("SHARE_PAIRS", 300), ("FREQUENT", 20)):
        monkeypatch.setattr(lm_scoring, name, value)
    texts = [t for t in data.random_texts(60, 13) if lm_scoring.tokens(t)]
    check_scores(spark, texts, range(0, len(texts), 3), chunk_words=150)


def test_scores_store_and_send_no_texts(spark, tmp_path, monkeypatch):
    """What is stored for scoring is less than a third of the texts, and the texts are not read again."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"word{i}" for i in rng.zipf(1.3, 1000) % 5_000) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(2)
    good = spark.createDataFrame([(i,) for i in range(0, 300, 7)], "doc_id BIGINT")
    monkeypatch.setattr(session, "scratch_dir", lambda _, purpose: str(tmp_path / purpose))
    scored = lm_scoring.cross_entropy_difference(df, good)
    plan = scored._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    assert not any("text" in str(leaves.apply(i).output()) for i in range(leaves.size()))
    assert scored.count() == 300
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < sum(map(len, texts)) / 3


def test_fingerprints(spark):
    texts = ["x", "", None, "ab", *[t for t in data.random_texts(70, 8) if t]]
    ids = random.Random(9).sample(range(10_000), len(texts))
    df = spark.createDataFrame([(i, t, 5) for i, t in zip(ids, texts)], "doc_id BIGINT, text STRING, part INT")
    rows = {r.doc_id: r for r in fingerprint.fingerprints(df.repartition(4)).collect()}
    order = sorted(zip(ids, texts))
    assert len(rows) == len(texts)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        row, code = rows[i], fingerprint.codes(text)
        assert row.n_chars == len(text) and row.fingerprint == fingerprint.digest(code)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.edited_fingerprint == fingerprint.digest(fingerprint.codes(changed))
        assert row.near_edited == fingerprint.likeness(code, fingerprint.codes(changed))
        assert row.near_next == fingerprint.likeness(code, fingerprint.codes(after))
        assert 0 <= row.near_next <= 1 and len(row.fingerprint) == 130


def plain_digest(text):
    """Length byte and quartiles of the triplets' buckets, one number at a time."""
    data = list(text.encode())
    size = len(data)
    buckets = [0] * 256
    padded = data + [0] * (3 - size)
    for one, two, three in zip(padded, padded[1:], padded[2:]) if size else ():
        mixed = (one * 2654435761 + two * 2246822519 + three * 3266489917) % 2 ** 32
        buckets[(mixed ^ mixed // 2 ** 15) * 668265263 % 2 ** 32 // 2 ** 24] += 1
    ranked = sorted(buckets)
    quartiles = [sum(count > ranked[place] for place in (63, 127, 191)) for count in buckets]
    return min(255, round(12 * math.log2(size + 1))), quartiles


def plain_likeness(text, other):
    (length, mine), (other_length, theirs) = plain_digest(text), plain_digest(other)
    steps = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(a - b)] for a, b in zip(mine, theirs))
    return 1 - (steps + min(64, abs(length - other_length))) / (6 * 256 + 64)


def test_digest_and_likeness_equal_a_plain_count():
    texts = ["", "a", "ab", "abc", "日本語", "\0\0\0", "word " * 30_000, *[t for t in data.random_texts(40, 21) if t]]
    for text, other in zip(texts, texts[1:] + texts[:1]):
        length, quartiles = plain_digest(text)
        digits = "".join("0123"[q] for q in quartiles)
        written = fingerprint.digest(fingerprint.codes(text))
        assert written == f"{length:02x}" + f"{int(digits, 4):0128x}"
        found = fingerprint.likeness(fingerprint.codes(text), fingerprint.codes(other))
        assert found == pytest.approx(plain_likeness(text, other), abs=1e-12)


def test_fingerprints_of_one_and_of_repeated_rows(spark):
    one = spark.createDataFrame([(4, "some text")], "doc_id BIGINT, text STRING")
    assert [r.near_next for r in fingerprint.fingerprints(one).collect()] == [1.0]
    many = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "c"), (2, "c")], "doc_id BIGINT, text STRING")
    assert sorted(str(r.doc_id) for r in fingerprint.fingerprints(many).collect()) == ["1", "1", "2", "2", "None"]
    assert fingerprint.fingerprints(one.limit(0)).collect() == []


def test_globs_equal_fnmatch():
    rng = random.Random(10)
    globs = ["*", "", "a*", "*a", "*ab*", "a?c", "?", "*a*b*", "abc", "**b", "a\\*", *[
        "".join(rng.choice("ab*?c") for _ in range(rng.randint(1, 30))) for _ in range(40)]]
    texts = ["", "a", "b", "ab", "abc", "a*", *["".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))
                                               for _ in range(200)]]
    got = url_filter.GlobSet(globs).matches([t.encode() for t in texts])
    for j, glob in enumerate(globs):
        pattern = re.compile(fnmatch.translate("a[*]" if glob == "a\\*" else glob))
        assert got[:, j].tolist() == [bool(pattern.match(t)) for t in texts], glob


def test_url_rules(spark):
    urls = [(1, "HTTP://A.Example.NET/en/x?q#f", "allow", "example.net/en/"), (2, "http://x.net/en/", "block", "net/"),
            (3, "http://net/", "block", "net/"), (4, "http://planet/", "allow", None), (5, None, "allow", None),
            (6, "no scheme", "allow", None), (7, "http://example.com/de/a", "block", "example.com/de/"),
            (8, "x://h.org/fr/#", "allow", "org/fr/"), (9, "http://a.net", "allow", None),
            (10, "http://host/a.net /b", "allow", None), (11, "http://e.net/\n日", "block", "net/"),
            (11, "http://e.net/\n日", "block", "net/")]
    df = spark.createDataFrame([u[:2] for u in urls], "page_id BIGINT, url STRING")
    rows = url_filter.judge_urls(df, queries.URL_RULES).collect()
    assert sorted((r.page_id, r.verdict, str(r.rule)) for r in rows) == sorted((u[0], u[2], str(u[3])) for u in urls)
    by_id = {r.page_id: r for r in rows}
    assert (by_id[1].host, by_id[1].path) == ("a.example.net", "/en/x") and by_id[5].host == ""
    extra = url_filter.judge_urls(df, [], [("*.org *", "block")], default="keep").collect()
    assert {r.page_id for r in extra if r.verdict == "block"} == {8}


def test_neighbours(spark):
    rng = np.random.default_rng(11)
    vectors = rng.standard_normal((400, 8)).tolist()
    vectors[5] = vectors[0]
    for i in range(100, 230):
        vectors[i] = vectors[40]
    bad = [(1000, None), (1001, [0.0] * 8), (1002, [1.0] * 7 + [float("nan")]), (1003, [1.0, None] + [0.0] * 6),
           (1020, [1.0]), (1021, [float("inf")] + [0.0] * 7), (7, vectors[7])]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(i, v, 1) for i, v in bad]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, rank INT").repartition(3)
    found: dict = {}
    for r in ann_forest.nearest(df, every=20, k=20, leaf=8).collect():
        found.setdefault(r.query_id, []).append(r)
    whole = np.array(vectors)
    hits = 0
    assert set(found) == set(range(0, 400, 20))
    for q, got in found.items():
        got.sort(key=lambda r: r["rank"])
        scores = (whole * whole[q]).sum(axis=1)
        best = [i for i in np.lexsort((np.arange(400), -scores)) if i != q][:20]
        assert [r["rank"] for r in got] == list(range(1, 21)) and q not in [r.vec_id for r in got]
        assert [r.score for r in got] == [scores[r.vec_id] for r in got]
        assert sorted(got, key=lambda r: (-r.score, r.vec_id)) == got
        hits += len({r.vec_id for r in got} & set(best))
    assert hits / (20 * len(found)) >= 0.9


def test_neighbours_of_few(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    assert ann_forest.nearest(spark.createDataFrame([], schema)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.5, 1.0]), (4, [-1.0, 0.0])], schema)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann_forest.nearest(few).orderBy("rank").collect()]
    assert got == [(0, 1, 3, 0.5), (0, 2, 4, -1.0)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, medium, name):
    assert compare(spark, connect(medium), queries.QUERIES[name], queries.ORACLE[name], medium) is None


def test_all_ten_are_registered():
    numbers = {re.match(r"op(\d+)_", name)[1] for name in entry.queries() if name.startswith("op")}
    assert numbers == {str(n) for n in range(1, 11)} and "pipeline" in entry.queries()


def brute_languages(rows):
    """(language, score) of each text, from plain counts over all training rows."""
    import math
    import re

    letters = re.compile(r"[^\W\d_]+")
    counts: dict = {}
    for doc_id, text, lang in rows:
        if text and lang and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5:
            counts.setdefault(lang, Counter()).update(letters.findall(text.lower()))
    languages = sorted(counts)
    tables = [{}, {}, {}, {}, {}]
    for lang in languages:
        for word, n in counts[lang].items():
            if n > 1:
                tables[0].setdefault(word, Counter())[lang] += n
            for size in range(1, 5):
                marked = f"<{word}>" if size > 1 else word
                for at in range(len(marked) - size + 1):
                    tables[size].setdefault(marked[at:at + size], Counter())[lang] += n
    sums = [{lang: sum(c[lang] for c in table.values()) for lang in languages} for table in tables]

    def logs(gram, size):
        return [math.log((tables[size][gram][lang] + 0.5) / (sums[size][lang] + 0.5 * len(tables[size])))
                for lang in languages]

    def of_gram(gram, size):
        if gram in tables[size]:
            return logs(gram, size)
        if size == 1:
            return [0.0] * len(languages)
        return [(a + b) / 2 for a, b in zip(of_gram(gram[:-1], size - 1), of_gram(gram[1:], size - 1))]

    def of_word(word):
        if word in tables[0]:
            return logs(word, 0)
        size = min(4, len(word) + 2)
        marked = f"<{word}>" if size > 1 else word
        parts = [of_gram(marked[at:at + size], size) for at in range(len(marked) - size + 1)]
        return [sum(p) for p in zip(*parts)]

    out = {}
    for doc_id, text, _ in rows:
        words = letters.findall((text or "").lower())
        if not words:
            out[doc_id] = "und", 0.0
            continue
        total = [sum(p) for p in zip(*map(of_word, words))]
        best = max(range(len(languages)), key=lambda i: (total[i], -i))
        out[doc_id] = languages[best], 1 / sum(math.exp((t - total[best]) / len(words)) for t in total)
    return out


def test_language_id_equals_brute_force(spark):
    """Predictions and scores, with one very long text."""
    import random

    rng = random.Random(21)
    sounds = {"aa": "abcdé", "bb": "cdefgü", "cc": "efghñ"}
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 6)))
                        for _ in range(rng.randint(1, 40)))
        rows.append((i, text.capitalize() + rng.choice([".", " 12!", "\n"]), rng.choice([lang, lang, None])))
    rows += [(500, None, "aa"), (501, " 1 ", "bb"), (502, " ".join(r[1] for r in rows) * 20, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    wanted = brute_languages(rows)
    for row in langid.identify(df.repartition(3)).collect():
        lang, score = wanted[row.doc_id]
        assert row.lang_pred == lang and abs(row.score - score) < 1e-4, row
    kept = {r.doc_id: (r.lang_pred, r.score) for r in langid.with_language(df).collect()}
    assert set(kept) == {i for i, (lang, _) in wanted.items() if lang != "und"}
    assert all(kept[i][0] == wanted[i][0] and abs(kept[i][1] - wanted[i][1]) < 1e-4 for i in kept)
