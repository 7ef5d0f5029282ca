"""Fill-in-middle against a plain version, and the exact way back."""

from hashlib import sha256

import pytest

from farelens.llm import fill_in_middle
from tests.llm import data

SCHEMA = "doc_id BIGINT, text STRING, row BIGINT, piece STRING, form INT"


def docs(spark, rows):
    """Extra columns clash with names used inside."""
    return spark.createDataFrame([(i, t, 7, "x", 1) for i, t in rows], SCHEMA)


def brute(doc_id, text):
    text = text or ""
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rows = list(enumerate(data.random_texts(150, 41)))
    rows += [(1000, "has <M> a mark"), (1001, "<<P" * 40), (1002, "<S" + "<" * 30 + "P"), (1003, "🙂é" * 300),
             (None, "no id"), (1004, "same"), (1004, "same"), (1004, "other"), (None, None)]
    return rows + [(2000 + i, "<M<S<P" * 9 + "<") for i in range(40)]


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_equals_brute_force_and_comes_back(spark, monkeypatch, chunk):
    """Pieces may end inside marks of the output only where the text has such letters."""
    monkeypatch.setattr(fill_in_middle, "CHUNK", chunk)
    rows = texts()
    df = docs(spark, rows).repartition(3)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)
           for r in fill_in_middle.transform(df).collect()]
    wanted = [(i, *brute(i, t)) for i, t in rows]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    back = fill_in_middle.joined(fill_in_middle.restored(fill_in_middle.pieces(df)), "text").collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(
        ((i, t or "") for i, t in rows), key=repr)
    digest = lambda t: sha256(t.encode()).hexdigest()
    assert sorted(((r.doc_id, r.output_sha256, r.restored_sha256)
                   for r in fill_in_middle.digests(df).collect()), key=repr) == sorted(
        ((i, digest(brute(i, t)[-1]), digest(t or "")) for i, t in rows), key=repr)


@pytest.mark.parametrize("form", ["plain", "psm", "spm"])
def test_sections_are_found_whatever_the_borders(form):
    parts = ["pre<", "mid<S", "suf<M<"]
    marks = {"plain": "pre<mid<Ssuf<M<", "psm": "<P>pre<<S>suf<M<<M>mid<S", "spm": "<S>suf<M<<P>pre<<M>mid<S"}
    for size in range(1, 9):
        sections, found = fill_in_middle.Sections(form), ["", "", ""]
        for at in range(0, len(marks[form]), size):
            for place, text in sections.feed(marks[form][at:at + size]):
                found[place] += text
        for place, text in sections.feed("", last=True):
            found[place] += text
        assert found == (["".join(parts), "", ""] if form == "plain" else parts)


def test_one_shuffle_brings_output_and_original_in_order(spark):
    plan = fill_in_middle.digests(docs(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort") == 2


def test_nothing_and_a_very_long_text(spark):
    assert fill_in_middle.digests(docs(spark, [])).collect() == []
    long = "äb c" * 1_500_000
    rows = {r.doc_id: r for r in fill_in_middle.digests(docs(spark, [(i, long) for i in range(4)])).collect()}
    for i, row in rows.items():
        n, form, prefix, middle, output = brute(i, long)
        assert (row.n, row.form, row.prefix_chars, row.middle_chars) == (n, form, prefix, middle)
        assert row.output_sha256 == sha256(output.encode()).hexdigest()
        assert row.restored_sha256 == sha256(long.encode()).hexdigest()
