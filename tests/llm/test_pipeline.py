"""The corpus pipeline, stage by stage, against brute force."""

import corpus_pipeline
from farelens.llm import queries
from tests.llm import data
from tests.llm.test_join_and_dedup import brute_dedup


def test_stages(spark, tmp_path):
    texts = data.random_texts(90, 12)
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    source = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    source.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{place}")
        docs = spark.read.parquet(f"{tmp_path}/{place}")
        kept.append({r.doc_id: r for r in docs.collect()})
        if place < 3:
            assert docs.columns == source.columns, name
    language, joined, cut, _ = kept
    assert set(language) == {i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)}
    expected = {i for i, (_, c) in data.components({i: texts[i] for i in language}).items() if i == c}
    assert set(joined) == expected and all(joined[i].text == texts[i] for i in joined)
    gone = brute_dedup({i: texts[i] for i in joined})
    for i in joined:
        left = texts[i]
        for start, stop in reversed(gone[i]):
            left = left[:start] + left[stop:]
        assert (i in cut) == bool(left.strip())
        if i in cut:
            assert cut[i].text.split() == left.split() and cut[i].n_chars == len(cut[i].text)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(queries.BYTE_BPE)
    total: dict = {}
    packed = docs.collect()
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(library.encode(r.text).ids) + 1 for i, r in cut.items()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(
        f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
