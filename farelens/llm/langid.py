"""Language identification by words first, then character n-grams.

A word that training has seen scores each language by its log frequency there. An
unseen word falls back to its character 4-grams; where one is unseen, to the 3-grams
inside it, and so on down to single letters. The language with the largest sum over
the text wins (ties to the first in alphabetical order); its score is its share of
the languages' likelihoods, taken per word.

Training counts words and n-grams by Spark over at most about ``train_rows`` labelled
documents with ``train_chars`` characters, chosen by a hash of their id; the model is
what comes to the driver. Languages are weighed alike.

Defined cases: a text that is null or has no letters is ``und`` with score 0, also
where there is nothing to learn from; null ids train nothing; repeated rows are judged
each; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import BoundedCache, pieces_of, stored

UNKNOWN = "und"
LONGEST = 4
LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str, size: int) -> list[str]:
    """The character n-grams of a word between marks; single letters without them."""
    marked = f"<{word}>" if size > 1 else word
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


def held_out(id_column) -> F.Column:
    """The fold that nothing is learned from: crc32 of the id's digits modulo 5 is 0."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


class LanguageModel:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, counts: list[tuple[str, str, int, int]]):
        """``counts``: (language, gram, size, count), size 0 for words."""
        self.languages = sorted({lang for lang, *_ in counts})
        place = {lang: i for i, lang in enumerate(self.languages)}
        self.rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        cells: list[list[tuple[int, int, int]]] = [[] for _ in range(LONGEST + 1)]
        for lang, gram, size, count in counts:
            rows = self.rows[size]
            cells[size].append((rows.setdefault(gram, len(rows)), place[lang], count))
        self.logs = []
        for rows, own in zip(self.rows, cells):
            table = np.zeros((len(rows), len(self.languages)))
            if own:
                row, lang, count = np.array(own, np.int64).T
                table[row, lang] = count
            self.logs.append(np.log(
                (table + 0.5) / (table.sum(axis=0) + 0.5 * len(table))).astype(np.float32))

    def known(self, gram: str, size: int) -> np.ndarray | None:
        """Log frequencies by language of a seen n-gram, or of a seen word at size 0."""
        row = self.rows[size].get(gram)
        return None if row is None else self.logs[size][row]

    def gram_score(self, gram: str, size: int) -> np.ndarray:
        while size:
            known = self.known(gram, size)
            if known is not None:
                return known
            if size == 1:
                break
            parts = [gram[:-1], gram[1:]]
            return sum(self.gram_score(part, size - 1) for part in parts) / 2
        return np.zeros(len(self.languages), np.float32)

    def word_score(self, word: str) -> np.ndarray:
        known = self.known(word, 0)
        if known is not None:
            return known
        size = min(LONGEST, len(word) + 2)
        return sum(self.gram_score(gram, size) for gram in grams(word, size))


class Judge:
    """Scores whole texts; what stands between blanks is looked up whole."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.rows = np.zeros((1024, len(model.languages) + 1), np.float32)
        self.used = 0
        self.places = BoundedCache(self.place, limit=200_000)

    def scores(self, text: str) -> np.ndarray:
        """Sums by language, and the number of words."""
        out = np.zeros(len(self.model.languages) + 1)
        for word in LETTERS.findall(text.lower()):
            out[:-1] += self.model.word_score(word)
            out[-1] += 1
        return out

    def place(self, piece: str) -> int:
        if self.used >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = self.scores(piece)
        self.used += 1
        return self.used - 1

    def judge(self, text: str | None) -> tuple[str, float]:
        total = np.zeros(self.rows.shape[1])
        pieces = (text or "").split(" ")
        for at in range(0, len(pieces), 4096):
            part = pieces[at:at + 4096]
            if self.used + len(part) > 1 << 19:
                self.places.forget()
                self.used = 0
            total += self.rows_of(part)
        if not total[-1] or not self.model.languages:
            return UNKNOWN, 0.0
        sums = total[:-1]
        best = int(sums.argmax())
        share = np.exp((sums - sums[best]) / total[-1])
        return self.model.languages[best], float(1 / share.sum())

    def rows_of(self, pieces: list[str]) -> np.ndarray:
        places = list(map(self.places.__getitem__, pieces))
        return self.rows[places].sum(axis=0, dtype=np.float64)


def gram_counts(words: DataFrame) -> DataFrame:
    """lang, gram, size and count of all n-grams of words (lang, word, count), as ``grams``
    cuts them."""

    def cut(size: int) -> F.Column:
        marked = F.concat(F.lit("<"), "word", F.lit(">")) if size > 1 else F.col("word")
        each = F.transform(F.sequence(F.lit(1), F.length(marked) - size + 1), lambda at: F.struct(
            F.lit(size).alias("size"), F.substr(marked, at, F.lit(size)).alias("gram")))
        return F.when(F.length(marked) >= size, each).otherwise(F.slice(F.array(F.struct(
            F.lit(size).alias("size"), F.lit("").alias("gram"))), 1, 0))

    found = F.explode(F.flatten(F.array(*[cut(size) for size in range(1, LONGEST + 1)])))
    return words.select("lang", "count", found.alias("one")).groupBy(
        "lang", F.col("one.gram").alias("gram"), F.col("one.size").alias("size")).agg(
        F.sum("count").alias("count"))


def training_counts(docs: DataFrame, train_rows: int, train_chars: int, fold: F.Column, id_col: str,
                    text_col: str, lang_col: str) -> list[tuple[str, str, int, int]]:
    """Counts of the words seen twice or more and of all n-grams in the training rows."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"),
                       docs[lang_col].alias("lang")).filter(
        docs[id_col].isNotNull() & docs[text_col].isNotNull() & docs[lang_col].isNotNull() & ~fold)
    total = rows.agg(F.count("*").alias("rows"), F.sum(F.length("text").cast("long")).alias("chars")).first()
    share = min(1.0, train_rows / max(total["rows"], 1), train_chars / max(total["chars"] or 0, 1))
    if share < 1:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    words = stored(rows.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
                   .filter("word != ''").groupBy("lang", "word").count(), "language-words")
    counts = words.filter("count > 1").select("lang", F.col("word").alias("gram"), F.lit(0).alias("size"), "count")
    found = counts.unionByName(gram_counts(words)).toArrow()
    return list(zip(*(found.column(c).to_pylist() for c in ("lang", "gram", "size", "count"))))


TRAIN_ROWS = 20_000
TRAIN_CHARS = 100_000_000


def fitted(docs: DataFrame, train_rows: int, train_chars: int, id_col: str, text_col: str, lang_col: str):
    """The model of the rows of ``docs`` that have a language and are not held out, for
    all tasks."""
    model = LanguageModel(training_counts(
        docs, train_rows, train_chars, held_out(docs[id_col]), id_col, text_col, lang_col))
    return docs.sparkSession.sparkContext.broadcast(model)


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang",
             train_chars: int = TRAIN_CHARS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row. Learns from the rows of
    ``docs`` with a language that are not held out."""
    shared = fitted(docs, train_rows, train_chars, id_col, text_col, lang_col)
    rows = docs.select(
        docs[text_col].alias("text"), docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(held_out(docs[id_col]), F.lit(False)).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in pieces_of(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *verdicts(judge, batch.column(0))],
                ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, into: tuple[str, str] | None = ("lang_pred", "score"),
                  train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", train_chars: int = TRAIN_CHARS) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with its name and score in the
    columns that ``into`` names, or as they are if that is None. Other columns may have
    any names. Texts go to Python once and only the verdicts come back; all else stays
    where it is."""
    shared = fitted(docs, train_rows, train_chars, id_col, text_col, lang_col)

    @F.arrow_udf("struct<lang:string,score:double>")
    def verdict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = Judge(shared.value)
        for column in texts:
            parts = [pa.StructArray.from_arrays(verdicts(judge, column[at:at + 256]), ["lang", "score"])
                     for at in range(0, len(column), 256)]
            yield pa.concat_arrays(parts) if parts else pa.array([], VERDICT)

    # else the optimizer may judge once for the filter and again for the columns
    verdict = verdict.asNondeterministic()
    names = {c: f"c{i}_kept" for i, c in enumerate(docs.columns)}
    judged = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())).withColumn(
        "verdict", verdict(names[text_col]))
    added = ([F.col("verdict.lang").alias(into[0]), F.col("verdict.score").alias(into[1])] if into else [])
    return judged.filter(F.col("verdict.lang") != UNKNOWN).select(
        *(F.col(n).alias(c) for c, n in names.items()), *added)


VERDICT = pa.struct([("lang", pa.string()), ("score", pa.float64())])


def verdicts(judge: Judge, texts: pa.Array) -> list[pa.Array]:
    """Languages and scores of texts."""
    found = [judge.judge(text) for text in texts.to_pylist()]
    return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
