"""Substring dedup by hashing of lines and the sentences in them.

Every text is cut into units: at line ends, and inside lines after ``. ! ?`` before
a blank, so that a repeated passage is found wherever in a line it stands; a line of less
than ``min_words`` words is one unit. A unit is
normalised (lower case, letters and digits only, single blanks) and hashed to 96
bits. All documents' units are grouped by digest; the occurrence with the smallest
(doc_id, start) is kept. The others are removed where they are whole lines or form runs of
at least ``min_words`` words of neighbouring repeated units; shorter runs inside lines, such
as single words that happen to be sentences, stay. Offsets are those of the original text.

With ``passage_words``, also every passage of at least that many words goes that occurs
earlier, in order of (doc_id, start), wherever it begins and ends in either text. Such a
passage shares one of the fingerprints of half its length that winnowing picks by their
content; windows of ``passage_words`` words around repeated fingerprints are hashed at
every word, grouped like units, and all but the earliest go.

Places are single numbers (``places``), so that the least place of a digest is combined
before the shuffle, however many documents share it. Only repeated digests, a table of
their own, meet the units again, in an equi-join that Spark splits where it is skewed.
Before such a join a bit table of fixed size (``Sieve``) leaves out most rows that meet
nothing; what it lets through wrongly only costs time.

Defined cases: null text stays null and has no units; rows that share a doc_id and differ
in their texts are documents of their own, ranked by doc_id and then by a digest of the
text; rows that share both are one document, each cut alike; rows without doc_id are
left as they are; an empty table gives no rows; a text of which everything is removed
becomes empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import discard, pieces_of, stored, written

WORD = re.compile(r"[^\W_]+")
CODES = 0x110000
#: Characters hashed at once, so that a very long text needs little memory beside its own.
AT_ONCE = 1 << 20
REMOVED = "array<struct<start:int,stop:int,kept_doc_id:bigint,kept_start:int>>"
PLACE = "decimal(38,0)"
HALF = np.uint64((1 << 31) - 1)


def tags(texts: list[str]) -> np.ndarray:
    """31 bits that tell texts with one doc_id apart."""
    return np.array([int.from_bytes(blake2b(t.encode(), digest_size=4).digest(), "little") >> 1
                     for t in texts], np.uint64)


def places(ids: np.ndarray, own_tags: np.ndarray, starts: np.ndarray) -> pa.Array:
    """(doc_id, tag, start) as numbers in the same order: doc_id * 2**62 + tag * 2**31 + start."""
    both = np.empty((len(ids), 2), np.uint64)
    rest = own_tags.astype(np.uint64) << np.uint64(31) | starts.astype(np.uint64)
    both[:, 0] = ids.astype(np.int64).view(np.uint64) << np.uint64(62) | rest
    both[:, 1] = (ids.astype(np.int64) >> 2).view(np.uint64)
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(ids), [None, pa.py_buffer(both.tobytes())])


def parts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, tag and start of places without nulls."""
    both = np.frombuffer(column.buffers()[1], np.uint64).reshape(-1, 2)[column.offset:column.offset + len(column)]
    ids = ((both[:, 1] << np.uint64(2)) | both[:, 0] >> np.uint64(62)).view(np.int64)
    return ids, (both[:, 0] >> np.uint64(31) & HALF).astype(np.int64), (both[:, 0] & HALF).astype(np.int64)


class Sieve:
    """Which values of a uniform hash may be in a table: 2**27 bits, whatever its size."""

    BITS = 27

    def __init__(self, hashes: DataFrame, column: str):
        position = F.col(column).bitwiseAND((1 << self.BITS) - 1) + 1
        found = (hashes.groupBy(F.bitmap_bucket_number(position).alias("bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits")).collect())
        table = np.zeros(1 << self.BITS - 3, np.uint8)
        for row in found:
            at = (row["bucket"] - 1) * len(row["bits"])
            table[at:at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
        self.shared = hashes.sparkSession.sparkContext.broadcast(table)

    def keeps(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) & np.uint64((1 << self.BITS) - 1)
        return (self.shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def let_through(self, rows: DataFrame, column: str) -> DataFrame:
        names = rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = batch.filter(pa.array(self.keeps(batch.column(names.index(column)).to_numpy())))
                if kept.num_rows:
                    yield kept

        return rows.mapInArrow(run, rows.schema)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


@cache
def character_kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: whether it is part of a word, whether it is a blank, and a
    64-bit number."""
    every = "".join(map(chr, range(CODES)))
    in_word, blank = np.zeros(CODES, bool), np.zeros(CODES, bool)
    for pattern, table in ((WORD, in_word), (re.compile(r"\s+"), blank)):
        for found in pattern.finditer(every):
            table[slice(*found.span())] = True
    return in_word, blank, mixed(np.arange(1, CODES + 1, dtype=np.uint64) * np.uint64(BASE))


BASE = 0x9E3779B97F4A7C15
OTHER_BASE = 0xD1342543DE82EF95


def powers_of(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2**64."""
    if count <= AT_ONCE:
        return tuple(row[:count] for row in many_powers(base))
    powers = np.ones((2, count), np.uint64)
    powers[0, 1:], powers[1, 1:] = base, pow(base, -1, 1 << 64)
    return tuple(np.multiply.accumulate(powers, axis=1))


@cache
def many_powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([p[:AT_ONCE], p[-1:]]) for p in powers_of(base, AT_ONCE + 1))


def hashes_of_runs(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[start:stop] for each start and stop, wherever the run stands."""
    powers, inverses = powers_of(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * inverses[starts])


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def ends_of(text: str) -> np.ndarray:
    """Start and stop of every word."""
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = character_kinds()[0][codes_of(text)]
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def words_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of every word, and a hash of it in lower case."""
    ends, numbers = ends_of(text), character_kinds()[2]
    lowered, at = text.lower(), ends
    if len(lowered) != len(text) or "\u03a3" in text:
        # these letters become two, or another one at the end of a word
        words = [text[start:stop].lower() for start, stop in ends.tolist()]
        sizes = np.cumsum([0, *map(len, words)])
        lowered, at = "".join(words), np.stack([sizes[:-1], sizes[1:]], axis=1)
    codes = codes_of(lowered)
    hashes, done = np.empty(len(at), np.uint64), 0
    while done < len(at):
        first = at[done, 0]
        upto = max(done + 1, int(np.searchsorted(at[:, 1], first + AT_ONCE - 1, side="right")))
        own = at[done:upto] - first
        hashes[done:upto] = hashes_of_runs(numbers[codes[first:at[upto - 1, 1]]], own[:, 0], own[:, 1], BASE)
        done = upto
    return ends, hashes


def unit_arrays(text: str, min_words: int) -> tuple[np.ndarray, ...]:
    """Start, stop, number of words and both parts of the digest of every unit with words."""
    codes, (_, blank, _) = codes_of(text), character_kinds()
    ends, hashes = words_of(text)
    line_ends = np.flatnonzero(codes == 10)
    starts, stops = np.concatenate([[0], line_ends + 1]), np.concatenate([line_ends, [len(codes)]])
    marks = np.flatnonzero((codes == 33) | (codes == 46) | (codes == 63))
    marks = marks[marks + 1 < len(codes)]
    marks = marks[blank[codes[marks + 1]] & (codes[marks + 1] != 10)]
    line = np.searchsorted(starts, marks, side="right") - 1
    sizes = np.searchsorted(ends[:, 0], stops) - np.searchsorted(ends[:, 0], starts)
    cuts = marks[(marks > starts[line]) & (sizes[line] >= min_words)] + 1
    starts, stops = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([stops, cuts]))
    first, last = np.searchsorted(ends[:, 0], starts), np.searchsorted(ends[:, 0], stops)
    worded = last > first
    first, last = first[worded], last[worded]
    low = hashes_of_runs(hashes, first, last, OTHER_BASE) >> np.uint64(32)
    return (starts[worded], stops[worded], last - first,
            hashes_of_runs(hashes, first, last, BASE).view(np.int64), low.astype(np.uint32).view(np.int32))


def units(text: str, min_words: int = 8) -> list[tuple[int, int, int, tuple[int, int]]]:
    """Start, stop, words and digest of every unit that has words."""
    return [(start, stop, words, tuple(digest)) for start, stop, words, *digest in zip(
        *(part.tolist() for part in unit_arrays(text, min_words)))]


def joined(texts: list[str]) -> tuple[str, np.ndarray]:
    """All texts as one, a line end between them, which no word and no unit crosses; and
    where each starts."""
    return "\n".join(texts), np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])


def unit_table(docs: DataFrame, min_words: int) -> DataFrame:
    """hi, lo (the digest), place, and info (length * 2**32 + words) of every unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = batch.column(1).to_pylist()
            together, offsets = joined(texts)
            starts, stops, words, high, low = unit_arrays(together, min_words)
            own = np.searchsorted(offsets, starts, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(high), pa.array(low),
                 places(batch.column(0).to_numpy()[own], tags(texts)[own], starts - offsets[own]),
                 pa.array(stops - starts << 32 | words)], ["hi", "lo", "place", "info"])

    return docs.select("doc_id", "text").mapInArrow(run, f"hi long, lo int, place {PLACE}, info long")


def kept_places(table: DataFrame, key: list[str], purpose: str) -> DataFrame:
    """The key and the least place of what occurs more than once."""
    return stored(table.groupBy(*key).agg(F.min("place").alias("kept"), F.count("*").alias("n"))
                  .filter("n > 1").select(*key, "kept"), purpose)


def by_document(found: DataFrame) -> DataFrame:
    """doc_id, tag, start, info, kept_doc_id and kept_start from place, info and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own_tags, starts = parts_of(batch.column(0))
            kept_ids, _, kept_starts = parts_of(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(own_tags), pa.array(starts.astype(np.int32)), batch.column(1),
                 pa.array(kept_ids), pa.array(kept_starts.astype(np.int32))],
                ["doc_id", "tag", "start", "info", "kept_doc_id", "kept_start"])

    return found.select("place", "info", "kept").mapInArrow(
        run, "doc_id long, tag long, start int, info long, kept_doc_id long, kept_start int")


def repeated_units(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, tag, start, info, kept_doc_id and kept_start of every unit that is not the
    kept occurrence of its digest."""
    table, path = written(unit_table(docs, min_words), "units")
    shared = kept_places(table, ["hi", "lo"], "shared-units")
    met = Sieve(shared, "hi").let_through(table, "hi").join(shared, ["hi", "lo"]).filter("place > kept").distinct()
    out = stored(by_document(met), "repeated-units")
    discard(docs.sparkSession, path)
    return out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` neighbouring words, as signed integers."""
    starts = np.arange(max(0, len(hashes) - size + 1))
    return hashes_of_runs(hashes, starts, starts + size, BASE).view(np.int64) if len(starts) else np.zeros(0, np.int64)


def winnowed(hashes: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints; each passage holds one or more."""
    size = passage_words // 2
    grams = window_hashes(hashes, size)
    window = passage_words - size + 1
    if len(grams) < window:
        return np.zeros(0, np.int64), grams[:0]
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = np.unique(np.arange(len(views)) + views.argmin(axis=1))
    return at, grams[at]


def fingerprints(docs: DataFrame, passage_words: int) -> DataFrame:
    """hash, doc_id, tag and at (a word's number) of the fingerprints of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = batch.column(1).to_pylist()
            together, offsets = joined(texts)
            ends, hashes = words_of(together)
            found = [winnowed(own, passage_words) for own in
                     np.split(hashes, np.searchsorted(ends[:, 0], offsets[1:]))]
            sizes = [len(at) for at, _ in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([h for _, h in found])),
                 pa.array(np.repeat(batch.column(0).to_numpy(), sizes)),
                 pa.array(np.repeat(tags(texts).astype(np.int32), sizes)),
                 pa.array(np.concatenate([at for at, _ in found]).astype(np.int32))],
                ["hash", "doc_id", "tag", "at"])

    return docs.select("doc_id", "text").mapInArrow(run, "hash long, doc_id long, tag int, at int")


def windows_near(rows: DataFrame, passage_words: int, min_words: int) -> DataFrame:
    """hash, place and info (0) of the whole windows around the fingerprints that ``near`` lists
    in rows (doc_id, tag, text, found, near). Windows inside ``found`` units that go
    anyway are left out: wherever such units stand in a row, they go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = np.arange(passage_words - passage_words // 2 + 1)
        for batch in pieces_of(batches):
            hashes, ids, own_tags, starts = [], [], [], []
            for doc_id, tag, text, found, near in zip(*(c.to_pylist() for c in batch.columns)):
                spans_of_words, word_hashes = words_of(text)
                grams = window_hashes(word_hashes, passage_words)
                at = np.unique(np.subtract.outer(np.array(near, np.int64), back))
                at = at[(at >= 0) & (at < len(grams))]
                if not len(at):
                    continue
                gone = spans(text, found or [], min_words)
                if gone:
                    first = np.array([g[0] for g in gone])
                    place = np.searchsorted(first, spans_of_words[:, 0], side="right") - 1
                    inside = (place >= 0) & (spans_of_words[:, 1] <= np.array([g[1] for g in gone])[place])
                    left = np.concatenate([[0], np.cumsum(~inside)])
                    at = at[left[at + passage_words] > left[at]]
                hashes.append(grams[at])
                ids.append(np.full(len(at), doc_id, np.int64))
                own_tags.append(np.full(len(at), tag, np.uint64))
                starts.append(spans_of_words[at, 0])
            if hashes:
                count = sum(map(len, hashes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes)),
                     places(np.concatenate(ids), np.concatenate(own_tags), np.concatenate(starts)),
                     pa.array(np.zeros(count, np.int64))], ["hash", "place", "info"])

    return rows.select("doc_id", "tag", "text", "found", "near").mapInArrow(
        run, f"hash long, place {PLACE}, info long")


KEY = ["doc_id", "tag"]


def split_by_tag(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs``, with their tag, whose document may be in ``found``, and those that
    are not. Only texts go to Python, and two numbers come back."""
    keeps = Sieve(found.select("tag"), "tag").keeps

    @F.arrow_udf("struct<tag:long,may:boolean>")
    def tagged(texts: pa.Array) -> pa.Array:
        own = tags([t or "" for t in texts.to_pylist()]).astype(np.int64)
        return pa.StructArray.from_arrays([pa.array(own), pa.array(keeps(own))], ["tag", "may"])

    rows = docs.withColumn("tagged", tagged.asNondeterministic()("text"))
    return tuple(rows.filter(wanted).withColumn("tag", F.col("tagged.tag")).drop("tagged")
                 for wanted in (F.col("tagged.may"), ~F.col("tagged.may")))


def repeated_windows(docs: DataFrame, units_found: DataFrame, passage_words: int, min_words: int) -> DataFrame:
    """doc_id, tag, start, info, kept_doc_id and kept_start of the windows of that many words
    that are not the earliest."""
    spark = docs.sparkSession
    prints, path = written(fingerprints(docs, passage_words), "fingerprints")
    often = stored(prints.groupBy("hash").count().filter("count > 1").select("hash"), "shared-fingerprints")
    near = stored(Sieve(often, "hash").let_through(prints, "hash").join(often, "hash")
                  .groupBy("doc_id", F.col("tag").cast("long").alias("tag"))
                  .agg(F.sort_array(F.collect_set("at")).alias("near")), "near")
    discard(spark, path)
    found = units_found.groupBy(*KEY).agg(F.collect_list(one_found()).alias("found"))
    wanted = near.join(found, KEY, "left")
    texts = split_by_tag(docs, near)[0].select(*KEY, "text").dropDuplicates(KEY)
    table, path = written(windows_near(texts.join(wanted, KEY), passage_words, min_words), "windows")
    kept = kept_places(table, ["hash"], "shared-windows")
    met = Sieve(kept, "hash").let_through(table, "hash").join(kept, "hash").filter("place > kept")
    out = stored(by_document(met.distinct()), "repeated-windows")
    discard(spark, path)
    return out


def passages(text: str, starts: np.ndarray, kept_ids: np.ndarray, kept_starts: np.ndarray,
             passage_words: int) -> list[tuple[int, int, int, int]]:
    """(start, stop, kept_doc_id, kept_start) of each run of words that repeated windows cover."""
    ends, order = ends_of(text), np.argsort(starts, kind="stable")
    first = np.searchsorted(ends[:, 0], starts[order])
    opens = np.flatnonzero(np.diff(first, prepend=-passage_words - 1) > passage_words)
    last = first[np.append(opens[1:], len(first)) - 1] + passage_words - 1
    return list(zip(ends[first[opens], 0].tolist(), ends[last, 1].tolist(),
                    kept_ids[order[opens]].tolist(), kept_starts[order[opens]].tolist()))


def united(units: list[tuple], found: list[tuple]) -> list[tuple]:
    """Spans of units and the parts of passages outside them, in order."""
    out = list(units)
    for start, stop, *kept in found:
        for other_start, other_stop, *_ in units:
            if other_stop <= start or other_start >= stop:
                continue
            if other_start > start:
                out.append((start, other_start, *kept))
            start = max(start, other_stop)
        if start < stop:
            out.append((start, stop, *kept))
    return sorted(out)


def spans(text: str, found: list[dict], min_words: int) -> list[tuple[int, int, int, int]]:
    """Whole lines, and runs of neighbouring repeated units with enough words, as (start, stop,
    kept_doc_id, kept_start) of each unit. Units are neighbours without words between them."""
    out, run, words = [], [], 0

    def that_go() -> list[tuple[int, int, int, int]]:
        return run if words >= min_words else [
            unit for unit in run if text[unit[0] - 1:unit[0]] in ("", "\n") and text[unit[1]:unit[1] + 1] in ("", "\n")]

    for unit in sorted(found, key=lambda u: u["start"]):
        stop = unit["start"] + (unit["info"] >> 32)
        if run and WORD.search(text, run[-1][1], unit["start"]):
            out.extend(that_go())
            run, words = [], 0
        run.append((unit["start"], stop, unit["kept_doc_id"], unit["kept_start"]))
        words += unit["info"] & 0xFFFFFFFF
    return out + that_go()


def without(text: str, removed: list[tuple[int, int, int, int]]) -> str:
    """The text without the spans, and without the line ends and blanks they leave bare."""
    parts, at = [], 0
    for start, stop, *_ in removed:
        parts.append(text[at:start])
        at = stop
        if not parts[-1].strip(" ") and (not parts[:-1] or parts[-2].endswith("\n")) or \
                parts[-1].endswith("\n"):
            while at < len(text) and text[at] == " ":
                at += 1
            if at < len(text) and text[at] == "\n":
                at += 1
    parts.append(text[at:])
    return "".join(parts)


def one_found() -> F.Column:
    return F.struct("start", "info", "kept_doc_id", "kept_start")


def deduplicate(docs: DataFrame, min_words: int = 8, passage_words: int = 0,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their text cut down, plus ``removed``: the spans of the
    original text that went, with the document and offset of the kept occurrence;
    for the parts of a passage, those of its first window."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    units_found = repeated_units(slim, min_words)
    found = units_found.withColumn("whole", F.lit(False))
    if passage_words:
        found = found.unionByName(repeated_windows(slim, units_found, passage_words, min_words)
                                  .withColumn("whole", F.lit(True)))
    cuts = stored(found.groupBy(*KEY).agg(
        F.collect_list(F.when(~F.col("whole"), one_found())).alias("found"),
        F.collect_list(F.when(F.col("whole"), one_found())).alias("windows")), "cuts")

    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    names = {c: f"c{i}_kept" for i, c in enumerate(rest)}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *(F.col(f"`{c}`").alias(names[c]) for c in rest))
    # only texts that may have a cut move to it
    touched, others = split_by_tag(rows, cuts)
    joined = touched.join(cuts, KEY, "left").select("doc_id", "text", "found", "windows", *names.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts, removed = [], []
            # the many windows stay arrays
            starts, _, kept_ids, kept_starts = (
                part.to_numpy() for part in batch.column(3).flatten().flatten())
            upto = np.cumsum(pc.list_value_length(batch.column(3)).fill_null(0).to_numpy()).tolist()
            for text, found, begin, end in zip(
                    batch.column(1).to_pylist(), batch.column(2).to_pylist(), [0, *upto], upto):
                gone = spans(text, found, min_words) if text and found else []
                if begin < end:
                    own = slice(begin, end)
                    gone = united(gone, passages(
                        text, starts[own], kept_ids[own], kept_starts[own], passage_words))
                texts.append(without(text, gone) if gone else text)
                removed.append([dict(zip(("start", "stop", "kept_doc_id", "kept_start"), s))
                                for s in gone])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()),
                                       ("kept_doc_id", pa.int64()), ("kept_start", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, batch.column(1).type), pa.array(removed, kind),
                 *batch.columns[4:]], ["doc_id", "text", "removed", *names.values()])

    kinds = dict(rows.dtypes)
    cut = joined.mapInArrow(run, ", ".join(
        ["doc_id long", "text string", f"removed {REMOVED}",
         *(f"{name} {kinds[name]}" for name in names.values())]))
    whole = others.select("doc_id", "text", F.array().cast(REMOVED).alias("removed"), *names.values())
    out = cut.unionByName(whole)
    back = {id_col: "doc_id", text_col: "text"} | names
    return out.select(*(F.col(back[c]).alias(c) for c in docs.columns), F.col("removed"))
