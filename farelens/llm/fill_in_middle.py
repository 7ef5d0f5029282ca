"""Fill-in-middle transformation of whole texts by secondary sort.

A document is cut at two places drawn from a digest of its doc_id; its middle moves to
the end behind marks, so that a model learns to fill gaps. No task holds a whole output:

1. ``pieces`` emits chunks of at most ``CHUNK`` code points, each with the number of
   its row and its position in the output. Partitioning by row and sorting inside
   partitions by (row, position), the DataFrame form of
   repartitionAndSortWithinPartitions, brings every output in order.
2. ``restored`` streams an output, finds the marks in it, and gives every part its
   place in the original. Rows stay in their partition; sorting there once more brings
   the text back in order, without another shuffle.
3. ``digests`` feeds either order to incremental digests; ``joined`` builds the texts.

Every row is a unit of its own under a number that Spark gives it, so repeated rows and
equal doc_ids meet in no common task.

Defined cases: null text is empty; an empty text, one that contains a mark, and the
share that is not drawn stay ``plain``; a null doc_id draws like no digits at all; an
empty table gives no rows; other columns are left behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import pieces_of, shuffle_width

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points in a piece, without its mark.
CHUNK = 1 << 16
#: Code points in an Arrow batch; only its last document goes beyond.
BATCH = 1 << 22

#: The parts of an output by form: the mark before each, and its place in the original.
ORDER = {"plain": [], "psm": [(PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)],
         "spm": [(SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)]}
FACTS = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
FACT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
FACT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def plan(doc_id: int | None, text: str, seed: int, percent: int, spm_percent: int
         ) -> tuple[str, int, int]:
    """Form, and where prefix and middle end."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, drawn, order = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    cuts = sorted((one % (len(text) + 1), two % (len(text) + 1)))
    if not text or drawn % 100 >= percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", *cuts
    return "spm" if order % 100 < spm_percent else "psm", *cuts


def chunks(mark: str, part: str) -> Iterator[str]:
    yield mark + part[:CHUNK]
    for at in range(CHUNK, len(part), CHUNK):
        yield part[at:at + CHUNK]


def batch_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pieces(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, at and piece of every output, in order inside partitions; the first piece of a
    row (at 0) carries doc_id, n, form, prefix_chars and middle_chars."""
    names = ["row", "at", "piece", *FACTS]
    kinds = [pa.int64(), pa.int64(), pa.string(), *FACT_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            rows, held = [], 0
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                form, first, second = plan(doc_id, text, seed, percent, spm_percent)
                parts = [text[:first], text[first:second], text[second:]]
                cuts = (None, None) if form == "plain" else (first, second - first)
                facts, at = (doc_id, len(text), form, *cuts), 0
                for mark, part in [(m, parts[p]) for m, p in ORDER[form]] or [("", text)]:
                    for piece in chunks(mark, part):
                        rows.append((row, at, piece, *facts))
                        at, facts = at + len(piece), (None,) * len(FACTS)
                held += at
                if held > BATCH:
                    yield batch_of(rows, names, kinds)
                    rows, held = [], 0
            yield batch_of(rows, names, kinds)

    width = shuffle_width(docs.sparkSession)
    return (docs.select(F.monotonically_increasing_id().alias("row"),
                        docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
            .mapInArrow(run, f"row long, at long, piece string, {FACT_SCHEMA}")
            .repartition(width, "row").sortWithinPartitions("row", "at"))


class Sections:
    """Finds the parts of one output that arrives in pieces, whatever their borders."""

    def __init__(self, form: str):
        self.waiting = list(ORDER[form])
        self.place = 0
        self.held = ""

    def feed(self, piece: str, last: bool = False) -> Iterator[tuple[int, str]]:
        """(place in the original, text) of what is sure by now."""
        self.held += piece
        while self.waiting:
            mark, place = self.waiting[0]
            cut = self.held.find(mark)
            if cut < 0:
                break
            yield self.place, self.held[:cut]
            self.held, self.place = self.held[cut + len(mark):], place
            self.waiting.pop(0)
        keep = len(PREFIX) - 1 if self.waiting and not last else 0
        sure = len(self.held) - keep
        if sure > 0:
            yield self.place, self.held[:sure]
            self.held = self.held[sure:]


def restored(outputs: DataFrame, output_digest: bool = False) -> DataFrame:
    """The pieces of the original texts in order, from those of the outputs and their forms.
    With ``output_digest`` each first piece carries the sha256 of the whole output."""
    names = ["row", "place", "at", "piece", *FACTS, "output_sha256"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), *FACT_TYPES, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, number = [], 0, None
        sections, facts, digest, at = None, (), None, 0

        def closed() -> None:
            nonlocal sections
            if sections is None:
                return
            rows.extend((number, place, at + i, text, *[None] * len(FACTS), None)
                        for i, (place, text) in enumerate(sections.feed("", last=True)) if text)
            rows.append((number, -1, 0, "", *facts, digest.hexdigest() if digest else None))
            sections = None

        for batch in pieces_of(batches, 64):
            for row, piece, *own in zip(*(batch.column(c).to_pylist()
                                          for c in ["row", "piece", *FACTS])):
                if row != number:
                    closed()
                    number, facts, at = row, own, 0
                    sections = Sections(own[FACTS.index("form")])
                    digest = sha256() if output_digest else None
                if digest:
                    digest.update(piece.encode())
                for place, text in sections.feed(piece):
                    if text:
                        rows.append((number, place, at, text, *[None] * len(FACTS), None))
                        at += 1
                        held += len(text)
                if held > BATCH:
                    yield batch_of(rows, names, kinds)
                    rows, held = [], 0
        closed()
        yield batch_of(rows, names, kinds)

    return outputs.mapInArrow(
        run, f"row long, place int, at long, piece string, {FACT_SCHEMA}, output_sha256 string"
    ).sortWithinPartitions("row", "place", "at")


def joined(ordered: DataFrame, into: str = "output") -> DataFrame:
    """The facts of every row and its whole text in the column ``into``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, facts, parts = None, (), []
        for batch in pieces_of(batches, 64):
            rows = []
            for row, piece, *own in zip(*(batch.column(c).to_pylist()
                                          for c in ["row", "piece", *FACTS])):
                if row != number:
                    if parts:
                        rows.append((*facts, "".join(parts)))
                    number, facts, parts = row, own, []
                parts.append(piece)
            yield batch_of(rows, [*FACTS, into], [*FACT_TYPES, pa.string()])
        yield batch_of([(*facts, "".join(parts))] if parts else [], [*FACTS, into],
                       [*FACT_TYPES, pa.string()])

    return ordered.mapInArrow(run, f"{FACT_SCHEMA}, `{into}` string")


def transform(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row."""
    return joined(pieces(docs, **settings))


def digests(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, and restored_sha256 of the
    text that is built again from the output."""
    ordered = restored(pieces(docs, **settings), output_digest=True)
    names = [*FACTS, "output_sha256", "restored_sha256"]
    kinds = [*FACT_TYPES, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, facts, digest = None, (), None
        for batch in pieces_of(batches, 256):
            rows = []
            for row, piece, *own in zip(*(batch.column(c).to_pylist()
                                          for c in ["row", "piece", *FACTS, "output_sha256"])):
                if row != number:
                    if digest:
                        rows.append((*facts, digest.hexdigest()))
                    number, facts, digest = row, own, sha256()
                digest.update(piece.encode())
            yield batch_of(rows, names, kinds)
        yield batch_of([(*facts, digest.hexdigest())] if digest else [], names, kinds)

    return ordered.mapInArrow(run, f"{FACT_SCHEMA}, output_sha256 string, restored_sha256 string")
