"""N-gram Jaccard self-join of documents with signature trees, and its components.

Two documents link when their sets of word shingles have a Jaccard similarity of
``percent`` or more. The join is exact in three steps:

1. Equal sets become one node with its smallest doc_id.
2. A node is sent under each of the first n - ceil(percent * n) + 1 of its shingles in
   one order; two sets that link share one of those. Shingles that very many nodes
   hold stand last in that order. Nodes under one shingle make a list; equal lists are
   one, and long lists are cut in blocks.
3. Every node is compared with the head of the list it shares most lists with, which
   costs one comparison a node and joins most copies of a text in components.
4. Each list, or pair of blocks, that still holds several components is joined by dual
   traversal of signature trees: nodes with OR-combined bitmaps and size ranges, pruned
   by the largest possible overlap. What the bounds let through are documents that may
   link with a component; they are compared with its members exactly, on the whole
   texts, until one links. In lists of more than ``FEW`` nodes the bitmaps have ``WIDE``
   bits for each shingle, so that texts that share a passage and nothing else are told
   apart there and are not compared one by one.

A group of thousands of copies so costs about its size in rows, not its square, and no
two components that a link joins are left apart.

Very frequent shingles are found by counting all documents' shingles inside tasks and
dropping what occurs once there. The list of them is bounded: at most ``2**20`` can
make up one in ``2**20`` of all shingles. Their lists are dealt to several tasks.

Defined cases: null or wordless text has no shingles and links with nothing; rows that
share a doc_id count as one document with the links of each; repeated rows are
returned each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import discard, pieces_of, shuffle_width, stored
from farelens.llm.components import components
from farelens.llm.shingles import mix, shingle_sets
from farelens.llm.signature_tree import WIDE, Entry, bitmap, build, reached
from farelens.session import scratch_dir

FREQUENT_SHARE = 1 << 20
FREQUENT_LEAST = 64
BLOCK = 512
#: Nodes of a list up to which narrow bitmaps do: it has few pairs in any case.
FEW = 32
#: Tasks over which the members and askers of one component are spread.
SPREAD = 16
PER_TASK = 4_096
FOLD = 4_000_000


def summaries(docs: DataFrame, words: int) -> DataFrame:
    """Two kinds of rows in one pass over the texts. kind 0: a document's doc_id, set size n,
    digest (d1, d2), bitmap and wide bitmap. kind 1: a shingle d1 and how many times n it
    recurs in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def recurring() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(waiting) if waiting else
                                      np.zeros(0, np.uint64), return_counts=True)
            many = counts > 1
            return rows(1, [None] * int(many.sum()), counts[many] - 1, found[many].view(np.int64),
                        None, None, None)

        for batch in pieces_of(batches):
            sets = list(shingle_sets(batch.column(1).to_pylist(), words))
            sums = [s.sum(dtype=np.uint64) for s in sets]
            others = [mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets]
            yield rows(0, batch.column(0), np.array([len(s) for s in sets], np.int64),
                       np.array(sums, np.uint64).view(np.int64),
                       np.array(others, np.uint64).view(np.int64), [bitmap(s) for s in sets],
                       [bitmap(s, WIDE) for s in sets])
            waiting += sets
            size += sum(map(len, sets))
            if size > FOLD:
                yield recurring()
                waiting, size = [], 0
        yield recurring()

    def rows(kind, ids, n, d1, d2, bits, wide) -> pa.RecordBatch:
        count = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(count, kind, np.int32)), pa.array(ids, pa.int64()),
             pa.array(n.astype(np.int64)), pa.array(d1),
             pa.array(d2 if d2 is not None else [None] * count, pa.int64()),
             pa.array(bits if bits is not None else [None] * count, pa.binary()),
             pa.array(wide if wide is not None else [None] * count, pa.binary())],
            ["kind", "doc_id", "n", "d1", "d2", "bits", "wide"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "kind int, doc_id long, n long, d1 long, d2 long, bits binary, wide binary")


def frequent_shingles(summary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that make up one in ``FREQUENT_SHARE`` of all, sorted, and into how many
    parts their lists go. At most ``FREQUENT_SHARE`` entries by that definition."""
    total = summary.filter("kind = 0").agg(F.sum("n").alias("n")).first()["n"] or 0
    least = max(FREQUENT_LEAST, -(-total // FREQUENT_SHARE))
    found = (summary.filter("kind = 1").groupBy("d1").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= least).toPandas())
    shingles = found["d1"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], found["n"].to_numpy(np.int64)[order] // PER_TASK + 1


def prefixes(docs: DataFrame, words: int, percent: int, frequent) -> DataFrame:
    """shingle, part and node (the digest d1) for the first shingles of every set. The part is
    0 for most shingles, and from 1 on where a frequent one is dealt to several tasks. A
    set is sent once from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, parts = frequent.value
        sent: set[int] = set()
        for batch in pieces_of(batches):
            shingles, nodes, salts = [], [], []
            for found in shingle_sets(batch.column(0).to_pylist(), words):
                if not len(found):
                    continue
                node = found.sum(dtype=np.uint64).view(np.int64)
                if int(node) in sent:
                    continue
                if len(sent) < 1_000_000:
                    sent.add(int(node))
                first = len(found) - -(-percent * len(found) // 100) + 1
                if len(many):
                    place = np.minimum(np.searchsorted(many, found), len(many) - 1)
                    often = many[place] == found
                    order = np.concatenate([np.flatnonzero(~often), np.flatnonzero(often)])[:first]
                    own = found[order]
                    salts.append(np.where(often[order], node % parts[place[order]] + 1, 0))
                else:
                    own = found[:first]
                    salts.append(np.zeros(len(own), np.int64))
                shingles.append(own)
                nodes.append(np.full(len(own), node, np.int64))
            if shingles:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shingles).view(np.int64)),
                     pa.array(np.concatenate(salts).astype(np.int32)),
                     pa.array(np.concatenate(nodes))], ["shingle", "part", "node"])

    return docs.select("text").mapInArrow(run, "shingle long, part int, node long")


def lists(prefix: DataFrame, width: int, size: int) -> DataFrame:
    """list, block, node and head of every list of two nodes or more. Lists that fit in one
    block of ``size`` and hold the same nodes have the same number; blocks of one shingle
    share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        key, held, block = None, np.zeros(0, np.int64), 0
        out: list[tuple] = []

        def put(final: bool) -> None:
            nonlocal held, block
            while len(held) > size or final and len(held) and (block or len(held) > 1 or key[1]):
                own, held = held[:size], held[size:]
                if final and not block and not len(held) and not key[1]:
                    with np.errstate(over="ignore"):
                        name = int(mix(own.view(np.uint64)).sum(dtype=np.uint64).view(np.int64))
                    if name in known:
                        return
                    if len(known) < 1_000_000:
                        known.add(name)
                else:
                    name = int(key[0])
                out.append((name, key[1] << 16 | block, own))
                block += 1

        for batch in batches:
            if not batch.num_rows:
                continue
            shingle, part, node = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((shingle[1:] != shingle[:-1]) | (part[1:] != part[:-1])) + 1
            sizes = np.diff(np.concatenate([[0], cuts, [len(shingle)]]))
            starts = np.concatenate([[0], cuts])
            # the first and the last group may go on in other batches; of the others
            # those of one row are no lists
            keep = sizes > 1
            keep[0] = keep[-1] = True
            for at, count in zip(starts[keep].tolist(), sizes[keep].tolist()):
                own = int(shingle[at]), int(part[at])
                if own != key:
                    if key is not None:
                        put(True)
                    key, held, block = own, np.zeros(0, np.int64), 0
                rows = node[at:at + count]
                held = np.unique(rows) if not len(held) else np.union1d(held, rows)
                put(False)
            if out:
                yield batch_of(out)
                out.clear()
        if key is not None:
            put(True)
        if out:
            yield batch_of(out)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        sizes = [len(nodes) for *_, nodes in found]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([f[0] for f in found], sizes)),
             pa.array(np.repeat(np.array([f[1] for f in found], np.int64), sizes)),
             pa.array(np.concatenate([f[2] for f in found])),
             pa.array(np.repeat([int(f[2][0]) for f in found], sizes))],
            ["list", "block", "node", "head"])

    return (prefix.repartition(width, "shingle", "part")
            .sortWithinPartitions("shingle", "part", "node")
            .mapInArrow(run, "list long, block long, node long, head long"))


def listed_texts(docs: DataFrame, found: DataFrame, nodes: DataFrame, width: int
                 ) -> tuple[DataFrame, Callable[[], None]]:
    """doc_id and text of every node in a list, written in buckets of doc_id: comparisons
    then move pairs to texts, not texts to pairs. Plans are alike at every size. Also what
    drops the table again, once all that reads it is written."""
    spark = docs.sparkSession
    needed = found.select("node").distinct().hint("merge").join(nodes.select("node", "rep"), "node").select(
        F.col("rep").alias("doc_id")).distinct()
    texts = docs.join(needed.hint("merge"), "doc_id", "left_semi").select("doc_id", "text")
    path = scratch_dir(spark, "join-texts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    texts.write.bucketBy(width, "doc_id").option("path", path).saveAsTable(name)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, path)

    return spark.table(name), drop


def same_enough(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(one) + len(two) - both)


def exact(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of doc_ids whose whole texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 64):
            left = shingle_sets(batch.column(2).to_pylist(), words)
            right = shingle_sets(batch.column(3).to_pylist(), words)
            links = [same_enough(one, two, percent) for one, two in zip(left, right)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(links))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    both = pairs.hint("merge").join(left, "a").hint("merge").join(right, "b")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long").distinct()


def with_members(duties: DataFrame, texts: DataFrame, labels: DataFrame, width: int, words: int,
                 percent: int, size: int) -> DataFrame:
    """One link (a, b) for each duty (x, component) that has one: x is compared with the
    component's members, exactly, until one links.

    Members and askers of a component meet in blocks of about ``size`` of each, so that
    neither a large component nor many askers gather in one task, and each member's
    text travels once for each block of askers.
    """
    duties = stored(duties, "join-duties")
    asked = duties.groupBy("component").agg(F.count("*").alias("askers"))
    members = (labels.groupBy("component").agg(F.count("*").alias("members"))
               .join(asked.hint("merge"), "component", "right")
               .withColumn("mb", F.ceil(F.coalesce("members", F.lit(1)) / size).cast("int"))
               .withColumn("xb", F.ceil(F.col("askers") / size).cast("int"))
               .select("component", "mb", "xb"))
    members = stored(members, "join-blocks")

    def block(column: str, count: str):
        return F.pmod(F.xxhash64(column), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    # a component's one row is laid out for each salt, so that its many members and askers
    # need not meet it in one task
    salted = members.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))

    def by_salt(rows: DataFrame, column: str) -> DataFrame:
        return rows.withColumn("salt", F.pmod(F.xxhash64(column, F.lit(1)), F.lit(SPREAD)).cast("int"))

    alone = members.select("component", F.col("component").alias("doc_id"))
    named = by_salt(labels.select("component", F.col("id").alias("doc_id")), "doc_id").join(
        salted.select("component", "salt").hint("merge"), ["component", "salt"], "left_semi")
    inside = named.select("component", "doc_id").unionByName(alone).distinct()
    held = (by_salt(inside, "doc_id").join(salted.hint("merge"), ["component", "salt"])
            .select("component", "doc_id", block("doc_id", "mb").alias("mb"), every("xb").alias("xb"))
            .withColumn("side", F.lit(0)))
    asking = (by_salt(duties, "x").join(salted.hint("merge"), ["component", "salt"])
              .select("component", F.col("x").alias("doc_id"), every("mb").alias("mb"),
                      F.col("xb").alias("count")).withColumn("xb", block("doc_id", "count"))
              .select("component", "doc_id", "mb", "xb").withColumn("side", F.lit(1)))
    rows = (held.select("component", "mb", "xb", "side", "doc_id").unionByName(asking)
            .hint("merge").join(texts, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, sets = None, [], []
        for batch in pieces_of(batches, 64):
            links = []
            rows_ = zip(*(c.to_pylist() for c in batch.columns[:5]),
                        shingle_sets(batch.column(5).to_pylist(), words))
            for *own, side, doc_id, found in rows_:
                if own != key:
                    key, names, sets = own, [], []
                if not side:
                    names.append(doc_id)
                    sets.append(found)
                    continue
                linked = next((name for name, other in zip(names, sets)
                               if 100 * min(len(found), len(other)) >= percent * max(len(found), len(other))
                               and same_enough(found, other, percent)), None)
                if linked is not None:
                    links.append((doc_id, linked))
            if links:
                ends = np.array(links, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["a", "b"])

    return (rows.repartition(width, "component", "mb", "xb")
            .sortWithinPartitions("component", "mb", "xb", "side", "doc_id")
            .select("component", "mb", "xb", "side", "doc_id", "text")
            .mapInArrow(run, "a long, b long").distinct())


def tree_duties(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(x, component) from rows (list, i, j, side, rep, component, members, n, bits): one
    tree for each side of each (list, i, j), joined with itself where i = j. x could link
    with some entry of a component that is not smaller than its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, sizes = None, ([], []), {}

        def duties() -> list[tuple[int, int]]:
            one, two = sides
            if key is None or not one or key[1] == key[2] and len(one) < 2 or \
                    key[1] != key[2] and not two:
                return []
            return list(reached(build(one), build(two) if key[1] != key[2] else None, sizes, percent))

        def batch_of(found) -> pa.RecordBatch:
            both = np.array(found, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1])], ["x", "component"])

        for batch in batches:
            found: list[tuple[int, int]] = []
            for name, i, j, side, rep, component, members, n, bits in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (name, i, j) != key:
                    found += duties()
                    key, sides, sizes = (name, i, j), ([], []), {}
                sizes[component] = members
                sides[side].append(Entry(rep, component, n, int.from_bytes(bits, "little"), 8 * len(bits)))
            if found:
                yield batch_of(found)
        if found := duties():
            yield batch_of(found)

    return (rows.repartition(width, "list", "i", "j").sortWithinPartitions("list", "i", "j", "side")
            .select("list", "i", "j", "side", "rep", "component", "members", "n", "bits")
            .mapInArrow(run, "x long, component long").distinct())


def heads(found: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """One pair for each node: its document and that of the head it shares most lists with,
    where sizes and bitmaps let them link."""
    best = (found.filter("node <> head").groupBy("node", "head").count()
            .groupBy("node").agg(F.max_by("head", F.struct("count", "head")).alias("head")))
    one = nodes.select("node", F.col("rep").alias("a"), F.col("n").alias("n1"))
    two = nodes.select(F.col("node").alias("head"), F.col("rep").alias("b"), F.col("n").alias("n2"))
    return (best.join(one, "node").join(two, "head")
            .filter(f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a < b").distinct())


def mixed_lists(found: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (list, i, j, side, rep, component, members, n, bits) of all lists, or pairs of
    blocks of a list, that hold more than one component."""
    named = (nodes.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")))
    counts = labels.groupBy("component").agg(F.count("*").alias("members"))
    sized = (named.join(counts, "component", "left")
             .select("rep", "n", "bits", "wide", F.coalesce("members", F.lit(1)).alias("members")))
    rows = stored(found.select("list", "block", "node").join(
        named.select("node", "rep", "component"), "node"), "join-lists")
    mixed = (rows.groupBy("list").agg(F.min("component").alias("least"), F.max("component").alias("most"),
                                      F.min("block").alias("first"), F.max("block").alias("last"),
                                      (F.count("*") > FEW).alias("many"))
             .filter("least < most").select("list", "first", "last", "many"))
    rows = rows.select("list", "block", "rep", "component").distinct().join(mixed, "list")
    own = rows.filter("first = last").select(
        "list", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"),
        "rep", "component", "many")
    cut = rows.filter("first < last").select("list", "block", "rep", "component")
    blocks = cut.groupBy("list", "block").agg(F.min("component").alias("least"),
                                              F.max("component").alias("most"))
    left = blocks.select("list", F.col("block").alias("i"), F.col("least").alias("l1"), F.col("most").alias("m1"))
    right = blocks.select("list", F.col("block").alias("j"), F.col("least").alias("l2"), F.col("most").alias("m2"))
    duties = left.join(right, "list").filter(
        "i <= j AND NOT (l1 = m1 AND l2 = m2 AND l1 = l2)").select("list", "i", "j")
    cut_rows = (duties.withColumn("block", F.col("i")).withColumn("side", F.lit(0))
                .unionByName(duties.filter("i < j").withColumn("block", F.col("j"))
                             .withColumn("side", F.lit(1)))
                .join(cut, ["list", "block"])
                .select("list", "i", "j", "side", "rep", "component", F.lit(True).alias("many")))
    return own.unionByName(cut_rows).join(sized, "rep").select(
        "list", "i", "j", "side", "rep", "component", "members", "n",
        F.when(F.col("many"), F.col("wide")).otherwise(F.col("bits")).alias("bits"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    summary = stored(summaries(rows, words), "join-summary")
    sets = summary.filter("kind = 0").select("doc_id", "n", "d1", "d2")
    nodes = stored(summary.filter("kind = 0 AND n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.first("bits").alias("bits"), F.first("wide").alias("wide"))
        .withColumnRenamed("d1", "node"), "join-nodes")
    frequent = spark.sparkContext.broadcast(frequent_shingles(summary))
    found = stored(lists(prefixes(rows, words, percent, frequent), width, BLOCK), "join-lists")
    texts, drop_texts = listed_texts(rows, found, nodes, width)
    links = stored(exact(heads(found, nodes, percent), texts, words, percent), "join-links")
    labels = components(links)
    duties = tree_duties(mixed_lists(found, nodes, labels), width, percent)
    links = links.unionByName(stored(
        with_members(duties, texts, labels, width, words, percent, BLOCK), "join-links"))
    drop_texts()
    own = (sets.filter("n > 0 AND doc_id IS NOT NULL")
           .join(nodes.select("n", F.col("node").alias("d1"), "d2", "rep"), ["n", "d1", "d2"]))
    shared = own.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b")
    several = own.join(shared.select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(links.unionByName(several))
    reps = nodes.select("n", F.col("node").alias("d1"), "d2", "rep").join(
        labels.withColumnRenamed("id", "rep"), "rep", "left")
    return (sets.join(reps, ["n", "d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep", "doc_id").alias("component_id")))
