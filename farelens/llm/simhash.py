"""SimHash near-duplicates by a generalised pigeonhole.

A document's fingerprint has a bit set where over half of its word shingles' XXH64 hashes
have it. Documents link when their fingerprints differ in at most ``distance`` bits, and
the join of fingerprints is exact:

1. Equal fingerprints are one, with their smallest doc_id.
2. The bits are grouped in parts, correlated bits together (``bit_groups``), by counts
   over all fingerprints. Skew so gathers in few parts and leaves the others selective.
3. Each fingerprint deals ``distance + 1`` units to the parts: none skips a part, one
   asks for equality there, two for at most one differing bit, and so on. If every part
   differed in as many bits as it got units, the whole would differ in more than
   ``distance``. A dynamic program (``allocate``) takes the deal with the fewest expected
   probes and candidates, estimated from counts over all fingerprints.
4. Fingerprints are probed for the values in reach of each part, in an equi-join with all
   fingerprints' parts, and verified on all bits.
5. A part's value that more than ``OFTEN`` fingerprints have is no key of that join. All
   that have it and all that probe it make a list; lists longer than ``BLOCK`` are split by
   the pigeonhole on their other bits. A list links those that share a neighbour at
   one bit, at 65 numbers for each member, and emits at most one link a member.

So the rows of the join are bounded by ``OFTEN`` a probe, and a group of thousands of
near copies costs about its size.

Defined cases: null text and text without words have fingerprint zero and link like any
other; fewer words than a shingle are one shingle; rows that share a doc_id count as one
document with the links of each; a null doc_id is given the component of its
fingerprint, if another row has one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import pieces_of, shuffle_width, stored
from farelens.llm.components import components

BITS = 64
SEED = 42
#: Bytes of a text that are cut into words at a time.
CHUNK = 1 << 22
#: Fingerprints with one value of a part, beyond which they make a list.
OFTEN = 64
#: Members of a list that one task links; 65 numbers are held for each.
BLOCK = 1 << 14
#: Bits that are counted together for the estimates.
COUNTED = 8

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ONES = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """(n, 64) of 0 and 1, the lowest bit first."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def shingle_hashes(data: bytes, words: int) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text, some megabytes of it at a time."""
    digest, held, most = xxhash.xxh64_intdigest, b"", 0
    for at in range(0, max(len(data), 1), CHUNK):
        part = held + data[at:at + CHUNK].translate(LOWER)
        last = at + CHUNK >= len(data)
        found = part.split()
        open_word = [] if last or not found or part[-1:].isspace() else [found.pop()]
        if len(found) >= words:
            yield np.array([digest(b" ".join(w), SEED) for w in
                            zip(*(found[i:] for i in range(words)))], np.uint64)
            most = words
        elif last and not most and found:
            yield np.array([digest(b" ".join(found), SEED)], np.uint64)
        tail = found[max(0, len(found) - words + 1):] if words > 1 else []
        held = b" ".join(tail + open_word) + (b"" if open_word or not tail else b" ")


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    total, counts = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes((text or "").encode(), words):
        total += len(hashes)
        counts += bits_of(hashes).sum(axis=0, dtype=np.int64)
    return int(ONES[2 * counts > total].sum()) if total else 0


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
                 ) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            found = [fingerprint(text, words) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def bit_pairs(prints: DataFrame) -> np.ndarray:
    """(64, 64): in how many fingerprints two bits are set, over all of them; a bit's own
    count on the diagonal. A task sends one matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        for batch in pieces_of(batches, 1 << 14):
            bits = bits_of(unsigned(batch.column(0))).astype(np.float64)
            both += (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(both[i, j])],
            ["i", "j", "n"])

    out = np.zeros((BITS, BITS))
    for row in prints.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(
            F.sum("n").alias("n")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["n"]
    return out


def bit_groups(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Every bit in one of ``parts`` groups of nearly equal size: each group begins with the
    two most correlated bits that are left and grows by the bit that is most correlated
    with it."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(share * (1 - share))
    scale = np.outer(spread, spread)
    close = np.abs(np.divide(both / max(total, 1) - np.outer(share, share), scale,
                             out=np.zeros_like(scale), where=scale > 1e-12))
    np.fill_diagonal(close, 0)
    left, groups = list(range(BITS)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        among = close[np.ix_(left, left)]
        first = int(among.argmax()) // len(left)
        group = [left.pop(first)]
        while len(group) < size:
            gain = close[np.ix_(left, group)].sum(axis=1)
            group.append(left.pop(int(gain.argmax())))
        groups.append(sorted(group))
    return groups


def cut_groups(groups: list[list[int]]) -> list[list[list[int]]]:
    """Each group in pieces of at most ``COUNTED`` bits."""
    return [[list(map(int, piece)) for piece in np.array_split(group, -(-len(group) // COUNTED))]
            for group in groups]


def packed(hashes: np.ndarray, piece: list[int]) -> np.ndarray:
    """The bits of a piece side by side, as small numbers."""
    out = np.zeros(len(hashes), np.int64)
    for place, bit in enumerate(piece):
        out |= ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def piece_shares(prints: DataFrame, cut: list[list[list[int]]], total: int, distance: int
                 ) -> list[list[np.ndarray]]:
    """For each piece of each part, (2**bits, distance + 1): the share of all fingerprints
    that differ from a value in so many bits of the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[np.zeros(1 << len(piece), np.int64) for piece in part] for part in cut]
        for batch in pieces_of(batches, 1 << 14):
            hashes = unsigned(batch.column(0))
            for p, part in enumerate(cut):
                for q, piece in enumerate(part):
                    counts[p][q] += np.bincount(packed(hashes, piece), minlength=1 << len(piece))
        for p, part in enumerate(counts):
            for q, found in enumerate(part):
                seen = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(seen), p, np.int32)), pa.array(np.full(len(seen), q, np.int32)),
                     pa.array(seen.astype(np.int32)), pa.array(found[seen])], ["p", "q", "v", "n"])

    counts = [[np.zeros(1 << len(piece)) for piece in part] for part in cut]
    for row in (prints.select("fp").mapInArrow(run, "p int, q int, v int, n long")
                .groupBy("p", "q", "v").agg(F.sum("n").alias("n")).collect()):
        counts[row["p"]][row["q"]][row["v"]] = row["n"]
    out = []
    for part in counts:
        own = []
        for found in part:
            values = np.arange(len(found))
            apart = np.bitwise_count(values[:, None] ^ values[None, :])
            own.append(np.stack([(apart == d) @ found for d in range(distance + 1)], axis=1) / max(total, 1))
        out.append(own)
    return out


def ball(group: list[int], radius: int) -> np.ndarray:
    """Masks of all changes of at most ``radius`` bits of a group."""
    masks = [np.zeros(1, np.uint64)]
    edges = [(0, np.uint64(0))]
    for _ in range(radius):
        edges = [(i + 1, mask | ONES[group[i]]) for start, mask in edges for i in range(start, len(group))]
        masks.append(np.array([m for _, m in edges], np.uint64))
    return np.concatenate(masks)


def expected(hashes: np.ndarray, cut: list[list[list[int]]], shares: list[list[np.ndarray]],
             total: int, distance: int) -> np.ndarray:
    """(n, parts, distance + 2): probes and candidates of a part that gets so many units. The
    pieces of a part count as independent."""
    out = np.zeros((len(hashes), len(cut), distance + 2))
    for p, part in enumerate(cut):
        size = sum(map(len, part))
        found = np.zeros((len(hashes), distance + 1))
        found[:, 0] = 1
        for piece, share in zip(part, shares[p]):
            own = share[packed(hashes, piece)]
            found = np.stack([sum(found[:, k] * own[:, d - k] for k in range(d + 1))
                              for d in range(distance + 1)], axis=1)
        probes, reach = 0, 1
        for units in range(1, distance + 2):
            probes += reach
            reach = reach * (size - units + 1) // units
            out[:, p, units] = probes + total * found[:, :units].sum(axis=1)
    return out


def allocate(cost: np.ndarray) -> np.ndarray:
    """(n, parts): the units of each part, ``cost.shape[2] - 1`` in all, that cost least."""
    n, parts, options = cost.shape
    best = np.full((n, options), np.inf)
    best[:, 0] = 0
    chosen = np.zeros((parts, n, options), np.int64)
    for p in range(parts):
        after = np.full((n, options), np.inf)
        for units in range(options):
            for before in range(options - units):
                value = best[:, before] + cost[:, p, units]
                better = value < after[:, before + units]
                after[better, before + units] = value[better]
                chosen[p, better, before + units] = units
        best = after
    out, left = np.zeros((n, parts), np.int64), np.full(n, options - 1)
    for p in reversed(range(parts)):
        out[:, p] = chosen[p, np.arange(n), left]
        left = left - out[:, p]
    return out


def masks_of(groups: list[list[int]]) -> np.ndarray:
    return np.array([ONES[group].sum() for group in groups], np.uint64)


def probes(prints: DataFrame, groups: list[list[int]], shares: list[list[np.ndarray]], total: int,
           distance: int) -> DataFrame:
    """mask, value, fp and rep: the values of parts that each fingerprint asks for."""
    cut, masks = cut_groups(groups), masks_of(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = [[ball(group, radius) for radius in range(distance + 1)] for group in groups]
        for batch in pieces_of(batches, 1 << 12):
            hashes, reps = unsigned(batch.column(0)), batch.column(1).to_numpy()
            units = allocate(expected(hashes, cut, shares, total, distance))
            for p, mask in enumerate(masks):
                for radius in range(distance + 1):
                    own = np.flatnonzero(units[:, p] == radius + 1)
                    if len(own):
                        near = around[p][radius]
                        values = ((hashes[own] & mask)[:, None] ^ near[None, :]).ravel()
                        yield keyed(np.full(len(values), mask, np.uint64), values,
                                    np.repeat(hashes[own], len(near)), np.repeat(reps[own], len(near)))

    return prints.select("fp", "rep").mapInArrow(run, KEYED)


KEYED = "mask long, value long, fp long, rep long"


def keyed(masks: np.ndarray, values: np.ndarray, hashes: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(masks.view(np.int64)), pa.array(values.view(np.int64)),
         pa.array(hashes.view(np.int64)), pa.array(reps)], ["mask", "value", "fp", "rep"])


def parts_of(prints: DataFrame, masks: np.ndarray) -> DataFrame:
    """mask, value, fp and rep: every fingerprint under its value of each part."""
    signed = masks.view(np.int64).tolist()
    return prints.select(F.explode(F.array(*(F.lit(m) for m in signed))).alias("mask"), "fp", "rep").select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp", "rep")


def linked(hashes: np.ndarray, distance: int) -> np.ndarray:
    """For distinct sorted fingerprints the place of one that stands for all it reaches by
    steps of at most ``distance`` bits, 0 to 2. At two bits they share a neighbour at one bit."""
    count = len(hashes)
    label = np.arange(count)
    if distance == 2:
        keys = np.concatenate([hashes, *(hashes ^ one for one in ONES)])
        order = np.argsort(keys, kind="stable")
        same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
        left, right = order[same] % count, order[same + 1] % count
    elif distance == 1:
        flips = np.concatenate([hashes ^ one for one in ONES])
        place = np.minimum(np.searchsorted(hashes, flips), count - 1)
        same = np.flatnonzero(hashes[place] == flips)
        left, right = same % count, place[same]
    else:
        return label
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, label[left], low)
        np.minimum.at(after, label[right], low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def split_lists(lists: DataFrame, distance: int) -> DataFrame:
    """Each list under the values of ``distance + 1`` parts of the bits it leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 1 << 14):
            mask, value, hashes = (unsigned(batch.column(i)) for i in range(3))
            reps = batch.column(3).to_numpy()
            for own in np.unique(mask):
                at = np.flatnonzero(mask == own)
                free = [i for i in range(BITS) if not own & ONES[i]]
                for part in np.array_split(np.array(free, np.int64), distance + 1):
                    more = ONES[part].sum(dtype=np.uint64)
                    yield keyed(np.full(len(at), own | more, np.uint64),
                                value[at] | hashes[at] & more, hashes[at], reps[at])

    return lists.mapInArrow(run, KEYED)


def list_links(lists: DataFrame, distance: int, width: int, block: int) -> DataFrame:
    """Links (a, b) that join all documents of a list that link inside it."""
    # no list below this many open bits can have more members than a block
    while True:
        big = stored(lists.groupBy("mask", "value").agg(F.count("*").alias("members"))
                     .filter((F.col("members") > block) & (F.bit_count("mask") < BITS - distance))
                     .select("mask", "value"), "simhash-long")
        if not big.head(1):
            break
        rest = lists.join(big, ["mask", "value"], "left_anti")
        cut = split_lists(lists.join(big, ["mask", "value"], "left_semi").select("mask", "value", "fp", "rep"),
                          distance)
        lists = stored(rest.select("mask", "value", "fp", "rep").unionByName(cut), "simhash-lists")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def links() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            hashes, at = np.unique(np.concatenate([h for h, _ in held]), return_index=True)
            reps = np.concatenate([r for _, r in held])[at]
            root = linked(hashes, distance)
            out = np.flatnonzero(root != np.arange(len(root)))
            if len(out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps[out]), pa.array(reps[root[out]])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            mask, value, hashes = (unsigned(batch.column(i)) for i in range(3))
            reps = batch.column(3).to_numpy()
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(mask)]):
                if (mask[a], value[a]) != key:
                    yield from links()
                    key, held = (mask[a], value[a]), []
                held.append((hashes[a:b], reps[a:b]))
        yield from links()

    return (lists.repartition(width, "mask", "value").sortWithinPartitions("mask", "value", "fp")
            .select("mask", "value", "fp", "rep").mapInArrow(run, "a long, b long"))


def parts_for(total: int, distance: int) -> int:
    """As many parts, up to ``distance + 1``, as leave each wide enough to tell ``total``
    random values apart; two at least."""
    return max(2, min(distance + 1, BITS // max(1, total.bit_length())))


def links_of(prints: DataFrame, distance: int = 2, often: int = OFTEN, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the reps of distinct fingerprints (fp, rep) that make the same
    components as all pairs of at most ``distance`` differing bits, which is 0 to 2: lists
    join what shares a neighbour at one bit."""
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")
    width = shuffle_width(prints.sparkSession)
    total = prints.count()
    groups = bit_groups(bit_pairs(prints), total, parts_for(total, distance))
    shares = piece_shares(prints, cut_groups(groups), total, distance)
    asked = stored(probes(prints, groups, shares, total, distance), "simhash-probes")
    entries = parts_of(prints, masks_of(groups))
    hot = stored(entries.groupBy("mask", "value").agg(F.count("*").alias("members"))
                 .filter(F.col("members") > often).select("mask", "value"), "simhash-often")
    key = ["mask", "value"]
    cold = asked.join(hot, key, "left_anti").select(*key, F.col("fp").alias("one"), F.col("rep").alias("a"))
    pairs = (cold.join(entries.join(hot, key, "left_anti"), key)
             .filter((F.col("one") != F.col("fp"))
                     & (F.bit_count(F.col("one").bitwiseXOR(F.col("fp"))) <= distance))
             .select("a", F.col("rep").alias("b")))
    probed = asked.join(hot, key, "left_semi").select(*key, "fp", "rep")
    met = stored(probed.select(*key).distinct(), "simhash-met")
    lists = probed.unionByName(entries.join(met, key, "left_semi").select(*key, "fp", "rep")).distinct()
    return pairs.unionByName(list_links(stored(lists, "simhash-lists"), distance, width, block))


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", often: int = OFTEN, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = stored(fingerprints(docs, words, id_col, text_col), "simhash-rows")
    named = rows.filter("doc_id IS NOT NULL")
    prints = stored(named.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-prints")
    links = links_of(prints, distance, often, block)
    own = named.join(prints, "fp")
    several = own.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a <> b")
    same = own.join(several.select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(links.unionByName(same)).withColumnRenamed("id", "rep")
    found = prints.join(labels, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return rows.join(found, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component", "doc_id").alias("component_id"))
