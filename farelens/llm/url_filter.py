"""URL filters by a bit-parallel wildcard automaton.

Glob rules over a canonical URL are packed into the bits of one multiword Shift-And
state: one bit for each symbol of each rule, ``*`` as a bit that may stay set, ``?``
as a symbol that takes any byte. All rules advance together, one byte of every URL
of a batch at a time.

The canonical URL is ``.host path``: the host in lower case behind a dot, a blank,
then the path, with blanks, control and non-ASCII bytes written as %XX. A rule
(host, path) becomes ``*.host path*``, which fits the host and all its subdomains.

Defined cases: a url that is null or has no ``://`` has an empty host and path and
fits no host rule; among rules that fit, the longest wins, then the first given;
where none fits, the extra globs decide, the first that fits, and else the default.
Repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import pieces_of

ANY = None


def symbols(glob: str) -> tuple[list[int | None], list[bool]]:
    """The symbols of a glob, and for each place before, between and after them
    whether a ``*`` stands there. A backslash takes the next character literally."""
    out: list[int | None] = []
    stars = [False]
    literal = False
    for char in glob:
        if not literal and char == "\\":
            literal = True
            continue
        if not literal and char == "*":
            stars[-1] = True
            continue
        for byte in [ANY] if char == "?" and not literal else canonical(char):
            out.append(byte)
            stars.append(False)
        literal = False
    return out, stars


def canonical(text: str) -> bytes:
    """Printable ASCII as it is, anything else but the separating blank as %XX."""
    return b"".join(bytes([b]) if 32 <= b < 127 else b"%%%02X" % b for b in text.encode())


class GlobSet:
    """All globs in one state of 64-bit words."""

    def __init__(self, globs: list[str]):
        parsed = [symbols(glob) for glob in globs]
        total = sum(len(s) for s, _ in parsed)
        words = max(1, -(-total // 64))
        self.take = np.zeros((256, words), np.uint64)
        self.stay, self.first = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        self.again = np.zeros(words, np.uint64)
        self.last: list[tuple[int, np.uint64] | bool] = []
        bit = 0
        for found, stars in parsed:
            for i, byte in enumerate(found):
                word, mask = bit // 64, np.uint64(1) << np.uint64(bit % 64)
                if byte is ANY:
                    self.take[:, word] |= mask
                else:
                    self.take[byte, word] |= mask
                if i == 0:
                    self.first[word] |= mask
                    if stars[0]:
                        self.again[word] |= mask
                if stars[i + 1]:
                    self.stay[word] |= mask
                bit += 1
            self.last.append((word, mask) if found else stars[0])

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text and a column for each glob."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        out = np.zeros((len(texts), len(self.last)), bool)
        state = np.zeros((len(texts), len(self.stay)), np.uint64)
        rows = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        starts = np.cumsum(lengths) - lengths
        one, top = np.uint64(1), np.uint64(63)
        alive = len(texts)
        for at in range(int(lengths.max(initial=0))):
            while alive and lengths[alive - 1] <= at:
                alive -= 1
            now = state[:alive]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= ~self.first
            moved |= self.again if at else self.first
            state[:alive] = (moved & self.take[rows[starts[:alive] + at]]) | (now & self.stay)
        for j, last in enumerate(self.last):
            if last is True:
                out[order, j] = True
            elif last is False:
                out[order, j] = lengths == 0
            else:
                out[order, j] = state[:, last[0]] & last[1] != 0
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z lowered, and the path."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    lowered = F.translate(F.regexp_extract(text, parts, 1),
                          "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(text, parts, 2)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]],
               globs: list[tuple[str, str]] = (), default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict. ``rules``: (host, path, verdict) with a
    path that begins with ``/``; ``globs``: (glob over the canonical URL, verdict)."""
    ranked = sorted(rules, key=lambda rule: -len(rule[0] + rule[1]))

    def escaped(text: str) -> str:
        return "".join("\\" + c if c in "\\*?" else c for c in text)

    patterns = [f"*.{escaped(host)} {escaped(path)}*" for host, path, _ in ranked]
    patterns += [glob for glob, _ in globs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobSet(patterns)
        for batch in pieces_of(batches, 4096):
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hits = automaton.matches([
                b"." + canonical(host).replace(b" ", b"%20") + b" "
                + canonical(path).replace(b" ", b"%20") for host, path in zip(hosts, paths)])
            names, verdicts = [], []
            for row in hits.tolist():
                at = row.index(True) if True in row else -1
                by_rule = 0 <= at < len(ranked)
                names.append(ranked[at][0] + ranked[at][1] if by_rule else None)
                verdicts.append(ranked[at][2] if by_rule
                                else globs[at - len(ranked)][1] if at >= 0 else default)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    host, path = host_and_path(pages[url_col])
    return pages.select(
        pages[id_col].cast("long").alias("page_id"), host.alias("host"), path.alias("path"),
    ).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
