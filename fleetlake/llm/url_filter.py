"""Verdicts on URLs by a bit-parallel automaton that runs all glob rules at once.

The canonical form of a URL is a dot, its host (A-Z lower-cased), one separator byte that UTF-8 text
never contains, and its path. Host: after the first `://` up to `/`, `?`, `#` or the end; path: from
there up to `?`, `#` or the end. A null URL or one without `://` has empty host and path.

Every rule is a glob over that form: `*` stands for any bytes (within its side of the separator), `?`
for one. Rules are packed into one row of 64-bit words, a start bit and a bit per literal each; one step
of Shift-And per byte moves all rules of all URLs of a batch: a bit goes on to the next literal if the
byte fits it and stays where a `*` follows it and takes the byte. The last bit of a rule is its match.

Of matching site rules the longest decides; without one the first matching glob decides; else allow.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import batches, bound_batches, text_bytes

BOUND = 0xFF
ANY = -1


class SiteRule(NamedTuple):
    """`site` is host and path, such as `example.net/en/`: the host, its subdomains, paths that start so."""

    verdict: str
    site: str

    def glob(self) -> tuple[str, str]:
        host, slash, path = self.site.partition("/")
        return f"*.{host}", f"{slash}{path}*"


class GlobSet:
    """Globs (host, path) as masks: `step[c]` and `stay[c]` for each byte, `start` and `final` bits."""

    def __init__(self, globs: list[tuple[str, str]]):
        literals, loops, starts, self.final = [], [], [], []
        for host, path in globs:
            starts.append(len(literals))
            literals.append(None)
            loops.append(None)
            for side, text in enumerate((host, path)):
                for byte in text.encode():
                    if byte == ord("*"):
                        loops[-1] = side
                    else:
                        literals.append(ANY if byte == ord("?") else byte)
                        loops.append(None)
                if side == 0:
                    literals.append(BOUND)
                    loops.append(None)
            self.final.append(len(literals) - 1)
        self.words = max(1, -(-len(literals) // 64))
        shape = (256, self.words)
        self.step, self.stay, self.start = np.zeros(shape, np.uint64), np.zeros(shape, np.uint64), np.zeros(self.words, np.uint64)
        inner = np.arange(256) != BOUND
        for i, (literal, loop) in enumerate(zip(literals, loops, strict=True)):
            word, bit = i // 64, np.uint64(1 << (i % 64))
            if literal is not None:
                self.step[inner if literal == ANY else literal, word] |= bit
            if loop is not None:
                self.stay[inner if loop == 0 else slice(None), word] |= bit
        for i in starts:
            self.start[i // 64] |= np.uint64(1 << (i % 64))

    def matches(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether each glob (column) matches each text (row) as a whole."""
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        begin, size = bounds[:-1][order], size[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        longest = int(size[0]) if len(size) else 0
        lasting = len(size) - np.searchsorted(size[::-1], np.arange(longest), side="right")
        for at in range(longest):
            n = lasting[at]
            byte, now = data[begin[:n] + at], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[byte]) | (now & self.stay[byte])
        found = np.zeros((len(order), len(self.final)), bool)
        for k, i in enumerate(self.final):
            found[order, k] = (state[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) == 1
        return found


def host_of(url):
    """Column: the host of a URL, empty without one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    """Column: the path of a URL, empty without one."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_verdicts(pages: DataFrame, rules: list[SiteRule], globs: list[tuple[str, tuple[str, str]]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of each row.

    `globs` holds (verdict, (host glob, path glob)), tried in order where no site rule fits; host globs
    are matched against a dot and the host.
    """
    bound_batches(pages.sparkSession)
    automaton = GlobSet([r.glob() for r in rules] + [g for _, g in globs])
    by_length = sorted(range(len(rules)), key=lambda i: -len(rules[i].site))
    choice = [*by_length, *range(len(rules), len(rules) + len(globs))]
    names = np.array([rules[i].site for i in by_length] + [None] * (len(globs) + 1), object)
    verdicts = np.array([rules[i].verdict for i in by_length] + [v for v, _ in globs] + ["allow"], object)

    def judge(it):
        for batch in batches(it):
            host, path = (text_bytes(batch.column(i)) for i in (1, 2))
            sizes = np.diff(host[1]) + np.diff(path[1]) + 2
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            data = np.full(bounds[-1], ord("."), np.uint8)
            data[bounds[:-1] + 1 + np.diff(host[1])] = BOUND
            for (own, at), shift in ((host, bounds[:-1] + 1), (path, bounds[:-1] + 2 + np.diff(host[1]))):
                data[np.arange(len(own)) + np.repeat(shift - at[:-1], np.diff(at))] = own
            found = automaton.matches(data, bounds)[:, choice]
            pick = np.concatenate([found, np.ones((len(found), 1), bool)], 1).argmax(1)
            arrays = [*batch.columns, pa.array(names[pick], pa.string()), pa.array(verdicts[pick], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "host", "path", "rule", "verdict"])

    url = F.col(url_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return rows.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")
