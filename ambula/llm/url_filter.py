"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into one bit string, a bit for each literal character and a bit for the start of each rule,
as 64-bit words. A step for one character shifts the states of all rules at once (Shift-And), keeps those whose next
literal is the character, and lets states before a `*` stay. Words are carried over between steps; all URLs of a batch
advance together, character by character.

A canonical URL is host and path: the host after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; the
path from there up to `?`, `#` or the end. Without `://`, and for null, both are empty.

Globs: `*` is any run of characters, also none; `?` is one character; a glob fits a whole canonical URL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): fits the host and its subdomains where the path starts with path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: What the method blocks where no rule fits: advertising, tracking, log-in and archive paths.
BLOCKED_GLOBS = ("ads.*", "*.ads.*", "*doubleclick*", "*/ads/*", "*/tracking/*", "*/login*", "*/wp-admin/*", "*.zip", "*.exe", "*/cart/*", "*casino*")


class GlobSet:
    """Compiled globs; match() tells which of them fit each text."""

    def __init__(self, globs: Sequence[str]) -> None:
        self.size = len(globs)
        self.literals: list[str] = []  # by bit; '' at the start of each glob
        stay, skip, last = [], [], []
        for glob in globs:
            self.literals.append("")
            stay.append(False)
            for ch in glob:
                if ch == "*":
                    stay[-1] = True
                else:
                    self.literals.append(ch)
                    stay.append(False)
            last.append(len(self.literals) - 1)
        n = len(self.literals)
        self.words = -(-max(n, 1) // 64)
        self.stay, self.starts = self._pack(stay), self._pack([x == "" for x in self.literals])
        alphabet = sorted({x for x in self.literals if len(x) == 1 and x != "?"})
        self.code = {ch: i + 1 for i, ch in enumerate(alphabet)}  # 0: any other character
        self.table = np.stack([self._pack([x == "?" or x == ch for x in self.literals]) for ch in [None, *alphabet]])
        self.last = np.array(last, np.int64)

    def _pack(self, bits: Sequence[bool]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for i, bit in enumerate(bits):
            if bit:
                out[i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return out

    def match(self, texts: Sequence[str]) -> np.ndarray:
        """Booleans, texts by globs."""
        found = np.zeros((len(texts), self.size), bool)
        if not self.size:
            return found
        order = np.argsort([-len(t) for t in texts], kind="stable")  # longest first: those that go on are a prefix
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        state = np.repeat(self.starts[None, :], len(texts), 0)
        get = self.code.get
        codes = [np.fromiter((get(c, 0) for c in texts[i]), np.int64, len(texts[i])) for i in order]
        for at in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -at, "left"))  # texts of more than `at` characters
            now = state[:n]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            chars = np.fromiter((c[at] for c in codes[:n]), np.int64, n)
            state[:n] = (shifted & self.table[chars]) | (now & self.stay)
        found[order] = (state[:, self.last // 64] >> (self.last % 64).astype(np.uint64)) & np.uint64(1) == 1
        return found


def canonical(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1)
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, blocked: Sequence[str] = BLOCKED_GLOBS) -> DataFrame:
    """page_id, host, path, rule and verdict for each row of pages(page_id, url).

    Of the rules that fit, the one of the longest text (host and path) decides, the first of equals; else a URL that one of the
    globs fits is blocked and others are allowed. Null and malformed URLs have an empty host and path and are judged
    like others. Repeated rows are judged each; other columns are ignored; no rows give no rows.
    """
    by_length = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    globs = [g for _, host, path in by_length for g in (f"{host}{path}*", f"*.{host}{path}*")]
    names = ["page_id", "host", "path", "rule", "verdict"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = GlobSet([*globs, *blocked])
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            fits = automaton.match([h + p for h, p in zip(hosts, paths)])
            # a host never holds "/", so in the canonical URL its rule can only end at the first one
            at_host = np.array([[bool(host) and (host == h or host.endswith("." + h)) for _, h, _ in by_length] for host in hosts], bool).reshape(len(hosts), len(by_length))
            ruled = (fits[:, : len(globs)].reshape(len(hosts), -1, 2).any(2)) & at_host
            first = np.where(ruled.any(1), ruled.argmax(1), -1)
            bad = fits[:, len(globs) :].any(1)
            rule = [by_length[i][1] + by_length[i][2] if i >= 0 else None for i in first]
            verdict = [by_length[i][0] if i >= 0 else "block" if b else "allow" for i, b in zip(first, bad)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names)

    host, path = canonical(F.col("url"))
    return pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
