"""Secret scans, in DataFrame functions only.

Base kinds (leftmost non-overlapping per kind):
  assign  a key word, `:` or `=`, and a value of 6 or more characters
  access  AKIA and upper-case letters or digits, 20 or more characters
  hex     24 or more of 0-9a-f
The method adds
  entropy candidate strings (20 or more of A-Za-z0-9+/_=-) some window of WINDOW characters of which has a Shannon
          entropy of at least the threshold of its character class, unless an allow-list pattern fits the candidate.
          The counts of a window's characters are kept as a string, a character for each count; a step changes it, and
          the sum of c*log2(c), for the leaving and the entering character only.

Spans are in code points from 0, the end exclusive. Null texts count as empty.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambula.llm.base import quoted

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # greedy runs of 20 or more: the same matches as `AKIA[A-Z0-9]+` less the short ones
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits per character. A window of 20 has at most log2(20) = 4.32.
THRESHOLDS = {"hex": 2.8, "mixed": 3.5, "lower": 3.3, "upper": 3.3}
#: Class of a candidate, the first that fits: hex digits with both letters and digits; upper, lower and digits all present;
#: lower case or upper case only, with three or more digits and nothing else. Others (words) have none.
CLASSES = (
    ("hex", (r"^[0-9a-fA-F]+$", r"[0-9]", r"[a-fA-F]")),
    ("mixed", (r"[0-9]", r"[A-Z]", r"[a-z]")),
    ("lower", (r"^[0-9a-z]+$", r"[0-9].*[0-9].*[0-9]", r"[a-z]")),
    ("upper", (r"^[0-9A-Z]+$", r"[0-9].*[0-9].*[0-9]", r"[A-Z]")),
)
#: Known harmless strings: UUIDs, paths of words, documented example keys, runs of one character, alphabets.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^/?([A-Za-z]+|[0-9]+)([/_-]+([A-Za-z]+|[0-9]+))*/?$",
    r"EXAMPLE",
    r"^(.)\1*$",
    r"(?i)0123456789|abcdefghij",
)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, matches: Column, kind: str, pattern: str) -> Column:
    """Places of the matches of a pattern, as array<struct<start,kind_no,end>>, by the lengths of what lies between them."""
    empty = F.array().cast("array<struct<start:int,kind_no:int,end:int>>")

    def step(acc, m):  # spans are added in blocks, as an addition copies what there is
        at = acc["pos"] + F.char_length(m["gap"])
        end = at + F.char_length(m["match"])
        span = F.array(F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.alias("end")))
        full = F.size(acc["block"]) >= 256
        spans = F.when(full, F.concat(acc["spans"], acc["block"])).otherwise(acc["spans"])
        return F.struct(end.alias("pos"), F.when(full, span).otherwise(F.concat(acc["block"], span)).alias("block"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("pos"), empty.alias("block"), empty.alias("spans"))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    zipped = F.arrays_zip(gaps.alias("gap"), matches.alias("match"))
    return F.when(F.size(matches) == 0, empty).otherwise(F.aggregate(zipped, start, step, lambda acc: F.concat(acc["spans"], acc["block"])))


#: What a further character adds to the sum of c*log2(c) if c are there already.
_GAIN = [(c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)]
#: The character of count 0 in the string of counts, one for each ASCII character.
_ZERO = "@"


def peak_entropy(candidate: Column) -> Column:
    """The largest entropy of any window of WINDOW characters of an ASCII string of at least as many, in bits per character."""
    gains = F.array(*map(F.lit, _GAIN))

    def code(i):  # places in the string of counts, from 1
        return F.ascii(F.substring(candidate, i, F.lit(1)))

    def count(counts, place):
        return F.ascii(F.substring(counts, place, F.lit(1))) - ord(_ZERO)

    def put(counts, place, n):
        return F.overlay(counts, F.char(n + ord(_ZERO)), place, F.lit(1))

    def leave(acc, i):
        def one(place):
            return _let(count(acc["counts"], place) - 1, lambda n: F.struct(put(acc["counts"], place, n).alias("counts"), (acc["sum"] - F.get(gains, n)).alias("sum"), acc["least"].alias("least")))

        return F.when(i > WINDOW, _let(code(i - WINDOW), one)).otherwise(acc)

    def enter(acc, i):
        def one(place):
            def two(n):
                total = acc["sum"] + F.get(gains, n)
                return F.struct(put(acc["counts"], place, n + 1).alias("counts"), total.alias("sum"), F.when(i >= WINDOW, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

            return _let(count(acc["counts"], place), two)

        return _let(code(i), one)

    start = F.struct(F.lit(_ZERO * 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(math.inf).alias("least"))
    step = lambda acc, i: _let(leave(acc, i), lambda left: enter(left, i))
    return F.aggregate(F.sequence(F.lit(1), F.char_length(candidate)), start, step, lambda acc: F.lit(math.log2(WINDOW)) - acc["least"] / WINDOW)


def _entropy_hit(c: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | c.rlike(pattern)
    limit = F.lit(None).cast("double")
    for name, patterns in reversed(CLASSES):
        fits = reduce(and_, (c.rlike(p) for p in patterns))
        limit = F.when(fits, F.lit(THRESHOLDS[name])).otherwise(limit)
    return F.when(limit.isNull() | allowed, F.lit(False)).otherwise(peak_entropy(c) >= limit)


def find_spans(docs: DataFrame) -> DataFrame:
    """docs with `base` and `found` (base and entropy): arrays of (start, kind_no, end), by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("scanned", text)
    t = F.col("scanned")
    # the value is of 6 or more characters where the match ends in as many of its class after the separator
    value = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(1))
    whole = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(0))
    out = out.withColumn("m_assign", F.when(t.rlike(ASSIGN), F.arrays_zip(whole.alias("w"), value.alias("v"))))
    out = out.withColumn("m_access", F.when(F.contains(t, F.lit("AKIA")), F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0))))
    out = out.withColumn("m_hex", F.regexp_extract_all(t, F.lit(HEX), F.lit(0)))
    out = out.withColumn("m_entropy", F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)))
    none = F.array().cast("array<string>")
    spans_assign = _spans(t, F.transform(F.coalesce(F.col("m_assign"), F.array().cast("array<struct<w:string,v:string>>")), lambda m: m["w"]), "assign", ASSIGN)
    kept = F.filter(F.arrays_zip(spans_assign.alias("s"), F.col("m_assign").alias("m")), lambda x: F.char_length(x["m"]["v"]) >= 6)
    out = out.withColumn("s_assign", F.when(F.col("m_assign").isNull(), F.array().cast("array<struct<start:int,kind_no:int,end:int>>")).otherwise(F.transform(kept, lambda x: x["s"])))
    out = out.withColumn("s_access", _spans(t, F.coalesce(F.col("m_access"), none), "access", ACCESS)).withColumn("s_hex", _spans(t, F.col("m_hex"), "hex", HEX))
    located = _spans(t, F.col("m_entropy"), "entropy", CANDIDATE)
    hits = F.filter(F.arrays_zip(located.alias("s"), F.col("m_entropy").alias("m")), lambda x: _entropy_hit(x["m"]))
    out = out.withColumn("s_entropy", F.transform(hits, lambda x: x["s"]))
    out = out.withColumn("base", F.array_sort(F.concat("s_assign", "s_access", "s_hex")))
    out = out.withColumn("found", F.array_sort(F.concat("base", "s_entropy")))
    return out.drop("m_assign", "m_access", "m_hex", "m_entropy")


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """A row of docs(doc_id, text) each: counts of the base kinds, the hash of base spans, and all spans.

    Null and empty texts have none (the hash is that of the empty string). Other columns are ignored, also such as
    have names used here. Equal rows give equal rows; no rows give no rows.
    """
    out = find_spans(docs.select("doc_id", "text"))
    return out.select(
        "doc_id",
        *[F.size(f"s_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.encode(_joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.size("s_entropy").cast("long").alias("n_entropy"),
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of a secret replaced by mark, overlapping spans as one; n_chars follows. Other texts stay as they
    are, and so do other columns, whatever their names. Null texts stay null; no rows give no rows."""
    found = find_spans(docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), "text"))
    t = F.col("scanned")

    def step(acc, s):
        new = s["start"] >= acc["pos"]
        piece = F.concat(F.substring(t, acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0))), F.lit(mark))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(new, F.concat(acc["text"], piece)).otherwise(acc["text"]).alias("text"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("text"))
    whole = F.aggregate(F.col("found"), start, step, lambda acc: F.concat(acc["text"], F.substring(t, acc["pos"] + 1, F.char_length(t))))
    out = found.withColumn("clean", F.when(F.size("found") == 0, F.col("text")).otherwise(whole))
    size = F.when(F.size("found") > 0, F.char_length("clean").cast("long"))
    own = lambda c: F.col("row")[c]
    return out.select(*[F.col("clean").alias(c) if c == "text" else F.coalesce(size, own(c)).alias(c) if c == "n_chars" else own(c).alias(c) for c in docs.columns])
