"""Winnowed document fingerprints, in DataFrame functions only.

A text is cut at white space into words, and words after every WORD characters, so text without spaces has words too.
Every run of K consecutive words is hashed (a k-gram). In every window of W consecutive k-grams the smallest hash is
chosen, the rightmost of equal ones, and kept with its position.

Guarantee: two texts that share a run of at least W + K - 1 words share the k-gram chosen in it.
A text with fewer than K words has one k-gram of all its words; one with fewer than W k-grams has one window.
Empty and blank texts have no k-grams and the empty fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W_
from pyspark.sql import functions as F

WORD = 16
K = 3
W = 4  # a power of two: minima over windows are made by doubling
#: Positions count down from here in the low 31 bits, so that the least value has the rightmost position.
TOP = 2**31 - 1
MAX_BUCKETS = 131_072
BUCKET_DOCS = 2_048


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _choose(words: Column) -> Column:
    """The chosen k-grams of a word array: (hash << 31 | TOP - position), by position."""

    def gram(word, i):
        later = [F.get(words, i + j) for j in range(1, K)]
        return F.shiftleft(F.hash(word, *later).cast("bigint"), 31).bitwiseOR(F.lit(TOP).cast("bigint") - i)

    def minima(values, width):
        if width == W:
            return values
        return _let(F.zip_with(values, F.slice(values, width + 1, F.size(values)), lambda a, b: F.least(a, b)), lambda m: minima(m, 2 * width))

    grams = F.slice(F.transform(words, gram), 1, F.greatest(F.size(words) - (K - 1), F.lit(1)))
    least = _let(grams, lambda g: F.slice(minima(g, 1), 1, F.greatest(F.size(g) - (W - 1), F.lit(1))))
    return F.array_distinct(least)


def winnow(text: Column) -> Column:
    """The chosen k-grams of a text, as an array of longs; see hashes() and positions()."""
    words = F.regexp_extract_all(text, F.lit(rf"\S{{1,{WORD}}}"), F.lit(0))
    return _let(words, lambda a: F.when(F.size(a) > 0, _choose(a)).otherwise(F.array().cast("array<bigint>")))


def hashes(chosen: Column) -> Column:
    return F.transform(chosen, lambda c: F.shiftright(c, 31))


def positions(chosen: Column) -> Column:
    """Word positions from 0."""
    return F.transform(chosen, lambda c: F.lit(TOP).cast("bigint") - c.bitwiseAND(F.lit(TOP).cast("bigint")))


def as_string(chosen: Column) -> Column:
    """The fingerprint as text: each chosen k-gram in hexadecimal digits, joined."""
    return F.array_join(F.transform(chosen, lambda c: F.hex(c)), ",")


def likeness(a: Column, b: Column) -> Column:
    """Twice the common distinct hashes over the distinct hashes of both, from arrays of distinct hashes. Two empty ones: 1."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / F.greatest(both, F.lit(1)))


def with_next(docs: DataFrame, key: str, value: str) -> DataFrame:
    """docs(key, value) in ranges of key, each with a copy (is_copy) of the first row of the following range.

    Ordering by (is_copy, key, value) within range_id makes the next row the next document; the last range is followed
    by the first. Null keys come first. The number of ranges, and so the broadcast, is at most MAX_BUCKETS.
    """
    low, high, n = docs.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    low, high = (0, 0) if low is None else (low, high)
    n_buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_DOCS)))
    width = -(-(high - low + 1) // n_buckets)
    bucket = F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low)) / F.lit(width))).cast("int")
    ranged = docs.withColumn("range_id", bucket)
    order = W_.orderBy("range_id")
    firsts = ranged.groupBy("range_id").agg(F.min(key).alias("first_key"))
    firsts = firsts.withColumn("before", F.coalesce(F.lag("range_id").over(order), F.max("range_id").over(W_.partitionBy())))
    firsts = firsts.where(F.col("first_key").isNotNull()).select(F.col("first_key").alias(key), "before")
    copies = docs.join(F.broadcast(firsts), key).select(key, value, F.col("before").alias("range_id"), F.lit(True).alias("is_copy"))
    return ranged.select(key, value, "range_id", F.lit(False).alias("is_copy")).unionByName(copies)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of docs(doc_id, text), of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the next document in
    ascending doc_id. Null texts count as empty; equal doc_ids are ordered by text; null doc_ids come first and the
    last document is followed by the first with a doc_id. Other columns are ignored. No rows give no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = with_next(docs, "doc_id", "text")
    order = W_.partitionBy("range_id").orderBy(F.col("is_copy"), F.col("doc_id").asc_nulls_first(), F.col("text"))
    own = ranged.withColumn("next_text", F.lead("text").over(order)).withColumn("chosen", winnow(F.col("text")))
    own = own.withColumn("grams", F.array_distinct(hashes(F.col("chosen"))))
    own = own.withColumn("next_grams", F.lead("grams").over(order)).where(~F.col("is_copy"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), half))
    out = own.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    out = out.withColumn("edited_chosen", winnow(F.col("edited")))
    out = out.withColumn("edited_grams", F.array_distinct(hashes(F.col("edited_chosen"))))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("chosen")).alias("fingerprint"),
        as_string(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("grams"), F.col("edited_grams")).alias("near_edited"),
        likeness(F.col("grams"), F.coalesce(F.col("next_grams"), F.array().cast("array<bigint>"))).alias("near_next"),
    )
