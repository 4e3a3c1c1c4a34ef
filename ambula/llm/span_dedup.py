"""Substring dedup by sliding sentence spans.

A text is cut into sentences, after . ! ? and following quotes and brackets where white space follows, after the full
stops of Chinese and Japanese, at line ends, and after every SENTENCE_WORDS words of what is longer. Every run of at least
MIN_SENTENCES consecutive sentences that has at least MIN_WORDS words counts. Runs are joined over the whole corpus by the
hash of their sentences (A-Z lower-cased, white space within a sentence as one space). The first place of a run, by doc_id
and then position, stays; sentences that any other place of a repeated run covers are removed.

Only the shortest run from every sentence on and the shortest back from every sentence are hashed; they are called spans.
No more are needed: each sentence of a longer run is in a span within the run, as the words from it to the run's end are
enough for a span from it, or so few that the span back from the run's last sentence covers it; and where a run has an
earlier place, so have the spans within it.

A sentence has as many words as parts between white space, or as sixteenths of its bytes if that is more, so that text
without spaces has words.

Heavy hashes, each of at least 1 / HEAVY of all spans, would gather in a few tasks. There are at most HEAVY of them, so
their first places are broadcast, and the spans of each text are held against them where they are. Only others are joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambula.llm.base import quoted
from ambula.stages import write_stage

MIN_SENTENCES = 2
MIN_WORDS = 20
SENTENCE_WORDS = 20
#: A hash is heavy if it has at least this part of all spans, so there are no more heavy ones than that.
HEAVY = 65_536
#: Stands for a null doc_id: the smallest.
NULL_ID = -(2**63)
#: White space after a sentence belongs to it, so that sentences tile the text.
_ENDS = re.compile(r"""[.!?]["'’”)\]]*\s+|[。！？]\s*|\s*\n\s*""")
_WORD = re.compile(r"\S+\s*")
#: Places are held as first sentence << SHIFT + number of the others, of which a span has under MIN_WORDS with words.
SHIFT = 20


def sentence_ends(text: str) -> list[int]:
    """Ends of the sentences, ascending; the last is the length of the text. The empty text has none."""
    ends = [m.end() for m in _ENDS.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    out, start = [], 0
    for end in ends:
        if end - start > 2 * SENTENCE_WORDS:  # fewer characters hold no more words
            words = [m.end() for m in _WORD.finditer(text, start, end)]
            out += words[SENTENCE_WORDS - 1 : -1 : SENTENCE_WORDS]
        out.append(end)
        start = end
    return out


def spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last sentence of each span, from 0, and its hash; by first, then last sentence."""
    starts = [0, *(ends := sentence_ends(text))]
    sentences = [b" ".join(text[a:b].encode("utf-8", "surrogatepass").lower().split()) for a, b in zip(starts, ends)]
    full = [i for i, s in enumerate(sentences) if s]
    none = np.empty(0, np.int64)
    if not full:
        return none, none, none
    counts = np.concatenate(([0], np.cumsum([max(s.count(b" ") + 1, len(s) // 16) for s in map(sentences.__getitem__, full)])))
    digest = b"".join(xxhash.xxh3_64_digest(sentences[i]) for i in full)
    n = len(full)
    at = np.arange(n)
    end = np.maximum(at + MIN_SENTENCES, np.searchsorted(counts, counts[:-1] + MIN_WORDS))  # exclusive
    start = np.minimum(at + 1 - MIN_SENTENCES, np.searchsorted(counts, counts[1:] - MIN_WORDS, "right") - 1)
    pairs = np.concatenate((np.stack((at, end), 1)[end <= n], np.stack((start, at + 1), 1)[start >= 0]))
    if not len(pairs):
        return none, none, none
    key = np.unique(pairs[:, 0] * (n + 1) + pairs[:, 1])
    first, last = key // (n + 1), key % (n + 1)
    view, one = memoryview(digest), xxhash.xxh3_64_intdigest
    found = np.fromiter((one(view[8 * a : 8 * b]) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(key))
    place = np.array(full)
    return place[first], place[last - 1], found.view(np.int64)


def _list(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64)))


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            found = [spans(t or "") for t in part.column(2).to_pylist()]
            places = [(a << SHIFT) + b - a for a, b, _ in found]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _list(places), _list([h for _, _, h in found])], ["doc_id", "text_hash", "places", "hashes"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, places) to (row, text without the places' sentences, number of sentences, how many went)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts, totals, gone = [], [], []
            for text, places in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                ends = sentence_ends(text or "")
                keep = np.ones(len(ends), bool)
                for p in places or ():
                    keep[p >> SHIFT : (p >> SHIFT) + (p & ((1 << SHIFT) - 1)) + 1] = False
                totals.append(len(ends))
                gone.append(int(len(ends) - keep.sum()))
                texts.append("".join(text[a:b] for a, b, k in zip([0, *ends], ends, keep) if k) if gone[-1] else text)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], ["row", "text", "n_sentences", "n_removed"])


def _each(spanned: DataFrame) -> DataFrame:
    """(h, at) for each span."""
    each = spanned.select("doc_id", "text_hash", F.explode(F.arrays_zip("places", "hashes")).alias("s"))
    return each.select(F.col("s.hashes").alias("h"), F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text_hash", F.col("s.places").alias("place")).alias("at"))


def _split(held):
    """Takes the heavy spans out of each text's, and tells which of them are not the first of their hash."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = held.value
        h, first_doc, first_text, first_place = (heavy[c] for c in ("h", "doc_id", "text_hash", "place"))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                lists, hashes = part.column(2), part.column(3)
                places, found = (np.asarray(x.flatten(), np.int64) for x in (lists, hashes))
                sizes = np.diff(np.asarray(lists.offsets))
                owner = np.repeat(np.arange(part.num_rows), sizes)
                near = np.minimum(np.searchsorted(h, found), max(len(h) - 1, 0))
                is_heavy = h[near] == found if len(h) else np.zeros(len(found), bool)
                doc = np.asarray(part.column(0).fill_null(NULL_ID), np.int64)[owner]
                text = np.asarray(part.column(1), np.int64)[owner]
                later = is_heavy.copy()
                if len(h):
                    later &= ~((first_doc[near] == doc) & (first_text[near] == text) & (first_place[near] == places))

                def lists_of(values, mask):
                    ends = np.concatenate(([0], np.cumsum(np.bincount(owner[mask], minlength=part.num_rows)))).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[mask]))

                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists_of(places, ~is_heavy), lists_of(found, ~is_heavy), lists_of(places, later)], ["doc_id", "text_hash", "places", "hashes", "later"])

    return split


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, places): for each text with any, the places of spans that are not the first of their hash."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spanned = write_stage(keyed.mapInArrow(_spanned, "doc_id long, text_hash long, places array<long>, hashes array<long>"), "spans")
    firsts = _each(spanned).groupBy("h").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last").select("h", "first", "n")
    firsts = write_stage(firsts, "firsts")
    total = spanned.agg(F.sum(F.size("places"))).first()[0] or 0
    heavy = firsts.where(F.col("n") * HEAVY >= total)
    table = heavy.select("h", "first.*").toPandas().sort_values("h")
    held = spanned.sparkSession.sparkContext.broadcast({c: table[c].to_numpy(np.int64) for c in table})
    split = spanned.mapInArrow(_split(held), "doc_id long, text_hash long, places array<long>, hashes array<long>, later array<long>")
    light = _each(split).join(firsts.where(F.col("n") * HEAVY < total).select("h", "first"), "h").where("at <> first").select("at.*").distinct()
    light = light.groupBy("doc_id", "text_hash").agg(F.collect_list("place").alias("places"))
    known = split.where("size(later) > 0").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text_hash", F.col("later").alias("places"))
    return light.unionByName(known).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("places")).alias("places"))


def _deduped(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), text, n_sentences and n_removed."""
    keyed = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), "text", F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    met = keyed.join(repeated_spans(docs), ["doc_id", "text_hash"], "left").select("row", "text", "places")
    row = T.StructField("row", met.schema["row"].dataType)
    return met.mapInArrow(_cut, T.StructType([row, T.StructField("text", T.StringType()), T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())]))


def dedup_spans(docs: DataFrame, drop_empty: bool = False) -> DataFrame:
    """docs with the sentences of repeated spans removed from text; n_chars follows the text where sentences went.

    Null and empty texts stay as they are; so do texts without spans. Rows with the same doc_id and text count as one
    document and stay alike. Null doc_ids count as the smallest. Other columns stay, whatever their names; no rows give no
    rows. With drop_empty documents of which all sentences went are left out.
    """
    out = _deduped(docs)
    if drop_empty:
        out = out.where("n_removed = 0 or n_removed < n_sentences")
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
    own = lambda c: F.col("row")[c]
    return out.select(*[F.col("text") if c == "text" else F.coalesce(size, own(c)).alias(c) if c == "n_chars" else own(c).alias(c) for c in docs.columns])


def report_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_sentences and n_removed of every row of docs(doc_id, text), as dedup_spans() leaves them."""
    return _deduped(docs.select("doc_id", "text")).select(F.col("row.doc_id"), "text", "n_sentences", "n_removed")
