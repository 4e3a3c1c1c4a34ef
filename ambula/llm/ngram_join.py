"""N-gram Jaccard join: all links of documents whose shingle sets have a Jaccard similarity of at least a ratio.

The join is exact. Equal sets are one class at once. For the others:

1. Two sets of sizes a <= b with similarity >= r/100 differ in at most a (100 - r) / r shingles (a / 9 for 90). The
   universe of shingles is split by hash into more parts than that; each full part's hash is a signature. A set with
   more full parts than that shares one with each set it links to, as each shingle that differs spoils one part at most.
   The number of parts follows the class of the smaller size; a set near the lower end of its class also gives the
   signatures of the class below. A set with fewer full parts also gives its shingles of least hash, one more than may
   differ (linked sets that both do so share one of these).
2. Of the sets with a common signature each is compared with the least one, its leader, and components are formed. Before
   their sets are fetched, a sketch drops pairs that cannot link: a bit for each of at least twice as many places as the
   set has shingles, set if an odd number of them falls there. Bits that differ between two sketches are at most as many
   as the shingles that differ, so no link is lost.
3. Token-group matrix: sets with a common leader are one group, dealt by hash to blocks of at most BLOCK on average, so
   any two sets with a common signature are in some group together. Groups of one component are done. Of the others, members
   whose sketches leave no partner of another component in the group go. Each block of the rest has the union of its
   members' shingles as rows of a matrix with the members as columns. A set can only link to a block if its overlap
   with the union is large enough for the block's smallest member; only then the block is opened, and the rows of
   the set's shingles are added up to its overlaps with all members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ambula.llm.base import quoted
from ambula.operators.components import connected_components
from ambula.stages import write_stage

SHINGLE = 3
RATIO = 90  # of 100
#: Members of a block on average at most, by sets and by sketches.
BLOCK, SKETCH_BLOCK = 256, 4_096

_MUL = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0xD6E8FEB86659FD93


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number modulo 2**64, as far as the longest word so far."""

    def __init__(self) -> None:
        self.table = np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if n > len(self.table):
            steps = np.full(max(n, 64), np.uint64(_ODD))
            steps[0] = 1
            self.table = np.multiply.accumulate(steps)
        return self.table


_powers = _Powers()


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct 64-bit hashes of all runs of `size` words, sorted; of the whole sequence if it is shorter.

    A-Z are lower-cased; words are runs of other characters than space and \\x09-\\x0d. Texts without words have none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    data *= _powers(int(lengths.max()))[np.arange(len(data)) - np.repeat(starts, lengths)]
    h = _mix(np.add.reduceat(data, starts) + lengths.astype(np.uint64) * _MUL)
    n = min(size, len(h))
    grams = h[: len(h) - n + 1]
    for j in range(1, n):
        grams = _mix(grams * _MUL + h[j : len(h) - n + 1 + j])
    return np.unique(_mix(grams + np.uint64(n)))


def least_size(ratio: int) -> int:
    """Sizes below this link with equal sets only: for 90 it is 9, as 8 of 9 shingles are under 0.9."""
    return -(-ratio // (100 - ratio))


def class_start(c: int, ratio: int = RATIO) -> int:
    """Classes of sizes grow by a factor of at least 100 / ratio, so that linked sets are in one class or in neighbours."""
    return int(np.ceil(least_size(ratio) * max(1.25, 100 / ratio) ** c - 1e-9))


def size_class(n: int, ratio: int = RATIO) -> int:
    c = max(0, int(np.log(n / least_size(ratio)) / np.log(max(1.25, 100 / ratio))))
    while class_start(c + 1, ratio) <= n:
        c += 1
    while class_start(c, ratio) > n:
        c -= 1
    return c


@lru_cache(maxsize=None)
def parts_of(k: int, ratio: int) -> tuple[int, int]:
    """How many shingles may differ if the smaller size is of class k, and the number of parts: so many that few sets have
    fewer full ones (by three deviations, for the least size of the class)."""
    differ, n = (class_start(k + 1, ratio) - 1) * (100 - ratio) // ratio, class_start(k, ratio)
    parts = differ + 1
    while parts <= 2 * differ:
        gap = np.exp(-n / parts)
        if parts * (1 - gap) - 3 * np.sqrt(parts * gap * (1 - (1 + n / parts) * gap)) > differ:
            break
        parts += max(1, differ // 200)
    return differ, parts


def signatures(s: np.ndarray, ratio: int = RATIO) -> np.ndarray:
    """Signatures of a sorted set, so that two linked, unequal sets have one in common."""
    n = len(s)
    if n < least_size(ratio):
        return np.empty(0, np.int64)
    c = size_class(n, ratio)
    classes = [c]
    if c and 100 * (class_start(c, ratio) - 1) >= ratio * n:  # a partner may be in the class below
        classes.append(c - 1)
    found = []
    for k in classes:
        differ, parts = parts_of(k, ratio)
        part = (_mix(s * _MUL + np.uint64(k)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        counts = np.bincount(part.astype(np.int64), minlength=parts)
        order = np.argsort(part, kind="stable")  # within a part by value
        full = np.flatnonzero(counts)
        starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        place = np.arange(n) - np.repeat(starts, counts[full])
        terms = s[order] * _powers(int(counts.max()))[place]
        sums = np.add.reduceat(terms, starts)
        tag = np.uint64(k << 24) + full.astype(np.uint64)
        found.append(_mix(_mix(sums + counts[full].astype(np.uint64)) + tag * _MUL))
        if len(full) <= differ:
            least = np.sort(_mix(s ^ np.uint64(0x5851F42D4C957F2D)))[: differ + 1]
            tag = np.array([k << 24 | 1 << 40], np.uint64)  # an array, as its product may wrap
            found.append(_mix(least + tag * _MUL))
    return np.concatenate(found).view(np.int64)


def sketch(s: np.ndarray) -> np.ndarray:
    """The parity sketch of a set, as 64-bit words; their number is a power of two."""
    bits = 1 << max(6, (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """Sketches (the last axis) at a smaller power of two of words."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def may_link(differ: np.ndarray, sizes: np.ndarray, ratio: int) -> np.ndarray:
    """Whether sets may link of whose shingles, `sizes` in both, at least `differ` are in one only."""
    return (100 + ratio) * differ <= (100 - ratio) * sizes


def _signed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingle_set(t, size) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_hash", "sketch"],
            )


def _marks(batches: Iterator[pa.RecordBatch], size: int, ratio: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            found = [signatures(shingle_set(t, size), ratio) for t in part.column(1).to_pylist()]
            ids = np.repeat(part.column(0).to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64()), pa.array(ids, pa.int64())], ["mark", "rep"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingle_set(t, size).view(np.int64) for t in part.column(1).to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], ["doc_id", "grams"])


def _hopeful(batches: Iterator[pa.RecordBatch], ratio: int) -> Iterator[pa.RecordBatch]:
    """Of pairs (q, y, sizes and sketches of both) those that may link."""
    for batch in batches:
        sizes = batch.column(2).to_numpy() + batch.column(4).to_numpy()
        differ = np.zeros(batch.num_rows, np.int64)
        for i, (a, b) in enumerate(zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            size = min(len(a), len(b))
            differ[i] = np.bitwise_count(fold(a, size) ^ fold(b, size)).sum()
        keep = pa.array(may_link(differ, sizes, ratio))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["q", "y"])


def _partners(left: pd.DataFrame, right: pd.DataFrame, ratio: int) -> pd.DataFrame:
    """Members of two blocks of a group that have a possible partner of another component in the other block."""
    out = {"y": [], "rep": []}
    if len(left) and len(right):
        own, sizes, reps = right.component_.to_numpy(), right.n_shingles_.to_numpy(), right.rep_.to_numpy()
        words = [np.frombuffer(w, np.uint64) for w in right.sketch_]
        widths = np.fromiter(map(len, words), np.int64, len(words))
        tables = {int(w): (at := np.flatnonzero(widths == w), np.stack([words[i] for i in at])) for w in np.unique(widths)}
        folded: dict[tuple[int, int], np.ndarray] = {}
        found = np.zeros(len(right), bool)
        mine = []
        for rep, component, n, data in zip(left.rep, left.component, left.n_shingles, left.sketch):
            a, hit = np.frombuffer(data, np.uint64), False
            for width, (at, table) in tables.items():
                size = min(width, len(a))
                if (width, size) not in folded:
                    folded[width, size] = fold(table, size)
                close = (own[at] != component) & (100 * np.minimum(sizes[at], n) >= ratio * np.maximum(sizes[at], n))
                near = at[close]
                if len(near):
                    differ = np.bitwise_count(folded[width, size][close] ^ fold(a, size)).sum(1, dtype=np.int64)
                    near = near[may_link(differ, sizes[near] + n, ratio)]
                    found[near] = True
                    hit = hit or bool(len(near))
            if hit:
                mine.append(rep)
        out["rep"] = [*mine, *reps[found].tolist()]
        out["y"] = [left.y.iloc[0]] * len(out["rep"])
    return pd.DataFrame(out).astype("int64")


class TokenGroup:
    """The token-group matrix of a block, by rows: for each shingle of the union the members that hold it."""

    def __init__(self, sets: list[np.ndarray], ratio: int = RATIO) -> None:
        self.ratio = ratio
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        grams = np.concatenate(sets)
        order = np.argsort(grams, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.union, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(grams))

    def overlaps(self, s: np.ndarray) -> np.ndarray | None:
        """How many shingles each member has in common with a sorted set; None if the union shows that none links."""
        at = np.searchsorted(self.union, s)
        at = at[at < len(self.union)] if len(self.union) else at[:0]
        at = at[np.isin(self.union[at], s)] if len(at) else at
        at = np.unique(at)
        # 100 i >= r (a + b - i) gives (100 + r) i >= r (a + b)
        if (100 + self.ratio) * len(at) < self.ratio * (len(s) + self.sizes.min()):
            return None
        counts = self.first[at + 1] - self.first[at]
        rows = np.repeat(self.first[at] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        return np.bincount(self.owners[rows], minlength=len(self.sizes))


def _cross(left: pd.DataFrame, right: pd.DataFrame, ratio: int) -> pd.DataFrame:
    """Links between two blocks of a group, of different components only: one of each set with each component."""
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        group = TokenGroup([np.asarray(g, np.int64) for g in right.grams_], ratio)
        own, reps = right.component_.to_numpy(), right.rep_.to_numpy()
        for rep, component, grams in zip(left.rep, left.component, left.grams):
            s = np.sort(np.asarray(grams, np.int64))
            common = group.overlaps(s)
            if common is None:
                continue
            linked = np.flatnonzero((100 * common >= ratio * (len(s) + group.sizes - common)) & (own != component))
            for k in np.unique(own[linked], return_index=True)[1]:
                found.append((rep, reps[linked[k]]))
    return pd.DataFrame(found, columns=["q", "y"]).astype("int64")


def _linked(pairs: DataFrame, sets: DataFrame, ratio: int) -> DataFrame:
    """Of the pairs (q, y) those whose sets, sets(doc_id, grams), are similar enough."""
    left = sets.select(F.col("doc_id").alias("q"), F.col("grams").alias("q_grams"))
    right = sets.select(F.col("doc_id").alias("y"), F.col("grams").alias("y_grams"))
    common = F.size(F.array_intersect("q_grams", "y_grams"))
    joined = pairs.join(left, "q").join(right, "y").withColumn("common", common)
    return joined.where(100 * F.col("common") >= ratio * (F.size("q_grams") + F.size("y_grams") - F.col("common"))).select("q", "y")


def _sets_of(docs: DataFrame, ids: DataFrame, name: str, size: int) -> DataFrame:
    """The shingle sets of the documents in ids(doc_id), as a stage table."""
    chosen = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")
    chosen = chosen.groupBy("doc_id").agg(F.max("text").alias("text"))
    return write_stage(chosen.mapInArrow(partial(_sets, size=size), "doc_id long, grams array<long>"), name)


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """members(y, rep, ..) with a block number, and how many blocks their group has: by hash, so that no task numbers them."""
    sizes = members.groupBy("y").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"))
    return members.join(sizes, "y").withColumn("block", F.pmod(F.xxhash64("rep", "y"), "n_blocks").cast("int"))


def _block_pairs(held: DataFrame, columns: list[str]):
    """The members of groups for every pair of blocks, grouped on both sides."""
    left = held.select("y", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("n_blocks") - 1)).alias("j"), *columns)
    right = held.select("y", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"), *columns)
    right = right.toDF(*[f"{c}_" for c in right.columns])
    return left.groupBy("y", "i", "j").cogroup(right.groupBy("y_", "i_", "j_"))


def join_documents(docs: DataFrame, size: int = SHINGLE, ratio: int = RATIO) -> DataFrame:
    """A row of docs(doc_id, text) each: doc_id, n_shingles, and component_id, the smallest doc_id reachable by links.

    Links are of a Jaccard similarity of ratio / 100 at least (ratio < 100) over runs of `size` words.

    Null, empty and blank texts have 0 shingles and no links. Rows with equal sets are linked whatever their number.
    A null doc_id has a null component_id and links nothing; rows with one doc_id are to have one text (with several,
    each row's set links it, and comparisons use any one). Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    signed = write_stage(docs.mapInArrow(partial(_signed, size=size), "doc_id long, n_shingles long, set_hash binary, sketch binary"), "signed")
    classes = write_stage(signed.where("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(F.min("doc_id").alias("rep")), "classes")
    # signatures are made anew from the texts and dealt once: they are most of the disk
    reps = docs.join(classes.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    mark = W.partitionBy("mark")
    shared = reps.mapInArrow(partial(_marks, size=size, ratio=ratio), "mark long, rep long").withColumn("y", F.min("rep").over(mark))
    pairs = write_stage(shared.where("rep <> y").select(F.col("rep").alias("q"), "y").distinct(), "pairs")
    # what is known of each set in a pair; of several texts of one doc_id any
    ids = pairs.select(F.explode(F.array("q", "y")).alias("doc_id")).distinct()
    known = signed.where("set_hash is not null").join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.max(F.struct("n_shingles", "sketch")).alias("k"))
    known = write_stage(known.select("doc_id", "k.*"), "sketches")
    both = pairs.join(known.toDF("q", "n_q", "sketch_q"), "q").join(known.toDF("y", "n_y", "sketch_y"), "y")
    both = both.where(100 * F.least("n_q", "n_y") >= ratio * F.greatest("n_q", "n_y")).select("q", "y", "n_q", "sketch_q", "n_y", "sketch_y")
    hopeful = write_stage(both.mapInArrow(partial(_hopeful, ratio=ratio), "q long, y long"), "hopeful")
    sets = _sets_of(docs, hopeful.select(F.explode(F.array("q", "y")).alias("doc_id")).distinct(), "sets", size)
    links = write_stage(_linked(hopeful, sets, ratio), "links")
    first = connected_components(links, "q", "y") if not links.isEmpty() else links.select(F.col("q").alias("node"), F.col("y").alias("component"))

    # groups of more than one component after the first comparisons
    groups = pairs.select("y", F.col("q").alias("rep")).unionByName(pairs.select("y", F.col("y").alias("rep")).distinct())
    groups = groups.join(first, groups.rep == first.node, "left").select("y", "rep", F.coalesce("component", "rep").alias("component"))
    several = groups.groupBy("y").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n_members"))
    several = several.where("low < high and n_members > 2").select("y")  # of two, both have been compared
    members = write_stage(groups.join(several, "y").select("y", "rep", "component"), "members")
    final = first
    if not members.isEmpty():
        held = _blocks(members, SKETCH_BLOCK).join(known.withColumnRenamed("doc_id", "rep"), "rep")
        near = _block_pairs(held, ["rep", "component", "n_shingles", "sketch"]).applyInPandas(lambda a, b: _partners(a, b, ratio), "y long, rep long")
        members = write_stage(members.join(near.distinct(), ["y", "rep"], "left_semi"), "members")
        sets = _sets_of(docs, members.select(F.col("rep").alias("doc_id")).distinct(), "sets", size)
        held = _blocks(members, BLOCK).join(sets.withColumnRenamed("doc_id", "rep"), "rep")
        more = _block_pairs(held, ["rep", "component", "grams"]).applyInPandas(lambda a, b: _cross(a, b, ratio), "q long, y long")
        more = write_stage(more, "more")
        if not more.isEmpty():
            final = connected_components(links.unionByName(more), "q", "y")
    classed = classes.join(final, classes.rep == final.node, "left").select("set_hash", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set_hash").join(classed, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, ratio: int = RATIO) -> DataFrame:
    """docs less all documents of a component but the one of the smallest doc_id; null doc_ids stay."""
    drop = join_documents(docs, size, ratio).where("component_id <> doc_id").select("doc_id").distinct()
    keyed = docs.select("doc_id", F.struct(*map(quoted, docs.columns)).alias("row"))  # names of other columns stay out of the way
    return keyed.join(drop, "doc_id", "left_anti").select("row.*")
