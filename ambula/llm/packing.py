"""Packing token sequences by minimum bin slack.

Each partition is packed as it streams by. Documents longer than a sequence give full sequences at once. What remains of
them, and shorter documents, waits in a window. A sequence starts with the longest piece that waits; of the multiset
of the other lengths a subset-sum over bitsets finds the sum that is closest to what is left, and backtracking gives
how many of each length are taken. If even the best sum leaves slack, a further piece is cut to fill it. At the end
of a partition what is left is laid out in a row and cut into sequences whose lengths are powers of two, so no
sequence is padded.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 1
#: Pieces that wait at most.
WINDOW = 512
#: Words that each of the cache's two generations in a Python worker holds at about most, and letters of one that it takes.
CACHE_WORDS, CACHE_LETTERS = 400_000, 64
#: Bytes of a text that are cut into words at once, of texts whose new words are learned at once, and letter words encoded as one.
SLICE, LEARNED, TOGETHER = 1_000_000, 16_000, 128

Piece = tuple[int, int, bytes, int]  # document, start, ids as bytes, ids of the document


class WordEncoder:
    """Ids by a tokenizer that drops white space, word by word, with a bounded cache.

    Words are cut at spaces and line ends only, which the tokenizer drops and never merges across, after A-Z are
    lower-cased, which the tokenizer does too. Words of letters alone are mostly one unit with one final token each, so many
    can be encoded as one text and told apart by final tokens. A comma or stop after such a word is a unit of its own;
    where the normalizer makes letters and marks of a letter there are more units, and the word is encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.final[i] = token.endswith("</w>")
        self.words: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        self.marks = {m: self._ids([m.decode()])[0] for m in (b",", b".")}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, missing: set[bytes]) -> None:
        cut: dict[bytes, bytes] = {}
        plain, single, other = set(), set(), []
        for word in missing:
            stem = word[:-1] if word[-1:] in self.marks else word
            if not (stem.isalpha() or stem.decode("utf-8", "surrogatepass").isalpha()):
                other.append(word)
            elif stem is word:
                plain.add(word)
            else:
                cut[word] = stem
                if stem in self.old:
                    self.words[stem] = self.old[stem]
                elif stem not in self.words:
                    plain.add(stem)
        stems = list(plain)
        groups = [stems[i : i + TOGETHER] for i in range(0, len(stems), TOGETHER)]
        for group, ids in zip(groups, self._ids([b" ".join(g).decode("utf-8", "surrogatepass") for g in groups])):
            ends = np.flatnonzero(self.final[np.frombuffer(ids, "<u4")]) + 1
            if len(ends) == len(group):
                self.words.update((w, ids[4 * a : 4 * b]) for w, a, b in zip(group, [0, *ends.tolist()], ends.tolist()))
                single.update(group)
            else:
                self.words.update(zip(group, self._ids([w.decode("utf-8", "surrogatepass") for w in group])))
        self.words.update(zip(other, self._ids([w.decode("utf-8", "surrogatepass") for w in other])))
        whole = []
        for word, stem in cut.items():
            if stem in single or self.final[np.frombuffer(self.words[stem], "<u4")].sum() == 1:
                self.words[word] = self.words[stem] + self.marks[word[-1:]]
            else:
                whole.append(word)
        self.words.update(zip(whole, self._ids([w.decode("utf-8", "surrogatepass") for w in whole])))

    def _joined(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part, whose new words are learned together."""
        if len(self.words) > CACHE_WORDS:  # words that are not met again go with the generation after
            self.words, self.old = {b"": b""}, self.words
        split = [part.split(b" ") for part in parts]
        missing: set[bytes] = set()
        for words in split:
            missing.update(filterfalse(self.words.__contains__, words))
        known = missing & self.old.keys()
        self.words.update(zip(known, map(self.old.__getitem__, known)))
        self._learn(missing - known)
        found = [b"".join(map(self.words.__getitem__, words)) for words in split]
        for word in missing:
            if len(word) > CACHE_LETTERS:
                self.words.pop(word)
                self.words.pop(word[:-1], None)
        return found

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for text in texts:
            data = text.encode("utf-8", "surrogatepass").lower().replace(b"\n", b" ")
            if size + len(data) > LEARNED or len(data) > SLICE:
                yield from self._joined(group)
                group, size = [], 0
            if len(data) > SLICE:
                yield b"".join(ids for part in _cut(data) for ids in self._joined([part]))
            else:
                group.append(data)
                size += len(data)
        yield from self._joined(group)

    def __call__(self, text: str) -> bytes:
        return next(self.encode([text]))


def _cut(data: bytes) -> Iterator[bytes]:
    """Parts of about SLICE bytes, cut at spaces."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def closest_sum(counts: dict[int, int], goal: int) -> dict[int, int]:
    """How many of each length to take so that the sum is as near to the goal as can be, and not above it.

    A bitset holds the sums that lengths so far reach, one step for each power of two of a length's count; steps are
    gone back over from the best sum. Longer lengths come first, and it stops where the goal itself is reached.
    """
    mask = (1 << (goal + 1)) - 1
    sums, steps = 1, []
    for length in sorted((n for n in counts if n <= goal), reverse=True):
        left, times = min(counts[length], goal // length), 1
        while left > 0 and not sums >> goal & 1:
            take = min(times, left)
            steps.append((sums, length, take))
            sums |= sums << (length * take) & mask
            left -= take
            times *= 2
        if sums >> goal & 1:
            break
    at, taken = sums.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            taken[length] += take
            at -= length * take
    return dict(taken)


class Packer:
    """Packs pieces into sequences; add() and finish() yield (sequence, [pieces])."""

    def __init__(self, capacity: int = CAPACITY, window: int = WINDOW) -> None:
        self.capacity, self.window = capacity, window
        self.waiting: dict[int, deque[Piece]] = defaultdict(deque)
        self.n = 0

    def _put(self, piece: Piece) -> None:
        if piece[2]:
            self.waiting[len(piece[2]) // 4].append(piece)
            self.n += 1

    def _take(self, length: int) -> Piece:
        queue = self.waiting[length]
        piece = queue.popleft()
        if not queue:
            del self.waiting[length]
        self.n -= 1
        return piece

    def _one(self) -> list[Piece] | None:
        """One full sequence, or None if all that waits is shorter."""
        pieces = [self._take(max(self.waiting))]
        left = self.capacity - len(pieces[0][2]) // 4
        for length, n in closest_sum({k: len(q) for k, q in self.waiting.items()}, left).items():
            for _ in range(n):
                pieces.append(self._take(length))
                left -= length
        if left and self.waiting:  # what still waits is longer than the slack
            doc, start, ids, total = self._take(max(self.waiting))
            pieces.append((doc, start, ids[: 4 * left], total))
            self._put((doc, start + left, ids[4 * left :], total))
            left = 0
        if left:
            for piece in pieces:
                self._put(piece)
            return None
        return pieces

    def add(self, doc, ids: bytes) -> Iterator[list[Piece]]:
        total, size = len(ids) // 4, 4 * self.capacity
        whole = len(ids) - len(ids) % size
        for at in range(0, whole, size):
            yield [(doc, at // 4, ids[at : at + size], total)]
        self._put((doc, whole // 4, ids[whole:], total))
        while self.n > self.window and (pieces := self._one()):
            yield pieces

    def finish(self) -> Iterator[list[Piece]]:
        while self.n and (pieces := self._one()):
            yield pieces
        rest = [self._take(length) for length in sorted(self.waiting, reverse=True) for _ in range(len(self.waiting[length]))]
        left = sum(len(p[2]) // 4 for p in rest)
        rest = deque(rest)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc, start, ids, total = rest.popleft()
                n = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    rest.appendleft((doc, start + n, ids[4 * n :], total))
                room -= n
            yield pieces


_SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all texts of docs(doc_id, text), packed: where each is in its document and in its sequence.

    A document is the ids of its text (null: none) and END_ID, so also empty texts have a token. sequence_id is unique
    over partitions and the same if a task runs again: the partition's number, then 33 bits for the sequence. With
    with_ids a column ids has the tokens of the piece. Rows are taken one by one, so repeated rows are packed each;
    null doc_ids stay; other columns are ignored; no rows give no rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    schema = _SCHEMA.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _SCHEMA

    def run(batches):
        words, packer = encoder(path), Packer(capacity)
        base, n, rows = TaskContext.get().partitionId() << 33, 0, []
        last = np.array([END_ID], "<u4").tobytes()

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def sequences():
            for batch in batches:
                texts = (text.as_py() or "" for text in batch.column(1))
                for doc, ids in zip(batch.column(0).to_pylist(), words.encode(texts)):
                    yield from packer.add(doc, ids + last)
            yield from packer.finish()

        for pieces in sequences():
            offset = 0
            for doc, start, ids, total in pieces:
                size = len(ids) // 4
                rows.append((doc, start, size, zlib.crc32(ids), total, base + n, offset, *([np.frombuffer(ids, "<u4").astype(np.int32)] if with_ids else [])))
                offset += size
            n += 1
            if len(rows) >= 5000:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    names = ", ".join(f"`{n}` long" for n in _SCHEMA.names) + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, names)
