"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The vocabulary's characters stand for bytes; the table is made by the usual rule: printable bytes of Latin-1 stand for
themselves, the others for the characters from 256 on. Offsets follow from the bytes of each token: a token covers the
characters that its bytes belong to, so a character that is split between tokens is covered by each of them.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from ambula.llm.base import safe_pieces

VOCABULARY = "byte_bpe_50k.json"
#: Characters handed to the library at once.
AT_ONCE = 500_000


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer and, by id, the bytes of each token and their number."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in byte_of for c in token):
            pieces[i] = bytes(map(byte_of.__getitem__, token))
    return tokenizer, pieces, np.array(list(map(len, pieces)), np.int64)


def encode_texts(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """The ids of each text, in order; null counts as empty. No more than about AT_ONCE characters are encoded at once."""
    tokenizer = load(path)[0]
    held: list[str] = []
    owners: list[int] = []
    done: list[list[int]] = []
    size = at = 0

    def flush(last: int):
        nonlocal at, size
        for owner, e in zip(owners, tokenizer.encode_batch_fast(held, add_special_tokens=False)):
            done[owner - at].append(np.array(e.ids, np.uint32))
        held.clear()
        owners.clear()
        ready, done[:] = done[: last - at], done[last - at :]
        at, size = last, 0
        for parts in ready:
            yield np.concatenate(parts) if parts else np.empty(0, np.uint32)

    for i, text in enumerate(texts):
        done.append([])
        for piece in safe_pieces(text or ""):
            if piece:
                held.append(piece)
                owners.append(i)
                size += len(piece)
            if size >= AT_ONCE:
                yield from flush(i)
    yield from flush(len(texts))


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    """The bytes of the tokens, joined; characters that tokens split become whole again."""
    return b"".join(map(load(path)[1].__getitem__, ids.tolist()))


def token_offsets(ids: np.ndarray, text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of each token of a text, in code points."""
    ends = np.cumsum(load(path)[2][ids])
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    owner = np.cumsum((data & 0xC0) != 0x80) - 1  # the character of each byte
    return owner[ends - load(path)[2][ids]], owner[ends - 1] + 1


def encode_documents(docs: DataFrame, path: str | None = None, offsets: bool = False) -> DataFrame:
    """(doc_id, ids) or, with offsets, (doc_id, ids, starts, ends) for each row of docs(doc_id, text)."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc_id, text, ids in zip(batch.column(0), texts, encode_texts(texts, path)):
                arrays = [pa.array([doc_id.as_py()], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))]
                if offsets:
                    arrays += [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in token_offsets(ids, text or "", path)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "starts", "ends"][: len(arrays)])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>" + ", starts array<int>, ends array<int>" * offsets)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null, bytes that are no UTF-8 the replacement character."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch in batches:
            texts = [None if ids is None else decode_ids(np.array(ids, np.int64), path).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row of docs(doc_id, text) each: number of tokens, hash of the ids, hash of the decoded bytes.

    Null and empty texts have no tokens. Rows are taken one by one, so ties, repeated rows and null doc_ids stay as
    they are; other columns are ignored.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch in batches:
            n, hashed, decoded = [], [], []
            for ids in encode_texts(batch.column(1).to_pylist(), path):
                n.append(len(ids))
                hashed.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decode_ids(ids, path)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
