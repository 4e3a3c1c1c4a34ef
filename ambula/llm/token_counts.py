"""Token counts by offset-mapped attribution.

Each document is encoded once, as a whole. Its sections tile it; tokens are joined to sections by their character
spans. A token within one section counts there. A token that crosses a boundary counts by an explicit rule:
"start": where its first character is; "largest": where most of its characters are, the earlier of equals.
Characters that tokens split count for each of them.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from ambula.llm.bpe import VOCABULARY, encode_texts, token_offsets

RULES = ("start", "largest")
#: Sections of a plain text end after each line end.
LINE = re.compile(r"\n")


def line_sections(text: str) -> np.ndarray:
    """Ends of the sections; the last is the length of the text, also of the empty text."""
    ends = [m.end() for m in LINE.finditer(text)]
    return np.array(ends if ends and ends[-1] == len(text) else [*ends, len(text)], np.int64)


def attribute(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross a boundary. starts, ends: character spans of the tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    owner = np.searchsorted(sections, starts, "right")
    owner = np.minimum(owner, len(sections) - 1)
    crossing = ends > sections[owner]
    if rule == "largest":
        for i in np.flatnonzero(crossing):
            j, last = owner[i], np.searchsorted(sections, ends[i], "left")
            edges = np.concatenate(([starts[i]], sections[j:last], [ends[i]]))
            owner[i] = j + int(np.argmax(np.diff(edges)))
    return np.bincount(owner, minlength=len(sections)), np.bincount(owner, weights=crossing, minlength=len(sections)).astype(np.int64)


def count_sections(docs: DataFrame, rule: str = "start", path: str | None = None, sections=line_sections) -> DataFrame:
    """A row for each section of each text of docs(doc_id, text): its number from 0, its place and its tokens.

    Columns: doc_id, section, start, end (code points, end exclusive), n_tokens, n_crossing (of n_tokens, those that
    cross a boundary), doc_tokens. Null and empty texts have one section of no tokens. Rows are taken one by one;
    other columns are ignored.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            held, size = [[] for _ in names], 0
            for doc_id, text, ids in zip(batch.column(0).to_pylist(), texts, encode_texts(texts, path)):
                ends = sections(text or "")
                n, crossing = attribute(*token_offsets(ids, text or "", path), ends, rule) if len(ids) else (np.zeros(len(ends), np.int64),) * 2
                starts = np.concatenate(([0], ends[:-1]))
                for column, values in zip(held, ([doc_id] * len(ends), np.arange(len(ends)), starts, ends, n, crossing, [len(ids)] * len(ends))):
                    column.append(pa.array(values, pa.int64()))
                size += len(ends)
                if size > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in held], names)
                    held, size = [[] for _ in names], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in held], names)

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"`{n}` long" for n in names))
