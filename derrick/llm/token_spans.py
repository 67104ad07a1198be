"""Token counts by section: texts are encoded whole, tokens mapped back by offset.

Sections are not encoded one by one, as a tokenizer sees other words at a cut. A text
is encoded once; a byte-level vocabulary spells the text's bytes exactly, so the sums
of the tokens' lengths are their offsets. An interval join of token spans and section
spans (both in order, so a binary search per token end) attributes every token. A token
that crosses a boundary is allocated by the rule given:

* ``most``: to the section that holds most of its bytes, of equals the first;
* ``first``: to the section of its first byte;
* ``share``: to each section by its share of the bytes (a fraction of a token each).

Under every rule the sections of a document add up to its tokens. A document is encoded
as a record, its fields joined by one space that belongs to the field before it; each
field is a section, and the last one is cut further, by default into lines, each with
its line end. ``cut`` may be any function from a text to the character offsets at which
its sections start (the first is 0).

Scale: one pass without a shuffle, one text at a time; the vocabulary (1 MB) is read by
the driver from a path, a parameter, and travels to the tasks. Rows out follow the
number of sections.

Edge cases: null and empty fields have one section without tokens of their own; a text that
ends in a line end has no empty section after it; equal rows give equal rows; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import documents

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public byte-level vocabulary cuts a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("most", "first", "share")
FIELDS = ("source", "lang", "text")
_LINE = re.compile("\n(?=.)", re.S)


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def encoder(ranks: dict[bytes, int]) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding and the byte length of every id."""
    lengths = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int64)
    for token, i in ranks.items():
        lengths[i] = len(token)
    return tiktoken.Encoding("spans", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def line_starts(text: str) -> list[int]:
    return [0, *(m.end() for m in _LINE.finditer(text))]


def attribute(lengths: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and crossing tokens per section, from the tokens' byte lengths
    and the sections' byte starts (the first is 0)."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    counts, crossing = np.zeros(len(starts)), np.zeros(len(starts), dtype=np.int64)
    whole = first == last
    counts += np.bincount(first[whole], minlength=len(starts))
    for t in np.flatnonzero(~whole):
        span = np.arange(first[t], last[t] + 1)
        edges = np.concatenate([[begins[t]], starts[span[1:]], [ends[t]]])
        bytes_in = np.diff(edges)
        crossing[span] += 1
        if rule == "share":
            counts[span] += bytes_in / lengths[t]
        else:
            counts[first[t] if rule == "first" else span[bytes_in.argmax()]] += 1
    return counts, crossing


def section_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    rule: str = "most",
    cut: Callable[[str], list[int]] = line_starts,
    doc_id: str = "doc_id",
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """One row per section of a record: its number, its field, its character span in the
    record, its tokens, how many of the tokens that touch it cross its boundary, and the
    tokens of the whole record."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, sizes = encoder(shared.value)
        names = np.array(fields, dtype=object)
        columns = ("section", "field", "start", "end", "n_tokens", "n_crossing", "doc_tokens")
        for rows in batches:
            out: list[tuple[np.ndarray, ...]] = []
            times = []
            for parts in zip(*(rows[f"f{i}"] for i in range(len(fields)))):
                parts = [x or "" for x in parts]
                t = " ".join(parts)
                heads = np.cumsum([0, *(len(x) + 1 for x in parts[:-1])])
                chars = np.append(heads[:-1], heads[-1] + np.array(cut(parts[-1]), dtype=np.int64))
                raw = np.frombuffer(t.encode("utf-8"), dtype=np.uint8)
                # Byte offset of each character, and the end.
                at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                ids = np.array(encoding.encode_ordinary(t), dtype=np.int64)
                counts, crossing = attribute(sizes[ids], at[chars], rule)
                n = len(chars)
                times.append(n)
                field = names[np.minimum(np.arange(n), len(fields) - 1)]
                out.append((np.arange(n), field, chars, np.append(chars[1:], len(t)), counts, crossing, np.full(n, len(ids))))
            done = {k: np.concatenate(v) for k, v in zip(columns, zip(*out))} if out else {k: [] for k in columns}
            yield pd.DataFrame({"doc_id": rows["doc_id"].repeat(times).reset_index(drop=True), **done})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)))
    return rows.mapInPandas(run, "doc_id long, section long, field string, start long, end long, n_tokens double, n_crossing long, doc_tokens long")


def op5_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = section_tokens(documents(spark, sf_dir))
    return found.withColumn("n_tokens", F.col("n_tokens").cast("long"))
