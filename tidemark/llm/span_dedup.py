"""Substring dedup by sliding sentence spans.

A run is any number of consecutive sentences that is long enough to be no chance. From
every sentence of every text the shortest run is hashed, and up to every sentence, too:
together these cover each longer run, and they occur again wherever it does. Runs that
occur again anywhere, in another text or later in the same one, are found by a global
count, and the sentences of all but the first occurrence are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, cut, text_key, text_of

by_value(__name__)

#: A run has three sentences or more with 12 words, or fewer (also one) with 24. Shorter
#: repeats are chance or formula, not copied passages.
SENTENCES, WORDS = 3, 12
LONG = 24
#: Ends of sentences: a stop with white space after it, or a line break.
BREAK = re.compile(r"[.!?]\s+|\n\s*")


def sentences(text: str) -> list[str]:
    """The text in sentences, each with the white space after it."""
    ends = [m.end() for m in BREAK.finditer(text)]
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True) if a < b]


def runs_of(words: list[int]) -> list[tuple[int, int]]:
    """First sentence and end of the shortest runs from and up to each sentence, in order."""
    at = [0, *accumulate(words)]

    def enough(start: int, end: int) -> bool:
        total = at[end] - at[start]
        return total >= LONG or end - start >= SENTENCES and total >= WORDS

    found, end = set(), 0
    for start in range(len(words)):
        end = max(end, start + 1)
        while end <= len(words) and not enough(start, end):
            end += 1
        if end > len(words):
            break  # nor does any later one have an end
        found.add((start, end))
    start = 0
    for end in range(1, len(words) + 1):
        while start + 1 < end and enough(start + 1, end):
            start += 1
        if enough(start, end):
            found.add((start, end))
    return sorted(found)


def run_hashes(text: str) -> list[int]:
    """Hash of each run by its number, not counting empty sentences."""
    parts = [w for w in (s.lower().split() for s in sentences(text)) if w]
    digests = [xxhash.xxh64_digest(" ".join(w)) for w in parts]
    return [
        xxhash.xxh64_intdigest(b"".join(digests[start:end])) - (1 << 63)
        for start, end in runs_of(list(map(len, parts)))
    ]


def without(text: str, numbers: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the runs of these numbers, and the removed ranges of characters."""
    parts = sentences(text)
    full = [i for i, s in enumerate(parts) if s.strip()]
    runs = runs_of([len(parts[i].split()) for i in full])
    gone = {full[i] for number in numbers for i in range(*runs[number])}
    kept, ranges, at = [], [], 0
    for i, part in enumerate(parts):
        if i not in gone:
            kept.append(part)
        elif ranges and ranges[-1][1] == at:
            ranges[-1] = (ranges[-1][0], at + len(part))
        else:
            ranges.append((at, at + len(part)))
        at += len(part)
    return "".join(kept).rstrip() if gone else text, ranges


def hashes_column(text: Column) -> Column:
    """Hashes of the runs, by their numbers."""

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(map(run_hashes, texts.to_pylist()), pa.list_(pa.int64()), size=len(texts))

    return F.arrow_udf(each, "array<bigint>")(text_of(text))


CLEANED = "struct<text:string,removed:string>"


def cleaned_column(text: Column, numbers: Column) -> Column:
    kind = pa.struct([("text", pa.string()), ("removed", pa.string())])

    def each(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, firsts in batches:
            rows = []
            for value, places in zip(texts.to_pylist(), firsts.to_pylist(), strict=True):
                if value is None or places is None:
                    rows.append(None)
                    continue
                clean, ranges = without(value, places)
                rows.append({"text": clean, "removed": ",".join(f"{a}:{b}" for a, b in ranges)})
            yield pa.array(rows, kind)

    return F.arrow_udf(each, CLEANED)(text, numbers)


def span_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``text`` without repeats, ``removed``, ``n_removed``.

    ``removed`` lists the ranges taken out (code points, end exclusive), ``n_removed`` counts
    their characters. The first occurrence of a run is that with the smallest id, then
    place; a NULL id comes first. Rows that repeat id and text are one document: they
    count once and are treated alike. A NULL text stays NULL and has no run. A text all of
    whose sentences repeat becomes empty. An empty table gives an empty result.

    Hashes are counted per task before the shuffle; only occurrences of repeated hashes
    are looked at further, in joins with one row per hash on one side. What is gathered
    per document is bounded by its own sentences.
    """
    by_batches(docs.sparkSession)
    key = text_key(F.col(text_col)).alias("_key")
    runs = cut(
        docs.select(F.col(id_col).alias("_id"), key, hashes_column(F.col(text_col)).alias("_hashes"))
        .where(F.size("_hashes") > 0)
    )
    spread = runs.select("_id", "_key", F.posexplode("_hashes").alias("_run", "_h"))
    # Tables of their own, so that the joins shuffle both sides and can be split.
    often = cut(spread.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h"))
    again = cut(spread.join(often, "_h"))
    place = F.struct("_id", "_key", "_run")
    first = cut(again.groupBy("_h").agg(F.min(place).alias("_first")))
    later = again.join(first, "_h").where(~place.eqNullSafe(F.col("_first")))
    gone = cut(later.groupBy("_id", "_key").agg(F.array_sort(F.collect_set("_run")).alias("_runs")))
    same = docs[id_col].eqNullSafe(gone["_id"]) & (text_key(docs[text_col]) == gone["_key"])
    text, numbers = docs[text_col], gone["_runs"]
    marked = docs.join(gone, same, "left").select(
        docs[id_col].alias("doc_id"),
        text.alias("_whole"),
        cleaned_column(F.when(numbers.isNotNull(), text), numbers).alias("_clean"),
    )
    return marked.select(
        "doc_id",
        F.when(F.col("_clean").isNull(), F.col("_whole")).otherwise(F.col("_clean.text")).alias("text"),
        F.coalesce("_clean.removed", F.lit("")).alias("removed"),
        F.when(F.col("_clean").isNull(), 0)
        .otherwise(F.length("_whole") - F.length("_clean.text"))
        .cast("bigint")
        .alias("n_removed"),
    )
