"""Toxicity by compression distance: one zstandard dictionary per class.

Both dictionaries end with the same common part, trained on ordinary text; before it,
the toxic one holds the stems that are typical of toxic text, as trained on labelled
texts, and the ordinary one neutral filler of equal length, so that a window without
such stems compresses alike. A window of text that compresses to fewer bytes with the toxic dictionary than
with the ordinary one is evidence; its saving counts from a calibrated number of bytes
on, and the mean over all windows is turned into a probability by an isotonic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, cut, hash_sample, text_of

by_value(__name__)

#: The model is fitted on at most so many labelled rows of each class, the first in the
#: order of a hash of the id, of texts of at most SAMPLE_CHARS characters. Scores read
#: whole texts.
SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 20_000
WINDOW = 8
COMMON_BYTES = 16_384
#: A stem is typical from this log-likelihood ratio on, in the part learnt from and in the
#: confirming one; so many of the most telling ones are used.
SURPRISE = 24.0
CONFIRMED = 8.0
STEMS = 400
THRESHOLD = 0.3
#: Rows with this remainder of crc32(id as text) modulo 4 are never learnt from.
HELD_OUT = 2


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str) -> list[bytes]:
    """The whole text in runs of ``WINDOW`` words."""
    words = words_of(text)
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)]


@dataclass
class Model:
    """Contents of the dictionaries, least saving that counts, and the curve to a probability."""

    toxic: bytes
    ordinary: bytes
    least: int
    savings: list[float]
    chances: list[float]

    @property
    def knows(self) -> bool:
        """Whether anything tells the classes apart; if not, every text has the same score."""
        return len(self.savings) > 1

    def open(self) -> tuple:
        return compressor(self.toxic), compressor(self.ordinary)

    def score(self, text: str, opened: tuple) -> float:
        return float(np.interp(saving(text, opened, self.least), self.savings, self.chances))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Fast matching of at least six bytes, with tables so large that equal parts act alike."""
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17,
        hash_log=16,
        chain_log=16,
        search_log=1,
        min_match=6,
        strategy=zstandard.STRATEGY_FAST,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=parameters)


def savings_of(text: str, opened: tuple) -> np.ndarray:
    """Bytes that each window takes less with the toxic dictionary."""
    toxic, ordinary = opened[0].compress, opened[1].compress
    return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], np.int64)


def saving(text: str, opened: tuple, least: int) -> float:
    found = savings_of(text, opened)
    return float(found[found >= least].sum() / len(found)) if len(found) else 0.0


# --- fitting --------------------------------------------------------------------------


def distinct_texts(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Without near copies, which would make one text's words look typical."""
    seen: set[int] = set()
    kept = []
    for text, label in sample:
        words = words_of(text)
        runs = {hash(tuple(words[i : i + 4])) for i in range(max(1, len(words) - 3))}
        if len(runs & seen) < 0.2 * len(runs):
            kept.append((text, label))
        seen |= runs
    return kept


def bare(word: bytes) -> bytes:
    return re.sub(rb"^[^a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff]+$", b"", word)


def stems_of(word: bytes) -> list[bytes]:
    return [word, *(word[:n] for n in range(5, min(10, len(word))))]


def stems(text: str) -> set[bytes]:
    """The text's words and their beginnings of 5 to 9 bytes."""
    return {s for w in set(words_of(text)) for s in stems_of(bare(w))}


def surprise(sample: list[tuple[str, int]], among: Container[bytes] | None = None) -> dict[bytes, float]:
    """Log-likelihood ratio of each stem that stands in a larger share of the toxic documents.

    Only stems of ``among``, if given, and of at least three toxic documents are counted.
    """
    sizes = [1 + sum(y == label for _, y in sample) for label in (0, 1)]
    toxic: Counter = Counter()
    for text, label in sample:
        if label:
            toxic.update(s for s in stems(text) if len(s) > 3 and (among is None or s in among))
    toxic = Counter({s: n for s, n in toxic.items() if n >= 3})
    plain: Counter = Counter()
    for text, label in sample:
        if not label:
            plain.update(s for s in stems(text) if s in toxic)
    found = {}
    for stem, n in toxic.items():
        rest = plain[stem]
        due = [(n + rest) * size / sum(sizes) for size in sizes]
        if n > due[1]:
            found[stem] = 2 * (n * math.log(n / due[1]) + (rest * math.log(rest / due[0]) if rest else 0))
    return found


def typical_stems(learn: list[tuple[str, int]], confirm: list[tuple[str, int]]) -> list[bytes]:
    """Stems that two separate parts of the sample show to be typical of toxic documents."""
    first = {w: s for w, s in surprise(learn).items() if s >= SURPRISE}
    second = surprise(confirm, first)
    kept = [w for w in first if second.get(w, 0.0) >= CONFIRMED]
    return sorted(kept, key=lambda w: (first[w], w))[-STEMS:]


def trained(size: int, samples: list[bytes]) -> bytes:
    """A zstandard dictionary trained on the samples; too few to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list[float], list[float]]:
    """Pooled non-decreasing means of y over x: x and value at the middle of each pool."""
    pools: list[list[float]] = []
    for value in np.unique(x):
        own = x == value
        w = float(weight[own].sum())
        pools.append([value * w, float((y * weight)[own].sum()), w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return [p[0] / p[2] for p in pools], [p[1] / p[2] for p in pools]


def rank_quality(x: np.ndarray, y: np.ndarray) -> float:
    """Chance that a toxic document has a larger x than an ordinary one."""
    _, place, count = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    toxic = y.sum()
    return float((rank[y == 1].sum() - toxic * (toxic + 1) / 2) / (toxic * (len(y) - toxic)))


def fit(sample: list[tuple[str, int]], totals: dict[int, int]) -> Model:
    """From (text, label) of the sample and the number of labelled rows of each class.

    Half of the sample gives the dictionaries and a quarter confirms what is typical;
    the rest calibrates the least saving and the curve, weighted to the classes' shares.
    """
    rate = totals.get(1, 0) / max(1, sum(totals.values()))
    sample = distinct_texts(sample)
    parts: list[list[tuple[str, int]]] = [[], [], []]
    for label in (0, 1):  # two of four, one and one of each class
        for i, row in enumerate(r for r in sample if r[1] == label):
            parts[(0, 0, 1, 2)[i % 4]].append(row)
    learn, confirm, check = parts
    marks = typical_stems(learn, confirm)
    labels = np.array([y for _, y in check])
    if not marks or not 0 < labels.sum() < len(labels):
        return Model(b" ", b" ", 1, [0.0], [rate])
    toxic = b" " + b" ".join(marks) + b" "
    common = trained(COMMON_BYTES, [w for t, y in learn if not y for w in windows(t)][:100_000])
    filler = (b"\xff\xfe" * len(toxic))[: len(toxic)]
    model = Model(toxic + common, filler + common, 1, [0.0], [rate])
    opened = model.open()
    each = [savings_of(t, opened) for t, _ in check]

    def means(least: int) -> np.ndarray:
        return np.array([d[d >= least].sum() / max(1, len(d)) for d in each])

    model.least = max(range(1, 7), key=lambda n: rank_quality(means(n), labels))
    share = np.bincount(labels, minlength=2) / len(labels)
    weight = np.where(labels == 1, rate / share[1], (1 - rate) / share[0])
    model.savings, model.chances = isotonic(means(model.least), labels.astype(float), weight)
    return model


# --- on tables ------------------------------------------------------------------------


def remainder(id_: Column) -> Column:
    return F.crc32(id_.cast("string")) % 4


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    Labels other than 0 and 1, NULLs and labels without a document are passed over; an id
    with several labels counts as toxic if one says so, and of several texts the least is
    taken. Without both classes every score is the share of toxic rows. At most twice
    ``rows`` documents of each class, of at most ``chars`` characters each, come to the
    driver, and ``rows`` of them are used.
    """
    by_batches(docs.sparkSession)
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & (remainder(F.col("_id")) != HELD_OUT))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    known, kind = cut(known), labels.schema[id_col].dataType.simpleString()
    totals = dict(known.groupBy("_label").count().collect())
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.where(F.length("_text") <= chars)
    sample = []
    for label, total in totals.items():
        # Twice as many ids as wanted, for those without a text or with a long one.
        ids = hash_sample(known.where(F.col("_label") == label), "_id", 2 * rows, total)
        named = docs.sparkSession.createDataFrame([(i, n) for n, i in enumerate(ids)], f"_id {kind}, _n int")
        found = texts.join(F.broadcast(named), "_id").groupBy("_n").agg(F.min("_text"))
        sample += [(n, label, text) for n, text in sorted(found.collect())[:rows]]
    return fit([(text, label) for _, label, text in sorted(sample)], totals)


def score_column(text: Column, model: Model) -> Column:
    """Probability of label 1, from the whole text."""

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        opened = model.open()
        for texts in batches:
            yield pa.array((model.score(t.as_py(), opened) for t in texts), pa.float64(), size=len(texts))

    return F.arrow_udf(each, "double")(text_of(text))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``_id``, ``held_out``, ``score`` and ``predicted``.

    Every text is scored whole and by its text alone; NULL and empty texts have no
    window and get the score of a saving of zero. A NULL id is not held out.
    """
    model = train(docs, labels, id_col, text_col)
    held_out = F.coalesce(remainder(F.col(id_col)) == HELD_OUT, F.lit(False))
    return docs.select(
        F.col(id_col).alias("_id"),
        held_out.alias("held_out"),
        score_column(F.col(text_col), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_stage(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that are not predicted toxic, with the columns of ``docs``.

    Where the labels show no difference between the classes (one class only, or no typical
    stem) there is no evidence against any document, and all are kept.
    """
    model, name = train(docs, labels, id_col, text_col), "_score"
    if not model.knows:
        return docs
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    scored = docs.withColumn(name, score_column(F.col(text_col), model))
    return scored.where(F.col(name) < THRESHOLD).drop(name)
