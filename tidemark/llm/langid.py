"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is its subwords: runs of 2 to 4 bytes of a word and of its borders. Each is hashed to
a row of a table of embeddings; their average goes through one linear layer and a softmax.
Table and layer are trained by stochastic gradient descent in numpy on a bounded sample. A
part of the sample that is not learnt from calibrates the softmax's sharpness, and the least
score that is still believed. Scoring reads whole texts, vectorised over many at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, text_of

by_value(__name__)

#: Rows of the table of embeddings, as a power of two, and their width.
TABLE_BITS, WIDTH = 15, 16
#: Bytes of a subword.
SIZES = (2, 3, 4)
#: Languages learnt, the most frequent ones; texts of the sample; their characters.
MOST_LANGUAGES, SAMPLE_ROWS, SAMPLE_CHARS = 1_000, 8_000, 1_000
#: Texts of a language in the sample, where there are enough.
ROWS_OF_LANGUAGE = (8, 1_000)
EPOCHS, RATE = 12, 1.0
#: Share of right answers wanted among those that are not rejected.
BELIEVED = 0.99
#: Bytes that are scored at a time.
SHARE = 1 << 18
UNKNOWN = "und"
HELD_OUT = 2

#: Multipliers of the hash, one for each size.
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: ASCII letters and bytes of other characters stay, the rest is a border.
_WORDS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def word_bytes(text: str) -> bytes:
    """The text's words in lower case, with a border before and after."""
    return b" " + text.lower().encode(errors="replace").translate(_WORDS) + b" "


def subwords(data: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: positions below ``starts`` where a subword begins, and its row of the table."""
    border = data == 32
    value = data.astype(np.uint32)
    for size, mix in zip(SIZES, _MIX):
        count = min(starts, len(data) - size + 1)
        if count <= 0:
            continue
        packed = value[:count].copy()
        for i in range(1, size):
            packed |= value[i : count + i] << np.uint32(8 * i)
        # No border but at the ends, and not borders alone.
        good = ~(border[:count] & border[size - 1 : count + size - 1]) if size == 2 else ~border[1 : count + 1]
        for i in range(2, size - 1):
            good &= ~border[i : count + i]
        rows = (packed * np.uint32(mix)) >> np.uint32(32 - TABLE_BITS)
        at = np.flatnonzero(good)
        yield at, rows[at].astype(np.intp)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the table that a text's subwords hash to, each once, and their shares."""
    data = np.frombuffer(word_bytes(text), np.uint8)
    found = [rows for _, rows in subwords(data, len(data))]
    rows, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.intp), return_counts=True)
    return rows, (counts / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    """Languages, embeddings and layer, the softmax's sharpness and the least believed score."""

    languages: list[str]
    table: np.ndarray = field(repr=False)
    layer: np.ndarray = field(repr=False)
    sharpness: float = 1.0
    least: float = 0.0

    def columns(self) -> np.ndarray:
        """What is averaged per subword: embeddings, or where these are wider, their logits."""
        return self.table @ self.layer if self.layer.shape[1] <= self.layer.shape[0] else self.table

    def logits(self, texts: Sequence[str], columns: np.ndarray) -> np.ndarray:
        """One row of logits for each text, from all its subwords."""
        sums = np.zeros((len(texts), columns.shape[1] + 1))
        group: list[tuple[int, bytes]] = []
        size = 0
        for number, text in enumerate(texts):
            data = word_bytes(text)
            if len(data) > SHARE:
                # A long text in parts, each read a little beyond its end.
                for start in range(0, len(data), SHARE):
                    part = np.frombuffer(data[start : start + SHARE + SIZES[-1] - 1], np.uint8)
                    self._add(sums, part, min(SHARE, len(part)), np.array([0]), [number], columns)
                continue
            group.append((number, data))
            size += len(data)
            if size > SHARE:
                self._add_group(sums, group, columns)
                group, size = [], 0
        if group:
            self._add_group(sums, group, columns)
        mean = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        return mean if columns.shape[1] == self.layer.shape[1] else mean @ self.layer

    def _add_group(self, sums: np.ndarray, group: list[tuple[int, bytes]], columns: np.ndarray) -> None:
        lengths = np.array([len(d) for _, d in group])
        data = np.frombuffer(b"".join(d for _, d in group), np.uint8)
        self._add(sums, data, len(data), np.cumsum(lengths) - lengths, [n for n, _ in group], columns)

    def _add(self, sums, data, starts, begins, numbers, columns) -> None:
        """Add each text's sums and number of subwords; a text's own are added in their order."""
        for at, rows in subwords(data, starts):
            owner = np.searchsorted(begins, at, "right") - 1
            for c in range(columns.shape[1]):
                sums[numbers, c] += np.bincount(owner, columns[rows, c], len(begins))
            sums[numbers, -1] += np.bincount(owner, minlength=len(begins))

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits * self.sharpness)


def softmax(logits: np.ndarray) -> np.ndarray:
    above = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return above / above.sum(axis=-1, keepdims=True)


def fit(sample: Sequence[tuple[str, str]], seed: int = 13) -> Model | None:
    """From (language, text): four fifths of each language train, the rest calibrates."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    parts: tuple[list, list] = ([], [])
    seen = [0] * len(languages)
    for lang, text in sample:
        i = number[lang]
        seen[i] += 1
        parts[seen[i] % 5 == 0].append((i, text))
        # Short texts are learnt and judged as well: a part of up to 80 characters.
        start = int(rng.integers(0, max(1, len(text) - 80)))
        parts[seen[i] % 5 == 0].append((i, text[start : start + 80]))
    learn = [(i, *bag(text)) for i, text in parts[0]]
    learn = [row for row in learn if len(row[1])]
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << TABLE_BITS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    for epoch in range(EPOCHS):
        for done, place in enumerate(rng.permutation(len(learn))):
            rate = np.float32(RATE * (1 - (epoch + done / len(learn)) / EPOCHS))
            i, rows, shares = learn[place]
            hidden = shares @ table[rows]
            wrong = softmax(hidden @ layer)
            wrong[i] -= 1
            back = layer @ wrong
            layer -= rate * np.outer(hidden, wrong)
            table[rows] -= rate * np.outer(shares, back) * len(rows) ** 0.5
    model = Model(languages, table, layer)
    check = [row for row in parts[1] if len(bag(row[1])[0])]
    if check and len(languages) > 1:
        calibrate(model, np.array([i for i, _ in check]), model.logits([t for _, t in check], model.columns()))
    return model


def calibrate(model: Model, right: np.ndarray, logits: np.ndarray) -> None:
    """The sharpness of the largest likelihood, then the least score above which enough is right."""

    def loss(sharpness: float) -> float:
        return -np.log(softmax(logits * sharpness)[np.arange(len(right)), right] + 1e-12).mean()

    model.sharpness = float(min(np.geomspace(0.05, 20, 121), key=loss))
    chances = model.scores(logits)
    score, hit = chances.max(axis=1), chances.argmax(axis=1) == right
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(hit[order]) / np.arange(1, len(order) + 1)
    # Equal scores are believed together, so only the last of each counts.
    last = np.append(np.diff(score[order]) != 0, True)
    good = np.flatnonzero(last & (share >= BELIEVED))
    model.least = float(score[order[good[-1]]]) if len(good) else 1.0


# --- on tables ------------------------------------------------------------------------


def remainder(id_: Column) -> Column:
    return F.crc32(id_.cast("string")) % 4


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on a bounded sample of the rows that have a language and are not held out.

    At most ``MOST_LANGUAGES`` languages, the most frequent, are learnt, each from distinct texts
    by the order of a hash: ``SAMPLE_ROWS`` in all, but at least 8 of each. Of a longer text a part
    of ``SAMPLE_CHARS`` characters is taken, from a place that its hash chooses. Rows whose id is
    NULL are not held out. None without a row to learn from.
    """
    text = F.col(text_col)
    known = docs.select(
        F.col(lang_col).cast("string").alias("_lang"),
        text.alias("_text"),
        F.xxhash64(text).alias("_hash"),
    ).where(
        F.col("_lang").isNotNull()
        & text.rlike(r"\p{L}")
        & (F.coalesce(remainder(F.col(id_col)), F.lit(-1)) != HELD_OUT)
    )
    # One row for each language, at most MOST_LANGUAGES.
    counts = known.groupBy("_lang").agg(F.count("*").alias("n"), F.approx_count_distinct("_hash").alias("kinds"))
    counts = counts.orderBy(F.desc("n"), "_lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return None
    low, high = ROWS_OF_LANGUAGE
    rows = max(low, min(high, SAMPLE_ROWS // len(counts)))
    # About twice the rows lie below a cut of the hash.
    shares = [(r["_lang"], min(1.0, 2 * rows / max(1, r["kinds"]))) for r in counts]
    cuts = [(lang, min((1 << 63) - 1, int((share - 0.5) * (1 << 64)))) for lang, share in shares]
    cuts = docs.sparkSession.createDataFrame(cuts, "_lang string, _cut bigint")
    room = F.greatest(F.length("_text") - SAMPLE_CHARS, F.lit(0)) + 1
    part = F.substr("_text", (F.pmod("_hash", room) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    near = (
        known.join(F.broadcast(cuts), "_lang")
        .where(F.col("_hash") <= F.col("_cut"))
        .select("_lang", "_hash", part.alias("_part"))
        .groupBy("_lang", "_hash")
        .agg(F.min("_part").alias("_part"))
    )
    found: dict[str, list[str]] = {}
    for row in sorted(near.collect()):
        found.setdefault(row["_lang"], []).append(row["_part"])
    return fit([(lang, t) for lang in sorted(found) for t in found[lang][:rows]])


def predicted(text: Column, model: Model | None) -> Column:
    """Struct of ``lang``, ``score`` and ``rejected`` from a whole text."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        columns = model.columns() if model else None
        for texts in batches:
            langs = np.full(len(texts), UNKNOWN, object)
            scores = np.zeros(len(texts))
            # A text without a letter comes as NULL.
            at = np.flatnonzero(np.asarray(texts.is_valid().to_numpy(zero_copy_only=False)))
            if model and len(at):
                chances = model.scores(model.logits([texts[int(i)].as_py() for i in at], columns))
                langs[at] = np.array(model.languages, object)[chances.argmax(axis=1)]
                scores[at] = chances.max(axis=1)
            rejected = (scores < model.least if model else scores == 0) | (langs == UNKNOWN)
            arrays = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.StructArray.from_arrays(arrays, fields=list(kind))

    return F.arrow_udf(each, "lang string, score double, rejected boolean")(F.when(text.rlike(r"\p{L}"), text))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: ``_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected``.

    ``rejected`` says that the score is below the calibrated least one. A text that is NULL or
    has no letter gets ``und``, a score of 0 and is rejected; so does every text where no row has
    a language to learn. Repeated rows get the same answer, an empty table gives no rows. A NULL
    id is not held out.
    """
    by_batches(docs.sparkSession)
    model = train(docs, id_col, text_col, lang_col)
    held_out = F.coalesce(remainder(F.col(id_col)) == HELD_OUT, F.lit(False))
    found = docs.select(
        F.col(id_col).alias("_id"),
        held_out.alias("held_out"),
        predicted(text_of(F.col(text_col)), model).alias("_found"),
    )
    return found.select(
        "_id",
        "held_out",
        F.col("_found.lang").alias("lang_pred"),
        F.col("_found.score").alias("score"),
        F.col("_found.rejected").alias("rejected"),
    )
