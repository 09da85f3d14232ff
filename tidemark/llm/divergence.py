"""Source divergence audit with late string materialization.

Terms are counted by fixed-width digests of language and term. A first reading of the texts
shuffles digests with their numbers of documents, and nothing else; it says which are kept. A
second one counts these by source, a task's counts written once with their texts. Sums,
probabilities and ranks are made of digests and numbers. Of each kept digest the least and the
greatest text are compared; where they differ, several terms share it, and a third reading
counts these by their texts. Otherwise texts are joined back to the rows that are put out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, cut, measured, text_of

by_value(__name__)

#: A term is kept in a language with at least so many documents that hold it.
LEAST_DOCUMENTS = 30
#: Added to each count.
SMOOTHING = 5
#: Probabilities are integers, in parts of this.
SCALE = 1_000_000_000
#: Terms reported for a source.
TERM_RANKS = 50
#: Terms that a task gathers before it hands them on.
GATHERED = 1 << 19
#: So many kept digests, of 8 bytes, are sent to the tasks; more are joined by a shuffle.
KEPT_IN_TASKS = 1_000_000
#: Bytes of a text that are split into terms at a time.
PIECE = 1 << 20
#: Probabilities compared in one piece of work, terms times sources.
CELLS = 1 << 17

#: ASCII letters in lower case, all other ASCII as spaces, bytes of other characters as they are.
TERM_BYTES = bytes(
    b | 32 if chr(b).isascii() and chr(b).isalpha() else 32 if b < 128 else b for b in range(256)
)


def pieces_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time; no piece ends within a term."""
    data = text.encode().translate(TERM_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def digests_of(lang: str, terms: Iterable[bytes], bits: int) -> np.ndarray:
    """Digests of a language's terms; fewer bits than 64 are for tests of collisions."""
    seed, mask = xxhash.xxh64_intdigest(lang.encode()), (1 << bits) - 1
    return np.array([xxhash.xxh64_intdigest(t, seed) & mask for t in terms], np.uint64).view(np.int64)


class Gathered:
    """Terms of some documents by group: in how many documents they are, how often, or both."""

    def __init__(self, docs: bool, times: bool) -> None:
        self.docs, self.times = docs, times
        self.groups: dict[tuple, tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, group: tuple, text: str) -> None:
        documents, times = self.groups.setdefault(group, (Counter(), Counter()))
        before, seen = len(documents) or len(times), set()
        for terms in pieces_of(text):
            if self.times:
                times.update(terms)
            if self.docs:
                seen.update(terms)
        documents.update(seen)
        self.size += (len(documents) or len(times)) - before


def document_counts(rows: DataFrame, bits: int) -> DataFrame:
    """Digests with the number of a task's documents that hold them. No text leaves the task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(True, False)
        for batch in batches:
            langs, _, texts = batch.columns
            for lang, text in zip(langs, texts):
                found.add((lang.as_py(),), text.as_py())
                if found.size >= GATHERED:
                    yield from handed(found)
                    found = Gathered(True, False)
        yield from handed(found)

    def handed(found: Gathered) -> Iterator[pa.RecordBatch]:
        for (lang,), (documents, _) in found.groups.items():
            counts = np.fromiter(documents.values(), np.int64, len(documents))
            columns = [pa.array(digests_of(lang, documents, bits)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "docs"])

    return rows.mapInArrow(each, "digest bigint, docs bigint")


def group_digest(seed: int, lang: str, source: str) -> int:
    """What ``numbered_groups`` computes of a language and source."""
    first = xxhash.xxh64_intdigest(f"{seed}:{lang}".encode(), 42)
    found = xxhash.xxh64_intdigest(source.encode(), first)
    return found - (1 << 64) if found >> 63 else found


def numbered_groups(rows: DataFrame) -> tuple[DataFrame, int]:
    """Every language and source with a digest that no other one has, and its seed."""
    groups = cut(rows.select("lang", "source").distinct())
    total, seed = groups.count(), 0
    while True:
        digest = F.xxhash64(F.concat(F.lit(f"{seed}:"), F.col("lang")), "source")
        found = groups.withColumn("group", digest)
        if found.agg(F.count_distinct("group")).first()[0] == total:
            return found, seed
        seed += 1


def term_counts(rows: DataFrame, bits: int, seed: int, kept: np.ndarray | None, texts: str) -> DataFrame:
    """Per task: digests of terms and of their groups, with their counts. No shuffle.

    ``kept`` are the sorted digests that are wanted; without it all terms are handed on. Texts
    come ``once`` for a term of a task, or with ``all`` rows, which then count documents too.
    """
    known = rows.sparkSession.sparkContext.broadcast(kept)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(texts == "all", True)
        for batch in batches:
            for lang, source, text in zip(*batch.columns):
                found.add((lang.as_py(), source.as_py()), text.as_py())
                if found.size >= GATHERED:
                    yield from handed(found)
                    found = Gathered(texts == "all", True)
        yield from handed(found)

    def chosen_of(found: Gathered) -> dict[str, dict[bytes, int]]:
        """The wanted terms of each language with their digests; each term is hashed once."""
        every: dict[str, set[bytes]] = {}
        for (lang, _), (_, times) in found.groups.items():
            every.setdefault(lang, set()).update(times)
        chosen, wanted = {}, known.value
        for lang, terms in every.items():
            terms = list(terms)
            digests = digests_of(lang, terms, bits)
            if wanted is None:
                chosen[lang] = dict(zip(terms, digests.tolist()))
                continue
            at = np.minimum(np.searchsorted(wanted, digests), max(0, len(wanted) - 1))
            hits = np.flatnonzero(wanted[at] == digests) if len(wanted) else []
            chosen[lang] = {terms[i]: int(digests[i]) for i in hits}
        return chosen

    def handed(found: Gathered) -> Iterator[pa.RecordBatch]:
        chosen, told = chosen_of(found), {}
        for (lang, source), (documents, times) in found.groups.items():
            digests, before = chosen[lang], told.setdefault(lang, set())
            terms = [t for t in times if t in digests]
            new = [None if texts == "once" and t in before else t.decode() for t in terms]
            before.update(terms)
            columns = {
                "digest": pa.array(np.fromiter((digests[t] for t in terms), np.int64, len(terms))),
                "group": pa.repeat(group_digest(seed, lang, source), len(terms)),
                "term": pa.array(new, pa.string()),
                "docs": pa.array(np.fromiter((documents[t] for t in terms), np.int64, len(terms))),
                "n": pa.array(np.fromiter((times[t] for t in terms), np.int64, len(terms))),
            }
            if texts == "once":
                del columns["docs"]
            yield pa.RecordBatch.from_pydict(columns)

    docs = "" if texts == "once" else "docs bigint, "
    return rows.mapInArrow(each, f"digest bigint, group bigint, term string, {docs}n bigint")


def kept_terms(rows: DataFrame, bits: int, seed: int, vocabulary: DataFrame, texts: str = "once") -> DataFrame:
    """Cut ``term_counts`` of the digests in ``vocabulary``, a cut frame."""
    if vocabulary.count() <= KEPT_IN_TASKS:
        digests = np.sort(vocabulary.toArrow().column("digest").to_numpy())
        return cut(term_counts(rows, bits, seed, digests, texts))
    every = term_counts(rows, bits, seed, None, texts)
    return cut(every.join(vocabulary, "digest", "left_semi").select(every.columns))


def counts_of(terms: DataFrame, key: list[str]) -> DataFrame:
    """Sums by key and group, with ``lang_n`` (and ``lang_docs``) of the key in all groups.

    One shuffle by key serves both the sums and the window, which sees one row per group.
    """
    sums = [c for c in ("docs", "n") if c in terms.columns]
    of_term = Window.partitionBy(*key)
    return (
        terms.select("group", *key, *sums)
        .repartition(*key)
        .groupBy(*key, "group")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .withColumns({f"lang_{c}": F.sum(c).over(of_term) for c in sums})
    )


def probability(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(scale * (n + 5) / (total + 5 * kinds)), exactly; NULL without kinds."""
    above = (n + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.when(kinds > 0, total + SMOOTHING * kinds).cast("decimal(20,0)")
    return (F.call_function("div", above, below) + 1).cast("bigint")


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least: int = LEAST_DOCUMENTS,
    ranks: int = TERM_RANKS,
    digest_bits: int = 64,
) -> DataFrame:
    """How each source's use of terms differs from the language's other sources and from the language.

    Rows of ``lang, source, part, item, value, rank``. Part ``pair`` has every other source of
    the language with the sum of differences over all kept terms; part ``term`` the terms that
    the source uses more than the language, up to rank ``ranks``. NULL languages, sources and
    texts count as empty; every row is a document of its own. Sources without terms are paired
    like any other, a language without kept terms has values of 0, and an empty table no rows.
    Ties are ordered by the item's bytes. ``digest_bits`` is for tests of colliding digests.
    """
    by_batches(docs.sparkSession)
    names = {"lang": lang_col, "source": source_col, "text": text_col}
    rows = docs.select(*[text_of(F.col(c).cast("string")).alias(n) for n, c in names.items()])

    # Tasks have counted already, so what follows the shuffle does all that is left.
    found = document_counts(rows, digest_bits).repartition("digest").groupBy("digest")
    vocabulary = cut(found.agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("digest"))
    known, seed = numbered_groups(rows)
    terms = kept_terms(rows, digest_bits, seed, vocabulary)

    # Of each digest the least and greatest text; where they differ it counts by texts.
    of_group = measured(known)
    told = terms.where(F.col("term").isNotNull()).join(of_group, "group")
    texts = cut(
        told.groupBy("digest").agg(
            F.min("term").alias("low"),
            (F.min("term") != F.max("term")).alias("_terms"),
            (F.min("lang") != F.max("lang")).alias("_langs"),
        )
    )
    shared = cut(texts.where(F.col("_terms") | F.col("_langs")).select("digest"))
    kept = counts_of(terms, ["digest"]).withColumn("term", F.lit(None).cast("string"))
    if not shared.isEmpty():
        again = kept_terms(rows, digest_bits, seed, shared, "all").join(of_group, "group")
        apart = counts_of(again, ["lang", "digest", "term"]).where(F.col("lang_docs") >= least)
        kept = kept.join(measured(shared), "digest", "left_anti").unionByName(apart.select(kept.columns))
    kept = cut(kept)

    # Numbers of each language and group.
    langs = (
        kept.join(of_group, "group")
        .groupBy("lang", "digest", "term")
        .agg(F.first("lang_n").alias("lang_n"))
        .groupBy("lang")
        .agg(F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    )
    totals = kept.groupBy("group").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    groups = (
        known.join(totals, "group", "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "kinds", "lang_total"])
        .withColumn("none", probability(F.lit(0), F.col("total"), F.col("kinds")))
        .withColumn("number", F.row_number().over(of_lang.orderBy("source")) - 1)
        .withColumn("sources", F.count("*").over(of_lang))
    )
    groups = cut(groups)
    used = kept.join(measured(groups), "group").withColumn(
        "p", probability(F.col("n"), F.col("total"), F.col("kinds"))
    )
    return typical_terms(used, texts, ranks).unionByName(source_pairs(used, groups))


def typical_terms(used: DataFrame, texts: DataFrame, ranks: int) -> DataFrame:
    """Terms a source has more than its language; texts are joined to the first ranks, ties included."""
    group = Window.partitionBy("lang", "source")
    first = (
        used.withColumn("value", F.col("p") - probability(F.col("lang_n"), F.col("lang_total"), F.col("kinds")))
        .where(F.col("value") > 0)
        .select("lang", "source", "digest", "term", "value")
        .withColumn("_rank", F.rank().over(group.orderBy(F.desc("value"))))
        .where(F.col("_rank") <= ranks)
    )
    named = cut(first).join(texts, "digest").withColumn("item", F.coalesce("term", "low"))
    ranked = named.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))
    return ranked.where(F.col("rank") <= ranks).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int")
    )


def source_pairs(used: DataFrame, groups: DataFrame) -> DataFrame:
    """Each two sources of a language with the sum of their differences over all kept terms.

    The terms of a language are dealt out to blocks of about ``CELLS`` probabilities; a task
    compares a block's sources and hands on one sum for two sources. So neither a language nor
    a term is a piece of work of its own, and no pair is made for a single term.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, cells, nones in zip(*batch.columns):
                fields = cells.values
                digest, number, p = (fields.field(n).to_numpy() for n in ("digest", "number", "p"))
                _, at = np.unique(digest, return_inverse=True)
                if fields.field("term").null_count < len(fields):
                    # Terms that share a digest are rows of their own.
                    key = pd.MultiIndex.from_arrays([digest, fields.field("term").to_pandas()])
                    at = pd.factorize(key)[0]
                table = np.tile(nones.values.to_numpy(), (int(at.max()) + 1, 1))
                table[at, number] = p
                for a in range(table.shape[1] - 1):
                    sums = np.abs(table[:, a + 1 :] - table[:, a : a + 1]).sum(axis=0)
                    columns = {
                        "lang": pa.repeat(lang, len(sums)),
                        "a": pa.repeat(pa.scalar(a, pa.int32()), len(sums)),
                        "b": pa.array(np.arange(a + 1, table.shape[1], dtype=np.int32)),
                        "value": pa.array(sums),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    parts = F.ceil(F.col("kinds") * F.col("sources") / CELLS).cast("bigint")
    dealt = F.pmod(F.xxhash64("digest", "term"), parts)
    blocks = used.groupBy("lang", dealt.alias("block")).agg(
        F.collect_list(F.struct("digest", "term", "number", "p")).alias("cells")
    )
    ordered = F.array_sort(F.collect_list(F.struct("number", "none", "source")))
    langs = cut(groups.groupBy("lang").agg(ordered.alias("_all")))
    nones = langs.select("lang", F.col("_all.none").alias("nones"))
    compared = blocks.join(measured(nones), "lang").select("lang", "cells", "nones")
    sums = compared.mapInArrow(each, "lang string, a int, b int, value bigint")
    # Every two sources, also of a language without terms.
    every = (
        groups.join(measured(langs.select("lang", F.size("_all").alias("_n"))), "lang")
        .where(F.col("number") + 1 < F.col("_n"))
        .select("lang", F.col("number").alias("a"), F.explode(F.sequence(F.col("number") + 1, F.col("_n") - 1)).alias("b"))
        .withColumn("value", F.lit(0).cast("bigint"))
    )
    summed = cut(sums.unionByName(every).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = summed.unionByName(summed.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = measured(groups.select("lang", "number", "source"))
    found = both.join(names.withColumnsRenamed({"number": "a"}), ["lang", "a"]).join(
        names.withColumnsRenamed({"number": "b", "source": "item"}), ["lang", "b"]
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )
