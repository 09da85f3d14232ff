"""Secret scan by grammar inference.

Fixed patterns find the base spans. Their values are the labelled credentials: for each
kind a prefix tree of them is turned into a probabilistic automaton by merging states
whose outgoing frequencies a Hoeffding bound cannot tell apart, and one more automaton
is inferred from ordinary tokens of the same alphabet. Every other token that could be a
credential is scored by how much likelier its format is under a credential automaton
than under the ordinary one; calibrated on credentials that were not learnt from, the likely
ones are added to the spans.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice, takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, cut, hash_sample, measured, text_key, text_of

by_value(__name__)

#: Kinds in their order, and the patterns of the base spans.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}+"
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

#: Tokens of at least so many characters of the credentials' alphabet, with a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}+"
#: Automata are inferred from at most so many distinct strings of each kind, in the order
#: of a hash, and half as many calibrate; of a longer string the first STEPS characters.
SAMPLE = 400
STEPS = 64
#: Fewer labelled credentials of a kind than this give no automaton.
LEAST_SAMPLE = 20
#: Significance of the merge test, and chance of a symbol that a state has not seen.
ALPHA = 0.05
UNSEEN = 1e-4
#: Share of known credentials that calibrates the threshold from above.
ACCEPTED = 0.95
#: Tokens that are accepted are left out of learning until of those not learnt from at most
#: this share is accepted.
SETTLED = 0.02
#: Share of known credentials that score no higher than equal chances where the tokens are
#: mostly credentials.
MIXED = 0.25
#: Symbols of the candidates' alphabet.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


# --- base spans and candidates --------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and value of the base spans, by start and kind."""
    found = []
    if ":" in text or "=" in text:
        for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII):
            if len(m[2]) >= LEAST_ASSIGN:
                found.append((m.start(), m.end(), "assign", m[2]))
    if "AKIA" in text:
        for m in re.finditer(ACCESS, text):
            if len(m[0]) >= LEAST_ACCESS:
                found.append((m.start(), m.end(), "access", m[0]))
    found += [(m.start(), m.end(), "hex", m[0]) for m in re.finditer(HEX, text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Tokens that could be credentials and meet no base span."""
    found, k = [], 0
    for m in re.finditer(CANDIDATE, text):
        if not re.search("[0-9]", m[0]):
            continue
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        near = takewhile(lambda s, end=m.end(): s[0] < end, islice(taken, k, None))
        if not any(s[1] > m.start() for s in near):
            found.append((m.start(), m.end(), "format", m[0]))
    return found


# --- grammar inference ----------------------------------------------------------------


@dataclass
class State:
    """Visits, ends, and for each symbol the number of passes and the next state."""

    visits: int = 0
    ends: int = 0
    steps: dict[str, list] = field(default_factory=dict)


def prefix_tree(strings: list[str]) -> State:
    root = State()
    for string in strings:
        state = root
        state.visits += 1
        for symbol in string[:STEPS]:
            step = state.steps.setdefault(symbol, [0, State()])
            step[0] += 1
            state = step[1]
            state.visits += 1
        state.ends += 1
    return root


def _differ(a: int, n: int, b: int, m: int) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return abs(a / n - b / m) > bound


def compatible(red: State, blue: State) -> bool:
    """Whether both states could send strings on, and end them, with the same chances."""
    pending = [(red, blue)]
    while pending:
        a, b = pending.pop()
        if not a.visits or not b.visits:
            continue
        if _differ(a.ends, a.visits, b.ends, b.visits):
            return False
        for symbol in a.steps.keys() | b.steps.keys():
            one, two = a.steps.get(symbol), b.steps.get(symbol)
            if _differ(one[0] if one else 0, a.visits, two[0] if two else 0, b.visits):
                return False
            if one and two and one[1] is not two[1]:
                pending.append((one[1], two[1]))
    return True


def fold(red: State, blue: State) -> None:
    """Add the tree below ``blue`` to the automaton at ``red``."""
    pending = [(red, blue)]
    while pending:
        a, b = pending.pop()
        a.visits += b.visits
        a.ends += b.ends
        for symbol, (count, target) in b.steps.items():
            if symbol in a.steps:
                a.steps[symbol][0] += count
                pending.append((a.steps[symbol][1], target))
            else:
                a.steps[symbol] = [count, target]


def infer(strings: list[str]) -> State:
    """The automaton of the strings: tree states are merged, the most visited first.

    A state next to the settled ones is merged with the first settled state that it is
    compatible with, its subtree folded in; if there is none it is settled itself.
    """
    root = prefix_tree(strings)
    settled = [root]
    while True:
        marks = {id(s) for s in settled}
        border = [
            (state, symbol, target)
            for state in settled
            for symbol, (_, target) in sorted(state.steps.items())
            if id(target) not in marks
        ]
        if not border:
            return root
        state, symbol, blue = max(border, key=lambda x: x[2].visits)
        for red in settled:
            if compatible(red, blue):
                state.steps[symbol][1] = red
                fold(red, blue)
                break
        else:
            settled.append(blue)


def likelihood(root: State, string: str) -> float:
    """Mean log chance of the symbols and the end; what was never seen gets ``UNSEEN``."""
    state, total = root, 0.0
    for symbol in string:
        step = state.steps.get(symbol) if state else None
        total += math.log(max(UNSEEN, step[0] / state.visits if step else 0.0))
        state = step[1] if step else root
    ends = state.ends / state.visits if state.visits else 0.0
    return (total + math.log(max(UNSEEN, ends))) / (len(string) + 1)


# --- the model ------------------------------------------------------------------------


@dataclass
class Model:
    credentials: list[State]
    ordinary: State | None
    threshold: float

    def score(self, token: str) -> float:
        if not self.credentials or self.ordinary is None:
            return -math.inf
        return max(likelihood(a, token) for a in self.credentials) - likelihood(self.ordinary, token)


def chance() -> State:
    """An automaton for which all symbols and the end are alike."""
    state = State(len(ALPHABET) + 1, 1)
    state.steps = {symbol: [1, state] for symbol in ALPHABET}
    return state


def fit(values: dict[str, list[str]], ordinary: list[str]) -> Model:
    """From labelled credentials by kind and ordinary tokens; two of three are learnt from.

    The threshold comes from the credentials not learnt from: halfway between equal
    chances and what nearly all of them reach. The tokens may hold any share of
    credentials: those that the model accepts are left out and the ordinary automaton is
    learnt again, until hardly any of the tokens not learnt from is accepted. If it
    describes a quarter of the known credentials as well as their own automata do, it
    starts from the tokens that are unlikely to come from these. Too few tokens that are
    left are replaced by plain chance.
    """
    learn = {k: [v for i, v in enumerate(vs) if i % 3] for k, vs in values.items()}
    check = [v for k, vs in values.items() if len(learn[k]) >= LEAST_SAMPLE for v in vs[::3]]
    automata = [infer(vs) for k, vs in sorted(learn.items()) if len(vs) >= LEAST_SAMPLE]
    if not automata:
        return Model([], None, math.inf)

    def least(scores: list[float], share: float) -> float:
        return sorted(scores)[int(share * len(scores))]

    def against(tokens: list[str]) -> Model:
        some = len(tokens) >= 2 * LEAST_SAMPLE
        model = Model(automata, infer([t for i, t in enumerate(tokens) if i % 3]) if some else chance(), math.inf)
        model.threshold = max(0.0, least(list(map(model.score, check)), 1 - ACCEPTED) / 2)
        return model

    plain, model = ordinary, against(ordinary)
    if least(list(map(model.score, check)), MIXED) <= 0:
        floor = least([max(likelihood(a, v) for a in automata) for v in check], 1 - ACCEPTED)
        plain = [t for t in plain if max(likelihood(a, t) for a in automata) < floor]
        model = against(plain)
    while True:
        taken = [model.score(t) >= model.threshold for t in plain]
        if sum(taken[::3]) <= SETTLED * len(plain[::3]):
            return model
        plain = [t for t, gone in zip(plain, taken, strict=True) if not gone]
        model = against(plain)


# --- on tables ------------------------------------------------------------------------

SPANS = "array<struct<start:int,end:int,kind:string,value:string>>"


def scan_column(text: Column) -> Column:
    """Base spans and candidates of a text, with their values."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ("start", "end", "kind", "value")
        for texts in batches:
            rows = []
            for text in (t.as_py() for t in texts):
                base = base_spans(text)
                found = base + candidates(text, base)
                rows.append([dict(zip(names, s, strict=True)) for s in found])
            yield pa.array(rows, kind)

    return F.arrow_udf(each, SPANS)(text_of(text))


def train(found: DataFrame, sample: int = SAMPLE) -> Model:
    """Automata from a bounded sample of the distinct values of ``found`` (kind, value)."""
    values = cut(found.select("kind", F.substring("value", 1, 4 * STEPS).alias("value")).distinct())
    totals = dict(values.groupBy("kind").count().collect())
    picked = {
        kind: hash_sample(values.where(F.col("kind") == kind), "value", sample + sample // 2, totals.get(kind, 0))
        for kind in KINDS
    }
    return fit({k: picked[k] for k in KINDS[:3]}, picked["format"])


def accepted_column(value: Column, model: Model) -> Column:
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array([model.score(v) >= model.threshold for v in values.to_pylist()], pa.bool_())

    return F.arrow_udf(each, "boolean")(value)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that has a span: ``_id``, ``_key`` and ``spans``.

    ``spans`` is an array of structs start, end (code points, end exclusive) and kind,
    by start and kind: the base spans, and as ``format`` what the automata add. Whole
    texts are scanned; a NULL text counts as empty and has no span. Rows that repeat id
    and text are one row here, as their spans are the same. Without enough labelled
    credentials of a kind nothing is added to the base spans.
    """
    by_batches(docs.sparkSession)
    scanned = docs.select(
        F.col(id_col).alias("_id"),
        text_key(F.col(text_col)).alias("_key"),
        scan_column(F.col(text_col)).alias("_found"),
    )
    found = cut(scanned.where(F.size("_found") > 0).select("_id", "_key", F.explode("_found").alias("_s")))
    found = found.select("_id", "_key", "_s.start", "_s.end", "_s.kind", "_s.value")
    base, tokens = found.where(F.col("kind") != "format"), found.where(F.col("kind") == "format")
    model = train(found)
    if model.credentials:
        base = base.unionByName(tokens.where(accepted_column(F.col("value"), model)))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = F.array_sort(F.collect_set(F.struct("start", rank.alias("rank"), "end", "kind")))
    return (
        base.groupBy("_id", "_key")
        .agg(spans.alias("spans"))
        .withColumn("spans", F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_of(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != "format")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done: Column, span: Column) -> Column:
        between = F.substr(text, done["at"] + 1, span["start"] - done["at"])
        after = F.struct(F.concat(done["out"], between, F.lit(mark)).alias("out"), span["end"].alias("at"))
        longer = F.struct(done["out"].alias("out"), F.greatest(done["at"], span["end"]).alias("at"))
        return F.when(span["start"] < done["at"], longer).otherwise(after)

    return F.aggregate(spans, zero, step, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1)))


def secrets_stage(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars"
) -> DataFrame:
    """``docs`` with every secret replaced by a mark, and the length column kept true.

    Documents stay, and texts without a secret are left as they are, NULLs included.
    """
    found = measured(cut(find_secrets(docs, id_col, text_col)))
    same = docs[id_col].eqNullSafe(found["_id"]) & (text_key(docs[text_col]) == found["_key"])
    joined, spans = docs.join(found, same, "left"), found["spans"]
    clean = F.when(spans.isNull(), docs[text_col]).otherwise(redacted(docs[text_col], spans))
    columns = []
    for name in docs.columns:
        if name == text_col:
            columns.append(clean.alias(name))
        elif name == chars_col:
            length = F.length(clean).cast(docs.schema[name].dataType)
            columns.append(F.when(spans.isNull(), docs[name]).otherwise(length).alias(name))
        else:
            columns.append(docs[name])
    return joined.select(*columns)
