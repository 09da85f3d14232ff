"""URL filter: rules, and for the rest a ratio of two character language models.

One model describes the URLs that rules accept, one those that rules reject. Each is a
variable-order Markov model: the chance of a character after up to five others is the
longest context's count, smoothed with the next shorter one by the number of different
characters the context has been seen with (Witten-Bell). A URL is judged by the mean
difference of the log chances of its characters, against a threshold calibrated on the
labelled URLs. All of it is aggregates and joins over n-gram tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small

#: Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Characters of a window: five of context and the one they precede.
ORDER = 6
START, END = "\x02", "\x03"
#: Chance of any character when nothing is known.
UNIFORM = 1 / 256
#: Scores are compared in steps of this size when the threshold is chosen, within +-SPAN.
STEP, SPAN = 0.01, 10.0


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.when(F.instr(url, "://") > 0, lower), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(F.instr(url, "://") > 0, path), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct of rule and verdict, of the longest rule that fits; NULL if none does."""
    found = []
    for verdict, its_host, its_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == its_host) | host.endswith(f".{its_host}")) & path.startswith(its_path)
        rule = F.struct(F.lit(its_host + its_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found.append(F.when(fits, rule))
    return F.coalesce(*found)


# --- language models ------------------------------------------------------------------


def windows_of(text: Column) -> Column:
    """Each character, and the end, with the characters before it."""
    padded = F.concat(F.lit(START * (ORDER - 1)), text, F.lit(END))
    places = F.sequence(F.lit(1), F.length(text) + 1)
    return F.explode(F.transform(places, lambda i: F.substr(padded, i, F.lit(ORDER))))


def log_ratios(grams: DataFrame) -> DataFrame:
    """``gram`` and ``ratio`` (log chance accepted minus rejected) of every window.

    ``grams`` has ``gram`` of ORDER characters and its counts ``a`` and ``b`` in accepted
    and rejected URLs, zero included. Shorter n-grams are the windows' ends, so their
    counts are sums of the windows'.
    """
    below: DataFrame | None = None
    for n in range(1, ORDER + 1):
        level = (
            grams.groupBy(F.substring("gram", ORDER - n + 1, n).alias("gram"))
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
            .withColumn("context", F.substring("gram", 1, n - 1))
        )
        contexts = level.groupBy("context").agg(
            F.sum("a").alias("all_a"),
            F.sum("b").alias("all_b"),
            F.count_if(F.col("a") > 0).alias("kinds_a"),
            F.count_if(F.col("b") > 0).alias("kinds_b"),
        )
        level = level.join(contexts, "context")
        if below is None:
            level = level.withColumns({"low_a": F.lit(UNIFORM), "low_b": F.lit(UNIFORM)})
        else:
            shorter = below.select(
                F.col("gram").alias("end"), F.col("p_a").alias("low_a"), F.col("p_b").alias("low_b")
            )
            level = level.join(shorter, F.substring("gram", 2, n - 1) == F.col("end"))

        def chance(c: str) -> Column:
            seen = F.col(f"all_{c}") + F.col(f"kinds_{c}")
            mixed = (F.col(c) + F.col(f"kinds_{c}") * F.col(f"low_{c}")) / seen
            return F.when(seen > 0, mixed).otherwise(F.col(f"low_{c}"))

        below = level.select("gram", chance("a").alias("p_a"), chance("b").alias("p_b"))
    return below.select("gram", (F.log("p_a") - F.log("p_b")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score that parts accepted (``a`` rows) from rejected (``b``) with the best mean recall.

    Only counts by score step come here, so their number is bounded. Ties go to the step
    nearest to zero; with one class only the threshold is zero.
    """
    place = F.floor(F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN), "score")) / STEP).cast("int")
    counted = scored.groupBy(place.alias("place")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    steps = sorted(tuple(r) for r in counted.where("a > 0 or b > 0").collect())
    all_a, all_b = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not all_a or not all_b:
        return 0.0
    best, low_a, low_b = (-1.0, 0, 0), 0, 0
    for place_, a, b in [*steps, (steps[-1][0] + 1, 0, 0)]:
        best = max(best, ((all_a - low_a) / all_a + low_b / all_b, -abs(place_), place_))
        low_a, low_b = low_a + a, low_b + b
    return best[2] * STEP


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    A rule fits its host and all subdomains if the path starts with the rule's; the
    longest wins and gives the verdict. Where none fits the language models decide: allow
    if the score reaches the threshold. They are counted over all URLs that have a rule,
    host and path, each as often as it occurs. A NULL url, or one without ``://``, has an
    empty host and path, fits no rule, and is scored like any other (by its end alone).

    Equal URLs are one row of the work; n-grams are counted per task before they are
    shuffled, and windows meet their ratios in an equi-join, by broadcast if the table of
    windows is small.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.col("_rule.verdict")
    urls = cut(
        rows.groupBy("host", "path").agg(
            F.count_if(verdict == "allow").alias("a"), F.count_if(verdict == "block").alias("b")
        )
    )
    windows = urls.select("host", "path", "a", "b", windows_of(F.concat("host", "path")).alias("gram"))
    grams = cut(windows.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    ratios = small(cut(log_ratios(grams)))
    scored = cut(
        windows.join(ratios, "gram")
        .groupBy("host", "path")
        .agg(F.avg("ratio").alias("score"), F.first("a").alias("a"), F.first("b").alias("b"))
    )
    least = threshold(scored)
    guess = F.when(F.col("score") >= least, "allow").otherwise("block")
    return rows.join(scored.select("host", "path", "score"), ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(verdict, guess).alias("verdict"),
        "score",
    )
