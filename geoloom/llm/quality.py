"""Quality rules by weak supervision (operator 4), in DataFrame functions only.

Each rule looks at one measured feature of a document and votes good, bad or
abstains.  The votes of the documents that pass the base rules are counted by
pattern, as the verdict is about those alone.  Expectation maximisation over the
counts estimates a mixture: one class of good documents and one class for each
family of junk (odd characters, repetition, no language), with the share of each
class and the rate at which each rule votes bad there.  The posterior probability
of "good" given a document's pattern decides, instead of asking that every rule
pass.  Starting values weigh as a share of the documents (``START_SHARE``), so the
result doesn't depend on the size of a table.  The table of patterns has at most
3 ** rules rows (19,683 for nine rules) whatever the size of the corpus; it comes
to the driver once, and all rounds run over it there.

Defined results: a null text has no word (kept is false); empty texts likewise;
very long texts are measured whole; repeated rows are measured and counted each;
a posterior of just ``keep`` keeps; extra columns pass through, but for those
named ``_q``, ``_votes``, ``p_good``, ``base_failed`` and ``kept``, which are
replaced; an empty table yields an empty table.

Repeated three-word windows are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, fresh, stored, text_of

#: Fixed values of the base rules.
MIN_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
#: Common function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the", "of", "and", "to", "in", "is", "was", "that", "for", "with", "as", "on", "it", "this", "by", "from", "are", "be", "a", "or",
    "de", "la", "le", "les", "des", "et", "en", "un", "une", "du", "que", "qui", "dans", "pour", "par", "sur", "au", "est", "avec", "ou",
    "der", "die", "das", "und", "zu", "den", "dem", "von", "mit", "nicht", "ist", "sich", "auf", "eine", "ein", "im", "für", "auch", "als", "an",
    "el", "los", "las", "y", "se", "del", "por", "con", "no", "su", "para", "al", "lo", "como", "más", "pero", "sus", "o", "es", "una",
)


def words(text: Column) -> Column:
    """Runs of characters that aren't spaces."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` (the text without null) and the features, in fields of the column ``_q``."""
    docs = docs.drop("_q")
    (none,) = fresh(docs, "_")
    a = docs.select(F.struct(F.lit(0).alias(none), *[c for c in docs.columns if c != text]).alias("_row"), text_of(text).alias("_t"))
    # one pass leaves the few characters that are counted
    a = a.withColumns({"_w": words(F.col("_t")), "_lines": F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""), "_odd": F.regexp_replace("_t", r"[^\p{Lu}0-9!?#*$%&|<>]+", "")})
    a = a.withColumns({"_n": F.size("_w"), "_wh": F.transform("_w", lambda x: F.xxhash64(x)), "_chars": F.length(F.array_join("_w", ""))})
    windows = F.transform("_wh", lambda x, i: F.xxhash64(x, F.get(F.col("_wh"), i + 1), F.get(F.col("_wh"), i + 2)))
    a = a.withColumn("_h", F.slice(windows, F.lit(1), F.greatest(F.col("_n") - 2, F.lit(0))))
    # most texts repeat no window, which a hash set tells without a sort
    a = a.withColumn("_again", F.size(F.array_distinct("_h")) < F.size("_h"))
    a = a.withColumn("_sorted", F.when(F.col("_again"), F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    near = lambda k: F.get(F.col("_sorted"), k)["h"]
    flagged = F.transform("_sorted", lambda s, k: F.when((s["h"] == near(k + 1)) | ((k > 0) & (s["h"] == near(F.greatest(k - 1, F.lit(0))))), s["i"]))
    a = a.withColumn("_at", F.sort_array(F.filter(flagged, lambda i: i.isNotNull())))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    counted = lambda kinds: F.length(F.regexp_replace("_odd", f"[^{kinds}]+", "")).cast("long")
    q = F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        counted(SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("_again"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_wh")).cast("long").alias("n_distinct"),
        F.size(F.array_intersect("_w", F.array(*[F.lit(x) for x in FUNCTION_WORDS]))).cast("long").alias("n_function"),
        counted(r"\p{Lu}").alias("n_upper"),
        counted("0-9").alias("n_digits"),
        counted("!?").alias("n_shouts"),
    )
    return a.select("_row.*", F.col("_t").alias(text), q.alias("_q")).drop(none)


@dataclass(frozen=True)
class Rule:
    """Votes bad at or beyond ``bad``, good at or within ``good``, abstains between; ``rising``: high values are bad."""

    name: str
    good: float
    bad: float
    rising: bool = True


#: The rules and their limits.
RULES = (
    Rule("symbol_ratio", 0.02, 0.10),
    Rule("upper_ratio", 0.12, 0.30),
    Rule("shout_ratio", 0.02, 0.10),
    Rule("digit_ratio", 0.03, 0.20),
    Rule("dup_line_ratio", 0.20, 0.50),
    Rule("repeat_ratio", 0.10, 0.30),
    Rule("word_length", 9.0, 14.0),
    Rule("distinct_ratio", 0.40, 0.25, rising=False),
    Rule("function_words", 4.0, 1.0, rising=False),
)


def values() -> dict[str, Column]:
    q = lambda x: F.col(f"_q.{x}")
    ratio = lambda a, b: q(a) / F.greatest(q(b), F.lit(1)).cast("double")
    return {
        "symbol_ratio": ratio("n_symbols", "n_words"), "upper_ratio": ratio("n_upper", "word_chars"), "shout_ratio": ratio("n_shouts", "n_words"),
        "digit_ratio": ratio("n_digits", "word_chars"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"), "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "word_length": ratio("word_chars", "n_words"), "distinct_ratio": F.when(q("n_words") >= 200, ratio("n_distinct", "n_words") * F.sqrt(q("n_words") / 1000.0)).otherwise(F.lit(0.3)),
        "function_words": F.when(q("n_words") >= MIN_WORDS, q("n_function").cast("double")).otherwise(F.lit(2.0)),
    }


def vote(rule: Rule, value: Column) -> Column:
    good, bad = (value <= rule.good, value >= rule.bad) if rule.rising else (value >= rule.good, value <= rule.bad)
    return F.when(bad, -1).when(good, 1).otherwise(0)


def with_votes(features: DataFrame, rules=RULES) -> DataFrame:
    v = values()
    return features.withColumn("_votes", F.array(*[vote(r, v[r.name]) for r in rules]))


#: Families of junk, by the rules that see it: each is a class of the mixture.
FAMILIES = (("symbol_ratio", "upper_ratio", "shout_ratio", "digit_ratio"), ("dup_line_ratio", "repeat_ratio", "distinct_ratio"), ("word_length", "function_words"))
#: Starting values: share of good documents; how often a rule votes bad on good documents, on its own family of junk, and on another; what they weigh, as a share of the documents.
GOOD_SHARE, ON_GOOD, ON_OWN, ON_OTHER, START_SHARE = 0.85, 0.003, 0.6, 0.2, 0.01
#: The limits are set so that a rule votes bad on at most this share of good documents; which class is the good one rests on it.
FALSE_ALARM = 0.003


@dataclass(frozen=True)
class Model:
    """Share of each class, the good one first; for each class and rule, the share of bad votes among its votes."""

    shares: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]


def posterior(votes: Column, model: Model) -> Column:
    """Probability of the good class; an abstention tells nothing."""

    def score(share: float, bad: tuple[float, ...]) -> Column:
        down, up = F.lit(np.log(bad).tolist()), F.lit(np.log1p(-np.array(bad)).tolist())
        each = F.transform(votes, lambda v, j: F.when(v == 1, F.get(up, j)).when(v == -1, F.get(down, j)).otherwise(0.0))
        return F.aggregate(each, F.lit(float(np.log(share))), lambda t, x: t + x)

    good, *junk = [score(*x) for x in zip(model.shares, model.bad, strict=True)]
    return F.lit(1.0) / (F.lit(1.0) + sum((F.exp(x - good) for x in junk), F.lit(0.0)))


def fit(voted: DataFrame, rules=RULES, families=FAMILIES, rounds: int = 60, edge: float = 0.001) -> Model:
    """Expectation maximisation over the counts of vote patterns of all rows.

    In every junk class each rule votes bad more often than on good documents,
    which fixes the meaning of the classes.
    """
    rows = voted.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted((tuple(r["_votes"]), r["n"]) for r in rows)
    start = np.array([[ON_GOOD] * len(rules), *[[ON_OWN if r.name in f else ON_OTHER for r in rules] for f in families]])
    first = np.array([GOOD_SHARE, *[(1 - GOOD_SHARE) / len(families)] * len(families)])
    shares, bad = first, start
    if rows:
        votes, n = np.array([v for v, _ in rows]), np.array([float(k) for _, k in rows])
        down, cast = (votes == -1).astype(float), (votes != 0).astype(float)
        weight = START_SHARE * n.sum() * first
        for _ in range(rounds):
            s = np.log(shares) + down @ np.log(bad).T + (cast - down) @ np.log1p(-bad).T
            p = np.exp(s - s.max(axis=1, keepdims=True))
            mass = (n[:, None] * p / p.sum(axis=1, keepdims=True)).T
            shares = (mass.sum(axis=1) + weight) / (n.sum() + weight.sum())
            bad = np.clip((mass @ down + weight[:, None] * start) / (mass @ cast + weight[:, None]), edge, 1 - edge)
            bad[0] = np.minimum(bad[0], FALSE_ALARM)
            bad[1:] = np.maximum(bad[1:], bad[0] + edge)
    return Model(tuple(shares.tolist()), tuple(map(tuple, bad.tolist())))


def base_failed() -> Column:
    """What the fixed rules reject."""
    return (F.col("_q.n_words") < MIN_WORDS) | (100 * F.col("_q.n_repeat_words") > REPEAT_PERCENT * F.col("_q.n_words"))


def judged(docs: DataFrame, text: str = "text", rules=RULES, keep: float = 0.5) -> DataFrame:
    """``docs`` without the text, with features, votes, ``p_good``, ``base_failed`` and ``kept``."""
    voted = with_votes(measured(docs.drop("_votes", "p_good", "base_failed", "kept"), text), rules)
    # the votes of a document are needed twice: measure once, keep what is small
    slim = stored(voted.drop(text), "quality").withColumn("base_failed", base_failed())
    model = fit(slim.where(~F.col("base_failed")), rules)
    out = slim.withColumn("p_good", posterior(F.col("_votes"), model))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = [F.col(f"_q.{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged(docs).select("doc_id", *q, "base_failed", "kept")
