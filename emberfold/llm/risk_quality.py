"""Quality rules whose cutoff is chosen under a proven limit of false rejections.

Each document gets counts of junk (symbols, repeated lines and windows, capitals, exclamation
marks) and from them one score: the worst of its ratios, each over a fixed reference value.
Labelled documents are the holdout. For every stratum (language) a fixed sequence of cutoffs is
tested from the most lenient on: a cutoff is certified while the exact binomial probability of
seeing so few rejected good documents, were the true false-rejection rate ``alpha``, is at most
``delta`` over the number of labelled strata. The sequence stops at its first failure, so no correction
within a stratum is needed, and the division corrects across strata: with probability
``1 - delta`` no stratum rejects more than ``alpha`` of its good documents by the score. Among the
certified cutoffs the one with the smallest labelled cost is taken, the most lenient of equals.

Defined cases: a null or empty text has no words and fails the base rules; a null language is a
stratum of its own; every stratum is certified by its own labels alone, so one with too few good
labels, without labels or without poor ones rejects nothing by score; repeated labels of a document count once, as good if
any says so; labels without a document or a quality are ignored; no labels at all leave only the
base rules; repeated documents give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.common import let, word_list
from emberfold.session import cut_lineage

WINDOW = 5
SYMBOLS = "#*$%&|<>"
# Ratios at which a text is called junk; the score is the largest ratio over its reference.
REFERENCES = {"symbols": 0.10, "repeats": 0.20, "dup_lines": 0.30, "capitals": 0.50, "bangs": 0.25}
# Cutoffs from the most lenient to the strictest.
CUTOFFS = [round(4.0 * 0.95**i, 6) for i in range(60)]
ALPHA, DELTA, REJECTION_COST = 0.02, 0.05, 5
# Strata up to which their cutoffs are broadcast.
BROADCAST_STRATA = 100_000


def _windows(hashes: Column) -> Column:
    def body(h):
        at = lambda i: F.xxhash64(*[h[i + j] for j in range(WINDOW)])
        return F.when(
            F.size(h) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), at)
        ).otherwise(F.array().cast("array<bigint>"))

    return let(hashes, body)


def _covered(windows: Column) -> Column:
    """Words lying in windows that occur twice or more."""

    def positions(s):
        same = lambda k: (
            F.when(k > 0, s[k - 1]["x"] == s[k]["x"]).otherwise(False)
            | F.when(k < F.size(s) - 1, s[k + 1]["x"] == s[k]["x"]).otherwise(False)
        )
        spots = F.filter(F.sequence(F.lit(0), F.size(s) - 1), same)
        return F.sort_array(F.transform(spots, lambda k: s[k]["i"]))

    def length(p):
        steps = F.transform(
            p, lambda v, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), v - p[F.greatest(k - 1, F.lit(0))]))
        )
        return F.aggregate(steps, F.lit(0), lambda a, v: a + v)

    def body(w):
        tagged = F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        repeated = let(let(F.sort_array(tagged), positions), length)
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(repeated)

    return let(windows, body)


def _without(text: Column, drop: str) -> Column:
    return F.length(text) - F.length(F.translate(text, drop, ""))


def measures(text: Column) -> Column:
    """Struct of the counts behind the rules, one pass over the words."""
    text = F.coalesce(text, F.lit(""))
    spaces = " \t\n\x0b\f\r"

    def of_words(words):
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _covered(_windows(hashes)).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.translate(s, spaces, "")) > 0)
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return let(
        F.struct(let(word_list(text), of_words).alias("w"), line_counts.alias("l")),
        lambda m: F.struct(
            m["w"]["n_words"].alias("n_words"),
            F.length(F.translate(text, spaces, "")).cast("long").alias("word_chars"),
            _without(text, SYMBOLS).cast("long").alias("n_symbols"),
            m["l"]["n_dup_lines"].alias("n_dup_lines"),
            m["w"]["n_repeat_words"].alias("n_repeat_words"),
            m["l"]["lines"].alias("n_lines"),
            _without(text, "!").cast("long").alias("n_bangs"),
            F.length(F.regexp_replace(text, "[^\\p{Lu}]", "")).cast("long").alias("n_capitals"),
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def junk_score(m: Column) -> Column:
    words = F.greatest(m["n_words"], F.lit(1)).cast("double")
    return F.greatest(
        m["n_symbols"] / words / F.lit(REFERENCES["symbols"]),
        m["n_repeat_words"] / words / F.lit(REFERENCES["repeats"]),
        m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)).cast("double") / F.lit(REFERENCES["dup_lines"]),
        m["n_capitals"] / F.greatest(m["word_chars"], F.lit(1)).cast("double") / F.lit(REFERENCES["capitals"]),
        m["n_bangs"] / words / F.lit(REFERENCES["bangs"]),
    )


def _stricter(score: Column) -> Column:
    """Index of the first cutoff that rejects the score; the number of cutoffs if none does."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in CUTOFFS]), lambda c: c >= score))


def _most_allowed(n: Column, alpha: float, level: Column) -> Column:
    """Largest k with P(Binomial(n, alpha) <= k) <= level; -1 if there is none."""
    start = F.struct(
        (n * F.log(F.lit(1 - alpha))).alias("lp"), F.lit(0.0).alias("cdf"), F.lit(-1).cast("long").alias("most")
    )
    odds = F.log(F.lit(alpha / (1 - alpha)))

    def step(s, k):
        cdf = s["cdf"] + F.exp(s["lp"])
        more = F.when(n > k, F.log((n - k) / (k + 1).cast("double")) + odds).otherwise(F.lit(-1e300))
        return F.struct(
            (s["lp"] + more).alias("lp"),
            cdf.alias("cdf"),
            F.when((cdf <= level) & (s["most"] == k - 1), k).otherwise(s["most"]).cast("long").alias("most"),
        )

    steps = F.sequence(F.lit(0).cast("long"), F.ceil(n * alpha).cast("long"))
    return F.aggregate(steps, start, step, lambda s: s["most"])


def choose_cutoffs(
    scored: DataFrame, labels: DataFrame, *, alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """(stratum, cutoff) from ``scored`` (doc_id, stratum, score) and ``labels`` (doc_id, quality).

    Rows counted per stratum are at most one per cutoff, whatever the size of the corpus. Strata
    that certify nothing have no row.
    """
    known = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.max(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("_good"))
    )
    tally = (
        scored.select("doc_id", "stratum", _stricter(F.col("score")).alias("level"))
        .join(known, "doc_id")
        .groupBy("stratum", "level")
        .agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("poor"))
    )
    # One row per stratum, so few that a single task counts them.
    limits = (
        tally.groupBy("stratum").agg(F.sum("good").alias("n"), F.sum("poor").alias("all_poor"))
        .withColumn("m", F.count("*").over(Window.partitionBy(F.lit(0)))).filter("n > 0")
        .withColumn("most", _most_allowed(F.col("n"), alpha, F.lit(delta) / F.col("m")))
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(len(CUTOFFS) - 1))))
    )
    upto = Window.partitionBy("a.stratum").orderBy("a.level")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("stratum", "level")]
    path = (
        limits.alias("a").join(tally.alias("b"), same, "left")
        .select("a.stratum", "a.level", "most", "all_poor",
                F.sum(F.coalesce("good", F.lit(0))).over(upto).alias("rejected_good"),
                F.sum(F.coalesce("poor", F.lit(0))).over(upto).alias("rejected_poor"))
    )
    # Rejections only grow along the sequence, so passing is the same as passing up to here.
    cost = REJECTION_COST * F.col("rejected_good") + F.col("all_poor") - F.col("rejected_poor")
    best = (
        path.filter("rejected_good <= most AND rejected_poor > 0")
        .groupBy("stratum").agg(F.min(F.struct(cost.alias("cost"), "level")).alias("best"))
    )
    cutoffs = F.array(*[F.lit(c) for c in CUTOFFS])
    return best.select("stratum", cutoffs[F.col("best.level")].alias("cutoff"))


def _verdicts(df: DataFrame, cutoffs: DataFrame, stratum: str, score: str, failed: str) -> DataFrame:
    """``df`` with ``kept``. Cutoffs, a row per stratum, travel to every task unless they are many."""
    small = cut_lineage(cutoffs.select(F.col("stratum").alias("_stratum"), "cutoff"))
    if small.count() <= BROADCAST_STRATA:
        small = F.broadcast(small)
    joined = df.join(small, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    kept = ~F.col(failed) & F.coalesce(F.col(score) <= F.col("cutoff"), F.lit(True))
    return joined.withColumn("kept", kept).drop("_stratum", "cutoff")


def quality_report(docs: DataFrame, labels: DataFrame, *, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts, base verdict, score and final verdict of every row of ``docs``."""
    m = F.col("m")
    counted = docs.select("doc_id", F.col("lang").alias("stratum"), measures(F.col("text")).alias("m"))
    scored = cut_lineage(
        counted.select("doc_id", "stratum", "m.*", base_failed(m).alias("base_failed"), junk_score(m).alias("score"))
    )
    return _verdicts(scored, choose_cutoffs(scored, labels, alpha=alpha, delta=delta), "stratum", "score", "base_failed")


def keep_good(docs: DataFrame, labels: DataFrame, *, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base rules and their stratum's cutoff.

    The judged rows are written down: measuring a text twice costs more than writing it once.
    """
    m = F.col("m")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = cut_lineage(
        docs.select(whole, F.col("lang").alias("stratum"), measures(F.col("text")).alias("m")).select(
            "row", "stratum", base_failed(m).alias("failed"), junk_score(m).alias("score")
        )
    )
    scored = judged.select(F.col("row.doc_id").alias("doc_id"), "stratum", "score")
    cutoffs = choose_cutoffs(scored, labels, alpha=alpha, delta=delta)
    return _verdicts(judged, cutoffs, "stratum", "score", "failed").filter("kept").select("row.*")
