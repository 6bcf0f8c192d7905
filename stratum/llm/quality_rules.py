"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Fixed base rules judge a document first. Beyond them, each ratio in ``RULES`` rejects documents
above a cutoff chosen from labelled holdouts: per stratum, a cutoff is certified when an exact
binomial test shows, at level ``delta`` divided by the number of tests (rules x cutoffs x
strata: Bonferroni), that it rejects at most a share ``risk`` of good documents. The strictest
certified cutoff is used; a rule without one does not apply in that stratum. With probability
1 - delta no rule in use rejects more than its stratum's risk of that stratum's good documents.

The risk of a stratum is the smallest of ``RISKS`` that its number of good labels can certify at all,
(1 - risk) ** n <= level. It depends on how many labels there are, never on what they say, so the
guarantee holds for it: with 160 tests some 800 good labels give 1 %, 400 give 2 %, 160 give 5 %.

Scale: the measures are a narrow table, written once to the checkpoint folder; the holdout
counts of all cutoffs are one map-side-combined aggregate with a row per stratum.

Defined cases: NULL and empty texts have no words and fail the base rules; a NULL stratum is a
stratum of its own; labels that repeat for an id count as good only if all do; NULL labels are
no labels; without labels no cutoff is certified; texts of any length are read whole; rows that
repeat are judged each; columns other than the named ones are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RISKS = (0.01, 0.02, 0.05)
DELTA = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CUTOFFS = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8)
RULES = {
    "symbols": "n_symbols / word_chars",
    "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "capitals": "n_capitals / word_chars",
}
_SPACES = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != "")


def _covered(windows: Column, sorted_windows: Column) -> Column:
    """Words that lie in 3-word windows found twice or more, from the windows with their places.

    Neighbours in the sorted array that share a hash are repeats; their places, sorted, cover
    3 words each less what the next one covers too.
    """
    n = F.size(sorted_windows)

    def place(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(sorted_windows, i - 1)["h"] == x["h"])
        after = F.when(i < n - 1, F.get(sorted_windows, i + 1)["h"] == x["h"])
        return F.when(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)), x["p"])

    places = F.sort_array(F.filter(F.transform(sorted_windows, place), lambda p: p.isNotNull()))
    # accumulator: words covered so far, first word after the covered ones
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(places, start,
                       lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"),
                                             (p + 3).alias("end")),
                       lambda a: a["n"])


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.col(stratum_col).alias("stratum"),
                     F.col(text_col).alias("text"))
    rows = rows.select(
        "id", "stratum", words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\x0b\f\r"))) > 0).alias("lines"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).alias("n_capitals"))
    n = F.size("words")
    hashes = F.transform(F.slice(F.col("words"), 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(
        w, F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2)))
    rows = rows.select(
        "id", "stratum", n.cast("long").alias("n_words"), "n_symbols", "n_capitals",
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        hashes.alias("windows"))
    # only documents in which some window repeats need their windows sorted with places
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("placed", F.when(repeats, F.sort_array(F.transform(
        F.col("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    covered = F.when(F.col("placed").isNull(), F.lit(0)).otherwise(_covered(F.col("windows"), F.col("placed")))
    return rows.select("id", "stratum", "n_words", "word_chars", F.col("n_symbols").cast("long").alias("n_symbols"),
                       F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
                       covered.cast("long").alias("n_repeat_words"),
                       "n_lines", "n_capitals")


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _ratio(rule: str) -> Column:
    over, under = RULES[rule].split(" / ")
    return F.coalesce(F.try_divide(F.col(over).cast("double"), F.col(under)), F.lit(0.0))


def stratum_risk(n: Column, risks: tuple[float, ...], level: Column) -> Column:
    """The smallest risk that n good labels without a false rejection certify (the largest, if none does)."""
    return F.coalesce(*[F.when(n * math.log1p(-r) <= F.log(level), F.lit(r)) for r in sorted(risks)], F.lit(max(risks)))


def critical_count(n: Column, risk: Column | float, level: Column) -> Column:
    """Most false rejections k among n with P(Binomial(n, risk) <= k) <= level; -1 if none.

    The exact tail, summed in log space from k = 0. It ends before n * risk, where the tail
    passes one half or so, so the sum has n * risk steps.
    """
    risk = risk if isinstance(risk, Column) else F.lit(risk)
    odds = F.log(risk / (1 - risk))
    start = F.struct((n * F.log1p(-risk)).alias("lp"), F.lit(0.0).alias("cdf"), F.lit(-1).alias("k"))

    def step(a: Column, j: Column) -> Column:
        cdf = a["cdf"] + F.exp(a["lp"])
        lp = a["lp"] + F.when(j < n, F.log(n - j)).otherwise(float("-inf")) - F.log(j + 1.0) + odds
        return F.struct(lp.alias("lp"), cdf.alias("cdf"), F.when(cdf <= level, j.cast("int")).otherwise(a["k"]).alias("k"))

    steps = F.sequence(F.lit(0), F.ceil(n * risk).cast("int") + 1)
    return F.aggregate(steps, start, step, lambda a: a["k"])


def certified_cutoffs(measured: DataFrame, labels: DataFrame, risks=RISKS,
                      delta: float = DELTA, cutoffs=CUTOFFS) -> DataFrame:
    """(stratum, risk, cut_<rule>...): the strictest certified cutoff of each rule, NULL if none.

    ``labels`` has id and good (boolean). One row per stratum.
    """
    good = (labels.where("id is not null and good is not null").groupBy(F.col("id").alias("label_id"))
            .agg(F.bool_and("good").alias("good")).where("good"))
    held = measured.where(~base_failed()).join(good, F.col("id") == F.col("label_id"), "left_semi")
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_ratio(r) > c).alias(f"k_{r}_{i}") for r in RULES for i, c in enumerate(cutoffs)])
    strata = counts.agg(F.count(F.lit(1)).alias("strata"))
    level = F.lit(delta) / (len(RULES) * len(cutoffs) * F.col("strata"))
    counts = (counts.crossJoin(F.broadcast(strata)).withColumn("risk", stratum_risk(F.col("n"), risks, level))
              .withColumn("allowed", critical_count(F.col("n"), F.col("risk"), level)))
    best = [F.coalesce(*[F.when(F.col(f"k_{r}_{i}") <= F.col("allowed"), F.lit(float(c)))
                         for i, c in sorted(enumerate(cutoffs), key=lambda x: x[1])]).alias(f"cut_{r}")
            for r in RULES]
    return counts.select("stratum", F.col("n").alias("n_good"), "risk", "allowed", *best)


def apply_cutoffs(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with base_failed, the rule that rejected it (NULL: none) and kept."""
    cuts = cutoffs.withColumnRenamed("stratum", "cut_stratum")
    rows = measured.join(cuts, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    rejected = F.coalesce(*[F.when(_ratio(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RULES])
    return (rows.withColumn("base_failed", base_failed())
            .withColumn("rejected_by", rejected)
            .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
            .drop("cut_stratum", "n_good", "risk", "allowed", *[f"cut_{r}" for r in RULES]))


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", risks=RISKS, delta: float = DELTA) -> DataFrame:
    """Measures, base_failed, rejected_by and kept of every row of ``df``."""
    measured = measures(df, id_col, text_col, stratum_col).checkpoint()
    return apply_cutoffs(measured, certified_cutoffs(measured, labels, risks, delta))
