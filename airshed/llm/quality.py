"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule is one ratio of a text, from 0 to 1, of which high values are suspect. Labelled texts are the trials: a text counts once for each
stratum (language) whatever the number of its copies and labels, and a hash of the text puts it into one of two halves. The first
half gives each rule its scale: the share of good texts whose ratio is as high or higher, a quantile grid, and beyond the largest good
ratio, below all shares, how far a ratio lies on the way to 1. A document's level is its smallest value on the scales of all rules, so the cutoffs of all rules tighten together along one nested path that doesn't depend on the second half.
The second half certifies: going along the path from the most lenient cutoffs to the strictest, a point is certified if an exact
binomial test shows that all rules together reject less than `risk` of the good texts; the walk ends at the first point that fails
(fixed sequence), which needs no further correction within a stratum. Strata are corrected for by Bonferroni, so with probability
1 - `error` no stratum loses more than `risk` of its good documents. Among the certified points the one that best parts
junk from good texts is taken, the most lenient of equals. A stratum with too few labels certifies nothing and rejects nothing.

Defined cases: null and empty texts have no words and fail the base rule; a null lang is a stratum of its own, together with the
lang ''; labels without doc_id or quality, or for unknown documents, are ignored; several labels for one text
count as its lowest; repeated documents and labels are one trial and are judged alike; empty tables give empty results; other
columns of the input are kept by `filter_documents` whatever their names. Near copies count as trials of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, as_record, once, written

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-ZÀ-ÖØ-Þ]"
SPACE = r"[\x20\x09-\x0D]+"

RISK = 0.05  # share of a stratum's good documents that the rules may reject
ERROR = 0.05  # probability that any stratum loses more
GRID = 1000  # steps of a ratio
LEVELS = 1000  # steps of a level: the path's points are at shares 0/1000, 1/1000, ...
MARGINS = 20  # points of the path before those: parts of the way from a rule's largest good ratio to 1
LONG_WORD = 32  # mean word length at which the ratio of long words is 1
GOOD_WEIGHT = 10  # a rejected good document weighs as much as so many rejected junk documents (as shares)

RULES = ("symbols", "capitals", "dup_lines", "repeats", "adjacent", "long_words", "short_words")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _paired(hashes: Column, span: int) -> Column:
    """Each hash with the one `span` places on."""
    return once(hashes, lambda a: F.transform(a, lambda h, i: F.xxhash64(h, F.get(a, i + span))))


def _window_hashes(words: Column) -> Column:
    """Hash of each window of REPEAT_WINDOW (a power of two) words, from hashes of halves."""
    hashes, span = F.transform(words, lambda w: F.xxhash64(w)), 1
    while span < REPEAT_WINDOW:
        hashes, span = _paired(hashes, span), 2 * span
    return F.slice(hashes, 1, F.size(words) - REPEAT_WINDOW + 1)


def _repeat_words(windows: Column) -> Column:
    """Words in windows found twice or more: equal hashes stand side by side once sorted."""
    found = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    paired = once(found, lambda f: F.filter(F.transform(f, lambda s, k: F.when(
        (s["h"] == F.get(f, k - 1)["h"]) | (s["h"] == F.get(f, k + 1)["h"]), s["i"])), lambda i: i.isNotNull()))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))  # words counted so far, and up to where
    return F.aggregate(
        F.sort_array(paired), start,
        lambda a, i: F.struct((a["n"] + i + REPEAT_WINDOW - F.greatest(i, a["end"])).alias("n"),
                              (i + REPEAT_WINDOW).alias("end")), lambda a: a["n"])


def measured(documents: DataFrame) -> DataFrame:
    """`_row` (all input columns), `doc_id`, `stratum`, `digest` of the text, the COUNTS, one step from 0 to GRID for each rule, `base_failed`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = documents.select(as_record(documents), F.col("doc_id").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
                          text.alias("_text"))
    df = df.withColumns({
        "_words": F.filter(F.split("_text", SPACE), lambda w: w != ""),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD)),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
        "_capitals": F.regexp_count("_text", F.lit(CAPITALS)).cast("long"),
    })
    size = F.size("_words")
    df = df.withColumns({
        "n_words": size.cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "_windows": F.when(size >= REPEAT_WINDOW, _window_hashes(F.col("_words"))),
        "_adjacent": once(F.col("_words"), lambda a: F.size(F.filter(a, lambda w, i: w == F.get(a, i - 1)))),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    df = df.withColumn("n_repeat_words", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        _repeat_words(F.col("_windows"))).otherwise(0).cast("long"))
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    ratios = {
        "symbols": share("n_symbols", "word_chars"), "capitals": share("_capitals", "word_chars"),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.size("_lines"), F.lit(1)), "repeats": share("n_repeat_words", "n_words"),
        "adjacent": share("_adjacent", "n_words"), "long_words": share("word_chars", "n_words") / LONG_WORD,
        "short_words": share("n_words", "word_chars"),
    }
    return df.select(
        "_row", "doc_id", "stratum", F.sha2("_text", 256).alias("digest"), *COUNTS,
        *[F.ceil(F.least(F.lit(1.0), ratios[r]) * GRID).cast("int").alias(r) for r in RULES],
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"))


def binomial_tail(n: Column, k: Column, p: Column) -> Column:
    """P(Binomial(n, p) <= k), exact up to rounding, summed in logarithms; 1 if k >= n * p (never significant)."""
    first = n.cast("double") * F.log1p(-p)
    odds = F.log(p) - F.log1p(-p)

    def add(a: Column, j: Column) -> Column:
        term = a["term"] + F.log((n - j + 1).cast("double") / j.cast("double")) + odds
        return F.struct(term.alias("term"), (F.greatest(a["total"], term)
                                             + F.log1p(F.exp(-F.abs(a["total"] - term)))).alias("total"))

    log_tail = F.aggregate(
        F.when((k > 0) & (k < n * p), F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>")),
        F.struct(first.alias("term"), first.alias("total")), add, lambda a: a["total"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_tail)))


def trials(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum, digest, good, first (whether of the first half), the rules' steps: one row for each labelled text that passes the base rule."""
    label = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.min("quality") > 0).alias("good"))
    seen = judged.where(~F.col("base_failed")).join(label, "doc_id")
    return seen.groupBy("stratum", "digest", *RULES).agg(F.min("good").alias("good")).withColumn("first", F.col("digest") < "8")


def certify(judged: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Cutoffs: stratum, and for each rule the step from which on it rejects (null: it rejects nothing).

    `judged`: rows of `measured`. Only documents that pass the base rule count.
    """
    tried = written(trials(judged, labels), "trials")
    strata = tried.select("stratum").distinct().count()
    steps = F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES]))
    per_rule = tried.select("stratum", "digest", "good", "first", steps)
    by = Window.partitionBy("stratum", "rule")
    counts = per_rule.where("good and first").groupBy("stratum", "rule", "step").agg(F.count(F.lit(1)).alias("_n"))
    rules = tried.select("stratum", F.explode(F.array(*map(F.lit, RULES))).alias("rule")).distinct()
    grid = rules.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(GRID))))
    above = by.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)  # good texts at this step or beyond
    filled = grid.join(counts, ["stratum", "rule", "step"], "left").fillna(0, ["_n"])
    tail = filled.select("stratum", "rule", "step", F.sum("_n").over(above).alias("k"), F.sum("_n").over(by).alias("n"),
                         F.max(F.when(F.col("_n") > 0, F.col("step"))).over(by).alias("top"))
    beyond = F.expr(f"-(((step - top) * {MARGINS}) div ({GRID} - top))")
    level = F.when(F.col("k") > 0, F.ceil(F.col("k") * LEVELS / F.col("n"))).otherwise(beyond).cast("int")
    tail = written(tail.where("n > 0").select("stratum", "rule", "step", level.alias("level")), "levels")
    levels = per_rule.where("not first").join(tail, ["stratum", "rule", "step"]).groupBy("stratum", "digest", "good").agg(F.min("level").alias("level"))
    tally = levels.groupBy("stratum", "level").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("junk"))
    points = tally.select("stratum").distinct().withColumn("level", F.explode(F.sequence(F.lit(-MARGINS), F.lit(LEVELS))))
    full = points.join(tally, ["stratum", "level"], "left").fillna(0, ["good", "junk"])
    whole = Window.partitionBy("stratum")
    upto = whole.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)  # texts that this point rejects
    cut = full.select("stratum", "level", F.sum("good").over(whole).alias("n"), F.sum("junk").over(whole).alias("n_junk"),
                      F.sum("good").over(upto).alias("k"), F.sum("junk").over(upto).alias("k_junk"))
    passed = cut.withColumn("ok", binomial_tail(F.col("n"), F.col("k"), F.lit(risk)) <= F.lit(error / max(1, strata)))
    certified = passed.withColumn("all_ok", F.min("ok").over(upto)).where("all_ok")
    worth = F.col("k_junk") / F.greatest("n_junk", F.lit(1)) - GOOD_WEIGHT * F.col("k") / F.greatest("n", F.lit(1))
    best = certified.groupBy("stratum").agg(F.max(F.struct(worth.alias("worth"), (-F.col("level")).alias("lenient"))).alias("best"))
    point = best.select("stratum", (-F.col("best.lenient")).alias("_point"))
    within = tail.join(point, "stratum").where(F.col("level") <= F.col("_point"))
    return within.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("step"))).alias(f"cut_{r}") for r in RULES])


def verdict(judged: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """`judged` with `kept`: passes the base rule and no certified cutoff rejects it."""
    cutoffs = written(cutoffs.withColumnRenamed("stratum", "_stratum"), "cutoffs")
    rejected = [F.coalesce(F.col(r) >= F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    joined = judged.join(cutoffs, F.col("stratum") == F.col("_stratum"), "left")
    any_rejected = rejected[0]
    for r in rejected[1:]:
        any_rejected = any_rejected | r
    return joined.withColumn("kept", ~F.col("base_failed") & ~any_rejected).select(*judged.columns, "kept")


def judge(documents: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per document: doc_id, stratum, digest, COUNTS, the rules' steps, base_failed, kept."""
    rows = written(measured(documents.select("doc_id", "text", "lang")).drop("_row"), "quality")
    return verdict(rows, certify(rows, labels, risk, error))


def filter_documents(documents: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """`documents` (same columns) without those that the rules reject; texts are not shuffled."""
    rows = written(measured(documents.select("doc_id", "text", "lang")).drop("_row"), "quality")
    judged = verdict(measured(documents), certify(rows, labels, risk, error))
    # explode of a null gives no row; a filter would be pushed below the measures and compute them twice
    kept = judged.select(F.explode(F.when(F.col("kept"), F.array("_row"))).alias("_row"))
    return kept.select(*[F.col(f"_row.`{c}`") for c in documents.columns])
