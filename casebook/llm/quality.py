"""Quality rules: hashed n-gram log-likelihood ratio of two multinomials (native).

Every text is cut into word and punctuation tokens. Their uni- and bigrams, by 64-bit
hash, are counted over the whole corpus and over a trusted target (documents labelled
as good). A document's score is the mean over its n-grams of ln p_target - ln p_raw; it
is rejected below a threshold set where the labelled good and bad documents' scores lie
equally many standard deviations away. Simple base rules (too short, too repetitive)
come first.

Only DataFrame functions are used. The counts are tables that grow with the distinct
n-grams. They are worked through in ``SLICES``, each a pass over the texts, which bounds
the disk that shuffles take. N-grams used once in the whole corpus are counted but not
kept, as their ratio follows from their document. The ratios of the at most ``FREQUENT``
most frequent are broadcast; a document's other n-grams meet theirs by a shuffle. Up to
``TRUSTED_BROADCAST`` trusted ids are broadcast, so that texts stay in place; more are
joined by a shuffle. None of these numbers has a part in the results.

Defined results: null and empty texts have no words and fail the base rules; repeated
rows are judged alike; without a trusted document no ratio can be formed and the base
rules alone decide; without labelled documents of both kinds ``THRESHOLD`` holds.
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from casebook.llm.common import id_text, stage
from casebook.llm.url_filter import calibrated_threshold
from casebook.plans.broadcast import broadcast_if_small

THRESHOLD = -0.5  # nats per n-gram, where labels can't set one
MIN_WORDS = 20
WINDOW = 8  # a power of two
MAX_REPEAT_PERCENT = 30
SLICES = 3
FREQUENT = 1 << 19
TRUSTED_BROADCAST = 1 << 20
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

GAP = r"[\x09-\x0D]"  # but for the space
NO_GAP = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def count_of_chars(text: Column, chars: str) -> Column:
    return F.size(F.split(text, f"[{chars}]")) - 1


def duplicate_lines(text: Column) -> Column:
    r"""Lines (split at \n) with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(NO_GAP))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


# The arrays below are columns of their own: a lambda that looks into an array finds it
# made, where an expression in its place would be evaluated anew for each element.
def joined_hashes(hashes: str, step: int) -> Column:
    """Of each hash with the one ``step`` places on, hashed together; the last ``step`` have none."""
    h = F.col(hashes)
    return F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))), F.slice(h, 1 + step, F.size(h)), lambda a, b: F.xxhash64(a, b))


def window_hashes(docs: DataFrame, word_hashes: str) -> DataFrame:
    """With ``hashes_``, a hash of each window of ``WINDOW`` words: those of 2 words, of them those of 4 and so on."""
    docs, step = docs.withColumn("hashes_", F.col(word_hashes)), 1
    while step < WINDOW:
        docs, step = docs.withColumn("hashes_", joined_hashes("hashes_", step)), 2 * step
    return docs


def sorted_if_repeated(hashes: str) -> Column:
    """(hash, position) sorted, which puts equal windows side by side; empty if all differ."""
    h = F.col(hashes)
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def repeat_starts(by_hash: str) -> Column:
    """Positions (from 0) of the windows found twice or more, ascending."""
    s = F.col(by_hash)
    twice = lambda x, j: (F.get(s, j + 1)["h"] == x["h"]) | (F.when(j > 0, F.get(s, j - 1)["h"]) == x["h"])
    at = F.transform(s, lambda x, j: F.when(F.coalesce(twice(x, j), F.lit(False)), x["i"]))
    return F.sort_array(F.filter(at, lambda i: i.isNotNull()))


def covered_words(starts: str) -> Column:
    """Words inside the windows at ``starts``: each adds what the next doesn't cover."""
    s = F.col(starts)
    own = F.transform(s, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - x, F.lit(WINDOW))))
    return F.aggregate(own, F.lit(0), lambda a, x: a + x).cast("long")


def base_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the counts of the base rules with ``base_failed``."""
    text = F.col("text")
    # What needs the text comes first: each step with a lambda copies its whole rows.
    counted = docs.withColumn("spaced_", F.regexp_replace(text, GAP, F.lit(" ")))  # as long as the text
    counted = counted.withColumn("split_", F.split("spaced_", " "))
    counted = counted.withColumns({
        "words_": F.transform(F.array_remove("split_", ""), lambda w: F.xxhash64(w)),
        "word_chars": (F.length("spaced_") - F.size("split_") + 1).cast("long"),
        "n_symbols": count_of_chars(text, SYMBOLS).cast("long"),
        "n_dup_lines": duplicate_lines(text),
    })
    counted = counted.withColumn("n_words", F.size("words_").cast("long"))
    counted = window_hashes(counted, "words_")
    counted = counted.withColumn("sorted_", sorted_if_repeated("hashes_"))
    counted = counted.withColumn("starts_", repeat_starts("sorted_"))
    counted = counted.withColumn("n_repeat_words", covered_words("starts_"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.drop("spaced_", "split_", "words_", "hashes_", "sorted_", "starts_").withColumn("base_failed", failed)


def token_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))


def document_ngrams(docs: DataFrame, part: int | None = None) -> DataFrame:
    """``key, gram``, a row for each use of a uni- or bigram: of all, or of those whose
    first token's hash falls into slice ``part``."""
    own = [c for c in docs.columns if c != "text"]
    hashed = docs.withColumn("token", token_hashes(F.col("text")))
    hashed = hashed.withColumn("next", F.slice("token", 2, F.size("token")))
    pairs = hashed.select(*own, F.explode(F.arrays_zip("token", "next")).alias("pair")).select(*own, "pair.token", "pair.next")
    if part is not None:
        pairs = pairs.where(F.pmod("token", F.lit(SLICES)) == part)
    bigram = F.when(F.col("next").isNotNull(), F.xxhash64("token", "next"))
    return pairs.select(*own, F.stack(F.lit(2), F.col("token"), bigram).alias("gram")).where("gram is not null")


@contextmanager
def shuffles_dropped(spark):
    """Shuffle files of what is written inside go at its end: nothing reads them again."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled good."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def ngram_counts(docs: DataFrame, trusted: DataFrame) -> tuple[list[DataFrame], int, int, int]:
    """For each slice ``gram, raw, target`` of the n-grams used twice or more; over all
    n-grams the sums of ``raw`` and ``target`` and their number. Every document counts,
    as target or not.
    """
    ids = broadcast_if_small(trusted, TRUSTED_BROADCAST)  # more of them: a shuffle join, which moves the texts
    flagged = docs.join(ids.withColumn("trusted", F.lit(True)), "doc_id", "left").select("trusted", "text")
    repeated, totals = [], []
    for part in range(SLICES):
        seen = Observation()
        counts = document_ngrams(flagged, part).groupBy("gram").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target"))
        counts = counts.observe(seen, F.sum("raw").alias("raw"), F.sum("target").alias("target"), F.count(F.lit(1)).alias("distinct"))
        repeated.append(stage(counts.where("raw > 1"), "quality-ngrams"))
        totals.append(seen.get)
    return repeated, *(sum(t.get(k) or 0 for t in totals) for k in ("raw", "target", "distinct"))


def least_frequent(counts: DataFrame) -> int:
    """The least ``raw`` with at most ``FREQUENT`` n-grams from it on, among 8 a doubling."""
    steps = counts.groupBy(F.floor(8 * F.log2("raw")).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("least")).collect()  # 504 at most
    least, held = 1 << 62, 0
    for s in sorted(steps, key=lambda s: -s["step"]):
        held += s["n"]
        if held > FREQUENT:
            break
        least = s["least"]
    return least


def ratio_scores(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``key, llr_trusted, llr_other``: mean ratio over a text's n-grams, ln p_target - ln p_raw of
    each in thousandths, with add-one smoothing over the distinct n-grams. Whole numbers
    are added, so their order doesn't matter. Texts alike share a key: their mean is that
    of each. An n-gram without a row in the counts is used once: its ratio depends on
    whether its document is trusted, hence two means. No rows without a trusted document.
    """
    counts, raw, target, distinct = ngram_counts(docs, trusted)
    if not target:
        return docs.select("key", *[F.lit(0.0).alias(c) for c in ("llr_trusted", "llr_other")]).where(F.lit(False))
    p = lambda c, total: F.log((c + 1) / F.lit(float(total + distinct)))
    ratio = lambda t, r: F.round(1000 * (p(t, target) - p(r, raw))).cast("long")
    every = reduce(DataFrame.unionAll, counts)
    least = least_frequent(every)
    ratios = lambda rows: rows.select("gram", ratio(F.col("target"), F.col("raw")).alias("ratio"))
    frequent = lambda rows: F.broadcast(ratios(rows.where(F.col("raw") >= least)))
    added = [F.sum("ratio").alias("sum"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("ratio").isNull()).alias("once")]
    texts = docs.select("key", "text")
    parts = [document_ngrams(texts).join(frequent(every), "gram").groupBy("key").agg(*added)]
    for part, own in enumerate(counts):
        rare = document_ngrams(texts, part).join(frequent(own), "gram", "left_anti")
        others = ratios(own.where(F.col("raw") < least))
        parts.append(stage(rare.join(others.hint("merge"), "gram", "left").groupBy("key").agg(*added), "quality-sums"))
    total = reduce(DataFrame.unionAll, parts).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("sum", "n", "once")])
    once = lambda t: F.col("once") * ratio(F.lit(t), F.lit(1))
    mean = lambda t: (F.coalesce("sum", F.lit(0)) + once(t)) / (1000 * F.col("n"))
    return total.select("key", mean(1).alias("llr_trusted"), mean(0).alias("llr_other"))


def labelled_threshold(judged: DataFrame, labels: DataFrame) -> Column:
    """From the scores of the labelled documents that pass the base rules; null without both kinds."""
    known = labels.where("quality in (0, 1)").select("doc_id", (F.col("quality") == 1).alias("accepted"))
    return calibrated_threshold(judged.where(~F.col("base_failed")).select("doc_id", F.col("llr").alias("lm_score")).join(known, "doc_id"))


def judge_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """Base counts, ``base_failed``, ``llr`` and ``kept`` for every document; without a
    ``threshold`` the labels set it."""
    docs = id_text(documents, id_col, text_col)
    docs = docs.withColumn("key", F.xxhash64("text"))
    trusted = stage(trusted_ids(labels), "quality-trusted")
    with shuffles_dropped(documents.sparkSession):
        scores = ratio_scores(docs, trusted)
        judged = base_rules(docs).drop("text").join(scores, "key", "left").join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left")
        llr = F.coalesce(F.when(F.col("trusted"), F.col("llr_trusted")).otherwise(F.col("llr_other")), F.lit(0.0))
        judged = stage(judged.withColumn("llr", llr).drop("key", "trusted", "llr_trusted", "llr_other"), "quality-scored")
    least = F.lit(threshold) if threshold is not None else F.coalesce(labelled_threshold(judged, labels), F.lit(THRESHOLD))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= least))
