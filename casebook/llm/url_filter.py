"""URL filter: host and path rules, then a character language-model ratio (native).

URLs that a rule accepts or rejects train two smoothed variable-order Markov models
over characters. A URL that no rule fits is judged by the difference of the two
log-likelihoods per character. The threshold comes from ruled URLs that a second pair
of models, trained without them, has scored: a quarter of the distinct URLs, by hash. The
models that trained on a URL would score it too far from the other class.

All work is DataFrame functions. Counts are kept by the n-gram itself, in tables that
grow with the distinct n-grams: every position has one n-gram of each length and the
shorter ones are its ends, so one pass counts the longest and the others are sums of
those. A URL's score joins its n-grams with the log-ratios; each distinct URL is scored
once.

Defined results: a null URL or one without ``://`` has empty host and path and is no
address: its score is 0 and it is allowed. One with ``://`` but an empty host
(``file:///a``) fits no rule and is judged by the models. When either class has no URL, no
model can be built and every unruled URL is allowed; when either has none held out, the
scores of the URLs trained on set the threshold. Rows are judged one by one, so repeated
rows and null ids keep their own result; an empty table gives no rows. A very long URL is a
row for each character while it is scored, and no more in memory than one n-gram array.
Only the two named columns are read, so further columns of any name change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import stage

ORDERS = (1, 2, 3, 4, 5)  # n-gram lengths; the longest seen one predicts
SMOOTHING = 4.0  # weight of the shorter context's prediction
FOLDS = 4  # one of them is held out to set the threshold
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest fitting rule's text, or null."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.lit(r.text)).otherwise(found)
    return found


def _grams(text: Column) -> Column:
    """The longest n-gram that ends at each character; start marks give every character
    a context of every length."""
    longest = max(ORDERS)
    padded = F.concat(F.lit("\u0002" * (longest - 1)), text)
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, F.lit(longest)))).otherwise(F.array().cast("array<string>"))


def url_grams(judged: DataFrame) -> DataFrame:
    """``u1, u2, gram, n, acc, rej``: the longest n-grams of each distinct URL and how
    often it was accepted and rejected; u1 and u2 are two hashes of the URL."""
    distinct = judged.groupBy("u1", "u2", "lm_text").agg(F.count_if(F.col("ruled_as") == "allow").alias("acc"), F.count_if(F.col("ruled_as") == "block").alias("rej"))
    return (distinct.select("u1", "u2", "acc", "rej", F.explode(_grams(F.col("lm_text"))).alias("gram"))
            .groupBy("u1", "u2", "gram", "acc", "rej").agg(F.count(F.lit(1)).alias("n")))


def held_out(u1: str = "u1") -> Column:
    """Whether a distinct URL, by its hash, takes no part in training the second models."""
    return F.pmod(F.col(u1), F.lit(FOLDS)) == 0


def gram_counts(grams: DataFrame, training: Column) -> DataFrame:
    """``gram, acc, rej``: uses of each n-gram by the URLs of ``training``; n-grams of other
    URLs are there with 0."""
    uses = lambda c: F.sum(F.when(training, F.col("n") * F.col(c)).otherwise(0))
    return grams.groupBy("gram").agg(uses("acc").alias("acc"), uses("rej").alias("rej"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram, ratio`` for every longest n-gram: ln p(char | context), accepted less
    rejected, in thousandths (whole numbers make a score independent of the order of
    addition), by the longest of its ends that a ruled URL has; 0 without any.

    An order's probability is its relative frequency smoothed by the next shorter
    order's: (n(context, char) + s * p_shorter) / (n(context) + s). ``counts`` has the
    uses ``acc`` and ``rej`` of each longest n-gram, also of those that only unruled
    URLs have.
    """
    classes, by_order = ("acc", "rej"), {max(ORDERS): counts}
    for k in reversed(ORDERS[:-1]):
        by_order[k] = by_order[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*[F.sum(c).alias(c) for c in classes])
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in classes]).first()
    shorter = None
    for k in ORDERS:
        t = by_order[k]
        if shorter is None:
            t = t.withColumns({f"n_{c}": F.lit(total[c]) for c in classes} | {f"q_{c}": F.lit(1.0 / 256) for c in classes} | {"back": F.lit(0.0)})
        else:
            t = t.withColumns({"context": F.substring("gram", 1, k - 1), "end": F.expr("substring(gram, 2)")})
            contexts = t.groupBy("context").agg(*[F.sum(c).alias(f"n_{c}") for c in classes])
            t = t.join(contexts, "context").join(shorter, "end")
        t = t.withColumns({f"p_{c}": (F.col(c) + SMOOTHING * F.col(f"q_{c}")) / (F.col(f"n_{c}") + SMOOTHING) for c in classes})
        t = t.withColumn("ratio", F.when(F.col("acc") + F.col("rej") > 0, F.log(F.col("p_acc") / F.col("p_rej"))).otherwise(F.col("back")))
        shorter = t.select(F.col("gram").alias("end"), *[F.col(f"p_{c}").alias(f"q_{c}") for c in classes], F.col("ratio").alias("back"))
    return shorter.select(F.col("end").alias("gram"), F.round(F.col("back") * 1000).cast("long").alias("ratio"))


def lm_scores(grams: DataFrame, ratios: DataFrame) -> DataFrame:
    """``u1, u2, lm_score``: mean over a URL's characters of the log-ratio."""
    total = grams.join(ratios, "gram").groupBy("u1", "u2").agg(F.sum(F.col("n") * F.col("ratio")).alias("sum"), F.sum("n").alias("n"))
    return total.select("u1", "u2", (F.col("sum") / (1000 * F.col("n"))).alias("lm_score"))


def calibrated_threshold(scored: DataFrame) -> Column:
    """Where the two classes' scores lie equally many standard deviations away."""
    a, r = F.col("accepted"), ~F.col("accepted")
    s = scored.agg(*[f(F.when(c, F.col("lm_score"))).alias(n) for c, n, f in (
        (a, "ma", F.avg), (r, "mr", F.avg), (a, "sa", F.stddev_pop), (r, "sr", F.stddev_pop))])
    # A class without rows makes it null.
    weighed = (F.col("ma") * (F.col("sr") + 1e-9) + F.col("mr") * (F.col("sa") + 1e-9)) / (F.col("sa") + F.col("sr") + 2e-9)
    return F.lit(s.select(weighed.alias("t")).first()[0]).cast("double")


def ruled(scored: DataFrame) -> DataFrame:
    """``accepted`` and ``lm_score`` of the rows that a rule decides."""
    return scored.where(F.col("ruled_as").isNotNull()).select("lm_score", (F.col("ruled_as") == "allow").alias("accepted"))


def held_out_threshold(scored: DataFrame, grams: DataFrame) -> Column:
    """From ruled URLs that the models which score them here haven't seen; null where either
    class has none. Only n-grams of the URLs in question and of those trained on are kept."""
    asked = held_out() & (F.col("acc") + F.col("rej") > 0)
    training = ~held_out() & (F.col("acc") + F.col("rej") > 0)
    counts = stage(gram_counts(grams.where(asked | training), training), "url-held-out-counts")
    scores = lm_scores(grams.where(asked), log_ratios(counts))
    return calibrated_threshold(ruled(scored.drop("lm_score").where(held_out()).join(scores, ["u1", "u2"])))


def score_urls(judged: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with ``lm_score`` in place of ``lm_text``, and the threshold. ``ruled_as`` says
    how a row trains the models: allow, block, or (null) not at all."""
    judged = judged.withColumns({"u1": F.xxhash64("lm_text"), "u2": F.xxhash64(F.lit(1), "lm_text")})
    grams = stage(url_grams(judged), "url-ngrams")
    counts = stage(gram_counts(grams, F.lit(True)), "url-counts")
    scored = judged.drop("lm_text").join(lm_scores(grams, log_ratios(counts)), ["u1", "u2"], "left")
    scored = stage(scored.withColumn("lm_score", F.coalesce("lm_score", F.lit(0.0))), "url-scored")
    return scored, F.coalesce(held_out_threshold(scored, grams), calibrated_threshold(ruled(scored)))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, lm_score``: the longest fitting rule's
    verdict, else the language models'."""
    url = F.col(f"`{url_col}`").cast("string")
    judged = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.coalesce(url, F.lit("")).alias("lm_text"),
                          F.coalesce(F.instr(url, "://") > 0, F.lit(False)).alias("is_url"))
    judged = judged.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    by_text = {r.text: r.verdict for r in rules}
    ruled_as = F.lit(None).cast("string")
    for text, verdict in by_text.items():
        ruled_as = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(ruled_as)
    judged = judged.withColumn("ruled_as", ruled_as)

    scored, threshold = score_urls(judged)
    lm_score = F.when(F.col("is_url"), F.col("lm_score")).otherwise(0.0)
    # Without both classes the threshold is null: allow.
    by_model = F.when(F.col("is_url") & (F.col("lm_score") < threshold), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled_as", by_model).alias("verdict"), lm_score.alias("lm_score"))
