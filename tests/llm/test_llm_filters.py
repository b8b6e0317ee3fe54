"""Quality rules, toxicity, personal data, URL filter."""

import math
import random
import re
from collections import Counter

from conftest import SF_SMALL
from pyspark.sql import functions as F

from casebook.llm import pii, quality, toxicity, url_filter
from casebook.llm.queries import QUERIES


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules(spark):
    rng = random.Random(1)
    rows = [(0, None), (1, ""), (2, "\x0b\x0c"), (3, "a b c d e f g h " * 5), (None, "é\u00a0ü x"), (3, "twice"), (3, "twice")]
    rows += [(10 + i, "".join(rng.choice(["a", "b ", "é", "\n", " ", "*", "<x> "]) for _ in range(rng.randint(0, 200)))) for i in range(200)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge_quality(df, labels).select("doc_id", *COUNTS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *brute_base(t))) for i, t in rows)
    nothing = quality.judge_quality(df, labels.limit(0))  # no trusted documents: base rules decide
    assert nothing.where(F.col("kept") == F.col("base_failed")).count() == 0
    assert quality.judge_quality(df.limit(0), labels).count() == 0


def test_op3_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op3_quality_rules"](spark, SF_SMALL).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in got} == {i: brute_base(t) for i, t in docs.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels and not r.base_failed]
    assert all(kept for kept, good in judged if good)
    assert sum(not kept for kept, good in judged if not good) >= sum(not good for _, good in judged) - 2


def test_quality_in_a_larger_table(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    trained = labels.where("doc_id % 2 = 0")  # the others are held out
    got = quality.judge_quality(docs, trained).where("not base_failed and n_words >= 40").join(labels, "doc_id").collect()
    for mine in ([r for r in got if r.doc_id % 2 == 0], [r for r in got if r.doc_id % 2]):
        good, bad = [r.kept for r in mine if r.quality == 1], [r.kept for r in mine if r.quality == 0]
        print("kept good", sum(good), len(good), "rejected bad", len(bad) - sum(bad), len(bad))
        assert sum(good) >= 0.99 * len(good)
        assert sum(bad) <= 0.02 * len(bad)


def test_all_trusted_documents_count(spark):
    ids = spark.range(20_005).select(F.col("id").alias("doc_id"))
    labels = ids.withColumns({"quality": F.lit(1), "toxic": F.lit(0)})
    assert quality.trusted_ids(labels.unionAll(labels)).count() == 20_005


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op6_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    caught = [r.predicted for r in scored if r.toxic == 1]
    assert sum(caught) >= 0.75 * len(caught)
    assert sum(r.predicted for r in scored if r.toxic == 0) <= 3


def test_toxicity_odd_rows(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, "", 1.0), (None, "idiot", 1.0), (2, "a b", 1.0), (2, "a b", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels)
    assert [r.score < 1e-9 for r in toxicity.score_documents(df, model).collect()] == [True] * 5
    assert sorted(map(str, toxicity.drop_toxic(df, model).collect())) == sorted(map(str, df.collect()))
    assert toxicity.score_documents(df.limit(0), model).count() == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = pii.digits_of(m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and pii.luhn(d)):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(2)
    parts = ["a", "@", ".", "1", "2", "5", "+", " ", "-", "(", "b.c", "@x.y", "4111111111111111", "1.2.3.4", "é"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("0" * 6000 + ".1.1.1") == [("ip", 0, 6006)]


def test_personal_data(spark):
    card = "4465758382889437"
    rows = [(i, f"see {card} {card} and +1 (663) 555-6869 {card} ok") for i in range(40)] + [(100, None), (101, ""), (None, "no data"), (102, "call +1 (663) 555-6869 now")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.find_personal_data(df, pii.train(df)).collect()}
    assert got[0].n_card == 0 and got[0].spans.count("card:") == 3  # side by side: not in the base
    assert got[102].n_phone == 1 and got[102].spans == "phone:5:22"
    assert got[100].spans == got[101].spans == got[None].spans == ""
    redacted = {r.doc_id: r.text for r in pii.redact_documents(df, pii.train(df)).collect()}
    assert redacted[102] == "call [PHONE] now" and redacted[100] is None and card not in redacted[0]


def test_op7_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op7_pii"](spark, SF_SMALL).collect()}
    for d in docs:
        base = plain_spans(d.text or "")
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        assert set(pii.written(base).split(",")) <= set(r.spans.split(",")) | {""}


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.org/es/1?x#y", "http://a.example.org/en/15", "http://org", "http://xorg/", "http://a.org/", "http://b.com/fr/", "http://b.com/de/x", "http://a.net/en/://x", "x://y://z/", "http://com/fr"]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(None, "http://q.net/", "r")], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute_rule(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or got[i].verdict)
    assert got[0].verdict == got[1].verdict == got[2].verdict == "allow"
    assert {r.verdict for r in url_filter.judge_urls(df.where("page_id in (4, 10)")).collect()} <= {"allow", "block"}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_model_separates_the_ruled(spark):
    got = QUERIES["op10_url_filter"](spark, "/root/testdata/sf0.01").where("rule is not null").collect()
    right = sum((r.lm_score > 0) == (r.verdict == "allow") for r in got)
    assert right >= 0.9 * len(got)


def brute_url_scores(urls):
    """Exact n-gram counts, the longest n-gram seen decides; no cells."""
    top, seen = max(url_filter.ORDERS), Counter()
    pad = lambda u: "\u0002" * (top - 1) + u
    for u in urls:
        verdict = brute_rule(u)[3]
        for i in range(top, len(pad(u)) + 1) if verdict else ():
            for k in url_filter.ORDERS:
                seen[verdict, pad(u)[i - k:i]] += 1
                seen[verdict, "context", k, pad(u)[i - k:i - 1]] += 1

    def p(verdict, gram):
        shorter = p(verdict, gram[1:]) if len(gram) > 1 else 1 / 256
        return (seen[verdict, gram] + url_filter.SMOOTHING * shorter) / (seen[verdict, "context", len(gram), gram[:-1]] + url_filter.SMOOTHING)

    def ratio(gram):
        while gram and not seen["allow", gram] + seen["block", gram]:
            gram = gram[1:]
        return math.log(p("allow", gram) / p("block", gram)) if gram else 0.0

    return {u: sum(ratio(pad(u)[i - top:i]) for i in range(top, len(pad(u)) + 1)) / max(1, len(u)) for u in urls}


def test_url_model_is_exact(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    want = brute_url_scores(list(urls.values()))
    got = QUERIES["op10_url_filter"](spark, sf).collect()
    assert len(got) == len(urls)
    assert max(abs(r.lm_score - want[urls[r.page_id]]) for r in got if r.host) < 0.001


def test_unseen_urls_of_either_class_are_told_apart(spark):
    """Rules hidden for odd page ids: their URLs are judged by models that never saw them."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("url is not null")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    rule = url_filter.longest_rule(host, path)
    truth = F.when(rule.isin([r.text for r in url_filter.RULES if r.verdict == "allow"]), "allow").when(rule.isNotNull(), "block")
    judged = pages.select("page_id", F.col("url").alias("lm_text"), truth.alias("truth")).withColumn("ruled_as", F.when(F.col("page_id") % 2 == 0, F.col("truth")))
    scored, threshold = url_filter.score_urls(judged)
    got = scored.where("page_id % 2 = 1 and truth is not null").select("truth", F.when(F.col("lm_score") < threshold, "block").otherwise("allow").alias("said")).collect()
    for kind in ("allow", "block"):
        own = [r.said == kind for r in got if r.truth == kind]
        assert sum(own) >= 0.97 * len(own), (kind, sum(own), len(own))


def test_urls_without_host_and_long_ones(spark):
    allow = [f"http://a{i}.org/good/page/{i}" for i in range(60)]
    block = [f"http://b{i}.com/de/zzzz/qqqq/{i}" for i in range(60)]
    odd = ["file:///de/zzzz/qqqq/7", "file:///good/page/7", "http://x.net/" + "de/zzzz/qqqq/" * 2000, "no scheme", None, ""]
    rows = [(i, u, 1) for i, u in enumerate([*allow, *block, *odd, odd[0]])]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, lm_score int")).collect()}
    assert len(got) == len(rows)
    said = [got[120 + i].verdict for i in range(7)]
    assert said == ["block", "allow", "block", "allow", "allow", "allow", "block"]
    assert got[120].host == "" and got[120].path == "/de/zzzz/qqqq/7" and got[120].rule is None


def test_null_id_is_not_held_out(spark):
    got = spark.createDataFrame([(None,), (1,)], "doc_id long").select(toxicity.is_held_out(F.col("doc_id")).alias("h")).collect()
    assert got[0].h is False and got[1].h is not None
