"""Quality rules with verdicts on whole hosts, in DataFrame expressions only (operator 1).

Counts per document come from one projection. Failures are summed by host, a beta prior is fitted to the hosts' rates
by moments, and each host's rate is shrunk towards it: a host with few documents needs the support of the others
before it is rejected. Verdicts return to the documents by a join with the rejected hosts alone.

Defined cases. Null or empty texts have no words and fail. Documents without a host are judged by their own text.
A repeated row counts as often as it stands there. An empty table gives an empty result. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.session import materialise

from .batches import fresh

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MAX_HOST_RATE = 0.5          # shrunk failure rate beyond which a host's documents go
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more, from the word hashes of a text."""
    width = range(1, WINDOW)
    windows = F.transform(F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
                          lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in width]))

    def covered(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(ordered, lambda o: F.array_sort(F.transform(
            F.filter(o, lambda s, k: F.coalesce(s["h"] == F.get(o, k - 1)["h"], F.lit(False))
                     | F.coalesce(s["h"] == F.get(o, k + 1)["h"], F.lit(False))), lambda s: s["i"])))
        return let(again, lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, n: a + n))

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))


def text_counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.filter(F.split(whole, BLANKS), lambda w: w != ""), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.transform(words, lambda w: F.xxhash64(w)), _repeated).alias("n_repeat_words")))


def fails(counts: Column) -> Column:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def prior(hosts: int, docs: int, mean: float, square: float) -> tuple[float, float]:
    """Mean of the beta prior and its weight in documents. The spread of the hosts' rates beyond what chance
    adds is that of their true rates; without any, hosts share one rate and the prior outweighs them."""
    chance, spread = mean * (1 - mean), square - mean * mean
    excess = spread - chance * hosts / docs
    return mean, 1e6 if excess <= 0 else min(1e6, max(1.0, (chance - spread) / excess))


def host_rates(failures: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n, k, rate): documents, failures and shrunk failure rate of each host."""
    hosts = failures.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(failed)).alias("k"))
    hosts = materialise(hosts, "hosts")
    moments = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("docs"), (F.sum("k") / F.sum("n")).alias("mean"),
                        (F.sum(F.col("k") * F.col("k") / F.col("n")) / F.sum("n")).alias("square")).first()
    mean, weight = prior(moments["hosts"], moments["docs"] or 1, moments["mean"] or 0.0, moments["square"] or 0.0)
    return hosts.select("host", "n", "k", ((F.col("k") + mean * weight) / (F.col("n") + weight)).alias("rate"))


def judged(df: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None,
           counts: str = "counts", failed: str = "failed", rejected: str = "host_rejected") -> DataFrame:
    """The ``carry`` columns (all) of ``df`` with the text's counts, whether it fails and whether its host is rejected."""
    (key, other) = fresh(df, "quality_host", "rejected_host")
    columns = [F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]
    counted = df.select(*columns, F.col(host).alias(key), text_counts(F.col(text)).alias(counts))
    counted = materialise(counted, "quality").withColumn(failed, fails(F.col(counts)))
    bad = host_rates(counted, key, failed).filter(F.col("rate") > MAX_HOST_RATE).select(F.col("host").alias(other))
    bad = materialise(bad, "rejected-hosts")       # the planner knows its size and broadcasts it only if that is small
    return counted.join(bad, F.col(key) == F.col(other), "left").withColumn(
        rejected, F.col(other).isNotNull()).drop(key, other)


def keep_good(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``df`` that pass the rules and whose host does, with the columns of ``df``."""
    counts, failed, rejected = fresh(df, "counts", "failed", "host_rejected")
    found = judged(df, text, host, counts=counts, failed=failed, rejected=rejected)
    return found.filter(~F.col(failed) & ~F.col(rejected)).select([F.col(f"`{c}`") for c in df.columns])


def quality_rows(df: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed and kept."""
    found = judged(df.select("doc_id", "text", "source"), carry=["doc_id"])
    return found.select("doc_id", "counts.*", F.col("failed").alias("base_failed"),
                        (~F.col("failed") & ~F.col("host_rejected")).alias("kept"))


SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
again AS (SELECT doc_id, win FROM places GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT j) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM places JOIN again USING (doc_id, win)) GROUP BY doc_id),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
    SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS k FROM base WHERE source IS NOT NULL GROUP BY source),
moments AS (
    SELECT count(*) AS hosts, sum(n) AS docs, sum(k) / sum(n) AS mean,
           sum(k * k / n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) AS spread FROM hosts),
prior AS (
    SELECT mean, CASE WHEN spread - mean * (1 - mean) * hosts / docs <= 0 THEN 1e6
        ELSE least(1e6, greatest(1.0, (mean * (1 - mean) - spread) / (spread - mean * (1 - mean) * hosts / docs))) END AS weight
    FROM moments),
rejected AS (SELECT source FROM hosts, prior WHERE (k + mean * weight) / (n + weight) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r.source IS NULL AS kept
FROM base LEFT JOIN rejected r ON base.source = r.source
"""
