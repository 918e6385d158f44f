"""Host-level quality rules, in built-in functions only.

Each document is measured in one projection over its whole text. Rule failures are summed per host, the hosts' rates
give a beta prior by the method of moments, each rate is shrunk towards it, and a host whose shrunk rate is too high is
rejected: its documents must pass every rule to stay. The documents of other hosts only have to pass the
base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.arrays import let
from tagloom.llm.common import stored

LEAST_WORDS = 50
REPEAT_PERCENT = 50
SYMBOL_PERCENT = 10
LINE_PERCENT = 30
WORD_LENGTH = (3, 12)
HOST_LIMIT = 0.5
PRIOR_MOST = 1e6
SALTS = 32
_BLANKS = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more. Windows are told apart by 64-bit hashes; only texts in which
    one repeats sort them with their places."""

    def places(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(o: Column) -> Column:
            twin = F.filter(
                o,
                lambda x, k: (F.get(o, k + 1)["h"].eqNullSafe(x["h"]))
                | ((k > 0) & F.get(o, F.greatest(k - 1, F.lit(0)))["h"].eqNullSafe(x["h"])),
            )
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        return let(ordered, repeated)

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(places(hashes), covered)).otherwise(0)

    windows = let(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        ),
    )
    return F.when(F.size(words) >= 3, let(windows, count)).otherwise(0)


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` of every row.

    Null texts count as empty: all zero. Repeated rows are measured each.
    """
    text = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.coalesce("text", F.lit("")).alias("t"))
    split = text.select("*", _words(F.col("t")).alias("w"), F.split("t", "\n").alias("l"))
    lines = F.filter("l", lambda x: F.length(F.translate(x, _BLANKS, "")) > 0)
    return split.select(
        "doc_id", "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    )


def rule_failures() -> dict[str, Column]:
    """Each rule as a condition for failing it."""
    n = F.col("n_words")
    return {
        "short": n < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > SYMBOL_PERCENT * n,
        "lines": 100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines"),
        "word_length": (F.col("word_chars") < WORD_LENGTH[0] * n) | (F.col("word_chars") > WORD_LENGTH[1] * n),
    }


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, docs, failures, rate, rejected``: rates shrunk by the empirical beta prior.

    With mean m and variance v of the hosts' rates the prior has the weight m(1 - m)/v - 1, at least 0 and at most
    ``PRIOR_MOST`` (equal rates). A null host is a host of its own.
    """
    failed = F.lit(False)
    for rule in rule_failures().values():
        failed = failed | rule
    hosts = measured.groupBy("host").agg(F.count("*").alias("docs"), F.count_if(failed).alias("failures"))
    share = F.col("failures") / F.col("docs")
    # One row with the two moments, read as a scalar subquery.
    moments = hosts.agg(F.struct(F.avg(share).alias("m"), F.var_pop(share).alias("v")).alias("p")).scalar()
    known = hosts.withColumn("_p", moments)
    m, v = F.col("_p.m"), F.col("_p.v")
    weight = F.least(F.greatest(F.when(v > 0, m * (1 - m) / v - 1).otherwise(PRIOR_MOST), F.lit(0.0)), F.lit(PRIOR_MOST))
    rate = (F.col("failures") + m * weight) / (F.col("docs") + weight)
    return known.select("host", "docs", "failures", rate.alias("rate"), (rate > limit).alias("rejected"))


def quality(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The measures of every row with ``base_failed``, ``host_rejected`` and ``kept``.

    The join with the hosts is salted, so that a host with a third of all rows is spread over ``SALTS`` keys.
    """
    measured = stored(measures(docs, host), "quality")
    rules = rule_failures()
    any_failed = F.lit(False)
    for rule in rules.values():
        any_failed = any_failed | rule
    verdicts = host_verdicts(measured, limit).select(
        F.col("host").alias("_host"), F.col("rejected").alias("host_rejected"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    salted = measured.withColumn("_at", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = salted.join(verdicts, salted["host"].eqNullSafe(verdicts["_host"]) & (F.col("_at") == F.col("_salt")))
    base = rules["short"] | rules["repeats"]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~(F.col("host_rejected") & any_failed)).alias("kept"),
    )


ORACLE = f"""
WITH doc AS (SELECT doc_id, source, coalesce(text, '') AS t,
  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g')) > 0) AS l
  FROM documents),
spot AS (SELECT doc_id, unnest(range(0, len(w) - 2)) AS s, w FROM doc WHERE len(w) >= 3),
win AS (SELECT doc_id, s, w[s + 1] || ' ' || w[s + 2] || ' ' || w[s + 3] AS g FROM spot),
twice AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM twice WHERE c > 1) GROUP BY doc_id),
m AS (SELECT doc.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
  length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines
  FROM doc LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AS base_failed,
  (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words
   OR 100 * n_symbols > {SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {LINE_PERCENT} * n_lines
   OR word_chars < {WORD_LENGTH[0]} * n_words OR word_chars > {WORD_LENGTH[1]} * n_words) AS failed FROM m),
h AS (SELECT source, count(*) AS n, count_if(failed) AS k FROM f GROUP BY source),
p AS (SELECT avg(k / n) AS mean, var_pop(k / n) AS v FROM h),
q AS (SELECT mean, least(greatest(CASE WHEN v > 0 THEN mean * (1 - mean) / v - 1 ELSE {PRIOR_MOST} END, 0), {PRIOR_MOST}) AS weight FROM p),
r AS (SELECT source, (k + mean * weight) / (n + weight) > {HOST_LIMIT} AS rejected FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (rejected AND failed) AS kept
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""
