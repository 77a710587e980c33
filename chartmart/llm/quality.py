"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A document fails the base if it has fewer than 50 words or more than half of its words
stand in three-word windows that the text holds twice. Beyond it, each rule rejects a
document if its statistic, in hundredths, is over the rule's cutoff for the document's
stratum (its language):

* ``symbols``: characters of ``[#*$%&|<>]`` to characters in words;
* ``capitals``: upper-case letters to characters in words;
* ``lines``: lines that repeat an earlier one to lines with words;
* ``repeats``: words in repeated three-word windows to words.

Cutoffs come from the labelled documents, held out for this purpose. For a stratum with
``n`` good documents that pass the base, ``k`` of them over a cutoff, the cutoff is
certified if ``P(Bin(n, risk / rules) <= k) <= doubt / (rules * strata)``: by the exact
binomial bound and the union bound over rules and strata, with confidence ``1 - doubt``
no stratum rejects more than ``risk`` of its good documents. As ``k`` only grows with a
stricter cutoff, the tests of one rule are a fixed sequence from the laxest cutoff and need no further
correction. Of the certified cutoffs, the one with the most bad less good documents over
it is taken, and of equals the laxest; a stratum with too few labels to certify any, or without
bad documents over any, has no cutoff for the rule.

The labels are joined to the counts of the documents, never to their texts, and summed by
(stratum, rule, hundredth) before the shuffle; all that follows is as small as that table.

Defined cases: a null text has no words and fails the base; a null language is a stratum
of its own; a label without a document, or null, counts for nothing; several labels of
one document count as the best; rows that share an id are judged each by its own text, but
count once with the label (by the least text hash), and documents of one text in a stratum
count once with the best label of theirs, as the bound is on independent trials; other
columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmart.session import stage

from . import text as T
from .sqlmath import binomial_tail, let

RISK = 0.02  # most of a stratum's good documents that the rules may reject
DOUBT = 0.05  # chance that some stratum's bound does not hold
RULES = ("symbols", "capitals", "lines", "repeats")
MIN_WORDS = 50
MAX_REPEATS = 50


def _repeated(words: Column) -> Column:
    """Words in three-word windows that the array holds twice or more."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def twice(s: Column) -> Column:
            n = F.size(s)
            at = F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.when(j > 0, s[j]["w"] == s[F.greatest(j - 1, F.lit(0))]["w"]).otherwise(False)
                          | F.when(j < n - 1, s[j]["w"] == s[F.least(j + 1, n - 1)]["w"]).otherwise(False))
            return F.size(F.array_distinct(F.flatten(F.transform(at, lambda j: F.array(s[j]["i"], s[j]["i"] + 1, s[j]["i"] + 2)))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(placed, twice))

    windows = F.transform(F.sequence(F.lit(2), F.size(words) - 1), lambda i: F.concat_ws(" ", words[i - 2], words[i - 1], words[i]))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, covered))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``_q``, a struct of the counts that the rules use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = let(F.regexp_extract_all(text, F.lit(T.WORD), F.lit(0)), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("repeats")))
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(T.WORD)),
                lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    out = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), text.alias("_t"), words.alias("_w"), lines.alias("_l"))
    text, n = F.col("_t"), F.length("_t")
    return out.select("row", F.struct(
        F.col("_w.n").cast("long").alias("n_words"), _without(text, T.SPACE).cast("long").alias("word_chars"),
        (n - _without(text, r"[#*$%&|<>]")).cast("long").alias("n_symbols"), F.col("_l.dup").cast("long").alias("n_dup_lines"),
        F.col("_w.repeats").cast("long").alias("n_repeat_words"), F.col("_l.n").cast("long").alias("n_lines"),
        (n - _without(text, r"\p{Lu}")).cast("long").alias("n_capitals"), F.md5(text).alias("text_md5")).alias("_q"))


def _base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEATS * q["n_words"])


def _statistics(q: Column) -> dict[str, Column]:
    """Each rule's statistic in hundredths, rounded up, at most 100."""
    def share(a: str, b: str) -> Column:
        return F.least(F.expr(f"({q_name}.{a} * 100 + greatest({q_name}.{b}, 1) - 1) div greatest({q_name}.{b}, 1)"), F.lit(100))

    q_name = "_q"
    return {"symbols": share("n_symbols", "word_chars"), "capitals": share("n_capitals", "word_chars"),
            "lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words")}


def cutoffs(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang",
            risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """``_stratum`` and a cutoff column for each rule (101 where none is certified)."""
    good = labels.where("quality is not null").groupBy(F.col("doc_id").alias("_label")).agg(F.max("quality").alias("_good"))
    own = counted.where(~_base_failed(F.col("_q"))).select(
        F.col("row")[id_col].alias("_label"), F.coalesce(F.col("row")[stratum_col], F.lit("")).alias("_stratum"), F.col("_q.text_md5").alias("_md5"),
        F.array(*[F.struct(F.lit(k).alias("rule"), v.cast("int").alias("at")) for k, v in _statistics(F.col("_q")).items()]).alias("_s"))
    # the bound is on independent trials: a labelled id counts once, and so does a text, whatever its copies
    once = own.join(good, "_label").groupBy("_stratum", "_label").agg(F.min(F.struct("_md5", "_s", "_good")).alias("x")).select("_stratum", "x.*")
    once = once.groupBy("_stratum", "_md5").agg(F.max("_good").alias("_good"), F.first("_s").alias("_s"))
    held = once.select("_stratum", "_good", F.explode("_s").alias("_s")).groupBy(
        "_stratum", F.col("_s.rule").alias("rule"), F.col("_s.at").alias("at")).agg(
        F.sum(F.when(F.col("_good") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("_good") == 1, 0).otherwise(1)).alias("bad"))
    held = stage(held, "held_out")
    each = Window.partitionBy("_stratum", "rule")
    grid = held.select("_stratum", "rule").distinct().withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(100))))
    over = each.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    table = grid.join(held, ["_stratum", "rule", "at"], "left").select(
        "_stratum", "rule", "at", F.sum("good").over(each).alias("n"),
        F.coalesce(F.sum("good").over(over), F.lit(0)).alias("k"), F.coalesce(F.sum("bad").over(over), F.lit(0)).alias("gain"))
    table = table.crossJoin(held.agg(F.greatest(F.count_distinct("_stratum"), F.lit(1)).alias("_strata")))  # one row
    tail = binomial_tail(F.col("n"), F.col("k"), risk / len(RULES))
    certified = table.where("gain > k").where(tail <= doubt / (len(RULES) * F.col("_strata")))
    best = certified.groupBy("_stratum", "rule").agg(F.max(F.struct(F.col("gain") - F.col("k"), "at"))["at"].alias("cutoff"))
    return best.groupBy("_stratum").pivot("rule", list(RULES)).agg(F.first("cutoff")).select(
        "_stratum", *[F.coalesce(F.col(r), F.lit(101)).alias(f"_cut_{r}") for r in RULES])


def judged(counted: DataFrame, cut: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``row, _q, base_failed, kept`` of every row of ``counts``; ``cut`` has a row per stratum."""
    rows = counted.withColumn("_stratum", F.coalesce(F.col("row")[stratum_col], F.lit(""))).join(cut, "_stratum", "left")
    over = [F.coalesce(v > F.col(f"_cut_{k}"), F.lit(False)) for k, v in _statistics(F.col("_q")).items()]
    failed = _base_failed(F.col("_q"))
    kept = ~failed
    for rule in over:
        kept = kept & ~rule
    return rows.select("row", "_q", failed.alias("base_failed"), kept.alias("kept"))


def _counted(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """Counts without texts, written once: as narrow as the ids."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("lang"), F.col(text_col).alias("text"))
    return stage(counts(own).withColumn("row", F.col("row").dropFields("text")), "counts")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **options) -> DataFrame:
    """``row`` (id as ``doc_id`` and stratum as ``lang``), ``_q``, ``base_failed`` and ``kept`` of every document."""
    counted = _counted(docs, id_col, text_col, stratum_col)
    return judged(counted, cutoffs(counted, labels, **options))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Each text is counted once; rows meet their verdict by id, text
    hash and stratum, which rows with equal verdicts may share."""
    key = [F.coalesce(F.col(id_col).cast("long"), F.lit(T.NO_ID)).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"),
           F.coalesce(F.col(stratum_col), F.lit("")).alias("_st")]
    own = docs.select(*key, F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("lang"), F.col(text_col).alias("text"))
    counted = stage(counts(own).withColumn("row", F.col("row").dropFields("text")), "counts")
    kept = judged(counted, cutoffs(counted, labels, **options)).where("kept").select("row._id", "row._th", "row._st").distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *key)
    return rows.join(kept.hint("merge"), ["_id", "_th", "_st"], "left_semi").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    out = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("row.doc_id", *[F.col(f"_q.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS s, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(x) AS w, generate_subscripts(x, 1) AS p FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS x FROM d)),
w3 AS (SELECT r, p, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM w3 WHERE g IS NOT NULL) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY r),
wc AS (SELECT r, count(*) AS n, sum(length(w)) AS c FROM w GROUP BY r),
l AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT x) AS dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
q AS (SELECT d.r, doc_id, s, md5(t) AS m, coalesce(wc.n, 0)::BIGINT AS n_words, coalesce(wc.c, 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.dup, 0)::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0)::BIGINT AS n_lines,
        length(regexp_replace(t, '\P{{Lu}}', '', 'g'))::BIGINT AS n_capitals
      FROM d LEFT JOIN wc USING (r) LEFT JOIN l USING (r) LEFT JOIN cov USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATS} * n_words AS base_failed,
        least((n_symbols * 100 + greatest(word_chars, 1) - 1) // greatest(word_chars, 1), 100) AS symbols,
        least((n_capitals * 100 + greatest(word_chars, 1) - 1) // greatest(word_chars, 1), 100) AS capitals,
        least((n_dup_lines * 100 + greatest(n_lines, 1) - 1) // greatest(n_lines, 1), 100) AS lines,
        least((n_repeat_words * 100 + greatest(n_words, 1) - 1) // greatest(n_words, 1), 100) AS repeats FROM q),
g AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
byid AS (SELECT s, doc_id, min(m) AS m, any_value(good) AS good FROM f JOIN g USING (doc_id) WHERE NOT base_failed GROUP BY s, doc_id),
bytext AS (SELECT s, m, max(byid.good) AS good, any_value(f.symbols) AS symbols, any_value(f.capitals) AS capitals, any_value(f.lines) AS lines,
        any_value(f.repeats) AS repeats FROM byid JOIN f USING (s, m) GROUP BY s, m),
stats AS (UNPIVOT (SELECT r, doc_id, s, symbols, capitals, lines, repeats FROM f WHERE NOT base_failed) ON symbols, capitals, lines, repeats INTO NAME rule VALUE v),
h AS (UNPIVOT bytext ON symbols, capitals, lines, repeats INTO NAME rule VALUE v),
c AS (SELECT s, rule, lim, count(*) FILTER (WHERE good = 1) AS n, count(*) FILTER (WHERE good = 1 AND v > lim) AS k,
        count(*) FILTER (WHERE good <> 1 AND v > lim) AS gain
      FROM h, (SELECT unnest(range(0, 101)) AS lim) GROUP BY s, rule, lim),
tail AS (SELECT s, rule, lim, gain - k AS net, (SELECT count(DISTINCT s) FROM h) AS strata,
        list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
          + i * ln({RISK / 4}) + (n - i) * ln(1 - {RISK / 4})))) AS p
      FROM c WHERE gain > k AND k <= n * {RISK / 4} AND n > 0),
best AS (SELECT s, rule, max((net, lim)) AS b FROM tail WHERE p <= {DOUBT} / (4 * strata) GROUP BY s, rule),
bad AS (SELECT DISTINCT r FROM stats JOIN best USING (s, rule) WHERE v > b[2])
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept FROM f
"""
