"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every historical version of every path is content-addressed: its blob is the SHA-256 of
its text. The ledger holds, for each blob, the rules (with their versions) that have
scanned it and the spans they found. A scan

1. lists the blobs of all versions, one row per content however many paths hold it;
2. takes away the rules that the ledger has for each blob in their present version, and
   scans only what is left, each text once for all of its unseen rules;
3. writes the new entries as a new part of the ledger (parts are never changed; a scan
   that fails before its part is complete leaves none);
4. joins the findings back to all paths and versions by blob.

A rule is a Java regular expression; ``group`` (0: the whole match) must have ``least``
characters or more. Matches are leftmost and do not overlap; those that are too short are
dropped after matching, so they still take their text. Spans are code points, the end
exclusive. Texts between matches (``split``) and matches (``regexp_extract_all``) together
give the positions.

Defined cases: a null text is empty; null paths and versions are values like any other;
repeated rows find the same; texts of any length are scanned whole; other columns pass
through ``findings`` as they are, whatever their names; an empty table writes an empty part and gives no rows.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from chartmart.session import scratch_path

from .sqlmath import let


class Rule(NamedTuple):
    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: str | None = None  # a cheaper pattern that every text with a match matches


#: The order of rules is the order of kinds at equal starts.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         r"(?i:password|passwd|secret|token|api_?key)"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),  # a run is found whole, so shorter ones need no matching
    Rule("private", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(-----END [A-Z ]*PRIVATE KEY-----)?", 0, 0, "PRIVATE KEY-----"),
    Rule("github", 1, r"\b(gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})", 0, 0, "gh[pousr]_|github_pat_"),
    Rule("slack", 1, r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 0, "xox[abeoprs]-"),
    Rule("google", 1, r"\bAIza[A-Za-z0-9_-]{35}", 0, 0, "AIza"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0, "eyJ"),
    Rule("url", 1, r"\b[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]{6,}@", 0, 0, "://[^\\s/:@]+:"),
)
BASE = ("assign", "access", "hex")


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's matches in a text."""
    pattern = F.lit(rule.pattern)
    # a match without a group to measure has no second list
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else F.array().cast("array<string>")

    def place(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

        def step(acc: Column, m: Column) -> Column:
            begin = acc["at"] + F.length(m["gap"])
            end = begin + F.length(m["match"])
            long_enough = F.length(m["measured"] if rule.group else m["match"]) >= rule.least
            return F.struct(end.alias("at"), F.when(long_enough, F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(F.filter(found, lambda m: m["match"].isNotNull()), start, step, lambda acc: acc["out"])

    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), measured.alias("measured"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(text.rlike(rule.hint or rule.pattern), let(zipped, place)).otherwise(none)


class Ledger:
    """Parts of a ledger below one folder: ``blob``, and per scanned rule its name, version and spans."""

    SCHEMA = "blob string, scans array<struct<rule:string,version:int,spans:array<struct<start:int,end:int>>>>"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def entries(self) -> DataFrame:
        """One row per blob of all parts; an absent folder is an empty ledger, any other error is raised."""
        try:
            rows = self.spark.read.option("recursiveFileLookup", "true").schema(self.SCHEMA).parquet(self.folder)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], self.SCHEMA)
        # a scan that was run twice, or by two jobs at once, found the same spans
        return rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scans"))).alias("scans"))

    def scan(self, history: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scans every (blob, rule, version) of the history that the ledger lacks."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        blobs = history.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
        seen = self.entries().select("blob", F.transform("scans", lambda s: F.concat_ws("@", s["rule"], s["version"])).alias("seen"))
        due = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        due = due.where(F.size(F.array_except(F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules]), "seen")) > 0)
        scans = [F.when(~F.array_contains("seen", f"{r.name}@{r.version}"), F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), _spans(F.col("text"), r).alias("spans")))
                 for r in rules]
        part = due.select("blob", F.filter(F.array(*scans), lambda s: s.isNotNull()).alias("scans"))
        part.write.parquet(f"{self.folder}/part-{uuid.uuid4().hex}")

    def findings(self, history: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """``row`` (the columns of ``history`` but the text), ``blob`` and ``spans``: the findings of the rules' present versions, by start and rule."""
        def current(s: Column) -> Column:
            return F.array_contains(F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules]), F.concat_ws("@", s["rule"], s["version"]))

        order = F.array(*[F.lit(r.name) for r in rules])
        flat = F.flatten(F.transform(F.filter("scans", current), lambda s: F.transform(s["spans"], lambda x: F.struct(
            x["start"].alias("start"), F.array_position(order, s["rule"]).alias("at"), s["rule"].alias("kind"), x["end"].alias("end")))))
        found = self.entries().select("blob", F.sort_array(flat).alias("spans")).where(F.size("spans") > 0)
        columns = [F.col(c) for c in history.columns if c != text_col]  # texts are not shuffled again
        rows = history.select(F.struct(*columns).alias("row"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
        none = F.array().cast("array<struct<start:int,at:bigint,kind:string,end:int>>")
        return rows.join(found, "blob", "left").select("row", "blob", F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """Counts and spans of every document, by way of a ledger of this run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.scan(docs)
    found = ledger.findings(docs).select("row.doc_id", F.col("spans").alias("s"))
    base = F.filter("s", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[_count(k) for k in BASE],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
