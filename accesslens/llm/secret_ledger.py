"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text.  A ledger table
holds one row for each (blob, rule, rule version) that was scanned, findings
included.  A scan looks only at pairs the ledger lacks: a blob that many paths
or versions share is read once, a new rule version reads each blob once for that rule
alone.  Findings are joined back to every path that holds the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm.common import slices, stage, table, texts
from accesslens.sources.staging import fresh_path

LEDGER_SCHEMA = "blob binary, rule string, version int, spans array<struct<start:long, end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if the given group has at least ``least`` characters."""

    name: str
    version: int
    pattern: str
    least: int
    group: int = 0
    #: Lower-case words of which a text must hold one, if any are given.
    words: tuple[str, ...] = ()

    def spans(self, text: str, lower: str) -> list[tuple[int, int]]:
        if self.words and not any(w in lower for w in self.words):
            return []
        found = re.finditer(self.pattern, text, re.ASCII)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


#: Fixed patterns, in the order in which equal starts are listed.
RULES = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
        ("passw", "secret", "token", "api"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16, 0, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 32),
)


def _current(rules: tuple[Rule, ...]) -> Column:
    """Whether a ledger row is of a rule's version as it is now."""
    versions = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.version))])
    return F.col("version") == versions[F.col("rule")]


def blobs(versions: DataFrame) -> DataFrame:
    """Adds the content address; a null text is an empty one."""
    return versions.withColumn("blob", F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))


def scan(unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of (blob, text, rules): one per blob and rule to run, without findings too."""
    by_name = {r.name: r for r in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            done: list[tuple] = []
            for blob, text, todo in zip(*(b.column(i).to_pylist() for i in range(3))):
                lower = text.lower()
                for rule in (by_name[name] for name in todo):
                    spans = [{"start": s, "end": e} for s, e in rule.spans(text, lower)]
                    done.append((blob, rule.name, rule.version, spans))
            kinds = (pa.binary(), pa.string(), pa.int32(), _SPANS)
            arrays = [pa.array([x[i] for x in done], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["blob", "rule", "version", "spans"])

    return unseen.select("blob", "text", "rules").mapInArrow(run, LEDGER_SCHEMA)


class Ledger:
    """What was scanned, as a Parquet table that only grows: a folder per run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame | None:
        """The table, or None before the first run."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        store = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(folder):
            return None
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def unseen(self, versions: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, text, rules still to run): one row per blob that lacks a rule version.

        Copies meet map-side first, so a text with a third of all rows moves once per task.  Only addresses are
        compared with the ledger; texts move for the blobs that it lacks.
        """
        every = F.array(*[F.lit(r.name) for r in rules])
        one = F.first(F.coalesce("text", F.lit(""))).alias("text")
        seen = self.rows()
        if seen is None:
            return versions.groupBy("blob").agg(one).withColumn("rules", every)
        done = seen.where(_current(rules)).groupBy("blob").agg(F.collect_set("rule").alias("done"))  # at most one name per rule
        todo = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
        lacking = versions.select("blob").distinct().join(done, "blob", "left").select("blob", todo.alias("rules"))
        lacking = stage(lacking.where(F.size("rules") > 0), "unseen-blobs")
        return versions.join(lacking, "blob").groupBy("blob").agg(one, F.first("rules").alias("rules"))

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what is unseen, append it, and return all rows of the current rules.

        ``versions``: (text, blob).  A run that was cut off left no committed folder, so
        repeating it is safe; a pair that two runs both scanned counts once.
        """
        scan(self.unseen(versions, rules), rules).write.mode("append").option("compression", "zstd").parquet(self.path)
        rows = self.rows().where(_current(rules))
        return rows.groupBy("blob", "rule").agg(F.first("spans").alias("spans"))


def findings(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, blob, found): every input row with the findings of its blob.

    ``found``: array of (start, rank, end, rule) by start, then by the order of the rules; positions are
    code points, the end exclusive.  Null and empty texts have the same blob and no
    findings.  Repeated rows and null ids keep their rows.  An empty table gives no rows.
    """
    versions = blobs(texts(docs, id_col, text_col))
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    rows = ledger.scan(versions.select("blob", "text"), rules).where(F.size("spans") > 0)
    rows = rows.select("blob", F.transform("spans", lambda s: F.struct(s.start.alias("start"), rank[F.col("rule")].alias("rank"), s.end.alias("end"), F.col("rule"))).alias("found"))
    by_blob = rows.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    none = F.array().cast("array<struct<start:long,rank:int,end:long,rule:string>>")
    joined = versions.select("doc_id", "blob").join(by_blob, "blob", "left")
    return joined.select("doc_id", "blob", F.coalesce("found", none).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per base rule, all spans as text and their SHA-256."""
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x.rule, x.start, x.end)), ",")

    def of(rule: Rule) -> Column:
        return F.size(F.filter("found", lambda x: x.rule == rule.name)).cast("long").alias(f"n_{rule.name}")

    return found.select("doc_id", *map(of, RULES), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All secrets of documents, loaded twice into one ledger: the first load scans every text, the second finds nothing unseen."""
    docs = table(spark, sf_dir, "documents")
    ledger = Ledger(spark, fresh_path(spark, "secret-ledger"))
    ledger.scan(blobs(texts(docs)).select("blob", "text"))
    return digest(findings(docs, ledger))


def _either(word: str) -> str:
    """A word in either case, as a pattern without flags."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = f"({_NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"

#: Positions from the lengths of the matches and of the text between them.
ORACLE = {
    "op6_secret_scan": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), rules(rank, kind, least) AS (VALUES (0, 'assign', 8), (1, 'access', 16), (2, 'hex', 32)),
cut AS (
  SELECT doc_id, 0 AS rank, regexp_extract_all(text, '{_ASSIGN}') AS hits, regexp_extract_all(text, '{_ASSIGN}', 2) AS parts, regexp_split_to_array(text, '{_ASSIGN}') AS gaps FROM d
  UNION ALL SELECT doc_id, 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_split_to_array(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT doc_id, 2, regexp_extract_all(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'), regexp_split_to_array(text, '[0-9a-f]+') FROM d),
spans AS (
  SELECT doc_id, rank, i, length(parts[i]) AS n, length(hits[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut WHERE len(hits) > 0)),
kept AS (SELECT doc_id, kind, rank, start::bigint AS start, (start + size)::bigint AS stop FROM spans JOIN rules USING (rank) WHERE n >= least),
joined AS (
  SELECT doc_id, coalesce(string_agg(kind || ':' || start::varchar || ':' || stop::varchar, ',' ORDER BY start, rank), '') AS spans,
         count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)"""
}
QUERIES = {"op6_secret_scan": op6_secret_scan}
