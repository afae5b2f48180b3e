"""Secret scans with an incremental blob ledger.

Every version of a text is a *blob* addressed by the SHA-256 of its content. The ledger
is two Parquet folders: ``scans`` (blob, version) says which rule version has seen which
blob, ``findings`` (blob, version, kind, start, end) holds what was found. A scan takes
the pairs of blob and rule version that the ledger lacks, reads each such blob once
however many paths carry it, appends to the ledger, and joins findings back to all paths.

Everything runs as Spark SQL expressions: ``regexp_extract_all`` gives a pattern's
matches, ``split`` the gaps between them, and running sums of both lengths the offsets
(code points, end exclusive). A hot blob (many copies of a text) is reduced to one row a
task before the shuffle; the join back to its paths is a plain equi-join on the blob,
whose skewed partitions Spark splits.

Edge cases: a null text is the empty text; an empty text has no finding and the SHA-256 of
the empty string as digest; rows that repeat an id each get their text's findings, null
ids too; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import scratch


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first and without overlap; those whose group
    ``group`` has fewer than ``least`` characters are dropped. ``guard`` is a cheaper
    pattern that matches wherever ``pattern`` does."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    guard: str | None = None


# fixed values: version 1 has the base kinds, in their order; version 2 adds kinds.
# Runs of a class are matched with their least length at once, which finds the same runs.
RULES: dict[int, tuple[Rule, ...]] = {
    1: (Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             1, 6, r"(?i:passw|secret|token|api_?key)"),
        Rule("access", r"AKIA[A-Z0-9]{16,}", guard="AKIA"),
        Rule("hex", r"[0-9a-f]{24,}")),
    2: (Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
        Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", guard="xox"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", guard="eyJ"),
        Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", guard="-----BEGIN")),
}
_SCANS = "blob string, version int"
_FINDINGS = "blob string, version int, kind string, start int, end int"


def blob_of(text: Column) -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan_blobs(blobs: DataFrame, versions: list[int]) -> DataFrame:
    """Findings (blob, version, kind, start, end) in ``blobs`` (blob, text, todo), where
    ``todo`` lists the rule versions to apply to the row."""
    def tried(version: int, rule: Rule) -> Column:
        here = F.array_contains("todo", version) & F.col("text").rlike(rule.guard or rule.pattern)
        found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        value = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
        gaps = F.split("text", rule.pattern, -1)
        return F.when(here, F.struct(
            F.lit(version).alias("version"), F.lit(rule.kind).alias("kind"),
            F.transform(found, F.length).alias("size"), F.transform(gaps, F.length).alias("gap"),
            F.transform(value, lambda v: F.length(v) >= rule.least).alias("ok")))

    one = blobs.select("blob", F.explode_outer(F.array(*[tried(v, r) for v in versions for r in RULES[v]])).alias("r"))
    one = one.where("r IS NOT NULL").select(
        "blob", "r.version", "r.kind",
        F.posexplode_outer(F.arrays_zip(F.col("r.size").alias("size"), F.col("r.gap").alias("gap"),
                                  F.col("r.ok").alias("ok"))).alias("i", "m"))
    before = Window.partitionBy("blob", "version", "kind").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
    return (one.where("m.size IS NOT NULL")  # the last gap has no match after it
            .select("blob", "version", "kind", (end - F.col("m.size")).cast("int").alias("start"),
                    end.cast("int").alias("end"), "m.ok").where("ok").drop("ok"))


def update_ledger(spark: SparkSession, texts: DataFrame, ledger: str, versions: list[int]) -> None:
    """Scan the blobs of ``texts`` (text) that the ledger at the path ``ledger`` lacks for a
    version. Findings are appended before the scans that vouch for them: after a break
    in between, the pairs are scanned again and readers drop the repeats."""
    seen = read_ledger(spark, ledger)[0].where(F.col("version").isin(versions))
    done = seen.distinct().groupBy("blob").agg(F.collect_set("version").alias("done"))  # few versions a blob
    wanted = F.array(*[F.lit(v) for v in versions])
    texts = texts.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<int>")))
    if seen.isEmpty():
        unseen = texts.withColumn("todo", wanted)
    else:
        unseen = texts.join(done, "blob", "left").withColumn("todo", todo).drop("done").where("size(todo) > 0")
    blobs = unseen.groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    scan_blobs(blobs, versions).write.mode("append").parquet(f"{ledger}/findings")
    (unseen.select("blob", F.explode("todo").alias("version")).distinct()
     .write.mode("append").parquet(f"{ledger}/scans"))


def read_ledger(spark: SparkSession, ledger: str) -> tuple[DataFrame, DataFrame]:
    """(scans, findings) of the ledger; both empty before its first scan."""
    out = []
    for name, schema in (("scans", _SCANS), ("findings", _FINDINGS)):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{name}")
        there = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
        out.append(spark.read.schema(schema).parquet(f"{ledger}/{name}") if there else spark.createDataFrame([], schema))
    return out[0], out[1]


def findings_by_path(paths: DataFrame, findings: DataFrame, versions: list[int]) -> DataFrame:
    """One row for each row of ``paths`` (id, blob): the counts of the base kinds, the digest
    of their spans, and all spans in order of start, then kind."""
    kinds = [r.kind for v in versions for r in RULES[v]]
    base = [r.kind for r in RULES[1]]
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    spans = (findings.where(F.col("version").isin(versions)).distinct().groupBy("blob")
             .agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("s")))
    id_cols = [c for c in paths.columns if c != "blob"]

    def joined(keep) -> Column:
        some = F.filter(F.coalesce("s", F.array().cast(spans.schema["s"].dataType)), keep)
        return F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("s", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")

    return paths.join(spans, "blob", "left").select(
        *id_cols, *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(joined(lambda x: x["kind"].isin(base)), 256).alias("base_sha256"),
        joined(lambda x: F.lit(True)).alias("spans"))


def scan(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         versions: list[int] | None = None) -> DataFrame:
    """Update the ledger (default: a new one in the shared scratch folder) with ``docs`` and
    return the findings of every row of ``docs``."""
    spark, versions = docs.sparkSession, versions or sorted(RULES)
    ledger = ledger or scratch(spark, "secret-ledger")
    update_ledger(spark, docs.select(F.col(text_col).alias("text")), ledger, versions)
    paths = docs.select(F.col(id_col), blob_of(F.col(text_col)).alias("blob"))
    return findings_by_path(paths, read_ledger(spark, ledger)[1], versions)
