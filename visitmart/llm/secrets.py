"""Secret scan over an incremental blob ledger.

Every version of every file is content-addressed by its SHA-256. The ledger holds, for each blob
and rule version, what was found, also when that is nothing. A run scans just the pairs of blob
and rule version that the ledger lacks, one text per blob, appends them, and joins findings back
to all paths and versions of the blob. Only Spark SQL expressions touch the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm.shared import folder, stored

SPANS = "array<struct<kind:string,start:long,end:long>>"
LEDGER = f"blob binary, rule string, version int, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a regular expression, and the group whose length must reach ``least``."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str = ""  # a text that every match contains, sought first

    def spans(self, text: Column) -> Column:
        """Spans of the leftmost non-overlapping matches whose group is long enough, in code points."""
        whole = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))
        group = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(self.group))
        gaps = F.split(text, self.pattern, -1)
        rows = F.transform(
            F.arrays_zip(whole.alias("hit"), group.alias("part"), F.slice(gaps, 1, F.size(whole)).alias("gap")),
            lambda x: F.struct(
                F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["part"]).alias("part")
            ),
        )
        start = {"at": F.lit(0).cast("long"), "found": F.array().cast(SPANS)}

        def step(state: Column, row: Column) -> Column:
            begin = state["at"] + row["gap"]
            end = begin + row["hit"]
            span = F.struct(F.lit(self.kind).alias("kind"), begin.alias("start"), end.alias("end"))
            found = F.when(row["part"] >= self.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
            return F.struct(end.alias("at"), found.alias("found"))

        made = F.aggregate(rows, F.struct(*[c.alias(n) for n, c in start.items()]), step, lambda s: s["found"])
        maybe = text.contains(self.hint) & text.rlike(self.pattern) if self.hint else text.rlike(self.pattern)
        return F.when(maybe, made).otherwise(F.array().cast(SPANS))


# The three kinds, their patterns and least lengths, in the order of the report.
ASSIGN = Rule(
    "assign",
    1,
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    1,
    12,
)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, "AKIA")
HEX = Rule("hex", 1, r"[0-9a-f]{16,}+", 0, 16)  # a run of 16 and more is the whole run
RULES = (ASSIGN, ACCESS, HEX)


def blob_of(text: Column) -> Column:
    """SHA-256 of the UTF-8 text (null: empty), as bytes."""
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, ledger: str, path: str = "path", content: str = "text", rules=RULES) -> DataFrame:
    """Findings of every row of ``versions``: its columns but the content, plus blob and spans (start, then rule order).

    ``ledger`` is a Parquet folder; what it holds is not scanned again, what is new is appended.
    A null content counts as empty; equal contents are one blob whatever their paths; repeated
    rows each keep their row; no rows give no rows. Columns named as a result or work column (``_blob``,
    ``_pick``, ``_hit``) are left out.
    """
    spark = versions.sparkSession
    taken = {content.lower(), "_blob", "_pick", "_hit", "blob", "spans"}
    kept = [F.col(f"`{c}`") for c in versions.columns if c.lower() not in taken]
    addressed = stored(versions.select(*kept, blob_of(F.col(content)).alias("_blob")), "addresses")
    known = read_ledger(spark, ledger).select("blob", "rule", "version").distinct()
    wanted = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
    # one path stands for a blob; which of them does not matter
    blobs = addressed.groupBy("_blob").agg(F.min(path).alias("_pick"))
    unseen = (
        blobs.select("_blob", "_pick", wanted.alias("w"))
        .select(F.col("_blob").alias("blob"), "_pick", "w.rule", "w.version")
        .join(known, ["blob", "rule", "version"], "left_anti")
        .groupBy("blob", "_pick")
        .agg(F.collect_set(F.struct("rule", "version")).alias("due"))
    )
    texts = versions.select(F.col(path).alias("_pick"), F.coalesce(F.col(content), F.lit("")).alias("_text"))
    picked = texts.join(unseen.select(F.col("_pick").alias("_due_pick"), "blob", "due"), F.expr("_pick <=> _due_pick"))
    picked = picked.where(blob_of(F.col("_text")) == F.col("blob"))
    per_rule = [
        F.struct(
            F.lit(r.kind).alias("rule"),
            F.lit(r.version).alias("version"),
            F.when(
                F.array_contains("due", F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"))),
                r.spans(F.col("_text")),
            ).alias("spans"),
        )
        for r in rules
    ]
    found = picked.select("blob", F.explode(F.array(*per_rule)).alias("f")).where("f.spans IS NOT NULL")
    found.select("blob", "f.rule", "f.version", "f.spans").write.mode("append").parquet(ledger)

    current = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    hits = (
        read_ledger(spark, ledger)
        .where((F.size("spans") > 0) & F.array_contains(current, F.struct("rule", "version")))
        .groupBy("blob", "rule")
        .agg(F.first("spans").alias("spans"))  # a blob scanned twice has equal rows
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    ranked = F.transform(
        F.array_sort(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("n"), s["end"].alias("end"), s["kind"].alias("kind")))
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    hits = hits.select(F.col("blob").alias("_hit"), ranked.alias("spans"))
    joined = addressed.join(hits, F.col("_blob") == F.col("_hit"), "left")
    return joined.select(*kept, F.col("_blob").alias("blob"), F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Digest columns of the scan of ``docs`` (doc_id, text): counts by kind, hash of the base spans, all spans."""
    ledger = ledger or folder(docs.sparkSession, "ledger")
    found = scan_versions(docs.select("doc_id", "text"), ledger, "doc_id")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in RULES],
        F.sha2(F.encode(written(F.col("spans")), "UTF-8"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
