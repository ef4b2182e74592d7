"""Incremental secret scans over a content-addressed ledger, in built-in functions only.

A text version is addressed by its SHA-256. The ledger has, per blob, which rule
versions have read it and what they found; a run scans only blobs, and of those
only the rules, that the ledger lacks. Findings are joined back to every path
that ever held the blob. ``extend_ledger`` keeps a ledger in a folder from run to run.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import discard, materialise, materialise_counted

MARK = "[SECRET]"


class Rule(NamedTuple):
    """A kind of secret. ``needs`` is text without which no match exists, tested first."""

    kind: str
    version: int
    pattern: str
    needs: str = ""
    least: tuple[int, int] = (0, 0)  # a group and the code points it must have

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base kinds, in the order in which they are listed.
BASE = (
    Rule(
        "assign", 1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=(2, 6),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", "AKIA"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
#: Further kinds of widely used key formats. Like the base kinds they repeat single characters only, and
#: no run is read from more than one of its places: a pattern takes a time in proportion to the text.
ADDED = (
    Rule("forge", 1, r"gh[opsru]_[A-Za-z0-9]{36,}", "gh"),
    Rule("chat", 1, r"xox[abposr]-[A-Za-z0-9-]{10,}", "xox"),
    Rule("webtoken", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{5,}", "eyJ"),
    Rule("pem", 2, r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", "-----BEGIN "),
)
RULES = BASE + ADDED

LEDGER = "blob string, scanned array<string>, spans array<struct<start:bigint,rule:string,end:bigint>>"


def blob_of(text: Column) -> Column:
    """Address of a text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _hits(rule: Rule) -> Column:
    """Per match of ``rule``: code points since the last match, its length, and whether it counts."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    group, least = rule.least
    matches = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda m: F.struct(
            F.length(m).alias("len"),
            (F.length(F.regexp_extract(m, rule.pattern, group)) >= least).alias("ok") if least else F.lit(True).alias("ok"),
        ),
    )
    zipped = F.zip_with(
        F.slice(gaps, 1, F.size(matches)),
        matches,
        lambda gap, m: F.struct(gap.alias("gap"), m["len"].alias("len"), m["ok"].alias("ok")),
    )
    there = text.contains(rule.needs) & text.rlike(rule.pattern) if rule.needs else text.rlike(rule.pattern)
    todo = ~F.array_contains("seen", rule.name)
    return F.when(todo & there, F.struct(F.lit(rule.name).alias("rule"), zipped.alias("hits")))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for what ``ledger`` lacks: blobs of ``versions`` and rules that have not met.

    ``versions`` needs a column ``text``; others are not read. Equal texts are one
    blob, a null text is the empty one. A blob without findings has a row with no
    spans, so that it is not read again. ``spans`` count code points from 0, end
    exclusive, in the order of start and rule. No versions give no rows.
    """
    texts = versions.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules])
    none = F.array().cast("array<string>")
    if ledger is None:
        blobs = texts.dropDuplicates(["blob"]).withColumn("seen", none)
    else:
        # Addresses are compared first, so that only texts of unseen blobs move.
        read = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("seen"))
        held = texts.select("blob").distinct().join(materialise(read), "blob", "left").withColumn("seen", F.coalesce("seen", none))
        unseen = materialise(held.where(F.size(F.array_except(names, "seen")) > 0))
        blobs = texts.join(unseen, "blob").dropDuplicates(["blob"])
    scanned = materialise(
        blobs.select(
            "blob",
            F.array_except(names, "seen").alias("scanned"),
            F.filter(F.array(*[_hits(r) for r in rules]), lambda found: found.isNotNull()).alias("found"),
        )
    )
    return scanned.select("blob", "scanned").join(_spans(scanned), "blob", "left").select(
        "blob", "scanned", F.coalesce("spans", F.array().cast("array<struct<start:bigint,rule:string,end:bigint>>")).alias("spans")
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger stored at ``path``; empty where there is none yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def extend_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger at ``path`` lacks, append it there, and tell how many blobs were scanned.

    A run that fails leaves the ledger as it was; the next one scans the same blobs.
    """
    new, scanned = materialise_counted(scan(versions, read_ledger(versions.sparkSession, path), rules))
    if scanned:
        new.write.mode("append").parquet(path)
    discard(new)
    return scanned


def _spans(scanned: DataFrame) -> DataFrame:
    """Places of the matches that count, as one list per blob that has any."""
    hits = scanned.select("blob", F.explode("found").alias("f")).select(
        "blob", F.col("f.rule").alias("rule"), F.posexplode("f.hits").alias("i", "hit")
    )
    end = "sum(hit.gap + hit.len) OVER (PARTITION BY blob, rule ORDER BY i ROWS UNBOUNDED PRECEDING)"
    placed = hits.withColumn("end", F.expr(end)).where("hit.ok")
    span = F.struct((F.col("end") - F.col("hit.len")).alias("start"), "rule", "end")
    return materialise(placed.groupBy("blob").agg(F.collect_list(span).alias("spans")))


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, spans`` of the given rule versions, for blobs where there are any.

    ``spans`` is a list of ``(start, rank, kind, end)`` in this order, rank being the rule's place.
    """
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kind = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    spans = ledger.select("blob", F.explode("spans").alias("s")).where(F.col("s.rule").isin([r.name for r in rules]))
    item = F.struct("s.start", rank[F.col("s.rule")].alias("rank"), kind[F.col("s.rule")].alias("kind"), "s.end")
    return spans.groupBy("blob").agg(F.array_sort(F.collect_set(item)).alias("spans"))


def paths_with_findings(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """Every row of ``versions`` (without its text) with its ``spans``, and the ledger's new rows.

    Columns named ``text``, ``blob`` or ``spans`` are replaced; others pass. Rows
    without findings have an empty list. Repeated rows stay.
    """
    rest = [c for c in versions.columns if c not in ("text", "blob", "spans")]
    new = materialise(scan(versions, ledger, rules))
    known = new if ledger is None else ledger.unionByName(new)
    held = materialise(findings(known, rules))
    paths = materialise(versions.select(*rest, blob_of(F.col("text")).alias("blob")))
    empty = F.array().cast(held.schema["spans"].dataType)
    return paths.join(held, "blob", "left").select(*rest, "blob", F.coalesce("spans", empty).alias("spans")), new


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with a mark in the place of each secret; overlapping spans share one.

    ``n_chars``, if there, follows the new text. Rows without secrets stay as they
    are, null texts too. Names that start with two underscores are used on the way.
    """
    new = materialise(scan(versions, ledger, rules))
    held = findings(new if ledger is None else ledger.unionByName(new), rules)
    held = materialise(held.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")))
    joined = versions.withColumn("__blob", blob_of(F.col("text"))).join(held, "__blob", "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def add(done: Column, span: Column) -> Column:
        between = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], between, F.lit(MARK))).otherwise(done["out"])
        return F.struct(out.alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.length("text")))

    found = F.col("__spans").isNotNull()
    columns = {"text": F.when(found, F.aggregate("__spans", start, add, finish)).otherwise(F.col("text"))}
    marked = joined.withColumns(columns)
    if "n_chars" in versions.columns:
        length = F.length("text").cast(versions.schema["n_chars"].dataType)
        marked = marked.withColumn("n_chars", F.when(found, length).otherwise(F.col("n_chars")))
    return marked.select(*versions.columns)
