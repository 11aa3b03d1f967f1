"""Secret scans through an incremental ledger of blobs.

Every version of every file is a blob, named by the sha-256 of its content. The ledger is a
table of (blob, rule, version, spans), a row for each pair that was ever scanned, findings
or none. A run looks which (blob, rule version) pairs its documents need, scans only those
that the ledger lacks, each blob once however many paths hold it, appends them, and joins
findings back to all paths. A new rule, or a new version of one, scans old blobs again for
that rule alone.

A run appends in one job, so a failed run leaves the ledger as it was; pairs that two runs
scanned at the same time are read as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of the pattern whose group has at least so many characters."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    either_case: bool = False
    needs: tuple[str, ...] = ()  # lower-case ASCII texts; without any of them there is no match

    def spans(self, text: str, lowered: bytes, compiled: re.Pattern) -> list[tuple[int, int]]:
        if self.needs and not any(n.encode() in lowered for n in self.needs):
            return []
        return [m.span() for m in compiled.finditer(text) if len(m[self.group]) >= self.least]


#: Fixed values of the contract.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12, 2, True, ("password", "passwd", "secret", "token", "api"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, needs=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),
)
EXTRA_RULES = (Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, needs=("private key",)),)
RULES = BASE_RULES + EXTRA_RULES

LEDGER_SCHEMA = "blob string, kind string, version int, spans array<struct<start: int, end: int>>"


def blob_name(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, made there if it isn't yet."""
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _wanted(rules: Sequence[Rule]) -> Column:
    return F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules])


def unseen(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """(blob, text, kinds): one row per blob with the rules that it hasn't been scanned for."""
    blobs = docs.select(blob_name(F.col(text_col)).alias("blob"), F.coalesce(text_col, F.lit("")).alias("text"))
    seen = ledger.where(_wanted(rules)).groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    kinds = F.array_except(F.array(*(F.lit(r.kind) for r in rules)), F.coalesce("seen", F.array().cast("array<string>")))
    return (
        blobs.dropDuplicates(["blob"])  # each task drops its own copies before texts move
        .join(seen, "blob", "left")
        .select("blob", "text", kinds.alias("kinds"))
        .where(F.size("kinds") > 0)
    )


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows of blobs, for the rules that each one names."""
    by_kind = {r.kind: r for r in rules}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Letters in either case are ASCII letters: no other character folds onto them.
        compiled = {r.kind: re.compile(r.pattern, re.A | (re.I if r.either_case else 0)) for r in rules}
        for batch in batches:
            out = []
            for blob, text, kinds in zip(batch["blob"], batch["text"], batch["kinds"]):
                lowered = text.encode().lower()
                for kind in kinds:
                    rule = by_kind[kind]
                    spans = rule.spans(text, lowered, compiled[kind])
                    out.append((blob, kind, rule.version, [{"start": a, "end": b} for a, b in spans]))
            yield pd.DataFrame(out, columns=["blob", "kind", "version", "spans"])

    return blobs.mapInPandas(rows, LEDGER_SCHEMA)


def update_ledger(
    docs: DataFrame, path: str, rules: Sequence[Rule] = RULES, text_col: str = "text"
) -> DataFrame:
    """Scan what the ledger at ``path`` lacks for these documents; the ledger afterwards."""
    spark = docs.sparkSession
    ledger = open_ledger(spark, path)
    scan(unseen(docs, ledger, rules, text_col), rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def findings(
    docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, blob and found, an array of (start, rank, kind, end).

    Spans count code points, ends are exclusive; found is sorted by start, then by the
    rules' order, and empty where nothing was found. Null text is the empty blob. Repeated
    rows get equal answers; other columns are not looked at.
    """
    rank = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind")).cast("int")
    hits = (
        ledger.where(_wanted(rules) & (F.size("spans") > 0))
        .select("blob", "kind", rank.alias("rank"), F.explode("spans").alias("span"))
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.collect_set(F.struct(F.col("span.start"), F.col("rank"), F.col("kind"), F.col("span.end")))
            ).alias("found")
        )
    )
    paths = docs.select(id_col, blob_name(F.col(text_col)).alias("blob"))
    none = F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")
    return paths.join(hits, "blob", "left").select(id_col, "blob", F.coalesce("found", none).alias("found"))


def spans_text(found: Column) -> Column:
    """kind:start:end of every finding, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
