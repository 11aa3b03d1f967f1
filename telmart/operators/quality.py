"""Declarative validation rules, rejection tracking, profiling and integrity checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmart.functions.casts import to_boolean, to_moment, to_number
from telmart.operators.joins import unmatched_keys
from telmart.operators.shape import accepted

# Wording of the messages and the length at which they are cut.
MAX_REASON_LENGTH = 1000
MESSAGES = {
    "required": "{column} come with null value, ",
    "numeric": "{column} must be numeric, ",
    "positive": "{column} must be positive, ",
    "between": "{column} must be between {low} and {high}, ",
}

# Additions of this library.
MESSAGES["non_negative"] = "{column} must not be negative, "
MESSAGES["boolean"] = "{column} must be true or false, "
MESSAGES["format"] = "{column} {wording}, "

SKIP = "skip"
REJECT = "reject"

# Format checks, by kind: the test a well-formed value passes and the wording of the
# complaint. Null is left to the required rule.
FORMATS = {
    "phone": (lambda c: c.rlike("^0*[1-9][0-9]*$"), "must be a phone number"),
    "imei": (lambda c: c.rlike("^[0-9]{15}$"), "must be a 15 digit imei"),
    "cell_site": (lambda c: c.rlike("^[A-Z]+[0-9]+$"), "must be a cell site id"),
    "timestamp": (lambda c: to_moment(c).isNotNull(), "must be a timestamp"),
}


@dataclass(frozen=True)
class RuleSet:
    """Rules in the order in which their messages are written.

    ``non_negative``, ``formats`` (column -> kind) and ``boolean`` are additions; the
    shipped rule sets use the last one only. A boolean may be null.
    """

    required: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    between: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    formats: Mapping[str, str] = field(default_factory=dict)
    boolean: tuple[str, ...] = ()

    def checks(self) -> list[tuple[str, str]]:
        """(column, kind) in message order."""
        named = [(c, "required") for c in self.required]
        named += [(c, "numeric") for c in self.numeric]
        named += [(c, "positive") for c in self.positive]
        named += [(c, "between") for c in self.between]
        named += [(c, "non_negative") for c in self.non_negative]
        named += [(c, "format") for c in self.formats]
        named += [(c, "boolean") for c in self.boolean]
        return named


def _violation(rules: RuleSet, name: str, kind: str) -> tuple[Column, str]:
    """(condition that is true on a violation, message)."""
    value = F.col(f"`{name}`")
    number = to_number(value)
    details = {}
    if kind == "required":
        broken = value.isNull()
    elif kind == "numeric":
        broken = number.isNull()
    elif kind == "positive":
        broken = number <= 0
    elif kind == "non_negative":
        broken = number < 0
    elif kind == "boolean":
        broken = value.isNotNull() & to_boolean(value).isNull()
    elif kind == "between":
        low, high = rules.between[name]
        broken = (number < low) | (number > high)
        details = {"low": low, "high": high}
    else:
        passes, wording = FORMATS[rules.formats[name]]
        broken = value.isNotNull() & ~passes(value)
        details = {"wording": wording}
    return broken, MESSAGES[kind].format(column=name, **details)


RULES_COLUMN = "rejection_rules"
CUT_REASON = "(cut)"


def add_rejection_reason(
    df: DataFrame, rules: RuleSet, missing: str = SKIP, keep_rules: bool = False
) -> DataFrame:
    """Add ``rejection_reason`` (null when clean) and ``is_rejected``.

    The text is cut at ``MAX_REASON_LENGTH``, as its contract says. ``keep_rules`` adds
    ``rejection_rules``, the array of all violated rules, which is never cut.

    All messages form one expression, so the plan gets one projection however many
    rules there are. ``is_rejected`` is derived from the conditions rather than from
    the text: a plan that keeps only the flag never builds the text. A rule on an
    absent column is skipped, or with ``missing='reject'`` counts as violated.
    """
    reasons: list[Column] = []
    violated: list[Column] = []
    for name, kind in rules.checks():
        if name not in df.columns:
            if missing == REJECT and kind == "required":
                reasons.append(F.lit(MESSAGES["required"].format(column=name)))
                violated.append(F.lit(True))
            continue
        condition, message = _violation(rules, name, kind)
        reasons.append(F.when(condition, message))
        if kind == "required" and name in rules.numeric:
            continue  # a null fails the numeric rule too, which decides the flag
        violated.append(F.coalesce(condition, F.lit(False)))
    if not reasons:
        nothing = [F.array().cast("array<string>").alias(RULES_COLUMN)] if keep_rules else []
        return df.select(
            "*",
            F.lit(None).cast("string").alias("rejection_reason"),
            F.lit(False).alias("is_rejected"),
            *nothing,
        )
    text = F.substring(F.concat_ws("", *reasons), 1, MAX_REASON_LENGTH)
    names = F.transform(F.array_compact(F.array(*reasons)), lambda r: F.rtrim(r, F.lit(", ")))
    return df.select(
        "*",
        F.nullif(text, F.lit("")).alias("rejection_reason"),
        reduce(lambda a, b: a | b, violated).alias("is_rejected"),
        *([names.alias(RULES_COLUMN)] if keep_rules else []),
    )


def split_by_quality(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) halves of a validated frame; a null flag counts as valid."""
    return accepted(df), df.filter("is_rejected")


def rejection_report(df: DataFrame, *group_by: str) -> DataFrame:
    """Rows per group and single reason.

    Reasons are those of ``rejection_rules`` where the frame has them. Without, they are
    parsed from the texts; a text at its length limit may have been cut, so its last part
    is counted as ``CUT_REASON`` instead of passing for a reason.

    Whole lists are counted first: there are few distinct ones, so the explode runs on a
    handful of rows per group instead of on every rejected row.
    """
    groups = [F.col(g) for g in group_by]
    # The flag is the cheaper test: it is there before the text is built.
    rejected = "is_rejected" if "is_rejected" in df.columns else "rejection_reason is not null"
    source = RULES_COLUMN if RULES_COLUMN in df.columns else "rejection_reason"
    lists = df.filter(rejected).groupBy(*groups, source).agg(F.count(F.lit(1)).alias("n"))
    reasons = F.col(source)
    if source != RULES_COLUMN:
        # Texts end with a separator unless they were cut.
        parts = F.split(source, ", ")
        whole = F.slice(parts, 1, F.size(parts) - 1)
        cut = F.length(source) >= MAX_REASON_LENGTH
        reasons = F.when(cut, F.concat(whole, F.array(F.lit(CUT_REASON)))).otherwise(parts)
    singles = lists.select(*groups, F.explode(reasons).alias("reason"), "n").filter("reason <> ''")
    return singles.groupBy(*groups, "reason").agg(F.sum("n").alias("n_rows"))


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Keys of a fact that its dimension lacks, with their row counts.

    Null and '' mean "unknown member" in facts and are not orphans.
    """
    known = fact.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return unmatched_keys(counts, key, dim, dim_key)


def integrity_report(fact: DataFrame, links: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per link column: how many keys and rows have no dimension row.

    The fact is scanned once: its keys are unfolded by link and counted, in the tasks
    first, and one anti join with the keys of all dimensions finds the orphans.
    """
    keys = F.array(
        *[F.struct(F.lit(k).alias("link"), F.col(k).cast("string").alias("key")) for k in links]
    )
    counts = (
        fact.select(F.inline(keys))
        .filter("key is not null and key <> ''")
        .groupBy("link", "key")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = reduce(
        DataFrame.unionAll,
        [
            dim.select(F.lit(k).alias("link"), F.col(dim_key).cast("string").alias("key"))
            for k, (dim, dim_key) in links.items()
        ],
    ).distinct()
    orphans = counts.join(known, ["link", "key"], "left_anti").groupBy("link").agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("n_rows").alias("orphan_rows")
    )
    names = fact.sparkSession.createDataFrame([(k,) for k in links], "link string")
    zero = F.lit(0).cast("long")
    return names.join(orphans, "link", "left").select(
        "link",
        F.coalesce("orphan_keys", zero).alias("orphan_keys"),
        F.coalesce("orphan_rows", zero).alias("orphan_rows"),
    )


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability and the table's row count."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.inline(columns), "row_count").select(
        "position", "column_name", "data_type", "nullable", "row_count"
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        profile_table(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at; which ones is up to Spark."""
    return df.limit(n)
