"""Registered queries of the training-data operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmart.llm import (
    collocations,
    exact_dedup,
    itq_dedup,
    language_id,
    maxent_lm,
    mixing,
    quality,
    secret_ledger,
    sharding,
    simhash,
    spelling,
    toxicity,
)
from telmart.llm.common import bounded_sample, held_out, learnable, read, stored
from telmart.llm.digests import token_digests
from telmart.scratch import scratch_path


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"))


def op2_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_vectors(read(spark, sf_dir, "embeddings"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # The digest column is the query's own; the operator hashes survivors only.
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return exact_dedup.mark_duplicates(docs.withColumn("text_sha256", digest), carry=["text_sha256"])


def _labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Labels outside the held-out fold; of several of one document the largest counts."""
    labels = read(spark, sf_dir, "labels").where(learnable() & F.col(label).isNotNull())
    return labels.groupBy("doc_id").agg(F.max(label).alias("label"))


def _labelled(spark: SparkSession, sf_dir: str, label: str, sample_rows: int) -> DataFrame:
    """Documents outside the held-out fold with their label, about ``sample_rows`` at most.

    Labels are thinned first, so that the side that is broadcast has a size bound.
    """
    drawn = bounded_sample(_labels(spark, sf_dir, label), "doc_id", sample_rows)
    return read(spark, sf_dir, "documents").join(F.broadcast(drawn), "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit(_labelled(spark, sf_dir, "toxic", toxicity.SAMPLE_ROWS))
    scored = stored(toxicity.scores(read(spark, sf_dir, "documents"), model), "toxicity")
    toxicity.calibrate(model, scored, _labels(spark, sf_dir, "toxic"))
    answers = toxicity.decide(scored, model)
    return answers.select("doc_id", held_out().alias("held_out"), "score", "predicted", "flagged")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # A ledger of this run's own: every blob of the table is unseen.
    ledger = secret_ledger.update_ledger(docs, scratch_path(spark, "ledger"))
    found = F.col("found")

    def base(*kinds: str):
        return F.filter(found, lambda s: s["kind"].isin(*kinds))

    spans = secret_ledger.findings(docs, ledger)
    return spans.select(
        "doc_id",
        *(F.size(base(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_ledger.spans_text(base("assign", "access", "hex")), 256).alias("base_sha256"),
        secret_ledger.spans_text(found).alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    answers = language_id.identify(docs, language_id.fit_learnable(docs))
    return answers.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.mark_near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    answers = quality.classify(docs, quality.fit(_labelled(spark, sf_dir, "quality", quality.SAMPLE_ROWS)))
    return answers.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op10_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    answers = maxent_lm.score(docs, maxent_lm.fit(maxent_lm.learnable_docs(docs)))
    held = held_out(folds=maxent_lm.HELD_OUT_FOLDS).alias("held_out")
    return answers.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.vocabulary(read(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        F.col("checksum").alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_itq": op2_itq,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_secrets": op5_secrets,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_maxent_lm": op10_maxent_lm,
    "op11_spelling": op11_spelling,
    "op12_collocations": op12_collocations,
    "op13_sharding": op13_sharding,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        with hashed as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents)
        select doc_id, text_sha256,
               max(doc_id) over same_text as keep_id,
               count(*) over same_text as group_size,
               doc_id = max(doc_id) over same_text as kept
        from hashed
        window same_text as (partition by text_sha256)
    """,
    "op9_mixing": """
        with sized as (
            select doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size
            from documents),
        sources as (
            select source, sum(size)::bigint as source_size,
                   [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
            from sized group by source),
        levels as (
            select *, 3 * source_size as cap,
                   (sum(source_size) over () - coalesce(sum(3 * source_size) over below, 0))::double
                   / (sum(weight) over () - coalesce(sum(weight) over below, 0))::double as level
            from sources
            window below as (order by 3 * source_size / weight, source nulls last
                             rows between unbounded preceding and 1 preceding)),
        held as (select level from levels where level * weight <= cap
                 order by 3 * source_size / weight, level desc limit 1),
        targets as (
            select source, source_size,
                   least(held.level * weight, cap::double) as target,
                   ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8))::bigint::double
                   / 4294967296 as shift
            from levels, held),
        ranked as (
            select s.doc_id, s.size, t.source_size, t.target, t.shift,
                   case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
                   row_number() over (partition by s.source order by s.size, s.doc_id) as r
            from sized s join targets t on s.source is not distinct from t.source)
        select doc_id, size, source_size, target,
               (floor(r * rate + shift) - floor((r - 1) * rate + shift))::bigint * size as taken,
               (floor(r * rate + shift) - floor((r - 1) * rate + shift))::bigint as copies
        from ranked
    """,
}
