"""Registered queries of the training-data operators: one ``opN_<name>`` each, over
the whole of its table with production parameters, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterframe.llm import chat, collocations, filter_audit, html_text, line_dedup, mixing, pii, quality_rules, sharding
from rosterframe.llm.classifier import quality_scores
from rosterframe.llm.common import read
from rosterframe.llm.embedding_dedup import embedding_classes
from rosterframe.llm.packing import pack
from rosterframe.llm.simhash import simhash_classes


#: A line on one page only is never boilerplate, however small its site.
SITE_LINES = {"max_ratio": 0.1, "min_pages": 2}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return line_dedup.drop_site_lines(docs, **SITE_LINES).select("doc_id", "text", "n_lines_dropped")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(read(spark, sf_dir, "documents"), shingle=4, max_distance=4, seed=42)


def op3_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.mismatched_replies(read(spark, sf_dir, "conversations"))
    out = chat.format_preferences(pairs, "conv_id", after="after")
    return out.withColumns({c: chat.mask_text(out[c]) for c in ("chosen_mask", "rejected_mask")})


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's address ends in the number of its document, whose text labels the page."""
    pages = read(spark, sf_dir, "pages")
    doc_of = F.expr(r"try_cast(regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([0-9]+)', 1) as long)")
    labelled = html_text.labelled_sample(pages, read(spark, sf_dir, "documents"), doc_of, fit_pages=2000)
    return html_text.extract(pages, html_text.fit(labelled), columns=["page_id", "url"])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                               max_false_rejection=0.05, delta=0.05, keep=["doc_id"]).select("row.doc_id", "*").drop("row")


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a secret of the corpus owner; this one serves the registered query."""
    out = pii.pseudonymize(read(spark, sf_dir, "documents"), key="registered query", columns=["doc_id", "text"])
    return out.select("doc_id", "text", F.size("pii").alias("n_private"), out.pii.kind.alias("kinds"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_classes(read(spark, sf_dir, "embeddings"), cosine=0.9)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), capacity=1024)


#: Sources are flattened until the entropy is 99.99 % of the greatest possible, or until the
#: smallest is repeated half as often again as the largest.
MIX = {"target_entropy": 0.9999, "max_repetition": 1.5, "block_tokens": 50_000}


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(read(spark, sf_dir, "documents"), **MIX)
            .select("doc_id", "source", "n_tokens", "epoch", "block", "order_key"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), max_words=3, min_count=10, covered_pct=50, top=2000)


def op12_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest needs of a text is taken before the rows are sorted, so texts don't move."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.assign(docs, weights=[1.0] * 40).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read(spark, sf_dir, t) for t in ("documents", "labels"))
    rows, failing = filter_audit.row_table(docs, filter_audit.text_filters(F.coalesce(docs.text, F.lit(""))), docs.lang, copies="E")
    marked = {n: filter_audit.label_ids(rows, labels.where(F.col(c) == 1).select("doc_id"), n)
              for n, c in (("good", "quality"), ("toxic", "toxic"))}
    return filter_audit.audit(rows, failing, marked)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_preference_chat": op3_preference_chat,
    "op4_html_main_text": op4_html_main_text,
    "op5_quality_rules": op5_quality_rules,
    "op6_pii_pseudonyms": op6_pii_pseudonyms,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_source_mixing": op10_source_mixing,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_rendezvous_sharding": op12_rendezvous_sharding,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle(**SITE_LINES),
    "op3_preference_chat": chat.oracle(),
    "op10_source_mixing": mixing.oracle(**MIX),
    "op11_phrase_collocations": collocations.oracle(),
    "op12_rendezvous_sharding": sharding.oracle(shards=40),
    "op13_filter_audit": filter_audit.oracle(),
}
