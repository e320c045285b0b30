"""Queries of the training-text problems; the core does not import this module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.llm import cutoff, language, lookalike, markup, mojibake, packing, repetition, scan, tokens
from leafwright.session import table, through_disk


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results whose text holds markup that is not their class's own form."""
    return markup.residue(table(spark, sf_dir, "results")).select("result_id").distinct()


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and clean text of every result."""
    return markup.cleaned(table(spark, sf_dir, "results"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of results whose texts look the same but differ in their characters."""
    return lookalike.same_look(table(spark, sf_dir, "results"))


def p2_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one consistent text of every result."""
    return lookalike.consistent(table(spark, sf_dir, "results"))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results that others look like: class, form, and how many forms and rows the class has."""
    return lookalike.look_classes(table(spark, sf_dir, "results"))


def _untabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "results").where(F.coalesce("class", F.lit("")) != "table").select("result_id", "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results in which more than half of the characters repeat earlier ones."""
    return repetition.repetitive(_untabled(spark, sf_dir)).select("result_id").distinct()


def p3_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of repeated content of every result but tables, by rule."""
    return repetition.shares(_untabled(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results whose text shows noise of a scanned page."""
    return scan.noisy(table(spark, sf_dir, "results")).select("result_id").distinct()


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prose results as continuous paragraphs with misread words replaced."""
    return scan.repaired(table(spark, sf_dir, "results"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with a missing or wrong language label, or several languages: one row per language."""
    return language.mislabelled(table(spark, sf_dir, "results")).distinct()


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of every result, with a confidence and what the label names."""
    return language.detect(table(spark, sf_dir, "results"))


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of every result, with language and confidence."""
    return language.segments(table(spark, sf_dir, "results"))


def p5_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language that the label of every result names, null for missing, filler and other labels."""
    return table(spark, sf_dir, "results").select("result_id", language.label_language(F.col("lang")).alias("labelled"))


def p6_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histograms that are tested for spikes: how many results of a source have each length, in characters and in bytes."""
    return cutoff.length_histogram(table(spark, sf_dir, "results")).select("source", "unit", "at", "n")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results whose text was cut."""
    return cutoff.cut_rows(table(spark, sf_dir, "results")).select("result_id").distinct()


def p6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of cut results of each source."""
    return cutoff.by_source(table(spark, sf_dir, "results"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document by byte_bpe_50k."""
    return tokens.encode(table(spark, sf_dir, "documents"))


def p8_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return tokens.decode(tokens.encode(table(spark, sf_dir, "documents")))


def p9_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document, or piece of one that exceeds the capacity, is placed for each container kind."""
    sizes = through_disk(tokens.sizes(table(spark, sf_dir, "documents")), "sizes")
    return packing.pack(sizes, table(spark, sf_dir, "containers"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each kind are."""
    return packing.fill_report(p9_placements(spark, sf_dir), table(spark, sf_dir, "containers"))


def p9_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per container kind, how many documents there are, how many have a place, and how many rows have none as they have no tokens."""
    placed = p9_placements(spark, sf_dir)
    return placed.groupBy("container_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.countDistinct(F.when(F.col("bin_id").isNotNull(), F.col("doc_id"))).alias("n_placed"), F.count_if(F.col("bin_id").isNull()).alias("n_without"))


def p9_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fullest containers of each kind by tokens, segments and loss-bearing tokens, and how many break a limit: none."""
    return packing.limit_report(p9_placements(spark, sf_dir), table(spark, sf_dir, "containers"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with characters that came from a wrong decoding."""
    return mojibake.affected(table(spark, sf_dir, "documents"), whole=False).select("doc_id").distinct()


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents with what could be restored and the chains that did it."""
    return mojibake.affected(table(spark, sf_dir, "documents")).select("doc_id", F.col("fixed").alias("text"), F.concat_ws(",", "chains").alias("chains"))


QUERIES = {
    "p1_found": p1_found,
    "p1_clean": p1_clean,
    "p2_found": p2_found,
    "p2_texts": p2_texts,
    "p2_classes": p2_classes,
    "p3_found": p3_found,
    "p3_shares": p3_shares,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p5_found": p5_found,
    "p5_languages": p5_languages,
    "p5_segments": p5_segments,
    "p5_labels": p5_labels,
    "p6_lengths": p6_lengths,
    "p6_found": p6_found,
    "p6_sources": p6_sources,
    "p8_ids": p8_ids,
    "p8_texts": p8_texts,
    "p9_placements": p9_placements,
    "p9_fill": p9_fill,
    "p9_limits": p9_limits,
    "p9_documents": p9_documents,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}
_LABEL = " ".join(f"when regexp_extract(lower(trim(lang)), '^([^-_ ]+)', 1) in ({', '.join(chr(39) + n + chr(39) for n in names)}) then '{code}'" for code, names in language.LABELS.items())
#: What SQL can say of these operators; the others are tested against brute force, planted cases and round trips.
SQL: dict[str, str] = {
    "p5_labels": f"select result_id, case {_LABEL} end as labelled from results",
    "p6_lengths": """with t as (select source, text from results where length(text) > 0)
        select source, 'char' as unit, cast(length(text) as int) as at, count(*) as n from t group by 1, 2, 3
        union all select source, 'byte', cast(strlen(text) as int), count(*) from t group by 1, 2, 3""",
    "p8_texts": "select doc_id, coalesce(text, '') as text from documents",
    "p9_documents": """select container_id, count(distinct doc_id) as n_documents, count(distinct doc_id) filter (coalesce(text, '') <> '') as n_placed, count(*) filter (coalesce(text, '') = '') as n_without
        from containers, documents where capacity_tokens > 0 group by 1""",
}
