"""Inputs of the queries, derived from the test tables by integer arithmetic, alike in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.functions.scalars import edit_distance
from leafwright.session import table

#: Detections on pages of 800 x 1000, about thirty a page, from lineitem.
DETECTIONS = f"""
select *, case label {' '.join(f"when {i} then '{c}'" for i, c in enumerate(C.CLASSES))} end as class from (
select l_partkey as page_id,
 cast(row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate) - 1 as int) as det_idx,
 cast((l_suppkey*7+l_linenumber*3)%25 as int) as label,
 cast(cast((l_orderkey*37+l_linenumber*11)%1000 as double)/1000 as float) as score,
 cast((l_orderkey%2)*400+(l_linenumber*5)%20+0.5*(l_suppkey%2) as float) as x0,
 cast((l_orderkey%4)*250+(l_suppkey*3)%15 as float) as y0,
 cast((l_orderkey%2)*400+(l_linenumber*5)%20+4+((l_orderkey*7)%9)*45 as float) as x1,
 cast((l_orderkey%4)*250+(l_suppkey*3)%15+4+((l_orderkey*11)%7)*38 as float) as y1,
 cast((l_orderkey*31+l_linenumber)%64 as bigint) as read_order, 800 as width, 1000 as height
from {{lineitem}}) d0"""

#: Blocks of the recognised results; ties in reading order go by result_id.
BLOCKS = """
select stem as page, coalesce(read_order, 0) as read_order, result_id as idx, class, text from {results} where class is not null and text is not null"""

#: Pairs of neighbouring documents as scored samples, whole texts; the score is the edit distance, or a stand-in that SQL has too.
SAMPLES = """
select a.doc_id as doc_id, a.stem as img_id, a.source as source, coalesce(a.lang, 'none') as lang, a.stem as stem, a.g as norm_gt, b.g as norm_pred,
 cast(SCORE as bigint) as edit_num, cast(greatest(length(a.g), length(b.g)) as bigint) as upper_len
from (select doc_id, stem, source, lang, coalesce(text, '') as g from {documents}) a
join (select doc_id, coalesce(text, '') as g from {documents}) b on b.doc_id = a.doc_id + 1"""

#: DuckDB's levenshtein counts bytes, so what is compared with SQL takes the difference of the lengths for the score.
LENGTHS = SAMPLES.replace("SCORE", "abs(length(a.g) - length(b.g))")

TIMINGS = """
select stem, run_id, crops, layout_s, recognize_s, assemble_s from {speed_loadonce} where layout_s is not null and recognize_s is not null and assemble_s is not null and crops is not null"""


def _names(sql: str) -> list[str]:
    return [n for n in ("lineitem", "results", "documents", "speed_loadonce", "page_info", "manifest") if "{" + n + "}" in sql]


def spark_view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    table(spark, sf_dir, "region")  # ships the package
    return spark.sql(sql.format(**{n: f"parquet.`{sf_dir}/{n}.parquet`" for n in _names(sql)}))


def duck(sql: str) -> str:
    return sql.format(**{n: n for n in _names(sql)})


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, DETECTIONS)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, BLOCKS)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored by the edit distance of the whole texts.

    The distance takes time, not space, so both sides come in as many parts as the session shuffles into and
    are not put together again by their small size.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    docs = table(spark, sf_dir, "documents").withColumn("g", F.coalesce("text", F.lit("")))
    a = docs.select("doc_id", (F.col("doc_id") + 1).alias("_next"), "stem", "source", F.coalesce("lang", F.lit("none")).alias("lang"), F.col("g").alias("norm_gt")).repartition(parts, "_next")
    b = docs.select(F.col("doc_id").alias("_next"), F.col("g").alias("norm_pred")).repartition(parts, "_next")
    score = edit_distance(F.col("norm_gt"), F.col("norm_pred"))
    longer = F.greatest(F.length("norm_gt"), F.length("norm_pred")).cast("bigint")
    return a.join(b, "_next").select("doc_id", F.col("stem").alias("img_id"), "source", "lang", "stem", "norm_gt", "norm_pred", score.alias("edit_num"), longer.alias("upper_len"))


def samples_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, LENGTHS)


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, TIMINGS)
