"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators.compaction import CompactStore, as_records
from leafwright.session import shared_dir, table, through_disk


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the consolidated store, once.

    The files arrive twice: those written in the first nine tenths of the time, then the rest, for which the buckets
    that they reach are rewritten. The store is built when the query is defined.
    """
    store = CompactStore(spark, shared_dir(spark, "compact"))
    files = table(spark, sf_dir, "small_files").withColumn("written_at", F.col("written_at").cast("timestamp_ntz"))
    records = as_records(table(spark, sf_dir, "manifest"), table(spark, sf_dir, "speed_loadonce"))
    records = through_disk(records.join(files.select("file_id", "written_at"), "file_id", "left"), "records")
    first, last = files.agg(F.min("written_at"), F.max("written_at")).first()
    late = F.coalesce(F.col("written_at") > F.lit(first + (last - first) * 0.9), F.lit(False)) if first is not None else F.lit(False)
    for part in (~late, late):
        store.compact(records.where(part), files.where(part))
    return store.read().select("kind", "stem", "item")


QUERIES = {"p7_found": p7_found}

_NAME = r"lower(trim(regexp_replace(regexp_replace({0}, '^.*[/\\]', ''), '^\s+|\s+$', '', 'g')))"
SQL = {
    "p7_found": f"""
        select distinct 'manifest' as kind, regexp_replace({_NAME.format('stem')}, '\\.(png|jpg)$', '') as stem, {_NAME.format('crop')} as item
        from manifest where stem is not null and crop is not null
        union all
        select distinct 'timing', regexp_replace({_NAME.format('stem')}, '\\.(png|jpg)$', ''), cast(run_id as varchar)
        from speed_loadonce where stem is not null and run_id is not null"""
}
