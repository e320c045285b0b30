"""Queries of the evaluation, sampling and log operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.operators import evaluate as E
from leafwright.operators import geometry as G
from leafwright.operators import layout as L
from leafwright.operators import sampling as S
from leafwright.plans import views as V
from leafwright.session import table
from leafwright.sources import readers as R
from leafwright.sources import writers as W

Q: dict = {}
SQL: dict[str, str] = {}
D = f"d as ({V.duck(V.DETECTIONS)})"
B = f"b as ({V.duck(V.BLOCKS)})"
SM = f"s as ({V.duck(V.LENGTHS)})"
T = f"t as ({V.duck(V.TIMINGS)})"
_WHITE = " || ".join(f"chr({ord(c)})" for c in C.WHITE)
CATS = ", ".join(f"'{c}'" for c in C.TEXT_CATEGORIES)


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def scored(name: str, sql: str):
    """A query over scored samples: by the edit distance, which SQL cannot follow, and by length, compared with SQL."""

    def add(f):
        Q[name] = f
        Q[name + "_by_length"] = lambda spark, sf_dir: f(spark, sf_dir, V.samples_by_length)
        SQL[name + "_by_length"] = sql
        return f

    return add


def _six(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


_RATIO = "coalesce(edit_num::double/nullif(upper_len,0),0)"


def _reductions(by: str, src: str = "s") -> str:
    b = by + ", " if by else ""
    return f"""p as (select {b}img_id, sum(edit_num) e, sum(upper_len) u, sum({_RATIO}) r, count(*) c from {src} group by {b}img_id)
    select {b}cast(sum(c) as bigint) as n, count(*) as n_pages, round(coalesce(sum(e)::double/nullif(sum(u),0),0),6) as edit_whole, round(sum(r)/sum(c),6) as edit_sample_avg, round(avg(r/c),6) as page_avg from p {"group by " + by if by else ""}"""


@scored("edit_reductions", f"with {SM}, {_reductions('')}")
def edit_reductions(spark, sf_dir, samples=V.samples):
    return _six(E.edit_reductions(samples(spark, sf_dir)), "edit_whole", "edit_sample_avg", "page_avg")


@scored("edit_by_language", f"with {SM}, {_reductions('lang')}")
def edit_by_language(spark, sf_dir, samples=V.samples):
    return _six(E.edit_reductions(samples(spark, sf_dir), "lang"), "edit_whole", "edit_sample_avg", "page_avg")


@scored("edit_by_source", f"with {SM}, {_reductions('source')}")
def edit_by_source(spark, sf_dir, samples=V.samples):
    return _six(E.edit_reductions(samples(spark, sf_dir), "source"), "edit_whole", "edit_sample_avg", "page_avg")


@scored(
    "attribute_slices",
    f"""with {SM}, p as (select img_id, avg({_RATIO}) v from s group by 1), j as (select p.img_id, v, page_lang, layout_kind, special_issue from p join page_info i on i.stem = p.img_id),
    a as (select img_id, v, 'language' as attribute, coalesce(page_lang,'None') as slice from j union all select img_id, v, 'layout', coalesce(layout_kind,'None') from j
     union all select img_id, v, 'special_issue', unnest(case when coalesce(special_issue,'')='' then ['None'] else string_split(special_issue,';') end) from j)
    select attribute, slice, count(*) as n_pages, round(avg(v),6) as page_avg from a group by 1,2""",
)
def attribute_slices(spark, sf_dir, samples=V.samples):
    s = samples(spark, sf_dir)
    pages = s.groupBy("img_id").agg(F.avg(E.share(F.col("edit_num"), F.col("upper_len"))).alias("v"))
    info = table(spark, sf_dir, "page_info").select(F.col("stem").alias("img_id"), "page_lang", "layout_kind", "special_issue")
    one = lambda c: F.array_compact(F.array(c))
    issues = F.filter(F.split(F.coalesce("special_issue", F.lit("")), ";"), lambda x: x != "")
    attrs = {"language": one(F.col("page_lang")), "layout": one(F.col("layout_kind")), "special_issue": issues}
    return _six(E.attribute_slices(pages.join(info, "img_id"), attrs, "v"), "page_avg")


@scored(
    "overall_scores",
    f"""with {SM}, p as (select source, img_id, sum({_RATIO}) r, count(*) c from s group by 1, 2), q as (select source, avg(r/c) e from p group by 1)
    select source, round(((1-e)*100 + 90 + 80)/3, 6) as overall, round(((1-e)*100 + 90 + (1-e/2)*100)/3, 6) as proxy, round(((1-e)*100 + 90 + 100)/3, 6) as bound from q""",
)
def overall_scores(spark, sf_dir, samples=V.samples):
    r = E.edit_reductions(samples(spark, sf_dir), "source")
    e = F.col("page_avg")
    return _six(r.select("source", E.overall(e, F.lit(90.0), F.lit(80.0)).alias("overall"), E.overall_proxy(e, F.lit(90.0), e / 2).alias("proxy"), E.overall_bound(e, F.lit(90.0)).alias("bound")), "overall", "proxy", "bound")


@query("edit_shares")
def edit_shares(spark, sf_dir):
    """Every document with the next: edit distance of the whole texts as a share of the longer; null if both are empty."""
    return V.samples(spark, sf_dir).select("doc_id", "edit_num", "upper_len", F.try_divide("edit_num", "upper_len").alias("edit_share"))


_BUCKET = "case when length(norm_gt)>0 and length(norm_pred)=0 then 'MISS' when length(norm_pred)>0 and length(norm_gt)=0 then 'SPURIOUS' when edit_num=0 then 'EXACT' else 'RECOG' end"


@scored(
    "error_buckets",
    f"""with {SM}, g as (select {_BUCKET} as bucket, count(*) as n, sum(edit_num) e, sum(upper_len) u from s group by 1)
    select bucket, n, cast(e as bigint) as edits, cast(u as bigint) as chars, round(e::double/(select sum(u) from g),6) as contribution, round(e::double/(select sum(e) from g),6) as share from g""",
)
def error_buckets(spark, sf_dir, samples=V.samples):
    return _six(E.error_budget(samples(spark, sf_dir)), "contribution", "share")


_CATEGORY = "case when label in (22,0,4) then 'text_block' when label in (6,17) then 'title' when label in (18,19) then 'reference' when label = 12 then 'header' when label = 8 then 'footer' else 'figure' end"
_GT = f"""a as (select page_id, det_idx as ord, {_CATEGORY} as category, label = 0 as ignore, x0::double x0, y0::double y0, x1::double x1, y1::double y1 from d),
 sm as (select page_id, det_idx as sample_id, [det_idx, det_idx + 1] as gt_position, repeat('x', cast(5 + (det_idx*3+page_id)%20 as int)) as norm_gt, repeat('x', cast((det_idx*7+page_id)%26 as int)) as norm_pred, cast((det_idx*5+page_id)%9 as bigint) as edit_num from d where label in (22,17,19,3)),
 bx as (select page_id, x0::double x0, y0::double y0, x1::double x1, y1::double y1 from d where score > cast(0.5 as float)),
 lc as (select sm.*, g.gx0, g.gy0, g.gx1, g.gy1, g.category from sm left join (select w.page_id, w.sample_id, min(x0) gx0, min(y0) gy0, max(x1) gx1, max(y1) gy1, arg_min(category, a.ord) category
   from (select page_id, sample_id, unnest(gt_position) as ord from sm) w join a on a.page_id=w.page_id and a.ord=w.ord where category in ({CATS}) and not ignore group by 1,2) g on g.page_id=sm.page_id and g.sample_id=sm.sample_id),
 pr as (select lc.page_id, lc.sample_id, greatest(gx1-gx0,0)*greatest(gy1-gy0,0) ga, greatest(x1-x0,0)*greatest(y1-y0,0) ba, greatest(least(gx1,x1)-greatest(gx0,x0),0)*greatest(least(gy1,y1)-greatest(gy0,y0),0) i from lc join bx on bx.page_id=lc.page_id where gx0 is not null),
 st as (select page_id, sample_id, max(case when ga+ba-i>0 then i/(ga+ba-i) else 0 end) best, count(*) filter (ba>0 and i/ba>=0.5) n_inside, sum(case when ba>0 and i/ba>=0.5 and ga>0 then i/ga else 0 end) cover, bool_or(ga>0 and i/ga>=0.8 and ba>=1.5*ga) sw from pr group by 1,2),
 cs as (select lc.*, case when best is null then 'unlocatable' when length(norm_gt)>0 and length(norm_pred)=0 then case when best>=0.5 or cover>=0.7 then 'RECOG_EMPTY' else 'LAYOUT_MISS' end
   when best>=0.7 then case when length(norm_pred)::double/length(norm_gt)<0.9 then 'RECOG_SHORT' when length(norm_pred)::double/length(norm_gt)>1.1 then 'RECOG_LONG' else 'RECOG_SUBST' end
   when cover>=0.7 and n_inside>=2 then 'LAYOUT_SPLIT' when sw then 'LAYOUT_MERGE' when cover<0.7 then 'LAYOUT_PARTIAL' else 'OTHER' end as cause from lc left join st on st.page_id=lc.page_id and st.sample_id=lc.sample_id where edit_num > 0)"""


def _caused(spark, sf_dir):
    d = V.detections(spark, sf_dir)
    category = F.expr(_CATEGORY)
    ann = d.select("page_id", F.col("det_idx").alias("ord"), category.alias("category"), (F.col("label") == 0).alias("ignore"), *[F.col(c).cast("double").alias(c) for c in L.BOX])
    sm = d.where("label in (22, 17, 19, 3)").select(
        "page_id",
        F.col("det_idx").alias("sample_id"),
        F.expr("concat('[', det_idx, ', ', det_idx + 1, ']')").alias("gt_position"),  # as the scorer's JSON has it
        F.expr("repeat('x', cast(5 + (det_idx*3+page_id)%20 as int))").alias("norm_gt"),
        F.expr("repeat('x', cast((det_idx*7+page_id)%26 as int))").alias("norm_pred"),
        F.expr("cast((det_idx*5+page_id)%9 as bigint)").alias("edit_num"),
    )
    return E.causes(E.locate(sm.where("edit_num > 0"), ann), L.above_score(d, 0.5))


@query("cause_attribution", f"with {D}, {_GT} select page_id, sample_id, cause, category from cs")
def cause_attribution(spark, sf_dir):
    return _caused(spark, sf_dir).select("page_id", "sample_id", "cause", "category")


@query(
    "cause_rollup",
    f"""with {D}, {_GT}, x as (select case when cause in ('LAYOUT_MISS','LAYOUT_SPLIT','LAYOUT_MERGE','LAYOUT_PARTIAL') then 'layout' when cause in ('RECOG_EMPTY','RECOG_SHORT','RECOG_LONG','RECOG_SUBST') then 'recognition' else 'other' end as side, cause, edit_num from cs)
    select side, cause, count(*) as n, cast(sum(edit_num) as bigint) as edits from x group by rollup(side, cause)""",
)
def cause_rollup(spark, sf_dir):
    return E.cause_rollup(_caused(spark, sf_dir))


@query(
    "cause_ratio",
    f"""with {D}, {_GT}, x as (select sum(edit_num) filter (cause in ('LAYOUT_MISS','LAYOUT_SPLIT','LAYOUT_MERGE','LAYOUT_PARTIAL')) as l, sum(edit_num) filter (cause in ('RECOG_EMPTY','RECOG_SHORT','RECOG_LONG','RECOG_SUBST')) as r, sum(edit_num) as t from cs)
    select cast(l as bigint) as layout_edits, cast(r as bigint) as recognition_edits, round(l::double/t,6) as layout_share, round(r::double/t,6) as recognition_share, round(l::double/r,6) as ratio from x""",
)
def cause_ratio(spark, sf_dir):
    return _six(E.side_ratio(_caused(spark, sf_dir)), "layout_share", "recognition_share", "ratio")


@query(
    "cause_categories",
    f"""with {D}, {_GT}, c as (select cause, category, count(*) as n from cs where category is not null group by 1,2), r as (select *, row_number() over (partition by cause order by n desc, category) as rank from c) select cause, category, n, cast(rank as int) as rank from r where rank <= 3""",
)
def cause_categories(spark, sf_dir):
    counts = _caused(spark, sf_dir).where("category is not null").groupBy("cause", "category").agg(F.count(F.lit(1)).alias("n"))
    return E.top_per_group(counts, "cause", "category", "n")


@query(
    "worst_layout_pages",
    f"""with {D}, {_GT} select page_id, cast(sum(edit_num) as bigint) as edits from cs where cause like 'LAYOUT%' group by 1 order by edits desc, page_id limit 8""",
)
def worst_layout_pages(spark, sf_dir):
    c = _caused(spark, sf_dir).where(F.col("cause").isin(*E.LAYOUT_CAUSES))
    return c.groupBy("page_id").agg(F.sum("edit_num").alias("edits")).orderBy(F.desc("edits"), "page_id").limit(8)


@scored(
    "verbatim_recoverable",
    f"""with {SM}, p as (select img_id, string_agg(norm_pred, ' ' order by doc_id) as page_text from s group by 1)
    select doc_id, s.img_id as img_id, edit_num, contains(page_text, norm_gt) as found from s join p on p.img_id = s.img_id where edit_num > 0 and length(norm_gt) >= 8""",
)
def verbatim_recoverable(spark, sf_dir, samples=V.samples):
    s = samples(spark, sf_dir).select("doc_id", "img_id", "norm_gt", "norm_pred", "edit_num")
    return E.recoverable(s, "doc_id").select("doc_id", "img_id", "edit_num", "found")


@query(
    "stage_medians",
    f"""with {T}, f as (select 'layout' as stage, layout_s as v from t union all select 'recognize', recognize_s from t union all select 'assemble', assemble_s from t union all select 'total', layout_s+recognize_s+assemble_s from t)
    select stage, count(*) as n, round(median(v),6) as median, min(v) as lowest, max(v) as highest from f group by 1""",
)
def stage_medians(spark, sf_dir):
    return _six(E.stage_medians(V.timings(spark, sf_dir)), "median")


_PAIR = """a as (select stem, layout_s+recognize_s+assemble_s as first_s from t where run_id = 1), c as (select stem, crops, recognize_s + 0.88 as second_s from t where run_id = 2), p as (select a.stem as stem, crops, first_s, second_s from a join c on a.stem=c.stem)"""


@query("paired_timings", f"with {T}, {_PAIR} select stem, crops, round(first_s,6) as first_s, round(second_s,6) as second_s from p")
def paired_timings(spark, sf_dir):
    t = V.timings(spark, sf_dir)
    return _six(E.paired_timings(t.where("run_id = 1"), t.where("run_id = 2")), "first_s", "second_s")


@query(
    "bucket_medians",
    f"""with {T}, {_PAIR}, k as (select first_s, second_s, unnest(list_filter([case when crops between 1 and 5 then '1-5' when crops between 6 and 10 then '6-10' when crops between 11 and 15 then '11-15' when crops between 16 and 25 then '16-25' when crops between 26 and 40 then '26-40' when crops between 41 and 200 then '41-200' end, 'ALL'], lambda x: x is not null)) as bucket from p)
    select bucket, count(*) as n, round(median(first_s),6) as first, round(median(second_s),6) as second, round(median(first_s)/median(second_s),6) as ratio from k group by 1""",
)
def bucket_medians(spark, sf_dir):
    t = V.timings(spark, sf_dir)
    return _six(E.bucket_medians(E.paired_timings(t.where("run_id = 1"), t.where("run_id = 2"))), "first", "second", "ratio")


@query("ols_fit", f"with {T} select round(regr_slope(recognize_s, crops),6) as slope, round(regr_intercept(recognize_s, crops),6) as intercept, cast(regr_count(recognize_s, crops) as bigint) as n from t")
def ols_fit(spark, sf_dir):
    return _six(E.line_fit(V.timings(spark, sf_dir), "recognize_s", "crops"), "slope", "intercept")


@query("per_crop_seconds", f"with {T} select round(median(recognize_s/crops),6) as per_crop_s, count(*) as n from t where crops > 0")
def per_crop_seconds(spark, sf_dir):
    return _six(E.per_crop_seconds(V.timings(spark, sf_dir)), "per_crop_s")


_VIS = "class in ('chart','image','header_image','footer_image','seal')"
_VD = f"""v as (select page, count(*) filter ({_VIS}) as n_dropped, cast(sum(case when {_VIS} then length(trim(text, {_WHITE})) else 0 end) as bigint) as chars_dropped, cast(sum(case when {_VIS} then 0 else length(trim(text, {_WHITE})) end) as bigint) as chars_kept from b group by 1)"""


@query("visual_drop_pages", f"with {B}, {_VD} select * from v")
def visual_drop_pages(spark, sf_dir):
    return E.visual_drop(V.blocks(spark, sf_dir))


@query("visual_drop_top", f"with {B}, {_VD} select page, chars_dropped, chars_kept from v where chars_dropped > 0 order by chars_dropped desc, page limit 10")
def visual_drop_top(spark, sf_dir):
    v = E.visual_drop(V.blocks(spark, sf_dir)).where("chars_dropped > 0")
    return v.orderBy(F.desc("chars_dropped"), "page").limit(10).select("page", "chars_dropped", "chars_kept")


@query("visual_drop_classes", f"with {B} select class, count(*) as regions, cast(sum(length(trim(text, {_WHITE}))) as bigint) as chars from b where {_VIS} group by 1")
def visual_drop_classes(spark, sf_dir):
    return E.visual_drop_classes(V.blocks(spark, sf_dir))


@scored(
    "visual_drop_effect",
    f"""with {B}, {_VD}, {SM}, p as (select img_id, avg({_RATIO}) as e from s group by 1) select chars_dropped > 0 as flag, count(e) as n, round(median(e),6) as median, round(avg(e),6) as mean from v join p on img_id = page group by 1""",
)
def visual_drop_effect(spark, sf_dir, samples=V.samples):
    s = samples(spark, sf_dir)
    p = s.groupBy(F.col("img_id").alias("page")).agg(F.avg(E.share(F.col("edit_num"), F.col("upper_len"))).alias("e"))
    return _six(E.compare_groups(E.visual_drop(V.blocks(spark, sf_dir)).join(p, "page"), F.col("chars_dropped") > 0, "e"), "median", "mean")


@query(
    "mean_delta",
    f"""with {T}, a as (select stem, recognize_s as x from t where run_id = 1), c as (select stem, recognize_s as y from t where run_id = 2) select count(*) as n, round(avg(x),6) as mean_a, round(avg(y),6) as mean_b, round(avg(y)-avg(x),6) as delta from a join c on a.stem = c.stem""",
)
def mean_delta(spark, sf_dir):
    t = V.timings(spark, sf_dir)
    return _six(E.mean_delta(t.where("run_id = 1"), t.where("run_id = 2"), ["stem"], "recognize_s"), "mean_a", "mean_b", "delta")


@scored(
    "relative_profile",
    f"""with {SM}, p as (select source, sum(edit_num)::double/nullif(sum(upper_len),0) as ours, avg(length(norm_gt)) as theirs from s group by 1)
    select source, round(ours/(select avg(ours) from p) - theirs/(select avg(theirs) from p), 6) as delta from p""",
)
def relative_profile(spark, sf_dir, samples=V.samples):
    s = samples(spark, sf_dir)
    p = s.groupBy("source").agg(F.try_divide(F.sum("edit_num").cast("double"), F.nullif(F.sum("upper_len"), F.lit(0))).alias("ours"), F.avg(F.length("norm_gt")).alias("theirs"))
    return _six(E.relative_profile(p, "source", "ours", "theirs"), "delta")


_COVER = """cv as (select t.page_id, t.det_idx, least(1.0, coalesce(sum(greatest(least(t.x1,b.x1)-greatest(t.x0,b.x0),0)::double*greatest(least(t.y1,b.y1)-greatest(t.y0,b.y0),0)::double) filter (b.label % 3 = 0), 0)/((t.x1-t.x0)::double*(t.y1-t.y0)::double)) as ours,
 least(1.0, coalesce(sum(greatest(least(t.x1,b.x1)-greatest(t.x0,b.x0),0)::double*greatest(least(t.y1,b.y1)-greatest(t.y0,b.y0),0)::double) filter (b.label % 3 = 1), 0)/((t.x1-t.x0)::double*(t.y1-t.y0)::double)) as raw,
 least(1.0, coalesce(sum(greatest(least(t.x1,b.x1)-greatest(t.x0,b.x0),0)::double*greatest(least(t.y1,b.y1)-greatest(t.y0,b.y0),0)::double) filter (b.label % 3 <= 1), 0)/((t.x1-t.x0)::double*(t.y1-t.y0)::double)) as full_set
 from d t join d b on t.page_id=b.page_id where t.label = 5 group by t.page_id, t.det_idx, t.x0, t.y0, t.x1, t.y1)"""


def _covers(spark, sf_dir):
    d = V.detections(spark, sf_dir)
    b = d.select("page_id", F.col("label").alias("bl"), *[F.col(c).alias("b_" + c) for c in L.BOX])
    t = d.where("label = 5")
    j = t.join(b, "page_id")
    side = lambda p, q: F.greatest(q - p, F.lit(0.0).cast("float")).cast("double")
    i = side(F.greatest("x0", "b_x0"), F.least("x1", "b_x1")) * side(F.greatest("y0", "b_y0"), F.least("y1", "b_y1"))
    own = (F.col("x1") - F.col("x0")).cast("double") * (F.col("y1") - F.col("y0")).cast("double")
    part = lambda c: F.least(F.lit(1.0), F.sum(F.when(c, i).otherwise(0.0)) / F.first(own))
    return j.groupBy("page_id", "det_idx").agg(part(F.col("bl") % 3 == 0).alias("ours"), part(F.col("bl") % 3 == 1).alias("raw"), part(F.col("bl") % 3 <= 1).alias("full_set"))


@query(
    "coverage_report",
    f"""with {D}, {_COVER}, f as (select 'ours' as name, ours as c from cv union all select 'raw', raw from cv union all select 'full_set', full_set from cv) select name, round(avg(c),6) as mean_cover, count(*) filter (c < 0.7) as below, count(*) as n from f group by 1""",
)
def coverage_report(spark, sf_dir):
    return _six(E.coverage_report(_covers(spark, sf_dir), ["ours", "raw", "full_set"]), "mean_cover")


_SETS = """sa as (select * from d where label % 3 = 0 and page_id % 5 <> 0), sb as (select * from d where label % 3 = 1 and page_id % 7 <> 0), sc as (select * from d where label % 3 <= 1),
    sh as (select page_id from sa intersect select page_id from sb intersect select page_id from sc)"""


@query(
    "coverage_shared_pages",
    f"""with {D}, {_SETS}, x as (select page_id, x0, y0, x1, y1, 'ours' as name from sa union all select page_id, x0, y0, x1, y1, 'raw' from sb union all select page_id, x0, y0, x1, y1, 'full_set' from sc),
    t as (select d.* from d join sh on sh.page_id = d.page_id where label = 5),
    c as (select t.page_id, t.det_idx, n.name, least(1.0, coalesce(sum(greatest(least(t.x1,x.x1)-greatest(t.x0,x.x0),0)::double*greatest(least(t.y1,x.y1)-greatest(t.y0,x.y0),0)::double), 0)/any_value((t.x1-t.x0)::double*(t.y1-t.y0)::double)) as c
      from t cross join (select unnest(['ours','raw','full_set']) as name) n left join x on x.page_id = t.page_id and x.name = n.name group by 1, 2, 3)
    select name, round(avg(c),6) as mean_cover, count(*) filter (c < 0.7) as below, count(*) as n from c group by 1""",
)
def coverage_shared_pages(spark, sf_dir):
    """Three box sets that lack different pages, compared on the pages that all of them have."""
    d = V.detections(spark, sf_dir)
    sets = {"ours": d.where("label % 3 = 0 and page_id % 5 <> 0"), "raw": d.where("label % 3 = 1 and page_id % 7 <> 0"), "full_set": d.where("label % 3 <= 1")}
    targets = E.on_shared_pages(d.where("label = 5"), sets)
    every = [b.select("page_id", *[F.col(c).alias("b_" + c) for c in L.BOX], F.lit(n).alias("set")) for n, b in sets.items()]
    boxes = every[0].unionByName(every[1]).unionByName(every[2])
    side = lambda p, q: F.greatest(q - p, F.lit(0.0).cast("float")).cast("double")
    i = side(F.greatest("x0", "b_x0"), F.least("x1", "b_x1")) * side(F.greatest("y0", "b_y0"), F.least("y1", "b_y1"))
    own = (F.col("x1") - F.col("x0")).cast("double") * (F.col("y1") - F.col("y0")).cast("double")
    part = lambda n: F.least(F.lit(1.0), F.sum(F.when(F.col("set") == n, i).otherwise(0.0)) / F.first(own)).alias(n)
    covers = targets.join(boxes, "page_id").groupBy("page_id", "det_idx").agg(*[part(n) for n in sets])
    return _six(E.coverage_report(covers, list(sets)), "mean_cover")


@query(
    "coverage_verdict",
    f"""with {D}, {_COVER}, a as (select count(*) filter (ours<0.7 and raw>=0.7) as ours_only, count(*) filter (raw<0.7 and ours>=0.7) as raw_only, count(*) filter (ours<0.7 and full_set>=0.7) as recovered, count(*) filter (full_set<0.7 and ours>=0.7) as lost, count(*) filter (ours<0.7 and raw<0.7 and full_set<0.7) as all_fail, abs(avg(ours)-avg(raw)) as gap from cv)
    select ours_only, raw_only, recovered, lost, all_fail, gap < 0.02 as faithful, recovered > 2*lost as helps from a""",
)
def coverage_verdict(spark, sf_dir):
    return E.coverage_verdict(_covers(spark, sf_dir), "ours", "raw", "full_set")


@query(
    "box_set_compare",
    f"""with {D}, r as (select page_id, row_number() over (partition by page_id order by det_idx) p, class, x0 from d where score > cast(0.5 as float)), q as (select page_id, row_number() over (partition by page_id order by det_idx) p, class, x0 from d where score > cast(0.45 as float)),
    m as (select coalesce(r.page_id, q.page_id) as page_id, r.class is not distinct from q.class and r.x0 is not distinct from q.x0 as ok from r full outer join q on r.page_id=q.page_id and r.p=q.p) select page_id, bool_and(ok) as same from m group by 1""",
)
def box_set_compare(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("page_id").orderBy("det_idx")
    d = V.detections(spark, sf_dir)
    number = lambda x: x.withColumn("p", F.row_number().over(w))
    return E.same_boxes(number(L.above_score(d, 0.5)), number(L.above_score(d, 0.45)), ["page_id", "p"], ["class", "x0"])


_A, _B = "greatest(a.x1-a.x0,0)*greatest(a.y1-a.y0,0)", "greatest(b.x1-b.x0,0)*greatest(b.y1-b.y0,0)"


@query(
    "dropped_by_class",
    f"""with {D} select a.class as class, count(*) as n from d a where exists (select 1 from d b where a.page_id=b.page_id and a.det_idx<>b.det_idx and b.class not in ('chart','image','header_image','footer_image','seal')
    and {_A} > 0 and {_B} > {_A} and cast(greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0)/({_A}) as float) >= cast(0.8 as float)) group by 1""",
)
def dropped_by_class(spark, sf_dir):
    """Set difference of all and kept regions, counted by class."""
    d = V.detections(spark, sf_dir)
    return d.join(L.drop_nested(d).select("page_id", "det_idx"), ["page_id", "det_idx"], "left_anti").groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pending_pages",
    """select stem as page from page_info where stem not in (select stem from results where stem is not null)""",
)
def pending_pages(spark, sf_dir):
    listed = table(spark, sf_dir, "page_info").select(F.col("stem").alias("page"))
    done = table(spark, sf_dir, "results").select(F.col("stem").alias("page"))
    return E.pending(listed, done)


@query(
    "completeness",
    """with m as (select stem as page, count(*) as n_tasks from manifest group by 1), r as (select stem as page, count(*) as n_results from results group by 1)
    select coalesce(m.page, r.page) as page, coalesce(n_tasks,0) as n_tasks, coalesce(n_results,0) as n_results, coalesce(n_tasks,0) > 0 and coalesce(n_tasks,0) = coalesce(n_results,0) as complete from m full outer join r on m.page = r.page""",
)
def completeness(spark, sf_dir):
    m = table(spark, sf_dir, "manifest").select(F.col("stem").alias("page"))
    r = table(spark, sf_dir, "results").select(F.col("stem").alias("page"))
    return E.complete(m, r)


@query(
    "arm_identity",
    f"""with {B}, x as (select page, string_agg(text, '|' order by read_order, idx) as t from b group by 1), y as (select page, string_agg(text, '|' order by read_order, idx) as t from b where class <> 'seal' group by 1)
    select count(*) as n, count(*) filter (x.t = y.t) as same, count(*) filter (x.t <> y.t) as differ, count(*) filter ((x.t is null) <> (y.t is null)) as only_one from x full outer join y on x.page = y.page""",
)
def arm_identity(spark, sf_dir):
    from leafwright.operators.assemble import ordered_concat

    b = V.blocks(spark, sf_dir)
    arm = lambda d: ordered_concat(d, "page", ["read_order", "idx"], "text", gap="|")
    return E.identical(arm(b), arm(b.where("class <> 'seal'")), "page", "text")


@query(
    "aligned_results",
    f"""with {B}, x as (select page, row_number() over (partition by page order by read_order, idx) p, read_order, class from b), y as (select page, row_number() over (partition by page order by read_order, idx) p, read_order, case when idx % 50 = 0 then 'text' else class end as class from b),
    m as (select coalesce(x.page,y.page) as page, bool_and(x.read_order is not distinct from y.read_order and x.class is not distinct from y.class) as aligned from x full outer join y on x.page=y.page and x.p=y.p group by 1) select page, aligned from m""",
)
def aligned_results(spark, sf_dir):
    from leafwright.operators.assemble import positions

    b = positions(V.blocks(spark, sf_dir))
    regions = b.withColumn("class", F.when(F.col("idx") % 50 == 0, F.lit("text")).otherwise(F.col("class")))
    return E.positional(b, regions).select("page", "aligned").distinct()


@query(
    "subset_join",
    """with l as (select stem, row_number() over (order by stem) - 1 as pos from page_info where layout_kind = 'two_column') select l.stem as stem, cast(pos as bigint) as pos, source from l join page_info p on p.stem = l.stem""",
)
def subset_join(spark, sf_dir):
    info = table(spark, sf_dir, "page_info")
    listed = S.numbered(info.where("layout_kind = 'two_column'").select("stem", F.lit("all").alias("g")), "g", ["stem"]).select("stem", F.col("_i").cast("bigint").alias("pos"))
    return E.subset(listed, info.select("stem", "source"), "stem").select("stem", "pos", "source")


@query("shared_pages", "select distinct stem from results where class = 'table' intersect select distinct stem from results where class = 'display_formula'")
def shared_pages(spark, sf_dir):
    r = table(spark, sf_dir, "results")
    return r.where("class = 'table'").select("stem").intersect(r.where("class = 'display_formula'").select("stem"))


@query("page_counters", "select stem, cast(sum(n) as bigint) as n from (select stem, count(*) as n from results group by 1 union all select stem, count(*) from documents group by 1) x group by 1")
def page_counters(spark, sf_dir):
    r = table(spark, sf_dir, "results").groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    d = table(spark, sf_dir, "documents").groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    return r.unionByName(d).groupBy("stem").agg(F.sum("n").alias("n"))


@query(
    "truncated_parts",
    """with g as (select doc_id as group_id, unnest([doc_id * 7, doc_id * 3, -doc_id]) as id from documents), p as (select result_id as id, coalesce(read_order, 0) as ord, text from results where text is not null)
    select group_id, string_agg(text, '' order by ord, p.id) as text from g join p on p.id = g.id group by 1""",
)
def truncated_parts(spark, sf_dir):
    groups = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("group_id"), F.expr("array(doc_id * 7, doc_id * 3, -doc_id)").alias("ids"))
    parts = table(spark, sf_dir, "results").where("text is not null").select(F.col("result_id").alias("id"), F.coalesce("read_order", F.lit(0)).alias("ord"), "text")
    return E.resolve_parts(groups, parts)


@query(
    "stratified_sample",
    """with c as (select source, count(*) as n from page_info group by 1), t as (select sum(n) as total from c), r as (select source, n, n::double/total*150 as x from c, t), a as (select *, greatest(1, trunc(x)) as k from r),
    f as (select *, row_number() over (order by x - trunc(x) desc, source) as up, 150 - sum(k) over () as miss from a), g as (select source, n, cast(k + case when up <= miss then 1 else 0 end as bigint) as k from f),
    p as (select source, stem, row_number() over (partition by source order by coalesce(page_lang,''), coalesce(layout_kind,''), image_path) - 1 as i from page_info), q as (select source, n, k, unnest(range(0, k)) as j from g where k < n)
    select p.source as source, p.stem as stem from p join q on p.source = q.source and p.i = least(q.n - 1, cast(floor((q.j + 0.5) * q.n / q.k) as bigint)) union all select p.source, p.stem from p join g on p.source = g.source where g.k >= g.n""",
)
def stratified_sample(spark, sf_dir):
    info = table(spark, sf_dir, "page_info").select("source", "stem", F.coalesce("page_lang", F.lit("")).alias("l"), F.coalesce("layout_kind", F.lit("")).alias("k"), "image_path")
    return S.stratified(info, "source", ["l", "k", "image_path"], 150).select("source", "stem")


@query("attribute_distribution", "select coalesce(layout_kind,'None') as layout, coalesce(page_lang,'None') as language, count(*) as n from page_info group by 1,2")
def attribute_distribution(spark, sf_dir):
    info = table(spark, sf_dir, "page_info")
    return S.distribution(info.select(F.coalesce("layout_kind", F.lit("None")).alias("layout"), F.coalesce("page_lang", F.lit("None")).alias("language")), "layout", "language")


# sources and sinks


@query("results_json", f"""with {B}, j as (select page, '[' || string_agg('{{"read_order":' || read_order || ',"class":"' || class || '","text":' || cast(to_json(text) as varchar) || '}}', ',' order by read_order, idx) || ']' || chr(10) as json from b group by 1) select page, json from j""")
def results_json(spark, sf_dir):
    return W.results_json(V.blocks(spark, sf_dir))


@query("results_parse", f"with {B} select page, read_order, class, text from b")
def results_parse(spark, sf_dir):
    """Result files are written as JSON and read again."""
    return R.parse_results(W.results_json(V.blocks(spark, sf_dir))).select("page", "read_order", "class", "text")


@query("results_parse_dirty", f"with {B} select page, case when idx % 3 = 0 then 0 else read_order end as read_order, class, text from b where idx % 7 <> 0")
def results_parse_dirty(spark, sf_dir):
    """A text that is a number and an order that is a fraction, among whole rows."""
    b = V.blocks(spark, sf_dir)
    order = F.when(F.col("idx") % 3 == 0, F.lit("0.5")).otherwise(F.col("read_order").cast("string"))
    text = F.when(F.col("idx") % 7 == 0, F.lit("5")).otherwise(F.expr("substr(to_json(struct(text)), 9, length(to_json(struct(text))) - 9)"))
    row = F.concat(F.lit('{"read_order":'), order, F.lit(',"class":"'), F.col("class"), F.lit('","text":'), text, F.lit("}"))
    files = b.groupBy("page").agg(F.concat(F.lit("["), F.array_join(F.collect_list(row), ","), F.lit("]")).alias("json"))
    return R.parse_results(files).select("page", "read_order", "class", "text")


@query("results_lenient", f"with {B} select page, count(*) as n from b where page < 'n' group by 1")
def results_lenient(spark, sf_dir):
    """Files of half the pages are cut off and skipped."""
    j = W.results_json(V.blocks(spark, sf_dir)).withColumn("json", F.when(F.col("page") < "n", F.col("json")).otherwise(F.expr("substr(json, 1, length(json) - 3)")))
    return R.parse_results(j, strict=False).groupBy("page").agg(F.count(F.lit(1)).alias("n"))


@query("page_list", "select stem from page_info")
def page_list(spark, sf_dir):
    info = table(spark, sf_dir, "page_info")
    lines = info.select(F.explode(F.array(F.concat(F.lit("  "), "stem", F.lit(" \t")), F.lit("# a comment"), F.lit("   "))).alias("value"))
    return R.page_list(lines).select(F.col("value").alias("stem"))


def _log(spark, sf_dir):
    """Run-log lines of all pages in eight files; every third page has an older block in the file before."""
    base = V.detections(spark, sf_dir)
    begin = F.col("page_id").cast("bigint") * (1 << 32)  # a line number for every region that a page can have
    old = base.where("page_id % 3 = 0").withColumn("score", F.lit(0.111).cast("float")).withColumn("run", F.lit(0))
    both = old.unionByName(base.withColumn("run", F.lit(1)))
    file_no = F.col("run") * 8 + F.col("page_id") % 8
    head = both.select(file_no.alias("file_no"), begin.alias("line_no"), F.format_string("[%d] == page_%d ==", "page_id", "page_id").alias("value")).distinct()
    row = F.concat(F.lit("  read_order="), F.lpad(F.col("read_order").cast("string"), 3, " "), F.lit(" "), "class", F.lit(" score="), F.format_string("%.3f", F.col("score").cast("double")), F.lit(" bbox=["), F.concat_ws(", ", *[F.format_string("%.1f", F.col(c).cast("double")) for c in L.BOX]), F.lit("]"))
    return head.unionByName(both.select(file_no.alias("file_no"), (begin + 1 + F.col("det_idx")).alias("line_no"), row.alias("value")))


@query(
    "log_parse_carry",
    f"""with {D} select 'page_' || page_id as stem, det_idx as pos, read_order, class, round(score::double,3) as score, round(x0::double,1) as x0, round(y1::double,1) as y1 from d""",
)
def log_parse_carry(spark, sf_dir):
    r = R.region_log(_log(spark, sf_dir))
    return r.select("stem", "pos", "read_order", "class", "score", F.col("bbox")[0].alias("x0"), F.col("bbox")[3].alias("y1"))


@query("timing_log", f"with {T}, m as (select stem, run_id, max(floor(recognize_s)) as s from t group by 1, 2) select stem, cast(arg_max(s, run_id) as double) as seconds from m group by 1")
def timing_log(spark, sf_dir):
    """One log file a run, with the same numbers in each."""
    t = V.timings(spark, sf_dir).groupBy("stem", "run_id").agg(F.max(F.floor("recognize_s")).alias("s"))
    n = F.pmod(F.xxhash64("stem"), F.lit(1_000_000_000))
    pair = F.array(F.struct((n * 2).alias("line_no"), F.concat(F.lit("["), n, F.lit("] == "), "stem", F.lit(" ==")).alias("value")), F.struct((n * 2 + 1).alias("line_no"), F.concat(F.lit("["), n, F.lit("] wrote out/x.md in "), F.col("s"), F.lit("s")).alias("value")))
    return R.timing_log(t.select(F.col("run_id").alias("file"), F.explode(pair).alias("x")).select("file", "x.line_no", "x.value"))


@query("second_timing_log", f"with {T}, m as (select stem, run_id, cast(max(crops) as int) as c, round(max(recognize_s),1) as s from t where crops % 2 = 0 group by 1, 2) select stem, arg_max(c, run_id) as crops, arg_max(s, run_id) as seconds from m group by 1")
def second_timing_log(spark, sf_dir):
    t = V.timings(spark, sf_dir)
    m = t.groupBy("stem", "run_id", (F.col("crops") % 2 == 0).alias("even")).agg(F.max("crops").alias("crops"), F.max("recognize_s").alias("s"))
    i = F.when(F.col("even"), F.lit(211)).otherwise(F.lit(210))
    lines = m.select(F.col("run_id").alias("file"), F.lit(1).alias("line_no"), F.concat(F.lit("["), i, F.lit("/1651] "), "stem", F.lit(": "), F.col("crops").cast("int"), F.lit(" crops, 10 bytes, "), F.round("s", 1), F.lit("s")).alias("value"))
    return R.second_timing_log(lines, t.select("stem").distinct())


@query("page_elapsed", "select run, stem, epoch_us(coalesce(lead(ts) over (partition by run order by ts, stem), ended)) - epoch_us(ts) as micros from (select kind as run, path as stem, written_at as ts, max(written_at) over (partition by kind) as ended from small_files where file_id in (select min(file_id) from small_files group by kind, written_at)) x")
def page_elapsed(spark, sf_dir):
    from pyspark.sql import Window

    f = table(spark, sf_dir, "small_files")
    first = f.groupBy("kind", "written_at").agg(F.min_by("path", "file_id").alias("path"))
    ends = f.groupBy("kind").agg(F.max("written_at").alias("ended"))
    return R.page_elapsed(first.join(ends, "kind").select(F.col("kind").alias("run"), F.col("path").alias("stem"), F.col("written_at").alias("at"), "ended"))


@scored("scorer_log", f"""with {SM}, p as (select source, round(sum(edit_num)::double/nullif(sum(upper_len),0),4) as value from s group by 1) select 'run1' as run, source as slice, value from p where value is not null""")
def scorer_log(spark, sf_dir, samples=V.samples):
    s = samples(spark, sf_dir).groupBy("source").agg(F.round(F.try_divide(F.sum("edit_num").cast("double"), F.nullif(F.sum("upper_len"), F.lit(0))), 4).alias("v")).where("v is not null")
    line = F.concat(F.lit("data_source: "), "source", F.lit("   "), F.format_string("%.4f", "v"))
    text = s.agg(F.concat(F.lit("preamble\n【table】\nALL 0.5\n【text_block】\nEdit_dist:\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n"), F.lit("\n【reading_order】\nALL 0.1\n")).alias("text"))
    return R.scorer_log(text.select(F.lit("run1").alias("run"), "text"), "text_block")


@query("page_key", "select stem, image_path as image from page_info")
def page_key(spark, sf_dir):
    info = table(spark, sf_dir, "page_info")
    return R.page_key(info.select("stem"), info.select(F.col("image_path").alias("image")))


@query("timing_rows", f"with {T} select stem, crops, printf('%.3f', layout_s) as layout_s, printf('%.3f', recognize_s) as recognize_s, printf('%.3f', assemble_s) as assemble_s from t")
def timing_rows(spark, sf_dir):
    return W.timing_rows(V.timings(spark, sf_dir))


@query(
    "markdown_table",
    """with g as (select coalesce(class,'none') as class, count(*) as n from results group by 1) select '| class | n |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || class || ' | ' || n || ' |', chr(10) order by n desc, class) as markdown from g""",
)
def markdown_table(spark, sf_dir):
    g = table(spark, sf_dir, "results").groupBy(F.coalesce("class", F.lit("none")).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return W.markdown_table(g, ["class", "n"], [-F.col("n"), F.col("class")])


@query(
    "ground_truth_pages",
    f"""with {D} select 'p' || page_id || '.png' as image_path, 800 as width, 1000 as height, count(*) as n, min(x0::double) as x0 from d where label in (22, 17) group by page_id""",
)
def ground_truth_pages(spark, sf_dir):
    """Ground truth is written as JSON, read with its schema and measured."""
    d = V.detections(spark, sf_dir).where("label in (22, 17)")
    poly = F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y0", "x1", "y1", "x0", "y1")])
    det = F.struct(F.lit("text_block").alias("category_type"), poly.alias("poly"), F.col("det_idx").alias("order"), F.lit("t").alias("text"), F.lit(False).alias("ignore"))
    page = d.groupBy("page_id").agg(F.collect_list(det).alias("layout_dets"))
    info = F.struct(F.concat(F.lit("p"), "page_id", F.lit(".png")).alias("image_path"), F.lit(1000).alias("height"), F.lit(800).alias("width"), F.lit(1).alias("page_no"), F.struct(F.lit("x").alias("data_source")).alias("page_attribute"))
    json = page.select(F.to_json(F.struct("layout_dets", info.alias("page_info"))).alias("j"))
    read = json.select(F.from_json("j", R.GROUND_TRUTH).alias("r")).select("r.*")
    pages = R.ground_truth_pages(read).select("image_path", "width", "height", F.explode("annotations").alias("a"))
    return pages.groupBy("image_path", "width", "height").agg(F.count(F.lit(1)).alias("n"), F.min(G.polygon_box(F.col("a.poly"))["x0"]).alias("x0"))
