"""Queries of geometry, layout post-processing and task planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafwright.operators import geometry as G
from leafwright.operators import layout as L
from leafwright.operators import sampling as S
from leafwright.operators import tasks as T
from leafwright.plans import views as V

KEY = ("page_id", "det_idx")
Q: dict = {}
SQL: dict[str, str] = {}
D1 = f"with d as ({V.duck(V.DETECTIONS)})"
F32 = "cast({} as float)"


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.detections(spark, sf_dir)


_AREA = "cast(cast(greatest(cast({0}x1-{0}x0 as float),cast(0 as float))*greatest(cast({0}y1-{0}y0 as float),cast(0 as float)) as float) as float)"
_INTER = "cast(greatest(cast(least({0}x1,{1}x1)-greatest({0}x0,{1}x0) as float),cast(0 as float))*greatest(cast(least({0}y1,{1}y1)-greatest({0}y0,{1}y0) as float),cast(0 as float)) as float)"
_AP = "cast(cast(cast({0}x1-{0}x0 as float)+cast(1 as float) as float)*cast(cast({0}y1-{0}y0 as float)+cast(1 as float) as float) as float)"
_IP = "cast(greatest(cast(cast(least({0}x1,{1}x1)-greatest({0}x0,{1}x0) as float)+cast(1 as float) as float),cast(0 as float))*greatest(cast(cast(least({0}y1,{1}y1)-greatest({0}y0,{1}y0) as float)+cast(1 as float) as float),cast(0 as float)) as float)"


#: In DOUBLE: a box's sides multiplied, and what this box shares with the next.
_SIDES = "greatest(cast({0}x1 as double)-cast({0}x0 as double),0)*greatest(cast({0}y1 as double)-cast({0}y0 as double),0)"
_IU = "greatest(cast(least(x1,o_x1) as double)-cast(greatest(x0,o_x0) as double),0)*greatest(cast(least(y1,o_y1) as double)-cast(greatest(y0,o_y0) as double),0)"


def _iou(a: str, b: str) -> str:
    i = _IP.format(a, b)
    return f"cast({i}/cast(cast({_AP.format(a)}+{_AP.format(b)} as float)-{i} as float) as float)"


@query("score_threshold_raw", f"{D1} select page_id, det_idx, score from d where score > cast(0.5 as float)")
def score_threshold_raw(spark, sf_dir):
    return L.above_score(_d(spark, sf_dir), 0.5).select(*KEY, "score")


@query("score_threshold_ref", f"{D1} select page_id, det_idx, score from d where score > cast(0.3 as float)")
def score_threshold_ref(spark, sf_dir):
    return L.above_score(_d(spark, sf_dir), 0.3).select(*KEY, "score")


@query(
    "round_clip",
    f"""{D1}, r as (select page_id, det_idx, round_even(x0,0) x0, round_even(y0,0) y0, round_even(x1,0) x1, round_even(y1,0) y1 from d),
    c as (select page_id, det_idx, cast(trunc(greatest(x0,0)) as float) x0, cast(trunc(greatest(y0,0)) as float) y0, cast(trunc(least(x1,800)) as float) x1, cast(trunc(least(y1,1000)) as float) y1 from r)
    select * from c where x1 > x0 and y1 > y0""",
)
def round_clip(spark, sf_dir):
    return G.clip_to_page(G.round_even(_d(spark, sf_dir))).select(*KEY, *L.BOX)


@query(
    "page_sized_image",
    f"""{D1}, k as (select *, class <> 'image' or cast(cast(least(x1,800)-greatest(x0,0) as float)*cast(least(y1,1000)-greatest(y0,0) as float) as float) <= cast(cast(cast(0.93 as float)*800 as float)*1000 as float) keep, count(*) over (partition by page_id) n from d),
    a as (select *, bool_or(keep) over (partition by page_id) any_kept from k) select page_id, det_idx, class from a where keep or n <= 1 or not any_kept""",
)
def page_sized_image(spark, sf_dir):
    return L.drop_page_sized_image(_d(spark, sf_dir)).select(*KEY, "class")


_VIS = "('chart','image','header_image','footer_image','seal')"


@query(
    "drop_nested",
    f"""{D1} select a.page_id, a.det_idx from d a where not exists (select 1 from d b where a.page_id=b.page_id and a.det_idx<>b.det_idx and b.class not in {_VIS}
    and {_AREA.format('a.')} > 0 and {_AREA.format('b.')} > {_AREA.format('a.')} and cast({_INTER.format('a.', 'b.')}/{_AREA.format('a.')} as float) >= cast(0.8 as float))""",
)
def drop_nested(spark, sf_dir):
    return L.drop_nested(_d(spark, sf_dir)).select(*KEY)


_D = "cast({} as double)"


@query(
    "nested_f64",
    f"""{D1}, e as (select page_id, det_idx, x0::double x0, y0::double y0, x1::double x1, y1::double y1, greatest(x1::double-x0,0)*greatest(y1::double-y0,0) ar from d)
    select a.page_id, a.det_idx from e a where not exists (select 1 from e b where a.page_id=b.page_id and a.det_idx<>b.det_idx and a.ar>0 and b.ar>a.ar
    and greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0)/a.ar >= cast(0.7 as double))""",
)
def nested_f64(spark, sf_dir):
    return L.drop_nested(_d(spark, sf_dir), share=0.7, aware=False, double=True).select(*KEY)


@query(
    "merge_large",
    f"""{D1} select a.page_id, a.det_idx from d a where not exists (select 1 from d b where a.page_id=b.page_id and a.det_idx<>b.det_idx
    and b.class in ('chart','display_formula','doc_title','inline_formula','paragraph_title') and {_AREA.format('a.')} > 0 and cast({_INTER.format('a.', 'b.')}/{_AREA.format('a.')} as float) >= cast(0.9 as float))""",
)
def merge_large(spark, sf_dir):
    return L.merge_large(_d(spark, sf_dir)).select(*KEY)


@query(
    "layout_nms",
    f"""{D1}, p as (select page_id, list({{'det_idx':det_idx,'label':label,'x0':x0,'y0':y0,'x1':x1,'y1':y1}} order by score desc, det_idx) r from d group by page_id),
    k as (select page_id, list_reduce(r, lambda acc, x: case when len(list_filter(acc, lambda k: {_iou('x.', 'k.')} >= case when k.label = x.label then cast(0.6 as float) else cast(0.98 as float) end)) > 0 then acc else list_append(acc, x) end, r[1:0]) kept from p)
    select page_id, u.det_idx as det_idx from (select page_id, unnest(kept) u from k)""",
)
def layout_nms(spark, sf_dir):
    return L.suppress(_d(spark, sf_dir)).select(*KEY)


# the overlap filter as a fold over places of the page's list, with the flags of dropped boxes as state
_SI, _SJ = (f"greatest(r[{k}].x1-r[{k}].x0,0)*greatest(r[{k}].y1-r[{k}].y0,0)" for k in "ij")
_INNER = "greatest(least(r[i].x1,r[j].x1)-greatest(r[i].x0,r[j].x0),0)*greatest(least(r[i].y1,r[j].y1)-greatest(r[i].y0,r[j].y0),0)"
_SMALL = f"case when least({_SI},{_SJ})=0 then cast(0 as float) else cast({_INNER}/least({_SI},{_SJ}) as float) end"
_PIC = "in ('image','table','seal','chart')"
_FORMULA = "(r[i].class='inline_formula' or r[j].class='inline_formula')"
_CAPTION = f"((r[i].class {_PIC} or r[j].class {_PIC}) and r[i].class<>r[j].class and ((r[i].class<>'table' and r[j].class<>'table') or (r[i].class {_PIC} and r[j].class {_PIC})))"


def _gone(k: str, smaller: str) -> str:
    return f"case when {_FORMULA} then ({_SMALL})>cast(0.5 as float) and r[{k}].class='inline_formula' else ({_SMALL})>cast(0.7 as float) and not {_CAPTION} and {smaller} end"


_I, _J = _gone("i", f"{_SI}<{_SJ}"), _gone("j", f"{_SI}>={_SJ}")
_STEP = f"case when a[i] or a[j] then a when not (({_I}) or ({_J})) then a else list_transform(a, lambda v, q: v or (q=i and ({_I})) or (q=j and ({_J}))) end"


def _fold(source: str) -> str:
    """CTEs that end in f (page_id, u, gone): the boxes of ``source`` and whether the overlap filter drops them."""
    return f"""p as (select page_id, list({{'det_idx':det_idx,'class':class,'x0':x0,'y0':y0,'x1':x1,'y1':y1,'read_order':read_order}} order by read_order, det_idx) r from {source} where class<>'reference' group by page_id),
    k as (select page_id, r, list_reduce(range(1, len(r)+1), lambda acc, i: list_reduce(range(i+1, len(r)+1), lambda a, j: {_STEP}, list_transform(acc, lambda v, q: v or (q=i and (r[i].x1-r[i].x0<6 or r[i].y1-r[i].y0<6)))), list_transform(r, lambda x: false)) g from p),
    f as (select page_id, unnest(r) u, unnest(g) gone from k)"""


@query("filter_boxes", f"{D1}, {_fold('d')} select page_id, u.det_idx as det_idx, u.class as class from f where not gone")
def filter_boxes(spark, sf_dir):
    return L.filter_boxes(_d(spark, sf_dir)).select(*KEY, "class")


@query(
    "ref_postprocess",
    f"""{D1}, d1 as (select page_id, det_idx, label, class, score, read_order, cast(round_even(x0,0) as float) x0, cast(round_even(y0,0) as float) y0, cast(round_even(x1,0) as float) x1, cast(round_even(y1,0) as float) y1 from d where score > cast(0.3 as float)),
    n0 as (select page_id, list({{'det_idx':det_idx,'label':label,'x0':x0,'y0':y0,'x1':x1,'y1':y1}} order by score desc, det_idx) r from d1 group by page_id),
    n1 as (select page_id, list_reduce(r, lambda acc, x: case when len(list_filter(acc, lambda k: {_iou('x.', 'k.')} >= case when k.label = x.label then cast(0.6 as float) else cast(0.98 as float) end)) > 0 then acc else list_append(acc, x) end, r[1:0]) kept from n0),
    n2 as (select page_id, u.det_idx as det_idx from (select page_id, unnest(kept) u from n1)),
    d2 as (select d1.* from d1 join n2 on n2.page_id=d1.page_id and n2.det_idx=d1.det_idx),
    g0 as (select *, class <> 'image' or cast(cast(least(x1,800)-greatest(x0,0) as float)*cast(least(y1,1000)-greatest(y0,0) as float) as float) <= cast(cast(cast(0.93 as float)*800 as float)*1000 as float) keep, count(*) over (partition by page_id) n from d2),
    d3 as (select * from (select *, bool_or(keep) over (partition by page_id) any_kept from g0) where keep or n <= 1 or not any_kept),
    d4 as (select a.* from d3 a where not exists (select 1 from d3 b where a.page_id=b.page_id and a.det_idx<>b.det_idx and b.class in ('chart','display_formula','doc_title','inline_formula','paragraph_title')
      and {_AREA.format('a.')} > 0 and cast({_INTER.format('a.', 'b.')}/{_AREA.format('a.')} as float) >= cast(0.9 as float))),
    d5 as (select * from (select page_id, det_idx, class, read_order, cast(trunc(greatest(x0,0)) as float) x0, cast(trunc(greatest(y0,0)) as float) y0, cast(trunc(least(x1,800)) as float) x1, cast(trunc(least(y1,1000)) as float) y1 from d4) where x1 > x0 and y1 > y0),
    {_fold('d5')} select page_id, u.det_idx as det_idx, u.class as class, u.x0 as x0, u.y0 as y0, u.x1 as x1, u.y1 as y1, u.read_order as read_order from f where not gone""",
)
def ref_postprocess(spark, sf_dir):
    return L.postprocess(_d(spark, sf_dir)).select(*KEY, "class", *L.BOX, "read_order")


@query(
    "raw_postprocess",
    f"""{D1}, s as (select * from d where score > cast(0.5 as float)) select a.page_id, a.det_idx, a.class from s a where not exists (select 1 from s b where a.page_id=b.page_id and a.det_idx<>b.det_idx and b.class not in {_VIS}
    and {_AREA.format('a.')} > 0 and {_AREA.format('b.')} > {_AREA.format('a.')} and cast({_INTER.format('a.', 'b.')}/{_AREA.format('a.')} as float) >= cast(0.8 as float))""",
)
def raw_postprocess(spark, sf_dir):
    return L.raw_postprocess(_d(spark, sf_dir)).select(*KEY, "class")


@query(
    "decode_detections",
    f"""{D1}, n as (select page_id, count(*) - page_id % 3 as valid from d group by page_id) select d.page_id, det_idx, label, class, score, x0, y0, x1, y1, read_order from d join n on n.page_id = d.page_id where det_idx < valid""",
)
def decode_detections(spark, sf_dir):
    """Tensors of seven values a row are built and read again; each page has its own number of valid rows, up to two fewer than the tensor holds."""
    d = _d(spark, sf_dir)
    seven = F.array(F.col("label").cast("float"), "score", "x0", "y0", "x1", "y1", F.col("read_order").cast("float"))
    pages = d.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("det_idx", seven.alias("v")))).alias("r"))
    tensors = pages.select("page_id", F.flatten(F.transform("r", lambda x: x["v"])).alias("values"), (F.size("r") - F.col("page_id") % 3).cast("int").alias("bbox_num"))
    return L.decode(tensors)


_NEXT = ", ".join(f"lead({c}) over (partition by page_id order by det_idx) as o_{c}" for c in ("det_idx", "x0", "y0", "x1", "y1"))


@query(
    "box_pairs",
    f"""{D1}, p as (select page_id, det_idx, x0, y0, x1, y1, {_NEXT} from d)
    select page_id, det_idx, o_det_idx as other_idx, {_AREA.format('')} as area, {_INTER.format('', 'o_')} as inter, {_AP.format('')} as area_padded, {_iou('', 'o_')} as iou_padded,
    case when least({_AREA.format('')},{_AREA.format('o_')}) = 0 then cast(0 as float) else cast({_INTER.format('', 'o_')}/least({_AREA.format('')},{_AREA.format('o_')}) as float) end as overlap_small,
    coalesce({_IU} / nullif({_SIDES.format('')} + {_SIDES.format('o_')} - {_IU}, 0), 0) as iou
    from p where o_det_idx is not null""",
)
def box_pairs(spark, sf_dir):
    """Every region with the next one of its page: area, intersection, overlap over the smaller, padded and plain IoU."""
    w = Window.partitionBy("page_id").orderBy("det_idx")
    p = _d(spark, sf_dir).select(*KEY, *L.BOX, *[F.lead(c).over(w).alias("o_" + c) for c in ("det_idx", *L.BOX)]).where("o_det_idx is not null")
    a, b = G.box(), G.box("o_")
    return p.select(
        *KEY,
        F.col("o_det_idx").alias("other_idx"),
        G.area(a).alias("area"),
        G.intersection(a, b).alias("inter"),
        G.area_padded(a).alias("area_padded"),
        G.iou_padded(a, b).alias("iou_padded"),
        G.overlap_small(a, b).alias("overlap_small"),
        G.iou(a, b).alias("iou"),
    )


@query(
    "worst_nested_pages",
    f"""{D1}, i as (select distinct a.page_id, a.det_idx from d a join d b on a.page_id=b.page_id and a.det_idx<>b.det_idx and b.class not in {_VIS}
    and {_AREA.format('a.')} > 0 and {_AREA.format('b.')} > {_AREA.format('a.')} and cast({_INTER.format('a.', 'b.')}/{_AREA.format('a.')} as float) >= cast(0.8 as float))
    select page_id, count(*) as n_nested from i group by 1 order by n_nested desc, page_id limit 8""",
)
def worst_nested_pages(spark, sf_dir):
    return L.worst_nested(_d(spark, sf_dir), 8)


@query(
    "page_picks",
    f"""{D1}, c as (select page_id, count(*) as n from d where label = 22 or page_id % 7 = 0 group by 1)
    (select page_id, n, 'smallest' as pick from c where n between 1 and 2 order by n, page_id limit 3) union all (select page_id, n, 'middle' as pick from c where n between 18 and 26 order by n, page_id limit 3)""",
)
def page_picks(spark, sf_dir):
    """Pages with very few crops and with a middling number; of most pages the regions of one class are counted."""
    sizes = _d(spark, sf_dir).where("label = 22 or page_id % 7 = 0").groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    return S.size_picks(sizes, "page_id", "n", 3)


@query(
    "crop_rectangle",
    f"""{D1}, e as (select page_id, det_idx, cast(round(least(greatest(least(x0,x1)::double,0),800),0) as int) l, cast(round(least(greatest(greatest(x0,x1)::double,0),800),0) as int) r,
    cast(round(least(greatest(least(y0,y1)::double,0),1000),0) as int) t, cast(round(least(greatest(greatest(y0,y1)::double,0),1000),0) as int) b from d),
    f as (select *, least(l,799) x, least(t,999) y from e)
    select page_id, det_idx, x, y, greatest(1,least(r-l,800-x)) as w, greatest(1,least(b-t,1000-y)) as h from f""",
)
def crop_rectangle(spark, sf_dir):
    return G.crop_rectangle(_d(spark, sf_dir)).select(*KEY, "x", "y", "w", "h")


@query(
    "plan_tasks",
    f"""{D1}, o as (select *, row_number() over (partition by page_id order by read_order, det_idx) - 1 as i from d)
    select page_id, read_order, class, case when class='table' then 'Table Recognition:' when class in ('display_formula','inline_formula') then 'Formula Recognition:' when class='chart' then 'Chart Recognition:' when class='seal' then 'Seal Recognition:' else 'OCR:' end as prompt,
    printf('crop_%03d_%s.png', i, class) as crop from o""",
)
def plan_tasks(spark, sf_dir):
    return T.plan_tasks(_d(spark, sf_dir)).select("page_id", "read_order", "class", "prompt", "crop")


@query(
    "manifest_json",
    f"""{D1}, o as (select *, row_number() over (partition by page_id order by read_order, det_idx) - 1 as i from d),
    t as (select page_id, i, '  {{"read_order": ' || read_order || ', "class": "' || class || '", "prompt": "' || case when class='table' then 'Table Recognition:' when class in ('display_formula','inline_formula') then 'Formula Recognition:' when class='chart' then 'Chart Recognition:' when class='seal' then 'Seal Recognition:' else 'OCR:' end
    || '", "crop": "' || printf('crop_%03d_%s.png', i, class) || '"}}' as r from o)
    select page_id, '[' || chr(10) || string_agg(r, ',' || chr(10) order by i) || chr(10) || ']' || chr(10) as manifest from t group by page_id""",
)
def manifest_json(spark, sf_dir):
    return T.manifest_json(T.plan_tasks(_d(spark, sf_dir)))


@query(
    "union_box",
    f"""{D1} select page_id, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from d group by page_id""",
)
def union_box(spark, sf_dir):
    return G.union_box(_d(spark, sf_dir), "page_id")


@query("polygon_box", f"""{D1} select page_id, det_idx, x0::double as x0, y0::double as y0, x1::double as x1, y1::double as y1 from d where x1>=x0 and y1>=y0""")
def polygon_box(spark, sf_dir):
    d = _d(spark, sf_dir).where("x1 >= x0 and y1 >= y0")
    p = d.select(*KEY, F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y0", "x1", "y1", "x0", "y1")]).alias("poly"))
    return p.select(*KEY, *[e.alias(n) for n, e in G.polygon_box(F.col("poly")).items()])


@query(
    "union_cover",
    f"""{D1}, t as (select * from d where label = 5), c as (select distinct t.page_id, t.det_idx, greatest(t.x0,b.x0)::double x0, greatest(t.y0,b.y0)::double y0, least(t.x1,b.x1)::double x1, least(t.y1,b.y1)::double y1 from t join d b on t.page_id=b.page_id and b.label <> 5 where least(t.x1,b.x1)>greatest(t.x0,b.x0) and least(t.y1,b.y1)>greatest(t.y0,b.y0)),
    xs as (select page_id, det_idx, x, lead(x) over (partition by page_id, det_idx order by x) xn from (select distinct page_id, det_idx, x0 x from c union select distinct page_id, det_idx, x1 from c)),
    ys as (select page_id, det_idx, y, lead(y) over (partition by page_id, det_idx order by y) yn from (select distinct page_id, det_idx, y0 y from c union select distinct page_id, det_idx, y1 from c)),
    g as (select xs.page_id, xs.det_idx, (xn-x)*(yn-y) a from xs join ys on xs.page_id=ys.page_id and xs.det_idx=ys.det_idx where xn is not null and yn is not null and exists (select 1 from c where c.page_id=xs.page_id and c.det_idx=xs.det_idx and c.x0<=x and c.x1>=xn and c.y0<=y and c.y1>=yn))
    select t.page_id, t.det_idx, round(coalesce(s.a,0)/((t.x1::double-t.x0)*(t.y1::double-t.y0)),9) as cover from t left join (select page_id, det_idx, sum(a) a from g group by 1,2) s on s.page_id=t.page_id and s.det_idx=t.det_idx""",
)
def union_cover(spark, sf_dir):
    d = _d(spark, sf_dir)
    return G.union_cover(d.where("label = 5"), d.where("label <> 5"), "page_id", "det_idx").select("page_id", "det_idx", F.round("cover", 9).alias("cover"))


@query("class_names", "select label, class from class_names union all select 25, '?25'")
def class_names(spark, sf_dir):
    return spark.range(26).select(F.col("id").cast("int").alias("label")).select("label", L.class_name(F.col("label")).alias("class"))
