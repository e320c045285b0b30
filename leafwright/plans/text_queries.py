"""Queries of tables, text repair and assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwright import constants as C
from leafwright.operators import assemble as A
from leafwright.operators import tables as O
from leafwright.operators import textguard as G
from leafwright.operators.tablescore import table_similarity
from leafwright.plans import views as V
from leafwright.session import table

Q: dict = {}
SQL: dict[str, str] = {}
B = f"with b as ({V.duck(V.BLOCKS)})"
_WHITE = " || ".join(f"chr({ord(c)})" for c in C.WHITE)
TRIM = f"trim({{0}}, {_WHITE})"


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_T = "from results where class = 'table' and text is not null"


@query(
    "otsl_tokens",
    f"""with r as (select result_id, unnest(string_split(text, '<nl>')) as row, generate_subscripts(string_split(text, '<nl>'), 1) - 1 as r {_T}),
    s as (select result_id, r, unnest(string_split(regexp_replace(row, '<([felux]cel)>', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:]) as p, generate_subscripts(string_split(regexp_replace(row, '<([felux]cel)>', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:], 1) - 1 as c from r)
    select result_id, cast(r as int) as row_no, cast(c as int) as cell_no, '<' || string_split(p, chr(2))[1] || '>' as tag, {TRIM.format("string_split(p, chr(2))[2]")} as text from s""",
)
def otsl_tokens(spark, sf_dir):
    t = table(spark, sf_dir, "results").where("class = 'table' and text is not null")
    rows = t.select("result_id", F.posexplode(O.cells(F.col("text"))).alias("row_no", "cells"))
    return rows.select("result_id", "row_no", F.posexplode("cells").alias("cell_no", "c")).select("result_id", "row_no", "cell_no", F.col("c.tag").alias("tag"), F.col("c.text").alias("text"))


@query(
    "otsl_width",
    f"""with r as (select result_id, unnest(string_split(text, '<nl>')) as row {_T}),
    l as (select result_id, regexp_extract_all(row, '<[felux]cel>') as tags from r where regexp_matches(row, '<[felux]cel>')),
    n as (select result_id, len(tags) as n, len(tags) - coalesce(list_position(list_reverse(tags), '<fcel>'), len(tags) + 1) + 1 as last from l),
    m as (select result_id, max(last) as lo, greatest(max(last), max(n)) as hi from n group by 1),
    c as (select m.result_id, w, sum(abs(n.n - w)) as cost from (select result_id, unnest(range(lo, hi + 1)) as w from m) m join n using (result_id) group by 1, 2)
    select result_id, cast(arg_min(w, cost * 100000 + w) as int) as width from c group by 1 union all select result_id, 0 {_T} and not regexp_matches(text, '<[felux]cel>')""",
)
def otsl_width(spark, sf_dir):
    t = table(spark, sf_dir, "results").where("class = 'table' and text is not null")
    return t.select("result_id", O.width(O.cells(F.col("text"))).cast("int").alias("width"))


#: The renderer as joins: cells to a rectangle, spans by runs of tags, slots to the last cell that claims them.
_HTML = f"""raw as (RAW),
    rw as (select result_id, unnest(string_split(text, '<nl>')) as row, generate_subscripts(string_split(text, '<nl>'), 1) as r0 from raw),
    tk as (select result_id, r0, unnest(string_split(regexp_replace(row, '<([felux]cel)>', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:]) as p, generate_subscripts(string_split(regexp_replace(row, '<([felux]cel)>', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:], 1) as c from rw),
    ce as (select result_id, dense_rank() over (partition by result_id order by r0) as r, c, '<' || string_split(p, chr(2))[1] || '>' as tag, {TRIM.format("string_split(p, chr(2))[2]")} as txt from tk),
    ln as (select result_id, r, count(*) as n, coalesce(max(c) filter (tag = '<fcel>'), 0) as last from ce group by 1, 2),
    lo as (select result_id, max(last) as lo, greatest(max(last), max(n)) as hi, max(r) as height from ln group by 1),
    co as (select lw.result_id, w, sum(abs(ln.n - w)) as cost from (select result_id, unnest(range(lo, hi + 1)) as w from lo) lw join ln on ln.result_id = lw.result_id group by 1, 2),
    wd as (select result_id, arg_min(w, cost * 100000 + w) as w from co group by 1),
    sl as (select lh.result_id, w, height, r, unnest(range(1, w + 1)) as c from (select result_id, height, unnest(range(1, height + 1)) as r from lo) lh join wd on wd.result_id = lh.result_id),
    gr as (select sl.result_id, sl.w, sl.height, sl.r, sl.c, coalesce(ce.tag, '<ecel>') as tag, coalesce(ce.txt, '') as txt from sl left join ce on ce.result_id = sl.result_id and ce.r = sl.r and ce.c = sl.c),
    rn as (select *, lead(tag) over byrow as t1, lead(tag, 2) over byrow as t2, lead(txt) over byrow as x1,
      coalesce(min(c) filter (tag not in ('<lcel>', '<xcel>')) over (partition by result_id, r order by c rows between 1 following and unbounded following), w + 1) - c as wide,
      coalesce(min(r) filter (tag not in ('<ucel>', '<xcel>')) over (partition by result_id, c order by r rows between 1 following and unbounded following), height + 1) - r as tall
      from gr window byrow as (partition by result_id, r order by c)),
    og as (select result_id, r, c, tall, case when case when tag = '<ecel>' then txt = '' and t1 in ('<lcel>', '<xcel>') when txt <> '' then t1 in ('<lcel>', '<xcel>') else x1 = '' and t2 in ('<lcel>', '<xcel>') end then wide else 1 end as wide,
      case when tag = '<ecel>' then '' when txt <> '' then txt else coalesce(t1, '<nl>') end as txt from rn where tag in ('<fcel>', '<ecel>')),
    ow as (select gr.result_id, gr.r, gr.c, max(og.r * 100000 + og.c) as o from gr left join og on og.result_id = gr.result_id and gr.r between og.r and og.r + og.tall - 1 and gr.c between og.c and og.c + og.wide - 1 group by 1, 2, 3),
    td as (select ow.result_id, ow.r, ow.c, case when o is null then '<td></td>' when o = ow.r * 100000 + ow.c then '<td' || case when tall > 1 then ' rowspan="' || tall || '"' else '' end || case when wide > 1 then ' colspan="' || wide || '"' else '' end || '>'
      || replace(replace(replace(replace(replace(txt, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') || '</td>' else '' end as td from ow left join og on og.result_id = ow.result_id and og.r * 100000 + og.c = o),
    tr as (select result_id, r, '<tr>' || string_agg(td, '' order by c) || '</tr>' as tr from td group by 1, 2),
    html as (select result_id, '<table>' || string_agg(tr, '' order by r) || '</table>' as html from tr group by 1 union all select result_id, {TRIM.format('text')} from raw where not regexp_matches(text, '<[felux]cel>'))"""


@query("otsl_html", f"with {_HTML} select result_id, html from html".replace("RAW", f"select result_id, text {_T}"))
def otsl_html(spark, sf_dir):
    return table(spark, sf_dir, "results").where("class = 'table' and text is not null").select("result_id", O.to_html(F.col("text")).alias("html"))


@query("table_scores")
def table_scores(spark, sf_dir):
    """Every table against the same without its first row end: similarity by tree edit distance."""
    t = table(spark, sf_dir, "results").where("class = 'table' and text is not null")
    cut = F.regexp_replace("text", "^(.*?)<nl>", "$1")
    return t.select("result_id", F.round(table_similarity(O.to_html(F.col("text")), O.to_html(cut)), 6).alias("similarity"))


@query(
    "otsl_plain_html",
    f"""with t as (select result_id, text {_T} and regexp_matches(text, '^(<fcel>[^<]+(<fcel>[^<]+)*<nl>)+$')),
    r as (select result_id, unnest(string_split(text, '<nl>')) as row, generate_subscripts(string_split(text, '<nl>'), 1) as r from t),
    w as (select result_id from r where row <> '' group by 1 having count(distinct len(string_split(row, '<fcel>'))) = 1)
    select result_id, '<table>' || string_agg('<tr>' || list_aggregate(list_transform(string_split(row, '<fcel>')[2:], lambda c: '<td>' || replace(replace(replace(replace({TRIM.format('c')}, '&', '&amp;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') || '</td>'), 'string_agg', '') || '</tr>', '' order by r) || '</table>' as html
    from r join w using (result_id) where row <> '' group by result_id""",
)
def otsl_plain_html(spark, sf_dir):
    """The rectangular tables of filled cells, which SQL can render too."""
    t = table(spark, sf_dir, "results").where("class = 'table'").where(F.col("text").rlike("^(<fcel>[^<]+(<fcel>[^<]+)*<nl>)+$"))
    sizes = F.array_distinct(F.transform(F.filter(O.cells(F.col("text")), lambda r: F.size(r) > 0), lambda r: F.size(r)))
    return t.where(F.size(sizes) == 1).select("result_id", O.to_html(F.col("text")).alias("html"))


@query(
    "otsl_distinct_first",
    f"""{B}, t as (select * from b where class = 'table'), k as (select *, row_number() over (partition by text order by page, read_order, idx) as n from t)
    select text, page, idx, cast(len(regexp_extract_all(text, '<[lux]cel>')) as int) as n_spans from k where n = 1""",
)
def otsl_distinct_first(spark, sf_dir):
    return O.distinct_first(V.blocks(spark, sf_dir).where("class = 'table'"))


@query(
    "escape_html",
    "select doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') as html from documents",
)
def escape_html(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", O.escape(F.col("text")).alias("html"))


_LOOP = """select result_id, text || chr(10) || repeat(substr(text, 1, 20) || chr(10), cast(result_id % 60 as int)) as text from results where text is not null"""


@query(
    "dominant_line",
    f"""with d as ({_LOOP}), l as (select result_id, {TRIM.format('line')} as line from (select result_id, unnest(string_split_regex(text, '\r?\n')) as line from d)),
    c as (select result_id, line, count(*) as n from l where line <> '' group by 1, 2), s as (select result_id, sum(n) as total, arg_max(line, n) as line, max(n) as n from c group by 1)
    select result_id, line, cast(n as bigint) as n, cast(total as bigint) as "of" from s where total >= 10 and n >= 10 and 5 * n >= 4 * total""",
)
def dominant_line(spark, sf_dir):
    t = table(spark, sf_dir, "results").where("text is not null")
    looped = t.select("result_id", F.concat("text", F.lit("\n"), F.expr("repeat(concat(substr(text, 1, 20), '\n'), cast(result_id % 60 as int))")).alias("text"))
    return G.dominant_line(looped, "result_id")


_UNIT = "list_max(list_filter(range(8, length({s})//5 + 1), lambda u: right({s}, u*5) = repeat(right({s}, u), 5)))"
_COPIES = "list_max(list_filter(range(5, length({s})//{u} + 1), lambda k: right({s}, k*{u}) = repeat(right({s}, {u}), k)))"
_RTRIM = f"rtrim({{0}}, {_WHITE})"


def _content_guard(source: str, least: int = C.FLOOR_TEXT) -> str:
    """The repair of whole texts over ``source`` (result_id, t)."""
    core = TRIM.format(f"rtrim({TRIM.format('t')}, chr(65533))")
    return f"""with a as (select result_id, t, {core} as s from ({source})), b as (select *, case when not contains(s, chr(10)) and length(s) > 100 then {_UNIT.format(s='s')} end as u from a),
    c as (select *, case when u is not null then u * {_COPIES.format(s='s', u='u')} end as eaten, case when not contains(s, chr(10)) and length(s) > 10 then list_min(list_filter(range(1, length(s)//2 + 1), lambda n: length(s) % n = 0 and repeat(left(s, n), length(s)//n) = s)) end as tile,
      list_filter(list_transform(string_split(replace(t, chr(13) || chr(10), chr(10)), chr(10)), lambda x: {TRIM.format('x')}), lambda x: x <> '') as l from b),
    m as (select *, case when len(l) >= 10 then list_aggregate(l, 'mode') end as top from c)
    select result_id, case when length(t) < {least} or s = '' then t when eaten is not null and 2*eaten > length(s) then left(s, length(s) - eaten) when tile is not null and length(s)//tile >= 10 then left(s, tile)
      when top is not null and len(list_filter(l, lambda x: x = top)) >= 10 and 5*len(list_filter(l, lambda x: x = top)) >= 4*len(l) then top else t end as text from m"""


@query("phrase_repetition", _content_guard("select result_id, text || repeat(substr(text, 1, 9), cast(5 + result_id % 40 as int)) as t from results where text is not null"))
def phrase_repetition(spark, sf_dir):
    """A phrase looped behind every text: what the repair leaves."""
    t = table(spark, sf_dir, "results").where("text is not null")
    looped = F.concat("text", F.expr("repeat(substr(text, 1, 9), 5 + cast(result_id % 40 as int))"))
    return t.select("result_id", G.content_guard(looped, F.lit(C.FLOOR_TEXT)).alias("text"))


@query("char_repetition", _content_guard("select result_id, repeat(right(text, 2), cast(10 + result_id % 60 as int)) as t from results where length(text) > 2"))
def char_repetition(spark, sf_dir):
    """The last characters of every text, over and over: what the repair leaves."""
    t = table(spark, sf_dir, "results").where("length(text) > 2")
    return t.select("result_id", G.content_guard(F.expr("repeat(right(text, 2), 10 + cast(result_id % 60 as int))"), F.lit(C.FLOOR_TEXT)).alias("text"))


@query(
    "char_tiling",
    f"""with a as (select result_id, case when result_id % 60 >= 1 then repeat(text, cast(9 + result_id % 60 as int)) else text end as s from results where length(text) between 3 and 60 and not contains(text, chr(10))),
    t as (select result_id, s, list_min(list_filter(range(1, length(s)//10 + 1), lambda n: length(s) % n = 0 and repeat(left(s, n), length(s)//n) = s)) as n from a)
    select result_id, case when length(s) > 10 then left(s, n) end as unit from t""",
)
def char_tiling(spark, sf_dir):
    """Short texts repeated whole; titles, names and formulas are what recognizers tile a page with."""
    t = table(spark, sf_dir, "results").where("length(text) between 3 and 60 and not contains(text, '\\n')")
    return t.select("result_id", G.tiling(F.expr("if(result_id % 60 >= 1, repeat(text, 9 + cast(result_id % 60 as int)), text)")).alias("unit"))


@query(
    "line_repetition",
    f"""with a as (select result_id, 'one honest line' || chr(10) || text || repeat(substr(text, 1, 9), cast(5 + result_id % 40 as int)) as t from results where text is not null),
    x as (select result_id, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as i, length(t) as n from a), y as (select *, {_RTRIM.format("rtrim(line, chr(65533))")} as s from x),
    b as (select *, case when n >= 50 and length(s) > 100 then {_UNIT.format(s='s')} end as u from y), c as (select *, case when u is not null then u * {_COPIES.format(s='s', u='u')} end as eaten from b)
    select result_id, string_agg(case when eaten is not null and 2*eaten > length(s) then left(s, length(s) - eaten) else line end, chr(10) order by i) as text from c group by 1""",
)
def line_repetition(spark, sf_dir):
    t = table(spark, sf_dir, "results").where("text is not null")
    looped = F.concat(F.lit("one honest line\n"), "text", F.expr("repeat(substr(text, 1, 9), 5 + cast(result_id % 40 as int))"))
    return t.select("result_id", G.line_guard(looped, F.lit(C.FLOOR_TEXT)).alias("text"))


@query("repetition_floor", "select coalesce(class, 'none') as class, case when class = 'table' then 5000 else 50 end as floor, count(*) as n from results group by all")
def repetition_floor(spark, sf_dir):
    return table(spark, sf_dir, "results").groupBy(F.coalesce("class", F.lit("none")).alias("class"), G.floor(F.col("class")).alias("floor")).agg(F.count(F.lit(1)).alias("n"))


@query("task_prompts", """select class, case when class='table' then 'Table Recognition:' when class in ('display_formula','inline_formula') then 'Formula Recognition:' when class='chart' then 'Chart Recognition:' when class='seal' then 'Seal Recognition:' else 'OCR:' end as prompt from class_names""")
def task_prompts(spark, sf_dir):
    from leafwright.operators.tasks import prompt

    return table(spark, sf_dir, "class_names").select("class", prompt(F.col("class")).alias("prompt"))


@query(
    "strip_math",
    r"""select result_id, replace(replace(replace(replace(text, '\[', ''), '\]', ''), '\(', ''), '\)', '') as text, contains(text, 'begin{array}') and (contains(text, '\[') or contains(text, '\(')) as nested from results where text is not null""",
)
def strip_math(spark, sf_dir):
    from leafwright.functions.scalars import nested_math, strip_math_delimiters

    return table(spark, sf_dir, "results").where("text is not null").select("result_id", strip_math_delimiters(F.col("text")).alias("text"), nested_math(F.col("text")).alias("nested"))


# the flagship: repair whole texts, then lines, render tables, join blocks
_CORE = TRIM.format(f"rtrim({TRIM.format('text')}, chr(65533))")
_FLAGSHIP = f"""with b as ({V.duck(V.BLOCKS)}), ga as (select *, text as t, {_CORE} as s, case when class = 'table' then 5000 else 50 end as least from b),
    gb as (select *, length(t) >= least and s <> '' as long from ga), gc as (select *, case when long and not contains(s, chr(10)) and length(s) > 100 then {_UNIT.format(s='s')} end as u from gb),
    gd as (select *, case when u is not null then u * {_COPIES.format(s='s', u='u')} end as eaten, case when long and not contains(s, chr(10)) and length(s) > 10 then list_min(list_filter(range(1, length(s)//2 + 1), lambda n: length(s) % n = 0 and repeat(left(s, n), length(s)//n) = s)) end as tile,
      list_filter(list_transform(string_split(replace(t, chr(13) || chr(10), chr(10)), chr(10)), lambda x: {TRIM.format('x')}), lambda x: x <> '') as l from gc),
    ge as (select *, case when len(l) >= 10 then list_aggregate(l, 'mode') end as top from gd),
    gf as (select page, read_order, idx, class, least, case when not long then t when eaten is not null and 2*eaten > length(s) then left(s, length(s) - eaten) when tile is not null and length(s)//tile >= 10 then left(s, tile)
      when top is not null and len(list_filter(l, lambda x: x = top)) >= 10 and 5*len(list_filter(l, lambda x: x = top)) >= 4*len(l) then top else t end as text from ge),
    la as (select idx, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i, length(text) >= least as long from gf), lb as (select *, {_RTRIM.format("rtrim(line, chr(65533))")} as s from la),
    lc as (select *, case when long and length(s) > 100 then {_UNIT.format(s='s')} end as u from lb), ld as (select *, case when u is not null then u * {_COPIES.format(s='s', u='u')} end as eaten from lc),
    le as (select idx, string_agg(case when eaten is not null and 2*eaten > length(s) then left(s, length(s) - eaten) else line end, chr(10) order by i) as text from ld group by 1),
    v as (select * from (select page, read_order, gf.idx as idx, class, {TRIM.format('le.text')} as text from gf join le on le.idx = gf.idx where class not in ('chart','image','header_image','footer_image','seal')) x where text <> ''),
    {_HTML.replace("RAW", "select idx as result_id, text from v where class = 'table'")}
    select page, string_agg(case when class = 'doc_title' then '# ' || text when class in ('paragraph_title','figure_title') then '## ' || text when class = 'table' then html else text end, chr(10) || chr(10) order by read_order, idx) as markdown from v left join html on html.result_id = v.idx group by page"""


@query("assemble_results", _FLAGSHIP)
def assemble_results(spark, sf_dir):
    """The flagship: repaired texts, tables as HTML, one markdown a page."""
    return A.assemble(V.blocks(spark, sf_dir))

_UNREPAIRED = f"""{B}, v as (select * from (select page, read_order, idx, class, {TRIM.format('text')} as text from b where WHICH) x where text <> ''),
    {_HTML.replace("RAW", "select idx as result_id, text from v where class = 'table'")}
    select page, string_agg(case when class = 'doc_title' then '# ' || text when class in ('paragraph_title','figure_title') then '## ' || text when class = 'table' then html else text end, chr(10) || chr(10) order by read_order, idx) as markdown from v left join html on html.result_id = v.idx group by page"""


@query("assemble_markdown", _UNREPAIRED.replace("WHICH", "class not in ('chart','image','header_image','footer_image','seal')"))
def assemble_markdown(spark, sf_dir):
    """Without the repair of repetitions."""
    return A.assemble(V.blocks(spark, sf_dir), repair=False)


@query("assemble_keep_visual", _UNREPAIRED.replace("WHICH", "true"))
def assemble_keep_visual(spark, sf_dir):
    return A.assemble(V.blocks(spark, sf_dir), keep_visual=True, repair=False)


@query("page_files", f"""with m as ({_FLAGSHIP}) select substr(image_path, 1, length(image_path) - 4) || '.md' as file, markdown || chr(10) as content from m join page_info on page = stem""")
def page_files(spark, sf_dir):
    """Name and content of every page's file, all visible blocks repaired."""
    info = table(spark, sf_dir, "page_info").select(F.col("stem").alias("page"), "image_path")
    md = A.assemble(V.blocks(spark, sf_dir)).join(info, "page")
    return md.select(F.concat(A.page_name(F.col("image_path")), F.lit(".md")).alias("file"), F.concat("markdown", F.lit("\n")).alias("content"))


@query("source_documents", f"""with m as ({_FLAGSHIP}) select source, string_agg(markdown || chr(10), chr(10) order by coalesce(page_no, 0), page) as document from m join page_info on page = stem group by source""")
def source_documents(spark, sf_dir):
    """All pages of each source, one after the other."""
    info = table(spark, sf_dir, "page_info").select(F.col("stem").alias("page"), "source", F.coalesce("page_no", F.lit(0)).alias("page_no"))
    return A.document(A.assemble(V.blocks(spark, sf_dir)).join(info, "page"), "source", ["page_no", "page"])
