"""Queries over the star schema, events and pages: scans, joins, windows, rollups, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import intervals, joins, windows
from . import marts, quality, search, silver
from .registry import Registry, vector_of

register = Registry()
QUERIES, SQL = register.queries, register.sql

# Sales as orders by nation, one product for each part type

_SALES = """select o_orderkey order_id, o_custkey customer_id, cast(o_orderdate as date) order_date, n_name region,
  p_brand product, cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) amount
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey"""


#: Line items that one task joins with their orders and aggregates, about.
SALES_ROWS = 250_000


def _sales(t) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c, n = t("customer").select("c_custkey", "c_nationkey"), t("nation").select("n_nationkey", "n_name")
    p = t("part").select("p_partkey", "p_brand")
    bought = o.join(c, F.col("o_custkey") == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    lines = li.join(p, F.col("l_partkey") == p.p_partkey)
    # what a task holds of the sales does not grow with them: more rows are more tasks, which are not put together again
    parts = max(1, -(-li.count() // SALES_ROWS))
    j = lines.repartition(parts, "l_orderkey").join(bought.repartition(parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return j.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_date"), F.col("n_name").alias("region"), F.col("p_brand").alias("product"), amount.alias("amount"))


_MART = f"""select order_date, region, product, cast(sum(cast(amount as decimal(20,4))) as double) revenue,
  count(distinct order_id) order_count, count(distinct customer_id) customer_count,
  cast(sum(cast(amount as decimal(20,4))) as double) / count(distinct order_id) avg_order_value
  from ({_SALES}) group by order_date, region, product"""


@register(_MART)
def daily_revenue(t):
    return marts.daily_revenue(_sales(t))


@register(f"select region, cast(sum(cast(revenue as decimal(20,4))) as double) revenue from ({_MART}) group by region")
def revenue_by_region(t):
    return marts.revenue_by(marts.daily_revenue(_sales(t)), "region")


@register(f"select product, cast(sum(cast(revenue as decimal(20,4))) as double) revenue from ({_MART}) group by product")
def revenue_by_product(t):
    return marts.revenue_by(marts.daily_revenue(_sales(t)), "product")


@register(f"select cast(sum(cast(revenue as decimal(20,4))) as double) revenue, cast(sum(order_count) as bigint) orders, cast(sum(customer_count) as bigint) customers from ({_MART})")
def kpi_block(t):
    return marts.kpis(marts.daily_revenue(_sales(t))).drop("avg_order_value")


@register(f"select * from ({_MART}) where order_date between date '1996-01-01' and date '1996-12-31' and region = 'NATION_5'")
def dashboard_filter(t):
    return marts.between(marts.daily_revenue(_sales(t)), "NATION_5", "1996-01-01", "1996-12-31")


@register("select p_partkey, p_name, p_retailprice from part where p_size between 10 and 30 and p_retailprice >= 920")
def scan_filter_project(t):
    return t("part").filter(joins.facets(at_least={"p_size": 10, "p_retailprice": 920}, at_most={"p_size": 30})).select("p_partkey", "p_name", "p_retailprice")


@register("select p_partkey, p_name from part where p_size in (1, 5, 9, 23) and p_retailprice <= 1500 and lower(p_name) like '%a%'")
def dyn_facets(t):
    c = joins.facets(isin={"p_size": [1, 5, 9, 23]}, at_most={"p_retailprice": 1500}, equal={"p_type": None}, like={"p_name": "a"})
    return t("part").filter(c).select("p_partkey", "p_name")


_RAW = """select event_type source_file, user_id entry_name, cast(floor(value * 10) as int) % 3 entry_class,
  case when event_id % 3 = 0 then cast(event_id % 7 as int) end ref_page,
  case when event_id % 4 = 0 then props end school, case when event_id % 5 = 0 then props end sphere,
  cast(event_id % 9 as int) entry_level, case when event_id % 2 = 0 then 'Spell Index' else 'Other' end source_section from events"""


def _raw(t) -> DataFrame:
    e = F.col("event_id")
    return t("events").select(
        F.col("event_type").alias("source_file"),
        F.col("user_id").alias("entry_name"),
        (F.floor(F.col("value") * 10).cast("int") % 3).alias("entry_class"),
        F.when(e % 3 == 0, (e % 7).cast("int")).alias("ref_page"),
        F.when(e % 4 == 0, F.col("props")).alias("school"),
        F.when(e % 5 == 0, F.col("props")).alias("sphere"),
        (e % 9).cast("int").alias("entry_level"),
        F.when(e % 2 == 0, "Spell Index").otherwise("Other").alias("source_section"),
    )


@register(
    f"""with raw as ({_RAW}), idx as (select r.source_file, r.entry_name, r.entry_class, r.entry_level, r.ref_page,
  coalesce(r.school, a.school) school, coalesce(r.sphere, b.sphere) sphere from raw r
  left join (select source_file, entry_name, school from raw where school is not null) a on r.source_file = a.source_file and r.entry_name = a.entry_name
  left join (select source_file, entry_name, sphere from raw where sphere is not null) b on r.source_file = b.source_file and r.entry_name = b.entry_name
  where r.source_section like '%Spell Index%' or r.source_section like '%General Index%' or r.entry_class is not null),
rk as (select *, row_number() over (partition by source_file, entry_name, entry_class
  order by ref_page nulls last, school nulls last, sphere nulls last, entry_level nulls last) rn from idx)
select source_file, entry_name, entry_class, entry_level, ref_page, school, sphere from rk where rn = 1"""
)
def known_entries_dedup(t):
    return silver.known_entries(_raw(t))


@register(
    """select source_file, pdf_size_bytes, total_pages, count(*) total_entries, count(case when entry_title is not null then 1 end) named_entries,
  cast(sum(char_count) as bigint) total_chars from (select o_orderpriority source_file, case when l_returnflag = 'R' then l_linestatus end entry_title,
  cast(l_quantity as bigint) char_count, length(o_orderpriority) pdf_size_bytes, ascii(o_orderpriority) total_pages from lineitem join orders on l_orderkey = o_orderkey)
  group by all"""
)
def files_rollup(t):
    li, o = t("lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity"), t("orders").select("o_orderkey", "o_orderpriority")
    entries = li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_orderpriority").alias("source_file"), F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).alias("entry_title"), F.col("l_quantity").cast("long").alias("char_count"))
    found = o.select(F.col("o_orderpriority").alias("source_file")).distinct().select("source_file", F.length("source_file").alias("pdf_size_bytes"), F.ascii("source_file").alias("total_pages"))
    return silver.files(entries, found).drop("processed_at")


@register("select o_orderpriority source_file, count(*) total_chunks, count(distinct o_custkey) total_toc_entries from orders join customer on o_custkey = c_custkey group by 1")
def files_counts_distinct(t):
    j = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(F.col("o_orderpriority").alias("source_file")).agg(F.count("*").alias("total_chunks"), F.countDistinct("o_custkey").alias("total_toc_entries"))


@register("select event_type, count(*) n from events group by 1")
def type_histogram(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"))


@register("select lang, count(distinct d.doc_id) entries, count(distinct l.doc_id) described from documents d left join labels l on d.doc_id = l.doc_id group by 1")
def coverage_by_type(t):
    index = t("documents").select(F.col("doc_id").alias("entry_id"), F.col("lang").alias("entry_type"))
    return quality.coverage_by_type(index, t("labels").select(F.col("doc_id").alias("entry_id"))).withColumnRenamed("entry_type", "lang")


@register("select n_nationkey, n_name, s_suppkey, s_name from nation left join supplier on n_nationkey = s_nationkey and s_acctbal > 5000")
def toc_left_join_entries(t):
    s = t("supplier").filter("s_acctbal > 5000").select("s_nationkey", "s_suppkey", "s_name")
    return t("nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_nationkey", "n_name", "s_suppkey", "s_name")


@register("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def toc_gaps_anti(t):
    return joins.anti(t("customer").select("c_custkey", "c_name"), t("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@register("select doc_id, lang from documents where n_chars >= 200 and doc_id not in (select doc_id from labels)")
def pending_work_anti(t):
    return joins.anti(t("documents").filter("n_chars >= 200").select("doc_id", "lang"), t("labels"), ["doc_id"])


@register("select l.doc_id, l.quality from labels l where exists (select 1 from documents d where d.doc_id = l.doc_id and d.lang = 'en')")
def orphan_purge_semi(t):
    return joins.semi(t("labels").select("doc_id", "quality"), t("documents").filter("lang = 'en'"), ["doc_id"])


@register(
    """select 'left' side, o_custkey k from (select distinct o_custkey from orders where o_orderstatus = 'F') a where o_custkey not in (select o_custkey from orders where o_orderstatus = 'O')
  union all select 'right', o_custkey from (select distinct o_custkey from orders where o_orderstatus = 'O') b where o_custkey not in (select o_custkey from orders where o_orderstatus = 'F')"""
)
def set_difference_both(t):
    o = t("orders").withColumnRenamed("o_custkey", "k")
    return joins.differences(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"), ["k"])


@register(
    """select p.p_partkey, coalesce(a.m, b.m, c.m).n x_name, coalesce(a.m, b.m, c.m).k x_size from part p
  left join (select p_size k, p_brand b, max({'n': p_name, 'k': p_partkey}) m from part where p_partkey % 3 = 0 group by 1, 2) a on p.p_size = a.k and p.p_brand = a.b
  left join (select p_size k, max({'n': p_name, 'k': p_partkey}) m from part where p_partkey % 3 = 0 and p_brand = 'Brand#11' group by 1) b on p.p_size = b.k
  left join (select p_size k, max({'n': p_name, 'k': p_partkey}) m from part where p_partkey % 3 = 0 and p_brand = 'Brand#22' group by 1) c on p.p_size = c.k"""
)
def fallback_join_chain(t):
    p = t("part")
    side = p.filter("p_partkey % 3 = 0").select("p_size", F.col("p_brand").alias("x_brand"), F.col("p_name").alias("x_name"), F.col("p_partkey").alias("x_size"))
    return joins.fallback_join(p.select("p_partkey", "p_size", "p_brand"), side, ["p_size"], F.col("x_brand"), [F.col("p_brand"), F.lit("Brand#11"), F.lit("Brand#22")], ["x_name", "x_size"]).select("p_partkey", "x_name", "x_size")


@register(
    """select a.k, a.o_orderkey, b.event_id, a.rn rank from (select o_custkey k, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) rn from orders) a
  join (select user_id k, event_id, row_number() over (partition by user_id order by ts, event_id) rn from events) b on a.k = b.k and a.rn = b.rn"""
)
def rank_join(t):
    a = t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderdate")
    b = t("events").select(F.col("user_id").alias("k"), "event_id", "ts")
    out = joins.rank_join(a, b, ["k"], [F.col("o_orderdate"), F.col("o_orderkey")], [F.col("ts"), F.col("event_id")])
    return out.select("k", "o_orderkey", "event_id", "rank")


_RANGES = "select c_custkey id, c_mktsegment seg, c_custkey % 400 lo, c_custkey % 400 + c_nationkey hi from customer"


@register(f"select o_orderkey, r.id from (select o_orderkey, c_mktsegment seg, o_orderkey % 500 p from orders join customer on o_custkey = c_custkey  ) o join ({_RANGES}) r on o.seg = r.seg and p between lo and hi")
def range_join_pages(t):
    c = t("customer")
    ranges = c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"), (F.col("c_custkey") % 400).alias("lo"), (F.col("c_custkey") % 400 + F.col("c_nationkey")).alias("hi"))
    points = t("orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("seg"), (F.col("o_orderkey") % 500).alias("p"))
    return joins.range_join(points, ranges, ["seg"], "p", "lo", "hi", columns=["id"]).select("o_orderkey", "id")


@register(
    """select e.event_id, max({'t': v.ts, 'i': v.event_id}).i last_id from (select event_id, user_id, epoch_us(ts) ts from events where event_type <> 'view') e
  left join (select event_id, user_id, epoch_us(ts) ts from events where event_type = 'view') v on e.user_id = v.user_id and v.ts <= e.ts group by 1"""
)
def asof_last_anchor(t):
    e = t("events").select("event_id", "user_id", "ts", "event_type")
    right = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("last_id"))
    return joins.asof_join(e.filter("event_type <> 'view'").select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "at", ["last_id"]).select("event_id", "last_id")


@register("select o_orderkey, c_name, n_name from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_totalprice > 200000")
def lookup_join(t):
    o = t("orders").filter("o_totalprice > 200000").select("o_orderkey", "o_custkey")
    c = t("customer").select("c_custkey", "c_name", "c_nationkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(t("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


_CHAPTERS = "select o_custkey k, o_orderkey, cast(o_orderkey % 1000 as int) page_start from orders"


def _chapters(t) -> DataFrame:
    return t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey", (F.col("o_orderkey") % 1000).cast("int").alias("page_start"))


@register(f"select k, o_orderkey, page_start, cast(coalesce(lead(page_start) over (partition by k order by page_start, o_orderkey) - 1, 9999) as int) page_end from ({_CHAPTERS})")
def chapter_page_end_lead(t):
    return windows.chapter_ends(_chapters(t), ["k"], "page_start", [F.col("page_start"), F.col("o_orderkey")])


@register("select user_id, event_id, last(case when event_type = 'click' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) parent from events")
def parent_fill(t):
    e = t("events").select("user_id", "event_id", "event_type", "ts")
    return windows.fill_down(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.when(F.col("event_type") == "click", F.col("event_id")), "parent").select("user_id", "event_id", "parent")


@register("select user_id, event_id, coalesce(first(case when event_type <> 'view' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between 1 following and unbounded following), 9999) page_end from events")
def next_non_flag(t):
    e = t("events").select("user_id", "event_id", "event_type", "ts")
    return windows.section_ends(e, ["user_id"], "event_id", F.col("event_type") == "view", F.lit(9999), [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", F.col("page_end").cast("long").alias("page_end"))


@register("select * from (select l_suppkey k, lag(l_orderkey) over (partition by l_suppkey order by l_orderkey) previous, l_orderkey, l_orderkey - lag(l_orderkey) over (partition by l_suppkey order by l_orderkey) gap from (select distinct l_suppkey, l_orderkey from lineitem)) where gap > 200")
def page_gap_lag(t):
    return windows.gaps(t("lineitem").select(F.col("l_suppkey").alias("k"), "l_orderkey").distinct(), ["k"], "l_orderkey", 200)


@register("select conv_id, turn, role, cast(row_number() over (partition by conv_id, role order by turn) - 1 as int) chunk_index from (select distinct conv_id, turn, role from conversations)")
def chunk_index(t):
    return windows.running_index(t("conversations").select("conv_id", "turn", "role").distinct(), ["conv_id", "role"], [F.col("turn")])


@register("select user_id, event_id, coalesce(lag(event_type) over w <> event_type, true) changed from events window w as (partition by user_id order by ts, event_id)")
def change_flags(t):
    e = t("events").select("user_id", "event_id", "event_type", "ts")
    return windows.changes(e, ["user_id"], [F.col("ts"), F.col("event_id")], ["event_type"]).select("user_id", "event_id", "changed")


_TREE = "select user_id, row_number() over (partition by user_id order by ts, event_id) seq, cast(event_id % 4 as int) depth, event_type = 'purchase' opens from events"


@register(
    f"""with s as ({_TREE}), x as (select a.user_id, a.seq, bool_or(a.opens or coalesce(o.ok, false)) in_scope from s a
  left join (select c.user_id, c.seq cs, r.seq rs, true ok from s c join s r on c.user_id = r.user_id and r.seq > c.seq and c.opens
     where (select min(m.depth) from s m where m.user_id = c.user_id and m.seq > c.seq and m.seq <= r.seq) > c.depth) o
  on a.user_id = o.user_id and a.seq = o.rs group by 1, 2) select user_id, seq from x where in_scope"""
)
def class_scope_machine(t):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    s = t("events").select("user_id", F.row_number().over(w).cast("long").alias("seq"), (F.col("event_id") % 4).cast("int").alias("depth"), (F.col("event_type") == "purchase").alias("opens"))
    return windows.scope_rows(s, ["user_id"], "seq", "depth", F.col("opens")).filter("in_scope").select("user_id", "seq")


_IV = "select user_id k, event_id % 500 s, event_id % 500 + cast(floor(value) as bigint) % 7 e from events"


@register(
    f"""select k, min(s) s, max(e) e from (select *, sum(f) over (partition by k order by s, e rows unbounded preceding) g from
  (select *, case when s > coalesce(max(e) over (partition by k order by s, e rows between unbounded preceding and 1 preceding), -1000) + 1 then 1 else 0 end f from (select distinct * from ({_IV})))) group by k, g"""
)
def interval_coalesce(t):
    iv = t("events").select(F.col("user_id").alias("k"), (F.col("event_id") % 500).alias("s"), (F.col("event_id") % 500 + F.floor("value").cast("long") % 7).alias("e")).distinct()
    return intervals.coalesce_intervals(iv, ["k"], "s", "e", gap=1)


@register("select event_id, substr(props, 1, 2) || regexp_replace(substr(props, 3, 4), '.', ' ', 'g') || substr(props, 7) masked from events")
def mask_overlay(t):
    ranges = F.array(F.struct(F.lit(2).alias("char_start"), F.lit(6).alias("char_end")))
    return t("events").select("event_id", intervals.blank_ranges(F.col("props"), ranges).alias("masked"))


_KEY = "cast(('0x' || substr(sha256(concat_ws(chr(0), coalesce(cast(n_name as varchar), ''), coalesce(cast(n_regionkey as varchar), ''), coalesce(cast(nullif(n_nationkey, 3) as varchar), ''))), 1, 16))::uhugeint % 9223372036854775808 as bigint)"


@register(f"select n_nationkey, {_KEY} k from nation")
def stable_key_ids(t):
    return t("nation").select("n_nationkey", keys.stable_hash(F.col("n_name"), F.col("n_regionkey"), F.nullif(F.col("n_nationkey"), F.lit(3))).alias("k"))


@register("select page_id, regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g') plain from pages")
def html_strip(t):
    return t("pages").select("page_id", text.strip_html(F.col("html")).alias("plain"))


@register("select event_id, cast(json_extract_string(props, '$.k') as varchar) k from events")
def json_props(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@register("select distinct event_type, cast(value > 50 as boolean) high from events")
def filter_options_distinct(t):
    return t("events").select("event_type", (F.col("value") > 50).alias("high")).distinct()


@register("select p_brand, min(p_partkey) first_part from part group by 1")
def first_appearance(t):
    return t("part").groupBy("p_brand").agg(F.min("p_partkey").alias("first_part"))


@register("select conv_id, turn, text from (select *, row_number() over (partition by conv_id order by turn, role, text) rn from conversations) where rn = 1")
def distinct_on_first(t):
    return windows.top_one(t("conversations"), ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")]).select("conv_id", "turn", "text")


@register("select p_partkey, regexp_replace(replace(lower(p_name), ' ', '_'), '[^a-z0-9_]', '', 'g') slug from part")
def slugify(t):
    return t("part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@register("select case when n = 2 then 'x' else 'y' end kind, count(*) n_keys from (select o_custkey, count(*) n from orders group by 1 having count(*) > 1) group by 1")
def duplicate_groups(t):
    d = t("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 1")
    return d.groupBy(F.when(F.col("n") == 2, "x").otherwise("y").alias("kind")).agg(F.count("*").alias("n_keys"))


@register("select r_name, count(distinct c_custkey) customers, coalesce(sum(case when c_acctbal > 0 then 1 else 0 end), 0)::bigint positive from region join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey group by 1")
def section_stats(t):
    j = t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey")).join(t("customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.groupBy("r_name").agg(F.countDistinct("c_custkey").alias("customers"), F.coalesce(F.sum(F.when(F.col("c_acctbal") > 0, 1).otherwise(0)), F.lit(0)).cast("long").alias("positive"))


@register("select r_name, string_agg(n_name, '; ' order by n_name) names from region join nation on n_regionkey = r_regionkey group by 1")
def sub_headings(t):
    j = t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.array_join(F.slice(F.array_sort(F.collect_set("n_name")), 1, 50), "; ").alias("names"))


@register("select event_type, mode_value from (select event_type, cast(floor(value) as bigint) mode_value, row_number() over (partition by event_type order by count(*) desc, cast(floor(value) as bigint)) rn from events group by 1, 2) where rn = 1")
def mode_by_group(t):
    c = t("events").groupBy("event_type", F.floor("value").cast("long").alias("mode_value")).agg(F.count("*").alias("n"))
    return windows.top_one(c, ["event_type"], [F.col("n").desc(), F.col("mode_value")]).select("event_type", "mode_value")


@register("select vec_id, round(similarity, 4) similarity from (select vec_id, list_dot_product(embedding::double[], q) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(q, q))) similarity from embeddings, (select embedding::double[] q from embeddings where vec_id = 7) order by similarity desc, vec_id limit 20)")
def cosine_topk(t):
    return search.vector_top_k(t("embeddings"), vector_of(t("embeddings"), 7), 20).select("vec_id", F.round("similarity", 4).alias("similarity"))


@register()
def fuzzy_indel_pairs(t):
    p = t("part")
    a = p.select("p_size", F.col("p_name").alias("a"), F.col("p_partkey").alias("ka"))
    b = p.select("p_size", F.col("p_name").alias("b"), F.col("p_partkey").alias("kb"))
    return joins.fuzzy_pairs(a, b, ["p_size"], "a", "b", 90.0).filter("ka < kb").select("ka", "kb")


@register("select window_start, event_type, n from (select date_trunc('hour', ts) window_start, event_type, count(*) n from events group by 1, 2)")
def event_windows(t):
    from ..streaming.ingest import event_windows as windowed

    return windowed(t("events")).select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")
