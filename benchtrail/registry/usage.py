"""Operator-usage queries over F3 (usage table, catalogue, usage-tree logs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, with_fixtures
from benchtrail.operators import usage as U
from benchtrail.registry import query

USAGE_FILE = r"^count_prod_\d+_(\d+)\.log$"
PREFIX = "hl_"


def tree(spark, sf_dir):
    return U.parse_usage_tree(fixture(spark, sf_dir, "f3_usage_lines"))


def _cl(col="file"):
    return F.regexp_extract(F.col(col), USAGE_FILE, 1).cast("bigint")


FILES = """files as (select product, changelist, concat('count_', product, '_', cast(changelist as varchar(8)), '.log') as file,
   count(*) as n, sum(total) as s from f3_usage group by 1, 2)"""


@query("s6_usage_nodes", with_fixtures("""
select file, cast(0 as bigint) as node_id, 'frame_process' as name, 'proc' as tag, 0 as spaces, cast(3 as bigint) as loop_times,
       cast(null as bigint) as parent_id, cast(0 as bigint) as depth_id, false as orphan, 1.0 as low_average, cast(s as double) as low_total
from files
union all
select f.file, cast(row_number() over (partition by u.product, u.changelist order by u.api) as bigint) as node_id,
       concat('hl_', u.api) as name, 'op' as tag, 2 as spaces, cast(u.total % 9 + 1 as bigint) as loop_times,
       cast(0 as bigint) as parent_id, cast(1 as bigint) as depth_id, false as orphan, null as low_average, null as low_total
from f3_usage u join files f on u.product = f.product and u.changelist = f.changelist
""", "f3_usage", ctes=FILES))
def s6_usage_nodes(spark, sf_dir):
    nodes, _ = tree(spark, sf_dir)
    return nodes


@query("s6_usage_details", with_fixtures("""
select f.file, cast(0 as bigint) as node_id, u.api, cast(u.total as double) as average, u.total
from f3_usage u join files f on u.product = f.product and u.changelist = f.changelist
""", "f3_usage", ctes=FILES))
def s6_usage_details(spark, sf_dir):
    _, details = tree(spark, sf_dir)
    return details


@query("a5_usage_totals", with_fixtures("""
select api, changelist, cast(sum(total) as bigint) as total from f3_usage group by 1, 2
""", "f3_usage"))
def a5_usage_totals(spark, sf_dir):
    _, details = tree(spark, sf_dir)
    return U.usage_totals(details, _cl())


@query("a6_high_usage", with_fixtures("""
select api, changelist, cast(sum(total % 9 + 1) as bigint) as total from f3_usage group by 1, 2
""", "f3_usage"))
def a6_high_usage(spark, sf_dir):
    nodes, _ = tree(spark, sf_dir)
    _, det = U.high_usage(nodes, PREFIX)
    return U.usage_totals(det, _cl())


@query("a6_high_summary", with_fixtures("""
select file, cast(0 as bigint) as node_id, cast(sum(u.total % 9 + 1) as bigint) as high_total
from f3_usage u join files f on u.product = f.product and u.changelist = f.changelist group by 1
""", "f3_usage", ctes=FILES))
def a6_high_summary(spark, sf_dir):
    nodes, _ = tree(spark, sf_dir)
    summary, _ = U.high_usage(nodes, PREFIX)
    return summary


@query("j10_zero_filled", with_fixtures("""
select a.api, cast(coalesce(sum(u.total), 0) as bigint) as total
from (select distinct api from f3_api) a left join f3_usage u on a.api = u.api group by a.api
""", "f3_api", "f3_usage"))
def j10_zero_filled(spark, sf_dir):
    filled, _ = U.zero_filled(fixture(spark, sf_dir, "f3_api"), fixture(spark, sf_dir, "f3_usage"))
    return filled


@query("j10_used_count", with_fixtures("""
select count(distinct u.api) as n_used, (select count(distinct api) from f3_api) as n_items
from f3_api a join f3_usage u on a.api = u.api
""", "f3_api", "f3_usage"))
def j10_used_count(spark, sf_dir):
    _, used = U.zero_filled(fixture(spark, sf_dir, "f3_api"), fixture(spark, sf_dir, "f3_usage"))
    return used


REF_DUT = """r as (select api, cast(sum(total) as bigint) as total from f3_usage where product = 'prod_0' group by api),
d as (select api, cast(sum(total) as bigint) as total from f3_usage where product = 'prod_1' group by api),
c as (select distinct r.api, r.total from r join d on r.api = d.api and r.total = d.total)"""


@query("j14_usage_diff", with_fixtures("""
select api, total, 'common' as side from c
union all select api, total, 'ref' from r where api not in (select api from c)
union all select api, total, 'dut' from d where api not in (select api from c)
""", "f3_usage", ctes=REF_DUT))
def j14_usage_diff(spark, sf_dir):
    u = fixture(spark, sf_dir, "f3_usage")

    def side(p):
        return u.filter(F.col("product") == p).groupBy("api").agg(F.sum("total").cast("bigint").alias("total"))
    return U.usage_diff(side("prod_0"), side("prod_1"))


@query("a16_category_coverage", with_fixtures("""
select pc.category, pc.n_items, pc.n_used, pp.product, pp.n_used_by_product from pc left join pp on pc.category = pp.category
""", "f3_api", "f3_usage", ctes="""j as (select a.api, a.category, u.product from f3_api a
   left join (select distinct api, product from f3_usage where total > 0) u on a.api = u.api),
pc as (select category, count(distinct api) as n_items, count(distinct case when product is not null then api end) as n_used from j group by 1),
pp as (select category, product, count(distinct api) as n_used_by_product from j where product is not null group by 1, 2)"""))
def a16_category_coverage(spark, sf_dir):
    return U.category_coverage(fixture(spark, sf_dir, "f3_api"), fixture(spark, sf_dir, "f3_usage"))


# the deep trees: ids count all headers; which node a subtree's rows belong to is known from the fixture
DEEP = """heads as (select *, cast(row_number() over (partition by file order by g, k) - 1 as bigint) as id from f3_tree where kind <> 'd'),
nodes as (select h.file, h.g, h.k, h.id, h.name, h.indent, h.times, h.size, h.kind = 'o' as orphan,
   case h.k when 0 then null when 1 then 0 when 11 then null else p.id end as parent,
   case when h.kind = 'h' then cast(h.indent / 2 as bigint) end as depth
  from heads h left join heads p on p.file = h.file and p.g = h.g
    and p.k = case h.k when 2 then 1 when 13 then 1 when 3 then 2 when 6 then 2 when 7 then 6 else -1 end
  where h.kind <> 'c'),
flat as (select *, case when k = 3 then size + 10.5 end as low_average, case when k = 3 then cast(size + 10 as double) end as low_total from nodes)"""


def deep_tree(spark, sf_dir):
    return U.parse_usage_tree(fixture(spark, sf_dir, "f3_tree_lines"))


@query("s6_deep_nodes", with_fixtures("""
select file, id as node_id, name, 'op' as tag, indent as spaces, times as loop_times, parent as parent_id, depth as depth_id, orphan, low_average, low_total
from flat
""", "f3_tree", ctes=DEEP))
def s6_deep_nodes(spark, sf_dir):
    nodes, _ = deep_tree(spark, sf_dir)
    return nodes


TREE_JSON = DEEP + """,
heads_of as (select *, concat('{"name":"', name, '","id":', cast(id as varchar), ',"loop_times":', cast(times as varchar), ',"low_usage":',
   case when k = 3 then concat('{"summary":{"average":', cast(low_average as varchar), ',"total":', cast(low_total as varchar), '},"details":{"api_', cast(size % 7 as varchar),
     '":{"average":', cast(low_average as varchar), ',"total":', cast(cast(size + 10 as bigint) as varchar), '}}}') else 'null' end) as front,
   concat(',"pid":', cast(depth as varchar), ',"changelist":', cast(length(file) as varchar)) as back from flat where not orphan),
high as (select file, parent, sum(times) as total, string_agg(concat('"', substr(name, 4), '":{"average":null,"total":', cast(times as varchar), '}'), ',' order by substr(name, 4)) as details
  from flat where name like 'hl!_%' escape '!' and parent is not null group by 1, 2),
texts as (select n.file, n.g, n.k, n.id, n.parent, concat(n.front, ',"high_usage":', case when h.total <> 0 then concat('{"summary":{"average":null,"total":', cast(h.total as varchar),
   '},"details":{', h.details, '}}') else 'null' end, n.back) as body from heads_of n left join high h on h.file = n.file and h.parent = n.id),
deep as (select file, parent, concat(body, '}') as t from texts where k = 7),
inner_ as (select x.file, x.parent, x.id, concat(x.body, case when d.t is not null then concat(',"child_node":[', d.t, ']') else '' end, '}') as t
  from texts x left join deep d on d.file = x.file and d.parent = x.id where x.k in (3, 6)),
stage as (select x.file, x.parent, x.id, concat(x.body, ',"child_node":[', (select string_agg(i.t, ',' order by i.id) from inner_ i where i.file = x.file and i.parent = x.id), ']}') as t
  from texts x where x.k = 2),
under_a as (select * from stage union all select file, parent, id, concat(body, '}') from texts where k = 13),
a as (select x.file, x.parent, x.id, concat(x.body, ',"child_node":[', u.t, ']}') as t from texts x
  join (select file, parent, string_agg(t, ',' order by id) as t from under_a group by 1, 2) u on u.file = x.file and u.parent = x.id where x.k = 1)"""


@query("json_usage_trees", with_fixtures("""
select r.file, r.id as node_id, concat(r.body, ',"child_node":[', c.t, ']}') as tree
from texts r join (select file, string_agg(t, ',' order by id) as t from a group by 1) c on c.file = r.file where r.k = 0
""", "f3_tree", ctes=TREE_JSON))
def json_usage_trees(spark, sf_dir):
    nodes, details = deep_tree(spark, sf_dir)
    return U.usage_trees(nodes, details, PREFIX, F.length("file"))
