"""Coverage queries: trace and API-universe scans, the removal chain, token
matches over report text (F3 and the documents table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, raw, with_fixtures
from benchtrail.operators import coverage as V
from benchtrail.plans.coverage import coverage_report
from benchtrail.registry import query
from benchtrail.sources import logs as L

MARKER, PHRASE = "poison", "#pragma GCC poison"


def universe(spark, sf_dir):
    return L.read_api_universe(fixture(spark, sf_dir, "f3_header_lines"), MARKER, PHRASE)


def trace(spark, sf_dir):
    return L.read_trace(fixture(spark, sf_dir, "f3_trace"))


def chain(spark, sf_dir):
    api = fixture(spark, sf_dir, "f3_api")
    return V.coverage_chain(universe(spark, sf_dir), trace(spark, sf_dir), fixture(spark, sf_dir, "f3_report_lines"),
                            fixture(spark, sf_dir, "f3_header_lines"), api.filter(F.col("deprecated")))


HITS = """hits as (select concat('op_', cast(l_partkey as varchar(8))) as api,
   count(case when l_returnflag = 'A' and l_quantity > 45 then 1 end) as hits from lineitem group by l_partkey)"""

CHAIN = HITS + """,
p as (select concat('op_', cast(p_partkey as varchar(8))) as api, p_size from part),
ch as (select p.api, case when h.hits >= 1 then 'executed' when p.p_size % 3 = 0 then 'called_macro'
                          when p.p_size > 45 then 'macro' when p.p_size = 1 then 'deprecated' else 'not_covered' end as reason
       from p left join hits h on p.api = h.api)"""


@query("s10_read_trace", with_fixtures("select api, cast(hits as bigint) as hits from hits where hits >= 1", ctes=HITS))
def s10_read_trace(spark, sf_dir):
    return trace(spark, sf_dir)


@query("s11_api_universe", "select distinct concat('op_', cast(p_partkey as varchar(8))) as api from part")
def s11_api_universe(spark, sf_dir):
    return universe(spark, sf_dir)


@query("j5_coverage_chain", with_fixtures("select api, reason from ch", ctes=CHAIN))
def j5_coverage_chain(spark, sf_dir):
    return chain(spark, sf_dir)


@query("j5_chain_counts", with_fixtures("""
select count(*) as n_universe, count(*) filter (where reason <> 'executed') as n_not_executed,
       count(*) filter (where reason not in ('executed', 'called_macro')) as n_after_called_macro,
       count(*) filter (where reason not in ('executed', 'called_macro', 'macro')) as n_after_macro,
       count(*) filter (where reason = 'not_covered') as n_not_covered from ch
""", ctes=CHAIN))
def j5_chain_counts(spark, sf_dir):
    return V.chain_counts(chain(spark, sf_dir))


@query("j6_token_match", """
select distinct concat('op_', cast(p_partkey as varchar(8))) as api from part where p_size % 3 = 0
""")
def j6_token_match(spark, sf_dir):
    return V.token_match(universe(spark, sf_dir), fixture(spark, sf_dir, "f3_report_lines"))


@query("j7_macro_defined", "select distinct concat('op_', cast(p_partkey as varchar(8))) as api from part where p_size > 45")
def j7_macro_defined(spark, sf_dir):
    return V.macro_defined(universe(spark, sf_dir), fixture(spark, sf_dir, "f3_header_lines"))


# J6 over the documents: APIs = identifier words of the texts, report = the
# texts' lines, covered = longer than 40 characters.
DOC_CTES = r"""words as (select distinct unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) as api from documents),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as ln
          from documents),
pieces as (select doc_id, ln, line, unnest(string_split_regex(line, '[^A-Za-z0-9_]')) as piece,
                  unnest(range(1, len(string_split_regex(line, '[^A-Za-z0-9_]')) + 1)) as i
           from lines where length(line) > 40),
pos as (select *, cast(sum(length(piece) + 1) over (partition by doc_id, ln order by i rows between unbounded preceding and current row)
                  - length(piece) as bigint) as st from pieces),
runs as (select piece, case when st > 1 then substr(line, st - 1, 1) end as prv, substr(line, st + length(piece), 1) as nxt
         from pos where piece <> ''),
cands as (select piece as cand from runs where prv is not null and nxt in (' ', '|', '(', '')
          union all select piece from runs where prv = '(' and nxt = ','
          union all select substr(piece, k + 1) from (select piece, cast(unnest(range(1, length(piece))) as integer) as k from runs
                                                      where nxt in (' ', '|', '(', '')) s where substr(piece, k, 1) <> '_')"""


@query("j6_token_match_documents", with_fixtures("select api from words where api in (select cand from cands)", ctes=DOC_CTES))
def j6_token_match_documents(spark, sf_dir):
    docs = raw(spark, sf_dir, "documents")
    apis = docs.select(F.explode(F.split("text", "[^A-Za-z0-9_]+")).alias("api")).filter("api != ''").distinct()
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    return V.token_match(apis, lines, covered=F.length("line") > 40)


REF_LIST = "select concat('op_', cast(p_partkey as varchar(8))) as api from part where p_size between 20 and 30"


@query("u5_list_diff", with_fixtures(f"""
select coalesce(c.api, r.api) as api, case when r.api is null then 'added' else 'removed' end as change
from (select distinct api from ch where reason = 'not_covered') c full outer join ({REF_LIST}) r on c.api = r.api
where c.api is null or r.api is null
""", ctes=CHAIN))
def u5_list_diff(spark, sf_dir):
    ch = chain(spark, sf_dir)
    ref = raw(spark, sf_dir, "part").filter(F.col("p_size").between(20, 30)) \
        .select(F.concat(F.lit("op_"), F.col("p_partkey").cast("string")).alias("api"))
    return V.list_diff(ch.filter(F.col("reason") == "not_covered"), ref)


@query("r7_coverage_report", with_fixtures(f"""
select reason as kind, count(*) as n from ch group by 1
union all
select case when r.api is null then 'added' else 'removed' end, count(*)
from (select distinct api from ch where reason = 'not_covered') c full outer join ({REF_LIST}) r on c.api = r.api
where c.api is null or r.api is null group by 1
""", ctes=CHAIN))
def r7_coverage_report(spark, sf_dir):
    api = fixture(spark, sf_dir, "f3_api")
    ref = raw(spark, sf_dir, "part").filter(F.col("p_size").between(20, 30)) \
        .select(F.concat(F.lit("op_"), F.col("p_partkey").cast("string")).alias("api"))
    found = coverage_report(universe(spark, sf_dir), trace(spark, sf_dir), fixture(spark, sf_dir, "f3_report_lines"),
                            fixture(spark, sf_dir, "f3_header_lines"), api.filter(F.col("deprecated")), ref)
    return found["chain"].groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        found["changes"].groupBy(F.col("change").alias("kind")).agg(F.count(F.lit(1)).alias("n")))
