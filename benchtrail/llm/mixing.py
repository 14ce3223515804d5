"""Mix sources to target weights by hash thresholds.

Every document has a hash. Per source, tokens are summed by hash bucket (a
histogram of at most 2**12 buckets); the running sum finds the bucket in which
the source's budget ends; only that bucket is refined by the next bits of the
hash, until single hashes are left. The budget is then a
threshold: a document is taken once more if its hash lies below. Thresholds
of growing budgets are nested. Nothing is sorted but the histograms.
DataFrame functions only.

Defined results: a null text has size 0; null is a source of its own and
comes last; documents of equal id and text share one hash and so one fate;
sources without a token have target 0; an empty table gives an empty result.
Other columns are kept by :func:`mix_documents`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, id_text, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: widths of the histogram levels; together the 60 bits of the hash
LEVELS = (10, 12, 12, 26)
HASH_BITS = sum(LEVELS)
#: thresholds are broadcast up to this many sources and joined by a shuffle beyond
BROADCAST_SOURCES = 100_000


def doc_hash(id_col: str, text_col: str) -> Column:
    """The first 60 bits of the MD5 of ``id:text``."""
    text = F.concat(id_text(F.col(id_col)), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target): the weighted shares of all tokens, each
    capped at ``max_repeats`` times its source, what is cut off reshared.

    Filling shares with caps is water filling: in the order of cap / weight a
    source is capped as long as its cap is below the share that the tokens
    and weights left would give it. One row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    sources = (sources.withColumn("weight", F.element_at(table, ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int")))
               .withColumn("cap", F.col("source_size") * max_repeats).withColumn("ratio", F.col("cap") / F.col("weight")))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    filled = sources.withColumn("level", left / weight_left)
    # the level of the first source that its share doesn't fill up holds for all after it
    level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"]
    return (filled.withColumn("open", level)
            .select("source", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("open") * F.col("weight")),
                                                        F.col("cap").cast("double")).alias("target")))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, repeats, cut): documents are taken
    ``repeats`` times, those of a hash up to ``cut`` once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = (targets.withColumn("repeats", whole).withColumn("budget", F.col("target") - F.col("repeats") * F.col("source_size"))
            .withColumn("below", F.lit(0).cast("long")).withColumn("prefix", F.lit(0).cast("long")))
    shift = HASH_BITS
    for bits in LEVELS:
        inside = F.shiftright("hash", shift) if shift < HASH_BITS else F.lit(0).cast("long")
        shift -= bits
        rows = sized.select(F.col("source").alias("src"), "size", inside.alias("at"), F.shiftright("hash", shift).alias("bucket"))
        part = plan.select("source", "budget", "below", "prefix")
        hist = (rows.join(_small(part), F.col("src").eqNullSafe(F.col("source")) & (F.col("at") == F.col("prefix")))
                .groupBy("source", "bucket").agg(F.sum("size").alias("size"), F.first("budget").alias("budget"), F.first("below").alias("below")))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        # the last bucket that begins within the budget is the boundary
        hist = hist.withColumn("below", F.col("below") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
        bound = (hist.filter(F.col("below") <= F.col("budget")).groupBy("source")
                 .agg(F.max(F.struct("bucket", "below", "size")).alias("m")))
        plan = stored(plan.drop("prefix", "below").join(bound.withColumnRenamed("source", "src"), F.col("source").eqNullSafe(F.col("src")), "left")
                      .select("source", "source_size", "target", "repeats", "budget", F.coalesce("m.bucket", F.lit(0)).alias("prefix"),
                              F.coalesce("m.below", F.lit(0)).alias("below"), F.coalesce("m.size", F.lit(0)).alias("last")), "mix-level")
    # the document on the boundary is taken if that comes nearer to the budget
    nearer = F.col("below") + F.col("last") - F.col("budget") < F.col("budget") - F.col("below")
    return plan.select("source", "source_size", "target", "repeats",
                       F.when(F.col("budget") <= 0, F.lit(-1).cast("long")).when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("cut"))


def _small(sources: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source if its size, once counted, allows it."""
    return F.broadcast(sources) if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else sources


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       doc_hash(id_col, text_col).alias("hash"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, times) per document: the mix takes
    the document ``times`` times."""
    sized = stored(_sized(docs, id_col, text_col, source_col), "mix-sized")
    plan = thresholds(sized, stored(source_targets(sized, weights, max_repeats), "mix-targets")).withColumnRenamed("source", "src")
    return (sized.join(_small(plan), F.col("source").eqNullSafe(F.col("src")))
            .select("id", "source", "size", "source_size", "target", (F.col("repeats") + (F.col("hash") <= F.col("cut")).cast("long")).alias("times")))


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it.

    A document without a word weighs nothing and stays once if its source is
    taken at all.
    """
    sized = stored(_sized(docs, id_col, text_col, source_col), "mix-sized")
    plan = thresholds(sized, stored(source_targets(sized, weights, max_repeats), "mix-targets"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")  # one column: no name can clash
    keyed = docs.select(whole, F.col(source_col).alias("_src"), doc_hash(id_col, text_col).alias("_hash"))
    times = (F.col("repeats") + (F.col("_hash") <= F.col("cut")).cast("long")).cast("int")
    taken = (keyed.join(_small(plan), F.col("_src").eqNullSafe(F.col("source"))).withColumn("_n", times).filter("_n > 0")
             .select("doc", F.explode(F.sequence(F.lit(1), F.col("_n")))))
    return taken.select("doc.*")


def op4_hash_threshold_mix(spark, sf_dir):
    out = mix(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


OP4_SQL = """
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as hash
  from documents),
src as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, 3 * source_size as cap, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source nulls last)) - 1) % 3 + 1] as weight from src),
filled as (
  select *, cap / weight as ratio,
         (sum(source_size) over () - coalesce(sum(cap) over w, 0))::double
           / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as level
  from weighed window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_size,
         coalesce(least(cap::double, (select arg_min(level, ratio) from filled where ratio > level) * weight), cap::double) as target
  from filled),
planned as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as repeats,
         target - (case when source_size > 0 then floor(target / source_size)::bigint else 0 end) * source_size as budget
  from targets),
hashes as (select source, hash, sum(size)::bigint as size from sized group by source, hash),
running as (
  select *, coalesce(sum(size) over (partition by source order by hash rows between unbounded preceding and 1 preceding), 0) as below from hashes),
cuts as (
  select p.source, p.source_size, p.target, p.repeats,
         max(r.hash) filter (r.below <= p.budget) as last_hash,
         arg_max(r.size, r.hash) filter (r.below <= p.budget) as last_size,
         arg_max(r.below, r.hash) filter (r.below <= p.budget) as last_below, any_value(p.budget) as budget
  from planned p join running r on p.source is not distinct from r.source
  group by p.source, p.source_size, p.target, p.repeats)
select d.doc_id, d.size, c.source_size, c.target,
       (d.size * (c.repeats + case when d.hash < c.last_hash
                                     or (d.hash = c.last_hash and c.last_below + c.last_size - c.budget < c.budget - c.last_below)
                                   then 1 else 0 end))::bigint as taken
from sized d join cuts c on d.source is not distinct from c.source
"""
