"""Mixing sources to target weights by hash thresholds, with DataFrame functions only.

Every row has a key: hexadecimal digits of a hash. A source takes its rows as often as its target holds its size, and once
more those rows whose key lies below a threshold. The threshold is found from histograms: words by source and the key's
first three digits, then, of the bucket alone in which the running sum passes the budget, by three digits more, until one
row is left. So a larger budget takes what a smaller one does, and no row is sorted. As the row at a threshold may be a
very long one, the rows beyond it that still fit are dealt with in the same way, a few times.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura.llm._ranks import ranked
from murmura.llm._store import discard, table

WEIGHTS, MOST, PASSES, SEED = (5, 2, 1), 3, 3, 7
#: Hexadecimal digits of a key that come from the hash; 16 more tell rows apart that are alike. Digits of a level.
DIGITS, STEP = 30, 3
#: So many sources at most are broadcast, some 200 bytes each; beyond that rows meet theirs by source and salt.
BROADCAST, SALTS = 50_000, 64
WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, grp, size, key of every row."""
    told = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), "text"), 256)
    return docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("grp"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.concat(F.substring(told, 1, DIGITS), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")).alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, share: float = 1.0) -> DataFrame:
    """source, grp, source_size, target of every source (source, grp, source_size).

    Sources by code point, null last, have the weights in turn. share of all sizes is dealt by weight; a target stops at
    most times its source's size, and what is left over goes to the others by weight, until none is above."""
    order = ranked(sizes, [F.col("source").asc_nulls_last()])
    own = table(order.select("source", "grp", "source_size", F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, len(weights)).cast("int")).alias("weight")), "sources")
    whole = own.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, limit = (whole["size"] or 0) * share, F.col("source_size") * most
    budget = int(budget) if budget == int(budget) else budget
    level = budget / (whole["weight"] or 1)
    while True:
        full = F.col("weight") * F.lit(level) > limit
        got = own.where(full).agg(F.coalesce(F.sum(limit), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
        if got["weight"] == (whole["weight"] or 0):
            break
        after = (budget - got["size"]) / (whole["weight"] - got["weight"])
        if after <= level:
            break
        level = after
    return own.select("source", "grp", "source_size", F.least(F.col("weight") * F.lit(level), limit.cast("double")).alias("target"))


def _attach(rows: DataFrame, few: DataFrame, small: bool) -> DataFrame:
    """rows with what their source has in few (a row for each)."""
    if small:
        return rows.join(F.broadcast(few), "grp")
    salted = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(SALTS)).cast("int")).join(salted, ["grp", "salt"]).drop("salt")


def _threshold(rows: DataFrame, state: DataFrame, first: bool, small: bool) -> DataFrame:
    """state with whole (words of all rows in question) and edge: the row at which the sum passes rest, and the words before it.

    Rows in question lie beyond the state's after; but for the first time they fit in the rest by themselves."""
    running = Window.partitionBy("grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    opened = state.withColumns({"prefix": F.lit(""), "before": F.lit(0).cast("long"), "whole": F.lit(0).cast("long")})
    fits = (F.col("size") > 0) & (F.col("key") > F.col("after"))
    if not first:
        fits &= F.col("size") <= F.col("rest")
    level = 0
    edge = "struct<prefix:string,before:long,n:long,size:long,key:string>"
    while True:
        level += 1
        near = _attach(rows, opened.select("grp", "rest", "after", "prefix", "before"), small).where(fits & F.col("key").startswith(F.col("prefix")))
        hist = near.groupBy("grp", "rest", "before", F.substring("key", 1, STEP * level).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.min("key").alias("key"))
        run = hist.withColumn("upto", F.col("before") + F.sum("size").over(running))
        at = F.when((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") <= F.col("rest")), F.struct(
            F.col("bucket").alias("prefix"), (F.col("upto") - F.col("size")).alias("before"), "n", "size", "key"))
        found = run.groupBy("grp").agg(F.max("upto").alias("upto"), F.first(at, ignorenulls=True).cast(edge).alias("edge"))
        if level == 1:
            held = table(state.join(found.withColumnRenamed("upto", "whole"), "grp", "left"), "edges")
        else:
            after = table(held.join(found.select("grp", F.col("edge").alias("next")), "grp", "left").withColumn("edge", F.coalesce("next", "edge")).drop("next"), "edges")
            discard(held)
            held = after
        if not held.where("edge.n > 1").limit(1).count():
            return held
        opened = held.where("edge.n > 1").select("grp", "rest", "after", "edge.prefix", "edge.before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, share: float = 1.0, seed: int = SEED, passes: int = PASSES) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of every document the mix takes, repeats counted.

    A document is taken whole, at most `most` times. Beside its whole rounds a source takes the rows below its threshold,
    then of the rows beyond it that fit in what is left, and so on, `passes` times; at last the shortest row at a
    threshold, if that comes nearer to the target. A source whose documents are all longer than what is left misses its
    target by half its shortest row at a threshold or less.

    A null or blank text has size 0 and is taken 0 times; so is every document of a source of size 0. A null source is a
    source of its own, the last, and an empty one is another. A null doc_id is carried along. Of rows that are alike in
    doc_id and text any may be taken, so the result is the same; other columns are ignored. An empty table gives no rows."""
    rows = table(sized(docs, seed), "sizes")
    sizes = rows.groupBy("source", "grp").agg(F.sum("size").alias("source_size"))
    base = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    state = table(targets(sizes, weights, most, share).drop("source").withColumn("base", base).withColumns({
        "rest": F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size")), "after": F.lit(""),
        "picks": F.array().cast("array<struct<most:double,after:string,upto:string>>"), "missed": F.array().cast("array<struct<size:long,key:string>>")}), "state")
    small = state.count() <= BROADCAST
    for p in range(passes):
        seen = _threshold(rows, state, p == 0, small)
        pick = F.struct(F.when(F.lit(p > 0), F.col("rest")).alias("most"), F.col("after"), F.col("edge.key").alias("upto"))
        miss = F.when(F.col("edge").isNotNull(), F.array(F.struct("edge.size", "edge.key"))).otherwise(F.array())
        state = table(seen.select(
            "grp", "source_size", "target", "base", (F.col("rest") - F.coalesce("edge.before", "whole", F.lit(0))).alias("rest"), F.coalesce("edge.key", F.lit("~")).alias("after"),
            F.concat("picks", F.array(pick)).alias("picks"), F.concat("missed", miss).alias("missed")), "state")
        if not state.where("after <> '~'").limit(1).count():
            break
    least = F.array_min("missed")
    state = state.withColumn("last", F.when(least["size"] < 2 * F.col("rest"), least["key"]))

    def below(x: Column) -> Column:
        return (F.col("key") > x["after"]) & (x["upto"].isNull() | (F.col("key") < x["upto"])) & (x["most"].isNull() | (F.col("size") <= x["most"]))

    more = (F.exists("picks", below) & (F.size("picks") > 0)) | F.coalesce(F.col("key") == F.col("last"), F.lit(False))
    return _attach(rows, state, small).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("base") + more.cast("long"))).alias("taken"))


def mix_sql(passes: int = PASSES) -> str:
    """The same in SQL for DuckDB, by running sums over sorted rows."""
    first = WEIGHTS[0]
    weight = " ".join(f"when {i} then {w}" for i, w in enumerate(WEIGHTS[1:], 1))
    steps, tail = "", "s0"
    for p in range(passes):
        fits = "size <= rest and" if p else ""
        steps += f"""
c{p} as (select d.grp, key, size, rest, sum(size) over (partition by d.grp order by key rows unbounded preceding) as upto from d join s{p} using (grp) where size > 0 and {fits} key > after),
e{p} as (select grp, max(upto) as whole, arg_min(size, key) filter (upto > rest) as esize, min(key) filter (upto > rest) as ekey, arg_min(upto - size, key) filter (upto > rest) as before from c{p} group by 1),
s{p + 1} as materialized (select s.* replace (rest - coalesce(before, whole, 0) as rest, coalesce(ekey, '~') as after), {"rest as most, " if p else "cast(null as double) as most, "} after as a, ekey as u, esize
  from (select grp, source_size, target, base, rest, after from s{p}) as s left join e{p} using (grp)),"""
        tail = f"s{p + 1}"
    chosen = " or ".join(f"(key > p{p}.a and (p{p}.u is null or key < p{p}.u) and (p{p}.most is null or size <= p{p}.most))" for p in range(1, passes + 1))
    missed = " union all ".join(f"select grp, esize, u from s{p} where esize is not null" for p in range(1, passes + 1))
    joins = " ".join(f"join s{p} as p{p} using (grp)" for p in range(1, passes + 1))
    return f"""
with d as materialized (select doc_id, source, coalesce('s' || source, '') as grp, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
  substr(sha256(concat_ws(':', '{SEED}', cast(doc_id as varchar), text)), 1, {DIGITS}) || lpad(to_hex(row_number() over ()), 16, '0') as key from documents),
g as (select grp, any_value(source) as source, cast(sum(size) as bigint) as z from d group by 1),
w as (select *, case (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} {weight} else {first} end as w from g),
o as (select *, row_number() over (order by {MOST}.0 * z / w, grp) as i, sum({MOST} * z) over (order by {MOST}.0 * z / w, grp rows unbounded preceding) - {MOST} * z as c,
  sum(w) over (order by {MOST}.0 * z / w, grp rows unbounded preceding) - w as v from w),
l as (select coalesce(arg_min(cast(t - c as double) / cast(a - v as double), i) filter (w * (cast(t - c as double) / cast(a - v as double)) <= {MOST} * z), 0) as level
  from o, (select sum(z) as t, sum(w) as a from w)),
t as (select grp, z as source_size, least(w * level, cast({MOST} * z as double)) as target from w, l),
b as (select *, case when source_size > 0 then least(floor(target / source_size), {MOST}) else 0 end as base from t),
s0 as materialized (select *, greatest(0, target - base * source_size) as rest, '' as after from b),{steps}
m as (select grp, min(struct_pack(size := esize, key := u)) as least from ({missed}) group by 1),
f as (select f.grp, case when least.size < 2 * rest then least.key end as last from {tail} as f left join m using (grp))
select doc_id, size, p1.source_size, p1.target, cast(size * (p1.base + case when {chosen} or coalesce(key = last, false) then 1 else 0 end) as bigint) as taken
from d {joins} join f using (grp)"""


def op13_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents mixed by the weights."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
