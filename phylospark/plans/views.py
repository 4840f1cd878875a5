"""Tables of the data model derived from the driver's tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FROM, _TO = "abcdefghijklmnopqrstuvwxyz", "acgtacgtacgtacgtacgtacgtac"
_ALN_TO = "acgtacgtacgtacgtrcgtacn-ac"
READ = 151


#: Views that were written out beforehand, by name and folder of tables: a bench then times queries, not the making of views.
WRITTEN: dict[tuple[str, str], str] = {}


def write_view(spark: SparkSession, sf_dir: str, name: str, path: str) -> None:
    """Write a view's rows to ``path``; queries over those tables read them from there."""
    {"reads": reads, "alignments": alignments, "contigs": contigs}[name](spark, sf_dir).write.mode("overwrite").parquet(path)
    WRITTEN[name, sf_dir] = path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    if path := WRITTEN.get(("contigs", sf_dir)):
        return spark.read.parquet(path)
    docs = table(spark, sf_dir, "documents")
    seq = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), _FROM, _TO)
    out = docs.select(F.col("source").alias("sample"), F.col("doc_id").cast("string").alias("contig"), seq.alias("sequence"), ((F.col("n_chars") % 200) / 10.0).alias("depth"))
    return out.withColumn("length", F.length("sequence"))


CONTIGS = f"""contigs as (
  select sample, contig, sequence, depth, length(sequence) as length from (
    select source as sample, cast(doc_id as varchar) as contig, cast(n_chars % 200 as double) / 10.0 as depth,
      translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{_FROM}', '{_TO}') as sequence from documents))"""


def windows(sequence: Column, size: int) -> Column:
    """A text's windows of ``size`` letters, the last one shorter, in one pass over it; substrings cost time by their place."""
    return F.regexp_extract_all(sequence, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def reads(spark: SparkSession, sf_dir: str, quality: bool = True) -> DataFrame:
    """Windows of 151 bases of the contigs as reads, with qualities made from bases and places, unless they aren't wanted."""
    if path := WRITTEN.get(("reads", sf_dir)):
        return spark.read.parquet(path)
    c = contigs(spark, sf_dir).where("length > 0")
    named = F.concat_ws("_", "contig", F.col("w").cast("string")).alias("read_id"), (F.col("w") % 2 + 1).alias("mate")
    if not quality:
        return c.select("sample", "contig", F.posexplode(windows(F.col("sequence"), READ)).alias("w", "sequence")).select("sample", *named, "sequence")
    cut = c.withColumn("w", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / READ).cast("int"))))
    cut = cut.select("sample", *named, F.substring(F.col("sequence"), F.col("w") * READ + 1, F.lit(READ)).alias("sequence"))
    made = F.transform(F.split("sequence", ""), lambda b, i: F.char(33 + (F.ascii(b) * 7 + (i + 1) * 3) % 41))
    # the generator keeps later steps from computing the made-up quality once for each use
    return cut.withColumn("quality", F.explode(F.array(F.array_join(made, ""))))


READS = f"""{CONTIGS}, reads as (
  select sample, read_id, mate, sequence,
    array_to_string([chr(cast(33 + (ascii(substr(sequence, i, 1)) * 7 + i * 3) % 41 as int)) for i in range(1, length(sequence) + 1)], '') as quality
  from (select sample, contig || '_' || w as read_id, cast(w % 2 + 1 as int) as mate, substr(sequence, cast(w * {READ} + 1 as bigint), {READ}) as sequence
    from (select *, unnest(range(0, (length - 1) // {READ} + 1)) as w from contigs where length > 0)))"""


WIDTH = 120


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in stretches of 120 sites: a locus is a source's n-th stretch, a row a document's."""
    if path := WRITTEN.get(("alignments", sf_dir)):
        return spark.read.parquet(path)
    docs = table(spark, sf_dir, "documents")
    seq = F.upper(F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), _FROM, _ALN_TO))
    whole = docs.select("source", "doc_id", seq.alias("s")).where(F.length("s") > 0)
    cut = whole.select("source", "doc_id", F.posexplode(windows(F.col("s"), WIDTH)).alias("w", "s"))
    doc = F.col("doc_id")
    return cut.select(
        F.concat_ws("_", "source", F.col("w").cast("string")).alias("locus"),
        F.concat_ws("_", doc.cast("string"), F.col("w").cast("string")).alias("seq_name"),
        F.concat(F.lit("s"), (doc % 17).cast("string")).alias("sample"),
        F.floor(doc / 340).cast("int").alias("rank"),
        (doc % 29 == 0).alias("is_ref"),
        F.concat(F.lit("t"), (doc % 5).cast("string")).alias("target"),
        F.rpad("s", WIDTH, "-").alias("sequence"),
    )


ALIGNMENTS = f"""alignments as (
  select source || '_' || w as locus, doc_id || '_' || w as seq_name, 's' || (doc_id % 17) as sample, cast(doc_id // 340 as int) as rank,
    doc_id % 29 = 0 as is_ref, 't' || (doc_id % 5) as target, rpad(substr(s, cast(w * {WIDTH} + 1 as bigint), {WIDTH}), {WIDTH}, '-') as sequence
  from (select *, unnest(range(0, (length(s) - 1) // {WIDTH} + 1)) as w from (
    select source, doc_id, upper(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{_FROM}', '{_ALN_TO}')) as s from documents) where length(s) > 0))"""


def hits(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Line items as similarity hits of targets on contigs.

    Ids are 64-bit numbers as in the SQL, which end at 9.2 million orders; ``wide`` ones have the same values as decimals without that end.
    """
    items = table(spark, sf_dir, "lineitem")
    order = "cast(l_orderkey as decimal(38, 0))" if wide else "l_orderkey"
    hit_id = f"{order} * 1000000000000 + l_linenumber * 100000000000 + l_partkey * 10000 + l_suppkey"
    return items.selectExpr(
        f"cast({hit_id} as decimal(38, 0)) as hit_id" if wide else f"{hit_id} as hit_id",
        "concat('s', l_orderkey % 20) as sample",
        "l_suppkey as contig",
        "l_partkey as target",
        "l_partkey % 50 as locus",
        "cast((l_orderkey * 37) % 10000 as bigint) as t_start",
        "cast((l_orderkey * 37) % 10000 + l_quantity * 10 as bigint) as t_end",
        "cast(12000 as bigint) as t_size",
        "cast((l_orderkey * 11) % 400 as bigint) as q_start",
        "cast((l_orderkey * 11) % 400 + l_quantity * 10 as bigint) as q_end",
        "cast(1000 + l_partkey % 500 as bigint) as q_size",
        "cast(l_quantity * 9 as bigint) as matches",
        "cast(l_quantity as bigint) as mismatches",
        "cast(l_orderkey % 3 as bigint) as q_num_insert",
        "case when l_orderkey % 2 = 0 then '+' else '-' end as strand",
        "floor(l_extendedprice) / 100000.0D as wscore",
        "60 + (l_orderkey * 13 % 4000) / 100.0D as identity",
        "5 + (l_partkey * 7 % 9500) / 100.0D as coverage",
        "(1 + l_orderkey % 300) / 10.0D as depth",
    )


HITS = """hits as (
  select l_orderkey * 1000000000000 + l_linenumber * 100000000000 + l_partkey * 10000 + l_suppkey as hit_id, 's' || (l_orderkey % 20) as sample, l_suppkey as contig, l_partkey as target, l_partkey % 50 as locus,
    cast((l_orderkey * 37) % 10000 as bigint) as t_start, cast((l_orderkey * 37) % 10000 + l_quantity * 10 as bigint) as t_end, cast(12000 as bigint) as t_size,
    cast((l_orderkey * 11) % 400 as bigint) as q_start, cast((l_orderkey * 11) % 400 + l_quantity * 10 as bigint) as q_end, cast(1000 + l_partkey % 500 as bigint) as q_size,
    cast(l_quantity * 9 as bigint) as matches, cast(l_quantity as bigint) as mismatches, cast(l_orderkey % 3 as bigint) as q_num_insert,
    case when l_orderkey % 2 = 0 then '+' else '-' end as strand, floor(l_extendedprice) / 100000.0 as wscore,
    60 + cast(l_orderkey * 13 % 4000 as double) / 100.0 as identity, 5 + cast(l_partkey * 7 % 9500 as double) / 100.0 as coverage,
    cast(1 + l_orderkey % 300 as double) / 10.0 as depth
  from lineitem)"""


def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as extraction statistics: one row a recovered copy."""
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr("concat('s', o_custkey % 40) as sample", "concat('m', o_custkey % 3) as marker", "concat('L', o_orderkey % 97) as locus", "concat('t', o_custkey % 11) as target", "o_orderkey as hit_id", "floor(o_totalprice) / 500000.0D as wscore", "round((o_orderkey * 31 % 10000) / 100.0D, 2) as coverage", "cast(100 + o_orderkey % 900 as bigint) as ref_len_matched", "case when o_orderkey % 7 = 0 then '3,9' when o_orderkey % 5 = 0 then '12' end as frameshifts")


EXTRACTION = """extraction as (
  select 's' || (o_custkey % 40) as sample, 'm' || (o_custkey % 3) as marker, 'L' || (o_orderkey % 97) as locus, 't' || (o_custkey % 11) as target, o_orderkey as hit_id,
    floor(o_totalprice) / 500000.0 as wscore, round(cast(o_orderkey * 31 % 10000 as double) / 100.0, 2) as coverage,
    cast(100 + o_orderkey % 900 as bigint) as ref_len_matched, case when o_orderkey % 7 = 0 then '3,9' when o_orderkey % 5 = 0 then '12' end as frameshifts
  from orders)"""


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label as members of one cluster, named by the smallest id."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") * 10 + F.floor(F.col("vec_id") / 40) % 10).alias("g"))
    lead = e.groupBy("g").agg(F.min("vec_id").alias("centroid"))
    return e.join(lead, "g").select("centroid", F.col("vec_id").alias("member"), F.concat(F.lit("s"), (F.col("vec_id") % 13).cast("string")).alias("sample"), F.concat(F.lit("sp"), (F.col("vec_id") % 6).cast("string")).alias("species"), (100 + F.col("vec_id") * 7 % 900).alias("length"), F.concat(F.lit("L"), (F.col("vec_id") % 9).cast("string")).alias("locus"))


CLUSTERS = """clusters as (
  select min(vec_id) over (partition by label * 10 + (vec_id // 40) % 10) as centroid, vec_id as member, 's' || (vec_id % 13) as sample, 'sp' || (vec_id % 6) as species,
    100 + vec_id * 7 % 900 as length, 'L' || (vec_id % 9) as locus from embeddings)"""


def locus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a part type and size as the statistics of a locus; small groups miss the exon columns."""
    part = table(spark, sf_dir, "part")
    own = part.groupBy(F.concat_ws("_", "p_brand", F.col("p_size").cast("string")).alias("locus")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("p_size").alias("length"), F.min("p_partkey").alias("first_key"))
    k = F.col("first_key")
    return own.withColumns({"gc": (k * 17 % 10000) / 100.0, "mean_pid": (k * 29 % 10000) / 100.0, "missingness": (k * 41 % 10000) / 100.0, "informative": k * 3 % 200, "avg_copies": 1 + (k % 30) / 10.0, "len_long_exons_retained": F.when(k % 4 != 0, F.col("length") * 2), "perc_exons_retained": F.when(k % 4 != 0, (k * 13 % 10000) / 100.0)})


LOCUS_STATS = """locus_stats as (
  select *, cast(k * 17 % 10000 as double) / 100.0 as gc, cast(k * 29 % 10000 as double) / 100.0 as mean_pid, cast(k * 41 % 10000 as double) / 100.0 as missingness,
    k * 3 % 200 as informative, 1 + cast(k % 30 as double) / 10.0 as avg_copies, case when k % 4 <> 0 then length * 2 end as len_long_exons_retained,
    case when k % 4 <> 0 then cast(k * 13 % 10000 as double) / 100.0 end as perc_exons_retained
  from (select p_brand || '_' || p_size as locus, count(*) as sequences, cast(sum(p_size) as bigint) as length, min(p_partkey) as k from part group by 1))"""
