"""Title-shaped documents derived from the star-schema test tables.

One document per order ``k``.  Its lines, joined to supplier (with the
supplier's nation and region) and part, become the document's arrays; the
order and its customer give the scalar fields.  Rules (see FIXTURES.md)
deliberately plant placeholders, zeros, bad dates, sparse rows,
duplicates and null ids so that every cleaning rule has work to do.

Plan shape: lines are joined to supplier and part (no hints: the planner
broadcasts a side only when its measured size is under the broadcast
threshold, and shuffles otherwise), aggregated once per order into one
list of line structs, then joined to orders and customers.  Copies are made
with one ``explode`` rather than unions, so the tables are scanned once.

A document is one row by definition, so its arrays hold all of its lines;
the per-order list is the document's own content, not a gathered group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schema import PAYLOAD_SCHEMA, RAW_SCHEMA
from marquee.sources.readers import star_table, stored_bytes


#: Bytes of the lines' files for one task that builds documents (some 30,000
#: documents), and the number of tasks up to which the planner decides.
LINE_BYTES, FEW_TASKS = 4 << 20, 16


def _by_order(lines: DataFrame, stored: int) -> DataFrame:
    """Lines dealt by their order.  Documents are several times as wide as the
    lines they come from, and are sorted where they are built (by the dedupe);
    partitions sized by the lines would spill them, so beyond a few tasks their
    number follows the size of the files."""
    tasks = -(-stored // LINE_BYTES)
    if tasks <= FEW_TASKS:
        return lines.repartition("l_orderkey")
    # not fewer than the session's, else the join to the orders deals both sides anew
    return lines.repartition(max(tasks, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "l_orderkey")


def _typed_empty(field: str, schema=RAW_SCHEMA) -> Column:
    return F.array().cast(schema[field].dataType)


def _per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = star_table(spark, sf_dir, "nation")
    region = star_table(spark, sf_dir, "region")
    supplier = (star_table(spark, sf_dir, "supplier")
                .select("s_suppkey", "s_name", "s_nationkey")
                .join(nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                    F.col("n_name").alias("s_nation"),
                                    F.col("n_regionkey").alias("s_regionkey")),
                      "s_nationkey")
                .join(region.select(F.col("r_regionkey").alias("s_regionkey"), "r_name"),
                      "s_regionkey"))
    part = star_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    lines = star_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    x = (lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
         .join(part, lines.l_partkey == part.p_partkey))
    flag = F.col("l_returnflag")
    job = (F.when(flag == "R", "Director").when(flag == "A", "Writer")
           .when(flag == "N", "Producer"))
    # One list of line structs per order (a single aggregation buffer per
    # key); every array of the document is derived from it afterwards with
    # higher-order functions, which run inside the same codegen stage.
    # A map-side partial collect_list cannot shrink the data (the list keeps
    # every line) and costs a sort in the scan task, so the lines are
    # hash-partitioned by order first; the aggregate reuses that
    # partitioning, so this adds no exchange.
    per = _by_order(x, stored_bytes(spark, sf_dir, "lineitem")).groupBy("l_orderkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("rev_cents"),
        F.sum("l_linenumber").alias("sum_line"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.collect_list(F.struct(F.col("s_name").alias("name"), job.alias("job"), "p_type",
                                "p_brand", "s_nation", "r_name")).alias("_lines"))
    lines_arr = F.col("_lines")

    def distinct_sorted(field):
        return F.array_sort(F.array_distinct(F.transform(lines_arr, lambda v: v[field])))

    return per.select(
        "l_orderkey", "rev_cents", "sum_line", "n_lines", "qty",
        distinct_sorted("p_type").alias("types"),
        distinct_sorted("r_name").alias("regions"),
        distinct_sorted("s_nation").alias("nations"),
        distinct_sorted("p_brand").alias("brands"),
        F.array_sort(F.transform(lines_arr, lambda v: F.struct(v["name"].alias("name")))).alias("cast"),
        F.array_sort(F.transform(lines_arr, lambda v: F.struct(v["job"].alias("job"),
                                                               v["name"].alias("name")))).alias("crew"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order, before duplicates and null-id copies."""
    orders = star_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = star_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = star_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("cn"))
    per_order = _per_order(spark, sf_dir)
    d = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .join(nation, "c_nationkey")
         .join(per_order, F.col("o_orderkey") == per_order.l_orderkey, "left"))

    k = F.col("o_orderkey")
    sparse = (k % 31) == 0
    has_lines = F.col("n_lines").isNotNull()
    seg = F.col("c_mktsegment")
    pri = F.col("o_orderpriority")
    st = F.col("o_orderstatus")

    def keep(c: Column) -> Column:
        return F.when(~sparse, c)

    def named(arr: str, field: str) -> Column:
        return F.transform(F.col(arr), lambda v: F.struct(v.alias(field)))

    fields = {
        "id": k,
        "title": F.when(k % 97 != 0, F.concat(F.lit("Title "), k.cast("string"))),
        "overview": keep(F.when(seg == "BUILDING", "N/A").when(seg == "HOUSEHOLD", "")
                         .otherwise(F.col("c_name"))),
        "tagline": keep(F.when(pri == "5-LOW", "No Data").when(pri == "3-MEDIUM", "no data")
                        .when(pri == "1-URGENT", "NA").otherwise(pri)),
        "status": (F.when(st == "F", "Released").when(st == "O", "Post Production")
                   .when(st == "P", "Planned")),
        "original_language": F.when(k % 2 == 0, "en").otherwise("fr"),
        "poster_path": keep(F.concat(F.lit("/"), k.cast("string"), F.lit(".jpg"))),
        "release_date": keep(F.when(k % 23 == 0, "").when(k % 29 == 0, "1999-13-01")
                             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))),
        "budget": keep(F.when(k % 11 == 0, F.lit(0).cast("bigint"))
                       .otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint"))),
        "revenue": keep(F.when(k % 13 == 0, F.lit(0).cast("bigint"))
                        .otherwise(F.col("rev_cents"))),
        "runtime": keep(F.when(k % 19 == 0, F.lit(0).cast("bigint"))
                        .otherwise(F.col("sum_line") * 10)),
        "vote_count": keep(F.when(k % 17 == 0, F.lit(0).cast("bigint"))
                           .otherwise(F.col("qty").cast("bigint"))),
        "vote_average": keep(F.col("sum_line") / F.col("n_lines")),
        "popularity": keep(F.col("c_acctbal")),
        "belongs_to_collection": keep(F.when(
            seg.isin("AUTOMOBILE", "MACHINERY"),
            F.struct(F.col("c_nationkey").cast("bigint").alias("id"),
                     F.concat(F.col("cn"), F.lit(" Collection")).alias("name")))),
        "genres": keep(F.when(has_lines, F.transform(
            F.col("types"), lambda v: F.struct(F.lit(None).cast("bigint").alias("id"),
                                               v.alias("name"))))
            .when(k % 2 == 0, _typed_empty("genres"))),
        "spoken_languages": keep(named("regions", "english_name")),
        "production_countries": keep(named("nations", "name")),
        "production_companies": keep(named("brands", "name")),
        "cast": keep(F.col("cast")),
        "crew": keep(F.col("crew")),
        "origin_country": keep(F.array(F.col("cn"))),
    }
    return d.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def raw_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents plus an identical copy for k % 10 = 0 and a null-id copy
    for k % 101 = 0 (one pass: the copies come from ``explode``)."""
    d = documents(spark, sf_dir)
    k = F.col("id")
    copies = F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)),
                      lambda c: (c == 0) | ((c == 1) & (k % 10 == 0)) | ((c == 2) & (k % 101 == 0)))
    d = d.withColumn("_copy", F.explode(copies))
    return d.select(*[F.when(F.col("_copy") != 2, k).alias("id") if c == "id" else F.col(c)
                      for c in RAW_SCHEMA.fieldNames()])


def payloads(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Landed extractor payloads: ``raw_titles`` with cast and crew moved
    under ``credits`` for k % 3 = 0 (the pre-hoist form)."""
    r = raw if raw is not None else raw_titles(spark, sf_dir)
    under = F.col("id").isNotNull() & (F.col("id") % 3 == 0)
    credits = F.when(under, F.struct(F.col("cast").alias("cast"), F.col("crew").alias("crew")))
    cols = []
    for f in PAYLOAD_SCHEMA.fields:
        if f.name == "credits":
            cols.append(credits.cast(f.dataType).alias("credits"))
        elif f.name in ("cast", "crew"):
            cols.append(F.when(~under, F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return r.select(*cols)


def arriving_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, status and ``_arrival`` of landed payloads whose copies
    differ: k % 10 = 0 has a second copy with another title (none for
    k % 30 = 0) and status, which arrives before the first for k % 20 = 0;
    k % 101 = 0 has a copy without id."""
    d = documents(spark, sf_dir).select("id", "title", "status")
    k, c = F.col("id"), F.col("_copy")
    copies = F.filter(F.array(F.lit(0), F.lit(1), F.lit(2)),
                      lambda c: (c == 0) | ((c == 1) & (k % 10 == 0)) | ((c == 2) & (k % 101 == 0)))
    d = d.withColumn("_copy", F.explode(copies))
    late = F.when(k % 20 == 0, k * 10 - 5).otherwise(k * 10 + 5)
    return d.select(
        F.when(c != 2, k).alias("id"),
        F.when(c != 1, F.col("title")).when(k % 30 != 0, F.concat("title", F.lit(" (copy)"))).alias("title"),
        F.when(c == 1, "Planned").otherwise(F.col("status")).alias("status"),
        F.when(c == 0, k * 10).when(c == 1, late).otherwise(k * 10 + 7).alias("_arrival"))


def request_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids: every order key, the k % 10 = 0 keys again, -1 and 0,
    and 50 keys above the largest that have no payload."""
    orders = star_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    twice = orders.select(F.explode(F.when(F.col("id") % 10 == 0, F.array("id", "id"))
                                    .otherwise(F.array("id"))).alias("id"))
    top = orders.agg(F.max("id").alias("m"))
    extra = top.select(F.explode(F.concat(
        F.array(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint")),
        F.sequence(F.col("m") + 1, F.col("m") + 50))).alias("id"))
    return twice.unionByName(extra)
