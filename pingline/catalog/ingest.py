"""Raw to bronze to silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from pingline import session
from pingline.catalog.registry import query
from pingline.functions.columns import par_day
from pingline.operators import phones, silver
from pingline.session import scratch_path
from pingline.sources import bronze, tables

SALT = "salt"
GLOB = "*.json.gz"  # what Spark names gzip JSON lines


def bronze_calls(spark, sf_dir):
    return bronze.bronze_calls(tables.calls(spark, sf_dir), tables.phone_dimension(spark, sf_dir), SALT)


def bronze_browses(spark, sf_dir):
    return bronze.bronze_browses(tables.browses(spark, sf_dir), tables.phone_dimension(spark, sf_dir), SALT)


def stored(spark, df, name, keys=("par_day", "par_hour")):
    path = scratch_path(spark, name)
    bronze.write_partitioned(df, path, list(keys))
    return path


def raw_folder(spark, pings, name):
    path = f"{scratch_path(spark, 'raw')}/{name}"
    bronze.write_raw(pings, path)
    return path


@query("""
    SELECT phone_out, phone_in, cell_tower, date_trunc('second', time) AS time, par_day, par_hour FROM v_cdr""")
def src_raw_jsonl(spark, sf_dir):
    path = raw_folder(spark, tables.calls(spark, sf_dir).drop("par_day", "par_hour"), "cdr")
    return bronze.good_rows(bronze.read_raw(spark, path, "cdr", GLOB))


@query("""
    SELECT stream, par_day, par_hour, count(*) AS records FROM v_deliv GROUP BY ALL""")
def src_path_partition(spark, sf_dir):
    root = scratch_path(spark, "raw")
    pings = tables.deliveries(spark, sf_dir).withColumnRenamed("ts", "time")
    for stream in ("cdr", "seq"):
        bronze.write_raw(pings.filter(F.col("stream") == stream).select("event_id", "time"), f"{root}/{stream}")
    rows = spark.read.schema("event_id bigint").option("recursiveFileLookup", "true").json(root)
    files = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("records"))
    routed = files.withColumn("r", bronze.route("path", root, bronze.SPARK_RAW_FILE)).filter(F.col("r").isNotNull())
    return routed.groupBy("r.stream", "r.par_day", "r.par_hour").agg(F.sum("records").alias("records"))


@query("""
    SELECT strftime(time, '%Y%m%d') AS par_day, strftime(time, '%H') AS par_hour, phone_number, cell_tower, host_name,
           site_name, date_trunc('second', time) AS time FROM v_seq""")
def sink_event_time_partition(spark, sf_dir):
    path = raw_folder(spark, tables.browses(spark, sf_dir).drop("par_day", "par_hour"), "seq")
    return bronze.good_rows(bronze.read_raw(spark, path, "seq", GLOB))


@query("SELECT * FROM v_bcdr")
def bronze_cdr(spark, sf_dir):
    return spark.read.parquet(stored(spark, bronze_calls(spark, sf_dir), "bronze-cdr"))


@query("SELECT * FROM v_bseq")
def bronze_seq(spark, sf_dir):
    return spark.read.parquet(stored(spark, bronze_browses(spark, sf_dir), "bronze-seq"))


@query("""
    SELECT * FROM v_bcdr WHERE par_day = (SELECT strftime(max(ts) - INTERVAL 1 DAY, '%Y%m%d') FROM events)""")
def scan_bronze_partition(spark, sf_dir):
    """The day before the newest event: the default period of a daily job."""
    newest = tables.table(spark, sf_dir, "events").select(par_day(F.max("ts") - F.expr("INTERVAL 1 DAY"))).scalar()
    return bronze.read_partition(spark, stored(spark, bronze_calls(spark, sf_dir), "bronze-cdr"), newest)


@query("""
    SELECT phone, coalesce(hash, sha256('salt' || phone)) AS hash, hash IS NULL AS is_new
    FROM (SELECT phone_out AS phone FROM v_cdr UNION SELECT phone_in FROM v_cdr) LEFT JOIN v_dim USING (phone)""")
def hash_phones(spark, sf_dir):
    found = phones.distinct_phones(tables.calls(spark, sf_dir), ["phone_out", "phone_in"])
    return phones.hash_phones(found, tables.phone_dimension(spark, sf_dir), SALT)


@query("""
    SELECT phone, sha256('salt' || phone) AS hash, (SELECT max(ts) FROM events) AS created_at
    FROM (SELECT phone_out AS phone FROM v_cdr UNION SELECT phone_in FROM v_cdr) ANTI JOIN v_dim USING (phone)""")
def hash_new_rows(spark, sf_dir):
    found = phones.distinct_phones(tables.calls(spark, sf_dir), ["phone_out", "phone_in"])
    now = tables.table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    return phones.new_rows(found, tables.phone_dimension(spark, sf_dir), SALT, now)


CDR_SQL = """
    SELECT {keys}, phone_hash_out, count(*) AS total_calls, 10.0::DOUBLE * count(*) AS total_duration_s,
           count(DISTINCT phone_hash_in) AS unique_contacts,
           string_agg(DISTINCT cell_tower, ',' ORDER BY cell_tower) AS unique_towers,
           10.0::DOUBLE AS avg_call_duration_s
    FROM v_bcdr GROUP BY {keys}, phone_hash_out"""
SEQ_SQL = """
    SELECT {keys}, phone_hash, host_name, any_value(site_name) AS site_name, count(*) AS total_pings,
           string_agg(DISTINCT cell_tower, ',' ORDER BY cell_tower) AS unique_towers,
           10.0::DOUBLE * count(*) AS total_session_duration_s
    FROM v_bseq GROUP BY {keys}, phone_hash, host_name"""


def _flat(df):
    return df.withColumn("unique_towers", F.array_join("unique_towers", ","))


@query(CDR_SQL.format(keys="par_day, par_hour"))
def cdr_agg_hour(spark, sf_dir):
    return _flat(bronze_calls(spark, sf_dir).transform(silver.aggregate_calls, silver.HOURLY))


@query(CDR_SQL.format(keys="par_day"))
def cdr_agg_day(spark, sf_dir):
    return _flat(bronze_calls(spark, sf_dir).transform(silver.aggregate_calls, silver.DAILY))


@query(CDR_SQL.format(keys="par_day"))
def cdr_agg_day_partials(spark, sf_dir):
    """The day from the hours' stored partials: bronze is read once, by the hours."""
    rows = bronze_calls(spark, sf_dir)
    numbers = session.stored(silver.number_contacts(rows), "contact-numbers")
    partials = stored(spark, silver.call_partials(rows, numbers), "silver-cdr-partials")
    return _flat(silver.calls_of_partials(spark.read.parquet(partials)))


@query(SEQ_SQL.format(keys="par_day, par_hour"))
def seq_agg_hour(spark, sf_dir):
    return _flat(bronze_browses(spark, sf_dir).transform(silver.aggregate_browsing, silver.HOURLY))


@query(SEQ_SQL.format(keys="par_day"))
def seq_agg_day(spark, sf_dir):
    return _flat(bronze_browses(spark, sf_dir).transform(silver.aggregate_browsing, silver.DAILY))


@query(CDR_SQL.format(keys="par_day, par_hour"))
def silver_roundtrip(spark, sf_dir):
    """Hourly aggregate stored by hour and read back."""
    out = bronze_calls(spark, sf_dir).transform(silver.aggregate_calls, silver.HOURLY)
    return _flat(spark.read.parquet(stored(spark, out, "silver-cdr-hour")))
