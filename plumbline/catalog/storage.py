"""Sources and sinks: what is written must read back as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.catalog.base import lineitem, query, rounded, table
from plumbline.catalog.modelling import ORDER_SPLIT, _orders_split
from plumbline.operators import models
from plumbline.operators.coerce import coerce_numeric
from plumbline.operators.models import ModelSpec
from plumbline.session import checkpoint_dir
from plumbline.sources import files, runs


FILE_BYTES = 512 << 20     # of text that one task writes


def scratch(spark) -> str:
    """A fresh folder beside the checkpoints, which every executor can reach."""
    return f"{checkpoint_dir(spark)}/plumbline-{uuid.uuid4().hex}"


@query("""SELECT c_custkey::DOUBLE AS c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS segment,
  c_acctbal FROM customer""")
def csv_round_trip(spark, folder):
    path = f"{scratch(spark)}/customer.csv.gz"
    rows = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 4 == 0, F.lit("N/A")).otherwise(F.col("c_mktsegment")).alias("segment"),
        "c_acctbal")
    files.write_table(rows, path, short_floats=False)
    return coerce_numeric(files.load_dataset(spark, path), ["c_name", "segment"])


@query("""SELECT c_custkey, (CASE WHEN c_acctbal < 0 THEN -1 ELSE 1 END) *
  round(abs(c_acctbal * 1000), (5 - floor(log10(greatest(abs(c_acctbal * 1000), 1e-9))))::INT) AS scaled FROM customer""")
def csv_six_digits(spark, folder):
    path = f"{scratch(spark)}/scaled.csv"
    files.write_table(table(spark, folder, "customer").select("c_custkey", (F.col("c_acctbal") * 1000).alias("scaled")), path)
    return files.read_table(spark, path).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), F.col("scaled").cast("double").alias("scaled"))


@query("SELECT event_id, event_type, value FROM events")
def json_round_trip(spark, folder):
    path = f"{scratch(spark)}/events.jsonl"
    files.write_table(table(spark, folder, "events").select("event_id", "event_type", "value"), path)
    return files.read_table(spark, path).select("event_id", "event_type", "value")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def json_records_round_trip(spark, folder):
    """Several part files of one record per line, under the plain suffix."""
    path = f"{scratch(spark)}/orders.json"
    files.write_table(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").repartition(4, "o_orderkey"), path)
    return files.read_table(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""SELECT doc_id AS id, text FROM documents UNION ALL SELECT page_id, html FROM pages
UNION ALL SELECT doc_id, '  "' || source || '", \\' || chr(10) || lang || ' ' FROM documents""")
def csv_text_round_trip(spark, folder):
    """Quotes, backslashes, line breaks and padding."""
    path = f"{scratch(spark)}/texts.csv"
    docs = table(spark, folder, "documents")
    odd = F.concat(F.lit('  "'), "source", F.lit('", \\\n'), "lang", F.lit(" "))
    rows = (docs.select(F.col("doc_id").alias("id"), "text").unionAll(table(spark, folder, "pages").select("page_id", "html"))
            .unionAll(docs.select("doc_id", odd)))
    files.write_table(rows, path)
    return files.read_table(spark, path, missing=()).select(F.col("id").cast("bigint").alias("id"), "text")


@query("""SELECT doc_id AS id, k.k::INT AS copy, CASE k.k WHEN 0 THEN text WHEN 1 THEN chr(10) || text || '"' ELSE '"' || source || '",' || chr(10) || text END AS text
FROM documents, (SELECT unnest(range(3)) AS k) k""")
def csv_split_round_trip(spark, folder):
    """Quoted cells with line breaks in a file of up to ``FILE_BYTES``, or as many as it takes, each read by as many tasks as it has splits."""
    path = f"{scratch(spark)}/copies.csv"
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy"),
                                                    "source", "text")
    text = (F.when(F.col("copy") == 0, F.col("text")).when(F.col("copy") == 1, F.concat(F.lit("\n"), "text", F.lit('"')))
            .otherwise(F.concat(F.lit('"'), "source", F.lit('",\n'), "text")))
    size = table(spark, folder, "documents").agg(F.sum(3 * F.octet_length("text"))).first()[0] or 0
    files.write_table(docs.select("id", "copy", text.alias("text")).coalesce(1 + size // FILE_BYTES), path)
    return files.read_table(spark, path, missing=()).select(
        F.col("id").cast("bigint").alias("id"), F.col("copy").cast("int").alias("copy"), "text")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def parquet_round_trip(spark, folder):
    path = f"{scratch(spark)}/lines.parquet"
    files.write_table(lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), path)
    return files.read_table(spark, path)


@query("""SELECT round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem""")
def versioned_report(spark, folder):
    base = scratch(spark)
    rows = lineitem(spark, folder)
    files.write_version(rows.agg(F.lit(0.0).alias("mean"), F.lit(0).cast("bigint").alias("n")), base)
    files.write_version(rows.agg(rounded(F.avg("l_quantity")).alias("mean"), F.count(F.lit(1)).alias("n")), base)
    return files.read_version(spark, base).select("mean", "n")


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM tr)
SELECT o_orderkey, round(a + b * x, 3) AS prediction FROM te, f""")
def stored_model_predictions(spark, folder):
    base = scratch(spark)
    tr, te = _orders_split(spark, folder)
    features = ["x"]
    files.write_features(spark, features, f"{base}/features")
    runs.save_model(models.fit_model(tr, ModelSpec("linear", "linear"), features, "y"), f"{base}/models", "linear")
    name, = runs.model_names(spark, f"{base}/models")
    loaded = runs.load_model(f"{base}/models", name)
    scored = models.predict(loaded, te.select("o_orderkey", *files.read_features(spark, f"{base}/features")))
    files.write_predictions(scored, f"{base}/predictions.json", ("o_orderkey",))
    return files.read_table(spark, f"{base}/predictions.json").select("o_orderkey", rounded(F.col("prediction"), 3).alias("prediction"))


@query("""SELECT 'fit' AS name, 'orders' AS source, count(*)::DOUBLE AS n, true AS nested FROM orders
UNION ALL SELECT 'sweep', NULL, NULL, false""")
def run_log(spark, folder):
    path = f"{scratch(spark)}/runs"
    parent = runs.log_run(spark, path, "sweep", tags={"phase": "training"})
    runs.log_run(spark, path, "fit", {"source": "orders"}, {"n": table(spark, folder, "orders").count()}, parent=parent)
    return runs.read_runs(spark, path).select(
        "name", F.col("params")["source"].alias("source"), F.col("metrics")["n"].alias("n"),
        F.col("parent_run_id").isNotNull().alias("nested"))
