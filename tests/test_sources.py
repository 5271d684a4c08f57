import pytest
from conftest import rows, same
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from loomvault import schemas
from loomvault.operators import observe
from loomvault.sources import copy, drift, formats, seeds
from loomvault.sources.tables import TableFolder

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("amount", DoubleType())])
NOW = "2024-01-31 00:00:00"


def write(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_delimited_rules(spark, folder):
    write(folder, "a.csv", 'id|name|amount\n1| "x|y" |2.5\n2|N/A|\n3|NULL|1|extra\n4\n')
    got = formats.read_delimited(spark, folder, SCHEMA, "|").drop("_FILE_NAME")
    assert rows(got) == [(1, "x|y", 2.5), (2, None, None), (3, None, 1.0), (4, None, None)]


def test_by_name_and_other_header(spark, folder):
    write(folder, "a.csv", "AMOUNT,ID\n2.5,1\n")
    assert rows(formats.read_delimited(spark, folder, SCHEMA, by_name=True), "id", "name", "amount") == [(1, None, 2.5)]
    write(folder, "b.csv", "ID,AMOUNT\n7,9.5\n")  # each file by its own header
    write(folder, "c.csv", '"name",other,"Id"\nn,o,8\n')
    assert rows(formats.read_delimited(spark, folder, SCHEMA, by_name=True), "id", "name", "amount") == [(1, None, 2.5), (7, None, 9.5), (8, "n", None)]


def test_json_array_over_lines(spark, folder):
    write(folder, "a.json", '[\n{"id": 1, "name": null},\n{"id": 2, "name": "b"}\n]')
    got = formats.read_json(spark, folder, StructType.fromDDL("id int, name string"), multi_line=True).drop("_FILE_NAME")
    assert rows(got) == [(1, None), (2, "b")]


def test_stage_numbers_rows_per_file(spark, folder):
    spark.range(1000).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("name"), F.lit(1.0).alias("amount")).repartition(3).write.parquet(f"{folder}/p")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        staged = formats.read_stage(spark, formats.Stage(f"{folder}/p", "parquet"), NOW)
        stats = staged.groupBy("_FILE_NAME").agg(F.min("_FILE_ROW_NUMBER"), F.max("_FILE_ROW_NUMBER"), F.count_distinct("_FILE_ROW_NUMBER"), F.count("*")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(stats) == 3 and all(r[1] == 1 and r[2] == r[3] == r[4] for r in stats)


def test_avro_needs_its_module(spark, folder):
    with pytest.raises(RuntimeError):
        formats.read_avro(spark, folder)


def test_copy_skips_a_whole_file(spark, folder):
    write(f"{folder}/in", "good.csv", "id,name,amount\n1,a,2\n2,b,3\n")
    write(f"{folder}/in", "bad.csv", "id,name,amount\n3,c,4\nx,d,5\n")
    stage, tables = formats.Stage(f"{folder}/in", "csv_comma", SCHEMA), TableFolder(spark, f"{folder}/t")
    for batch in (1, 2):
        loaded = copy.copy_to_table(spark, stage, tables, "raw", "SHOP", NOW, batch)
    assert rows(loaded, "id") == [(1,), (2,)]
    log = tables.read(copy.LOG).select("FILE_NAME", "STATUS", "ROWS_LOADED", "ERRORS_SEEN").distinct()
    assert rows(log) == [("bad.csv", "SKIPPED", 0, 1), ("good.csv", "LOADED", 2, 0)]


def test_copy_matches_names_file_by_file(spark, folder):
    write(f"{folder}/csv", "a.csv", "id,name,amount\n1,a,2\n")
    write(f"{folder}/csv", "b.csv", "AMOUNT,ID\n4,2\n")
    write(f"{folder}/csv", "odd.csv", "x,y\n5,6\n")
    got = copy.copy_into(spark, formats.Stage(f"{folder}/csv", "csv_comma", SCHEMA), "SHOP", NOW)
    assert rows(got.rows, "id", "name", "amount") == [(1, "a", 2.0), (2, None, 4.0)]
    assert rows(got.log, "FILE_NAME", "STATUS", "FILE_SIZE_BYTES") == [("a.csv", "LOADED", 21), ("b.csv", "LOADED", 14), ("odd.csv", "SKIPPED", 8)]
    write(f"{folder}/json", "a.json", '{"ID":1,"Name":"x"}\n\n[{"id":2},{"id":3,"amount":1.5}]\n[]\n')
    write(f"{folder}/json", "bad.json", '{"id":4}\n{"id":\n')
    write(f"{folder}/json", "typed.json", '{"id":"no"}\n')
    got = copy.copy_into(spark, formats.Stage(f"{folder}/json", "json", SCHEMA), "SHOP", NOW)
    assert rows(got.rows, "id", "name", "amount") == [(1, "x", None), (2, None, None), (3, None, 1.5)]
    assert rows(got.log, "FILE_NAME", "STATUS", "ERRORS_SEEN") == [("a.json", "LOADED", 0), ("bad.json", "SKIPPED", 1), ("typed.json", "SKIPPED", 1)]


def test_broken_json_lines(spark, folder):
    write(folder, "a.json", '{"id": 1}\n{"id": \n[{"id": 2}, {"id": 3}]\n')
    schema = StructType.fromDDL("id int")
    assert rows(formats.read_json(spark, folder, schema), "id") == [(1,), (2,), (3,)]
    assert rows(formats.read_json(spark, folder, schema, strict=True), "_broken", "id") == [(False, 1), (False, 2), (False, 3), (True, None)]


def test_drift_versions(spark):
    def cols(ddl):
        return drift.inferred_columns(spark.createDataFrame([], ddl))
    first = drift.detect_drift(cols("a int, b int, c int"), None, "S", "T", NOW)
    assert first.version == 1 and first.changes.count() == 3
    second = drift.detect_drift(cols("a int, b string, d int"), first.registry, "S", "T", NOW)
    assert second.version == 2 and rows(second.changes, "COLUMN_NAME", "CHANGE_TYPE") == [("b", "TYPE_CHANGE"), ("c", "REMOVE"), ("d", "ADD")]
    assert rows(second.registry.where("IS_CURRENT"), "COLUMN_NAME", "SCHEMA_VERSION") == [("a", 2), ("b", 2), ("d", 2)]
    again = drift.detect_drift(cols("a int, b string, d int"), second.registry, "S", "T", NOW)
    assert not again.drifted and again.version == 2


def test_append_is_idempotent_and_checks_schema(spark, folder):
    tables = TableFolder(spark, folder)
    df = spark.range(3)
    tables.append("t", df, 1)
    tables.append("t", df, 1)
    tables.append("t", df, 2)
    assert tables.read("t").count() == 6 and tables.read("t", before_batch=2).count() == 3 and tables.read("none") is None
    with pytest.raises(schemas.SchemaDrift):
        tables.append("t", df.withColumn("x", F.lit(1)), 3)
    assert schemas.sync_columns(df.withColumn("old", F.lit(1)), df.withColumn("new", F.lit(2))).columns == ["id", "new"]


def test_upsert_moves_keys_between_partitions(spark, folder):
    tables = TableFolder(spark, folder)
    def frame(data):
        return spark.createDataFrame(data, "k int, v string, p string")
    tables.upsert("t", frame([(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "a", "z")]), ["k"], "p")
    got = tables.upsert("t", frame([(3, "b", "x"), (5, "b", "w"), (1, "b", "x")]), ["k"], "p")
    assert rows(got, "k", "v", "p") == [(1, "b", "x"), (2, "a", "x"), (3, "b", "x"), (4, "a", "z"), (5, "b", "w")]


def test_backup_restore_cleanup(spark, folder):
    tables = TableFolder(spark, folder)
    tables.replace("t", spark.range(5))
    tables.backup("t", "2024-01-01 00:00:00")
    tables.replace("t", spark.range(2))
    with pytest.raises(LookupError):
        tables.restore("t", "2023-12-31 00:00:00", "2024-01-03 00:00:00")
    tables.restore("t", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert tables.read("t").count() == 5
    assert [label for _, label, _ in tables.backups()] == ["BACKUP", "PRE_RESTORE"]
    assert tables.cleanup_backups("2024-03-01 00:00:00") == [] and len(tables.cleanup_backups("2024-06-01 00:00:00")) == 1


def test_a_write_that_fails_half_way_leaves_the_table_as_it_was(spark, folder):
    tables = TableFolder(spark, folder)
    rows_ = spark.range(8).withColumn("p", F.col("id") % 2)
    broken = rows_.withColumn("id", F.expr("if(id = 7, raise_error('no'), id)"))
    tables.replace("t", rows_, "p")
    tables.append("b", rows_, 1)
    for fail in (lambda: tables.replace("t", broken, "p"), lambda: tables.upsert("t", broken, ["id"], "p"), lambda: tables.append("b", broken, 1)):
        with pytest.raises(Exception, match="no"):
            fail()
    same(tables.read("t"), rows_)
    same(tables.read("b"), rows_)


def test_backup_and_restore_move_no_rows_and_vacuum_keeps_what_is_named(spark, folder):
    import os
    tables = TableFolder(spark, folder)

    def files():
        return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{folder}/t") for f in names if f.endswith(".parquet"))
    rows_ = spark.range(10).withColumn("p", F.col("id") % 3)
    tables.replace("t", rows_, "p")
    tables.backup("t", "2024-01-01 00:00:00")
    tables.upsert("t", spark.createDataFrame([(1, 1), (20, 1)], "id long, p long"), ["id"], "p")
    before = files()
    tables.restore("t", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert files() == before
    same(tables.read("t"), rows_)
    assert tables.vacuum("t") == []  # the state before the restore is still named
    tables.replace("t", spark.range(2).withColumn("p", F.lit(0).cast("long")), "p")
    assert len(tables.cleanup_backups("2024-06-01 00:00:00")) == 1
    assert tables.read("t").count() == 2 and tables.read_backup("t_PRE_RESTORE_20240103_000000").count() == 11
    assert not set(before) <= set(files())


def test_a_batch_that_runs_again_begins_where_it_began(spark, folder):
    tables = TableFolder(spark, folder)
    for batch, value in ((1, 5), (2, 6), (2, 7), (3, 8)):
        tables.begin("t", batch)
        tables.upsert("t", spark.createDataFrame([(batch, value, 0)], "k int, v int, p int"), ["k"], "p")
    assert rows(tables.read("t"), "k", "v") == [(1, 5), (2, 7), (3, 8)]
    tables.begin("t", 3)
    assert rows(tables.read("t"), "k") == [(1,), (2,)]
    assert tables.vacuum("t")


def test_partitions_of_odd_names(spark, folder):
    tables = TableFolder(spark, folder)
    data = [(1, "a b/c=d%"), (2, None), (3, "2024-01")]
    tables.replace("t", spark.createDataFrame(data, "k int, p string"), "p")
    got = tables.upsert("t", spark.createDataFrame([(2, "a b/c=d%"), (4, None)], "k int, p string"), ["k"], "p")
    assert rows(got, "k", "p") == [(1, "a b/c=d%"), (2, "a b/c=d%"), (3, "2024-01"), (4, None)]


def test_types_come_from_all_rows(spark, folder):
    write(folder, "a.csv", "i,l,d,b,day,at,s,none,mix,num\n" + "\n".join("1,2,3,true,2024-01-01,2024-01-01,x,,1,1" for _ in range(3000)) + "\n")
    write(folder, "b.csv", "i,l,d,b,day,at,s,none,mix,num\n-7,9999999999, 1.5 ,FALSE,2024-02-29,2024-01-01 10:00:00,1,NULL,odd,NA\n")
    got = {r.COLUMN_NAME: r.DATA_TYPE for r in drift.infer_from_files(spark, folder).collect()}
    assert got == {"i": "int", "l": "bigint", "d": "double", "b": "boolean", "day": "date", "at": "timestamp", "s": "string", "none": "string", "mix": "string", "num": "int"}


def test_parquet_files_of_differing_schemas_and_files_without_rows(spark, folder):
    spark.createDataFrame([(1, "a", 1.0)], "id int, name string, amount double").coalesce(1).write.parquet(f"{folder}/in/1")
    spark.createDataFrame([("2", "b", 2)], "ID string, name string, amount int").coalesce(1).write.parquet(f"{folder}/in/2")
    spark.createDataFrame([("x", "c", 3), ("4", "d", 4)], "id string, name string, amount int").coalesce(1).write.parquet(f"{folder}/in/3")
    spark.createDataFrame([], "id int, name string").coalesce(1).write.parquet(f"{folder}/in/4")
    spark.createDataFrame([(1,)], "other int").coalesce(1).write.parquet(f"{folder}/in/5")
    import os
    os.makedirs(f"{folder}/in/6")
    write(f"{folder}/in/6", "part-0.parquet", "this is no parquet")
    result = copy.copy_into(spark, formats.Stage(f"{folder}/in/*", "parquet", SCHEMA), "S", NOW)
    assert rows(result.rows, "id", "name", "amount") == [(1, "a", 1.0), (2, "b", 2.0)]
    log = {r.FILE_PATH.split("/in/")[1][0]: (r.STATUS, r.ROW_COUNT, r.ERRORS_SEEN) for r in result.log.collect()}
    assert log == {"1": ("LOADED", 1, 0), "2": ("LOADED", 1, 0), "3": ("SKIPPED", 2, 1), "4": ("LOADED", 0, 0), "5": ("SKIPPED", 1, 1), "6": ("SKIPPED", 1, 1)}


def test_a_header_without_rows_is_logged(spark, folder):
    write(folder, "a.csv", "id,name,amount\n1,x,2.0\n")
    write(folder, "b.csv", "id,name,amount\n")
    result = copy.copy_into(spark, formats.Stage(folder, "csv_comma", SCHEMA), "S", NOW)
    assert sorted((r.FILE_NAME, r.STATUS, r.ROW_COUNT) for r in result.log.collect()) == [("a.csv", "LOADED", 1), ("b.csv", "LOADED", 0)]


def test_seeds(spark):
    assert {n: seeds.seed(spark, n).count() for n in seeds.SEEDS} == {"country_codes": 20, "order_status_mapping": 10, "payment_methods": 10, "product_categories": 15}
    assert all(seeds.check_seed_key(seeds.seed(spark, n), key).isEmpty() for n, (_, _, key) in seeds.SEEDS.items())
    tops = seeds.category_hierarchy(seeds.seed(spark, "product_categories"))
    assert rows(tops.where("category_name = 'Laptops' or category_name = 'Books & Media'"), "category_name", "top_category", "depth") == [
        ("Books & Media", "Books & Media", 1), ("Laptops", "Electronics", 2)]


def test_declared_schemas(spark):
    for name, schema in {**schemas.LANDING, **schemas.CONTROL}.items():
        schemas.assert_schema(spark.createDataFrame([], schema), schema)


def test_products_register_once(spark):
    once = observe.register_products(spark, None, NOW)
    same(once.select("PRODUCT_NAME"), observe.register_products(spark, once, NOW).select("PRODUCT_NAME"))
    assert once.schema.names == schemas.DATA_PRODUCT_REGISTRY.names
    assert "SLA: 12h freshness, 99.50% uptime" in [r["SLA_SUMMARY"] for r in observe.product_catalog(once).collect()]


def test_log_of_events_has_no_row_of_a_split_without_the_source(spark, folder):
    from loomvault.registry import control_queries
    fields = "event_id bigint, event_type string, value double"
    spark.createDataFrame([(k, "view", k / 7) for k in range(5000)], fields).coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(9001, "error", 1.0), (9002, "error", 2.0)], fields).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    log = control_queries.file_ingestion_log(None, spark, folder)
    found = sorted((r.SOURCE_SYSTEM, r.STATUS, r.ROW_COUNT, r.ROWS_LOADED, r.ERRORS_SEEN) for r in log.collect())
    assert found == [("EMPTY", "LOADED", 0, 0, 0), ("ERROR", "SKIPPED", 2, 0, 2), ("VIEW", "LOADED", 5000, 5000, 0)]
