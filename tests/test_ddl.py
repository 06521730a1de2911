"""DDL text: clauses, definitions, and evolution."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, mismatch
from tidelog.operators import ddl, evolve, layout
from tidelog.plans import ddl_events
from tidelog.plans.registry import ORACLES
from tidelog.sources import catalog


def ops(spark, *statements):
    df = spark.createDataFrame(list(enumerate(statements)), "n int, ddl string")
    out = ddl.alter_operations(df).orderBy("n", "ordinal").collect()
    return [(r.operation, r.column_name, r.new_name) for r in out]


def columns(spark, statement):
    df = spark.createDataFrame([(statement,)], "ddl string")
    out = ddl.with_definition(ddl.alter_operations(df)).orderBy("ordinal").collect()
    return [(r.column_name, r.target_type, r.default_value, r.comment) for r in out]


def test_clauses_split_on_top_level_commas(spark):
    assert ops(
        spark, "ALTER TABLE `t` ADD COLUMN `a` DECIMAL(10,2) DEFAULT '1,2' COMMENT 'a, (b', DROP b,"
        " MODIFY c ENUM('x','y(z'), CHANGE COLUMN d e INT"
    ) == [("ADD", "a", None), ("DROP", "b", None), ("MODIFY", "c", None), ("CHANGE", "d", "e")]


def test_what_is_not_a_column_is_skipped(spark):
    assert ops(
        spark,
        "ALTER TABLE t ADD INDEX i (a)", "ALTER TABLE t ADD UNIQUE KEY u (a), ADD x INT", "ALTER TABLE t DROP PRIMARY KEY",
        "alter table t drop foreign key fk", "ALTER TABLE t RENAME TO t2", "ALTER TABLE t RENAME INDEX a TO b",
        "ALTER TABLE t ENGINE=InnoDB", "DROP TABLE t", "CREATE TABLE t (a INT)", "not ddl",
    ) == [("ADD", "x", None)]


def test_a_column_may_be_called_like_a_keyword(spark):
    assert ops(spark, "ALTER TABLE t ADD COLUMN `key` INT, DROP COLUMN `index`") == [
        ("ADD", "key", None), ("DROP", "index", None)]


def test_added_column_list(spark):
    assert columns(spark, "ALTER TABLE t ADD COLUMN (a DECIMAL(10,2) DEFAULT '0', `b` VARCHAR(20) COMMENT 'x, y')") == [
        ("a", "DECIMAL(10, 2)", "0", None), ("b", "VARCHAR(20)", None, "x, y")]


def test_line_breaks_and_case(spark):
    assert ops(spark, "alter table\n  db.t\n  add column\n a int,\n  rename column b to c") == [
        ("ADD", "a", None), ("RENAME", "b", "c")]


def test_definitions(spark):
    assert columns(
        spark,
        "ALTER TABLE t ADD a int(10) unsigned zerofill NOT NULL DEFAULT '5' COMMENT \"it's\", ADD b DOUBLE PRECISION DEFAULT NULL,"
        " ADD c DATETIME(3) DEFAULT CURRENT_TIMESTAMP(3) ON UPDATE CURRENT_TIMESTAMP(3), ADD d VARCHAR(9) DEFAULT COMMENT 'z',"
        " ADD e BIGINT DEFAULT -1 AFTER d, ADD f GEOMETRY, ADD `g` ENUM('a)', 'b,') DEFAULT 'a)'",
    ) == [
        ("a", "INTEGER", "5", "it's"), ("b", "DOUBLE", None, None), ("c", "TIMESTAMP(3)", "CURRENT_TIMESTAMP", None),
        ("d", "VARCHAR(9)", None, "z"), ("e", "BIGINT", "-1", None), ("f", None, None, None),
        ("g", "VARCHAR", "a)", None),
    ]


def test_time_defaults_need_a_time_target(values):
    rows = [("DATETIME", "now()"), ("DATETIMEV2(3)", "SysDate"), ("TIMESTAMP(3)", "NOW()"), ("DATETIME", "x"), ("DATETIME", None)]
    assert values("t string, d string", rows, ddl.default_value(F.col("t"), F.col("d"))) == [
        "CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP", "x", None]


def test_create_table(spark):
    text = """CREATE TABLE IF NOT EXISTS `db`.`t` (
        `id` BIGINT NOT NULL AUTO_INCREMENT, code VARCHAR(20) DEFAULT 'a, b' COMMENT 'the (code)', price DECIMAL(10,2),
        Mail TEXT, flag BIT PRIMARY KEY,
        PRIMARY KEY (`id`), UNIQUE KEY `u` (`CODE`, `id`), KEY k (price), CONSTRAINT fk FOREIGN KEY (code) REFERENCES x (y)
      ) ENGINE=InnoDB DEFAULT CHARSET=utf8 COMMENT='it (is)'"""
    df = spark.createDataFrame([(text,), ("ALTER TABLE t ADD a INT",)], "ddl string")
    got = ddl.create_columns(df).orderBy("ordinal").collect()
    assert [(r.column_name, r.target_type, r.is_key) for r in got] == [
        ("id", "BIGINT", True), ("code", "VARCHAR(20)", True), ("price", "DECIMAL(10, 2)", False), ("Mail", "VARCHAR", False),
        ("flag", "BOOLEAN", True)]
    assert got[1].default_value == "a, b" and got[1].comment == "the (code)"
    assert {r.table_comment for r in got} == {"it (is)"}


def test_event_kind(values):
    rows = [("ALTER", "x"), ("CREATE", "x"), (None, " truncate table t"), (None, "DROP TABLE t"), (None, None), ("DROP", "x")]
    assert values("t string, d string", rows, ddl.event_kind(F.col("t"), F.col("d"))) == [
        "ALTER", "CREATE", "TRUNCATE", "SKIPPED", "SKIPPED", "SKIPPED"]


def test_first_operation_and_renames(spark):
    df = spark.createDataFrame([
        ("ALTER TABLE t ADD COLUMN a varchar(10) NULL, ADD z INT",), ("alter table t drop b",), ("ALTER TABLE `t` CHANGE column `a` `b` int",),
        ("ALTER TABLE t RENAME COLUMN x TO y",), ("ALTER TABLE t ADD INDEX i (a)",),
    ], "ddl string")
    got = sorted(tuple(r)[1:] for r in ddl.first_operation(df).collect())
    assert got == [("ADD", "a", "varchar(10)"), ("DROP", "b", None)]
    assert sorted(tuple(r)[1:] for r in ddl.renamed(df).collect()) == [("a", "b"), ("x", "y")]


def test_comments_conditions_and_nesting(spark):
    assert columns(
        spark, "/* note, ( */ -- more\n ALTER TABLE `d`.`t` ADD COLUMN IF NOT EXISTS a INT /* in, */ DEFAULT 1,"
        " ADD b VARCHAR(10) DEFAULT (concat(lower(left('ab',1)),'x')) COMMENT 'c', ADD c BIT(1) DEFAULT b'0', # end\n ADD `d e` TIMESTAMP(3) DEFAULT now(3)"
    ) == [("a", "INTEGER", "1", None), ("b", "VARCHAR(10)", "(concat(lower(left('ab',1)),'x'))", "c"), ("c", "BOOLEAN", "0", None),
          ("d e", "TIMESTAMP(3)", "CURRENT_TIMESTAMP", None)]


def test_texts_of_any_size(spark):
    many = ", ".join(f"`c{i}` DECIMAL(10,{i % 9}) DEFAULT '{i}' COMMENT 'no, ({i}'" for i in range(1000))
    df = spark.createDataFrame([(f"CREATE TABLE t ({many}, PRIMARY KEY (`c7`))",)], "ddl string")
    got = ddl.create_columns(df).orderBy("ordinal").collect()
    assert len(got) == 1000 and [r.column_name for r in got if r.is_key] == ["c7"]
    assert (got[999].target_type, got[999].default_value, got[999].comment) == ("DECIMAL(10, 0)", "999", "no, (999")
    long_enum = ",".join(f"'v{i},('" for i in range(4000))
    assert columns(spark, f"ALTER TABLE t ADD e ENUM({long_enum}) COMMENT '{'x' * 60000}', ADD f INT") == [
        ("e", "VARCHAR", None, "x" * 60000), ("f", "INTEGER", None, None)]
    deep = "(" * 3000 + "1" + ")" * 3000
    assert columns(spark, f"ALTER TABLE t ADD e INT DEFAULT {deep}, ADD f INT")[0][2] == deep


def step(version, operation, name, **more):
    return {"version": version, "operation": operation, "column_name": name, **more}


def test_trace_follows_names():
    base = {"id": "bigint", "a": "string"}
    cols = evolve.trace(base, [
        step(1, "ADD", "a", spark_type="int"),  # there already: no effect
        step(2, "CHANGE", "a", new_name="b"), step(3, "ADD", "a", spark_type="int", default_value="7"),
        step(4, "RENAME", "a", new_name="c"), step(5, "MODIFY", "b", spark_type="binary"), step(6, "DROP", "gone"),
        step(7, "MODIFY", "gone", spark_type="int"), step(8, "RENAME", "gone", new_name="x"),
    ])
    assert [(c.name, c.type, c.since, c.default, c.names) for c in cols] == [
        ("id", "bigint", 0, None, [(0, "id")]), ("b", "binary", 0, None, [(0, "a"), (2, "b")]),
        ("c", "int", 3, "7", [(3, "a"), (4, "c")])]
    dropped = evolve.trace(base, [step(1, "DROP", "a"), step(2, "ADD", "a", spark_type="int")])
    assert [(c.name, c.since) for c in dropped] == [("id", 0), ("a", 2)]


def test_operations_on_stored_rows(spark):
    df = spark.createDataFrame([(1, "5", "x")], "id int, a string, b string")
    out = evolve.apply_operations(df, [
        step(1, "ADD", "n", spark_type="decimal(5,2)", default_value="1.5"), step(1, "ADD", "id", spark_type="string"),
        step(2, "DROP", "b"), step(2, "DROP", "b"), step(3, "CHANGE", "a", new_name="c"), step(4, "MODIFY", "c", spark_type="bigint"),
    ])
    assert out.schema.simpleString() == "struct<id:int,c:bigint,n:decimal(5,2)>"
    assert str(out.first()) == "Row(id=1, c=5, n=Decimal('1.50'))"


def test_bucket_and_partition_rules(values):
    rules = layout.parse_buckets("a.*:3, abc:5,.*:9")
    assert values("x string", ["abc", "ab", "b"], layout.bucket_count(F.col("x"), rules)) == [5, 3, 9]
    assert values("x string", ["b"], layout.bucket_count(F.col("x"), rules[:2])) == [None]
    assert layout.parse_partitions("t:dt:month, u:d:day") == {"t": ("dt", "month"), "u": ("d", "day")}


def test_catalog_round_trip(spark):
    catalog.create_database(spark, "cat_db")
    catalog.create_database(spark, "cat_db")
    with pytest.raises(Exception):
        catalog.create_database(spark, "cat_db", if_not_exists=False)
    spark.sql("CREATE TABLE cat_db.t (id BIGINT, v STRING) USING parquet TBLPROPERTIES ('primary_key'='id')")
    assert "cat_db" in catalog.list_databases(spark)
    assert catalog.list_tables(spark, "cat_db") == ["t"]
    assert catalog.table_exists(spark, "cat_db.t") and not catalog.table_exists(spark, "cat_db.u")
    assert catalog.column_types(spark, "cat_db.t") == {"id": "bigint", "v": "string"}
    meta = catalog.catalog_metadata(spark, "cat_db")
    assert [tuple(r) for r in catalog.discover_tables(meta, "cat_.*").collect()] == [
        ("cat_db", "t", 2, "id BIGINT,v STRING", "id")]
    with pytest.raises(Exception):
        catalog.drop_database(spark, "cat_db")
    catalog.drop_database(spark, "cat_db", cascade=True)
    catalog.drop_database(spark, "cat_db")
    assert "cat_db" not in catalog.list_databases(spark)


def test_a_hundred_thousand_columns(spark):
    """Reading takes time in proportion to the statement."""
    items = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99_999)), lambda i: F.concat(
        F.lit("`c"), i.cast("string"), F.lit("` ENUM('x,(','y') DEFAULT (lower(left('(',1))) COMMENT 'a,('"))), ", ")
    df = spark.range(1).select(F.concat(F.lit("CREATE TABLE t ("), items, F.lit(", PRIMARY KEY (c7))")).alias("ddl"))
    got = ddl.create_columns(df).agg(
        F.count(F.lit(1)).alias("n"), F.max("ordinal").alias("last"), F.count_if("is_key").alias("keys"),
        F.count_if(F.col("comment") == "a,(").alias("told")).first()
    assert tuple(got) == (100_000, 99_999, 1, 100_000)
    adds = df.select(F.regexp_replace("ddl", r"^CREATE TABLE t \(|, PRIMARY KEY \(c7\)\)$", "").alias("ddl"))
    adds = adds.select(F.concat(F.lit("ALTER TABLE t ADD ("), "ddl", F.lit(")")).alias("ddl"))
    assert ddl.alter_operations(adds).count() == 100_000


def test_odd_brackets(spark):
    deep = "(" * 30 + "1, 2" + ")" * 30
    assert ops(spark, f"ALTER TABLE t ADD a INT DEFAULT {deep}, DROP b", "ALTER TABLE t ADD a INT DEFAULT (1, DROP b",
               "ALTER TABLE t ADD a) INT, DROP b", "ALTER TABLE t ADD a INT COMMENT 'it, DROP b") == [
        ("ADD", "a", None), ("DROP", "b", None), ("ADD", "a", None), ("ADD", "a)", None), ("DROP", "b", None),
        ("ADD", "a", None), ("DROP", "b", None)]


def test_one_statement_on_many_shards_is_dealt_out(spark):
    df = spark.range(20_000).select("id", F.lit("ALTER TABLE t ADD a INT").alias("ddl"))
    dealt = ddl._statements(df, "ddl", "alter").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) > 1 and sum(r["count"] for r in dealt) == 20_000


def test_comments_are_taken_out_of_a_statement_once(spark):
    found = ddl.create_columns(spark.createDataFrame([("CREATE TABLE t (a INT /* x */ COMMENT 'c', b INT)",)], "ddl string"))
    plan = found.select("column_name", "comment")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(ddl.TO_COMMENT) == 1
    assert [tuple(r) for r in found.orderBy("ordinal").select("column_name", "comment").collect()] == [("a", "c"), ("b", None)]


def test_wide_statements_grow_with_the_table(spark, tmp_path):
    rows = [(7 * k, 50 * (k % 40) + 3, f"{k % 5}-P") for k in range(2_500)] + [(1, 4, "1-P"), (9, None, "1-P")]
    names = ("o_orderkey", "o_custkey", "o_orderpriority")
    pq.write_table(pa.table(dict(zip(names, map(list, zip(*rows))))), tmp_path / "orders.parquet")
    got = ddl_events.ddl_wide_create(spark, str(tmp_path)).collect()
    assert {t: sum(r["table_no"] == t for r in got) for t in (3, 4, None)} == {3: 5_000, 4: 2, None: 2}
    wide = sorted((r for r in got if r["table_no"] == 3), key=lambda r: r["ordinal"])
    assert [(r["ordinal"], r["column_name"]) for r in wide] == [(i, f"{'cd'[i % 2]}{7 * (i // 2)}") for i in range(5_000)]
    assert {r["comment"] for r in wide} == {None, *(f"a,({k}-P" for k in range(5))}
    assert mismatch(ddl_events.ddl_wide_create(spark, str(tmp_path)), ORACLES["ddl_wide_create"], connect(str(tmp_path))) is None


def test_definitions_of_one_wide_statement_are_dealt_out(spark):
    text = f"CREATE TABLE t ({', '.join(f'c{i} INT' for i in range(1_000))})"
    df = spark.createDataFrame([(1, text)], "id int, ddl string")
    found = ddl.create_columns(df, spread=True).drop("ddl")
    dealt = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) > 1 and sum(r["count"] for r in dealt) == 1_000
    plain = ddl.create_columns(df).drop("ddl").select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
