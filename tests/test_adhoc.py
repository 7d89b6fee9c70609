import pytest

from wardline.operators.adhoc import adhoc_sql, is_read_only


@pytest.mark.parametrize("sql,ok", [
    ("SELECT 1", True),
    ("with a as (select 1 x) select * from a", True),
    ("SELECT 'drop table x' AS s", True),           # keyword inside a literal
    ("SELECT replace(name, 'a', 'b') FROM t", True),  # names that are also verbs
    ("SELECT update, call, `set` FROM t -- drop table t", True),
    ("SELECT 1;", True),
    ("(SELECT 1) UNION ALL (SELECT 2) ORDER BY 1", True),
    ("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", False),
    ("INSERT INTO t VALUES (1)", False),
    ("CREATE TABLE t AS SELECT 1", False),
    ("MERGE INTO t USING s ON t.a = s.a WHEN MATCHED THEN DELETE", False),
    ("DROP TABLE t", False),
    ("SET spark.sql.ansi.enabled = false", False),
    ("CACHE TABLE t", False),
    ("SELECT 1; DELETE FROM t", False),
    ("SELECT 1; SELECT 2", False),
    ("update t set x = 1", False),
    ("SELEC 1", False),
    ("SELECT TRANSFORM(1) USING 'echo hi'", False),
    ("SELECT * FROM (SELECT TRANSFORM(a) USING 'cat' AS (b) FROM t) x", False),
    ("WITH a AS (SELECT TRANSFORM(1) USING 'echo hi') SELECT * FROM a", False),
    ("WITH a AS (SELECT 1), b AS (WITH c AS (SELECT TRANSFORM(1) USING 'echo hi') SELECT * FROM c) SELECT * FROM b", False),
    ("SELECT (SELECT max(x) FROM (SELECT TRANSFORM(1) USING 'echo hi' AS (x)))", False),
    ("SELECT 1 WHERE EXISTS (SELECT TRANSFORM(1) USING 'echo hi')", False),
    ("SELECT 1 WHERE 1 IN (SELECT reflect('java.lang.System', 'exit', 1))", False),
    ("SELECT reflect('java.lang.Runtime', 'getRuntime')", False),
    ("SELECT upper(java_method('java.util.UUID', 'randomUUID'))", False),
    ("SELECT TRY_REFLECT('java.util.UUID', 'randomUUID')", False),
    ("SELECT `reflect`('java.util.UUID', 'randomUUID')", False),
    ("SELECT builtin.reflect('java.util.UUID', 'randomUUID')", False),
    ("SELECT IDENTIFIER('reflect')('java.util.UUID', 'randomUUID')", False),
    ("SELECT sum(x) OVER (ORDER BY reflect('java.util.UUID', 'randomUUID')) FROM t", False),
    ("SELECT transform(array(1), x -> reflect('java.util.UUID', 'randomUUID'))", False),
    ("SELECT * FROM parquet.`/etc`", False),
    ("SELECT * FROM text.`/etc/passwd`", False),
    ("SELECT (SELECT count(*) FROM csv.`/etc/passwd`)", False),
    ("SELECT * FROM IDENTIFIER('text.`/etc/passwd`')", False),
    ("SELECT * FROM a JOIN binaryFile.`/etc/passwd` ON true", False),
    ("TABLE text.`/etc/passwd`", False),
    ("SELECT some_udf(1)", False),
    ("FROM t INSERT INTO u SELECT *", False),
    ("SELECT * FROM range(reflect('java.lang.Integer', 'parseInt', '5'))", False),
    ("EXPLAIN SELECT 1", False),
    ("SELECT replace(upper(name), 'A', 'b'), coalesce(x, 1) + 2, cast(y AS date), count(DISTINCT z) FILTER (WHERE z > 1) FROM t GROUP BY ALL HAVING count(*) > 1", True),
    ("SELECT *, row_number() OVER w FROM t WINDOW w AS (PARTITION BY a ORDER BY b DESC) ORDER BY 1 LIMIT 5 OFFSET 2", True),
    ("SELECT id, x FROM range(5) LATERAL VIEW explode(array(1, 2)) e AS x", True),
    ("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS v(k, s) WHERE k IN (SELECT id FROM range(3)) AND s LIKE 'a%'", True),
    ("SELECT transform(array(1, 2), x -> x + 1), CASE WHEN a THEN b END, date '2020-01-01' + INTERVAL 1 DAY, a.b[0], current_date() FROM t TABLESAMPLE (10 PERCENT)", True),
    ("SELECT * FROM (SELECT a, b FROM t) PIVOT (sum(b) FOR a IN (1, 2)) UNION SELECT 1, 2 EXCEPT SELECT 3, 4", True),
    ("SELECT a, grouping_id() FROM t GROUP BY GROUPING SETS ((a), ())", True),
    ("SELECT /*+ BROADCAST(t) */ t.a FROM t JOIN LATERAL (SELECT t.a + 1 AS c) ON true", True),
    ("", False),
])
def test_guard(spark, sql, ok):
    assert is_read_only(spark, sql)[0] is ok


def test_adhoc_caps_and_errors(spark):
    spark.range(500).createOrReplaceTempView("nums")
    assert adhoc_sql(spark, "SELECT id FROM nums").count() == 100
    err = adhoc_sql(spark, "DROP VIEW nums").first()
    assert "error" in err.asDict()
    err2 = adhoc_sql(spark, "SELECT nope FROM nums").first()
    assert "error" in err2.asDict()


def test_tables_of_the_catalog_by_their_whole_name(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE guarded LOCATION '{tmp_dir}/guarded'")
    spark.range(3).write.saveAsTable("guarded.ids")
    assert adhoc_sql(spark, "SELECT count(*) AS n FROM guarded.ids i WHERE EXISTS (SELECT 1 FROM spark_catalog.guarded.ids)").first()[0] == '{"n":3}'
    assert not is_read_only(spark, "SELECT * FROM guarded.others")[0]


def test_catalog_listing(spark):
    from wardline.operators.adhoc import describe_table, list_tables
    spark.range(3).withColumnRenamed("id", "encounter_id").createOrReplaceTempView("stays_view")
    names = [r.tableName for r in list_tables(spark).collect()]
    assert "stays_view" in names
    cols = [r.col_name for r in describe_table(spark, "stays_view").collect()]
    assert cols == ["encounter_id"]
