"""Read-only ad-hoc SQL over the registered views, and catalog listing.

The guard runs before ``spark.sql``: Spark executes commands (DDL/DML) eagerly
when the statement is analysed, so a read-only check after the fact would be too
late.  The statement is only parsed, and every part of its plan must be on a list of
what reads tables and computes: plan nodes, table functions, functions (Spark's own,
but for those that call Java methods), wherever they stand, also in subqueries and
common table expressions.  Tables are those of the catalog; files are not read by
path.  Names and literals never count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_CAP = 100
# Plan nodes that read and compute only.
_NODES = {
    "Project", "Filter", "Aggregate", "Join", "LateralJoin", "AsOfJoin", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Distinct",
    "Deduplicate", "Union", "Intersect", "Except", "SubqueryAlias", "UnresolvedWith", "WithWindowDefinition", "Generate", "OneRowRelation",
    "UnresolvedInlineTable", "LocalRelation", "UnresolvedHaving", "Pivot", "Unpivot", "Sample", "UnresolvedSubqueryColumnAliases", "Window",
    "RepartitionByExpression", "RebalancePartitions", "UnresolvedHint", "ResolvedInlineTable", "Range",
}
_TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "json_tuple", "stack"}
# What the parser leaves unresolved in expressions; a name made at run time is not among it.
_UNRESOLVED = {
    "UnresolvedAttribute", "UnresolvedStar", "UnresolvedFunction", "UnresolvedAlias", "UnresolvedOrdinal", "UnresolvedExtractValue",
    "UnresolvedRegex", "UnresolvedInlineTable", "UnresolvedStarExceptOrReplace", "MultiAlias", "UnresolvedStarWithColumns",
}
# Functions of Spark's own that reach out of the query.
_OUTSIDE = {"reflect", "java_method", "try_reflect", "input_file_name", "input_file_block_start", "input_file_block_length"}


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _words(seq) -> list[str]:
    return [str(x) for x in _each(seq)]


class _Guard:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        jvm = spark._jvm.org.apache.spark.sql.catalyst
        self.builtin, self.name = jvm.analysis.FunctionRegistry.builtin(), jvm.FunctionIdentifier

    def relation(self, parts: list[str]) -> str | None:
        # a name of one part is a view, a table or nothing; of several it might be a path
        name = ".".join("`" + p.replace("`", "``") + "`" for p in parts)
        if len(parts) > 1 and not self.spark.catalog.tableExists(name):
            return f"there is no table {'.'.join(parts)}"
        return None

    def function(self, parts: list[str]) -> str | None:
        name = parts[-1].lower()
        own = len(parts) == 1 or [p.lower() for p in parts[:-1]] in (["builtin"], ["system", "builtin"])
        if name in _OUTSIDE or not own or not self.builtin.functionExists(self.name(name)):
            return f"the function {'.'.join(parts)} is not allowed"
        return None

    def expressions(self, todo: list) -> str | None:
        while todo:
            e = todo.pop()
            kind, where = e.getClass().getSimpleName(), e.getClass().getPackageName()
            if kind == "UnresolvedFunction":
                why = self.function(_words(e.nameParts()))
                if why:
                    return why
            elif kind == "UnresolvedGenerator":
                if str(e.name().unquotedString()).lower() not in _TABLE_FUNCTIONS:
                    return f"the table function {e.name().unquotedString()} is not allowed"
            elif kind == "CallMethodViaReflection" or (where.endswith(".analysis") and kind not in _UNRESOLVED):
                return f"{kind} is not allowed"
            todo += _each(e.children())
        return None

    def plan(self, root) -> str | None:
        todo = [root]
        while todo:
            node = todo.pop()
            kind = node.getClass().getSimpleName().removesuffix("$")
            why = None
            if kind == "UnresolvedRelation":
                why = self.relation(_words(node.multipartIdentifier()))
            elif kind == "UnresolvedTableValuedFunction":
                name = _words(node.name())
                why = None if len(name) == 1 and name[0].lower() in _TABLE_FUNCTIONS else f"the table function {'.'.join(name)} is not allowed"
                why = why or self.expressions(_each(node.functionArgs()))
            elif kind not in _NODES:
                why = f"only queries are allowed, not {kind}"
            why = why or self.expressions(_each(node.expressions()))
            if why:
                return why
            inner = [x for x in _each(node.innerChildren()) if hasattr(x, "subqueries")]
            todo += _each(node.children()) + inner + _each(node.subqueries())
        return None


def is_read_only(spark: SparkSession, sql: str) -> tuple[bool, str]:
    """Whether ``sql`` is one query, and why not (the parser's whole message if it
    can't be parsed)."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
        why = _Guard(spark).plan(plan)
    except Exception as e:  # noqa: BLE001 - errors are data for the caller
        return False, str(e)
    return why is None, why or ""


def adhoc_sql(spark: SparkSession, sql: str, limit: int = RESULT_CAP) -> DataFrame:
    """Run a read-only query; rows come back as JSON text (values that have
    no JSON type are written as strings), at most ``limit`` rows.  A refused
    or failing query comes back as a one-row ``error`` result."""
    ok, why = is_read_only(spark, sql)
    if not ok:
        return spark.createDataFrame([(why,)], "error string")
    try:
        df = spark.sql(sql)
    except Exception as e:  # noqa: BLE001 - errors are data for the caller
        return spark.createDataFrame([(str(e),)], "error string")
    return df.limit(limit).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row_json"))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a schema, ordered by schema and name."""
    q = f"SHOW TABLES IN {database}" if database else "SHOW TABLES"
    return spark.sql(q).orderBy("namespace", "tableName")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a table in ordinal order (name, type, comment)."""
    return spark.sql(f"DESCRIBE TABLE {name}").where(~F.col("col_name").startswith("#"))
