"""Query texts, checked on the plan that the parser makes of them and not on their characters.

The grammar for queries has no statement that writes. The plan is walked before
anything is resolved, so nothing is looked up or run by the check: every node must be of a listed
kind, every relation a temporary view or a common table expression in scope, every function a
listed one under its plain name. What is not listed is refused, so new syntax is too.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Parts of a query that read nothing but their children.
NODES = frozenset((
    "Aggregate", "Distinct", "Except", "Filter", "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit",
    "LocalRelation", "Offset", "OneRowRelation", "Pivot", "Project", "Sort", "SubqueryAlias", "Union", "UnresolvedHaving",
    "UnresolvedInlineTable", "UnresolvedSubqueryColumnAliases", "Unpivot", "WithWindowDefinition",
))
FUNCTIONS = frozenset((
    "abs", "add_months", "any", "approx_count_distinct", "array", "array_contains", "array_join", "array_size", "avg", "between", "bool_and",
    "bool_or", "cast", "ceil", "char_length", "coalesce", "concat", "concat_ws", "contains", "corr", "count", "count_if",
    "covar_pop", "covar_samp", "cume_dist", "current_date", "current_timestamp", "date", "date_add", "date_diff", "date_format", "date_sub",
    "date_trunc", "datediff", "day", "dayofmonth", "dayofweek", "dayofyear", "dense_rank", "div", "double", "element_at", "endswith",
    "every", "exp", "explode", "extract", "first", "first_value", "float", "floor", "format_number", "from_unixtime", "greatest",
    "grouping", "hour", "if", "ifnull", "initcap", "instr", "int", "isnan", "isnotnull", "isnull", "lag", "last", "last_day",
    "last_value", "lead", "least", "left", "length", "ln", "locate", "log", "log10", "lower", "lpad", "ltrim", "make_date", "max",
    "max_by", "md5", "mean", "median", "min", "min_by", "minute", "mod", "mode", "month", "months_between", "nth_value", "ntile", "nullif",
    "nvl", "nvl2", "percent_rank", "percentile", "percentile_approx", "pmod", "position", "pow", "power", "quarter", "rank",
    "regexp_extract", "regexp_replace", "repeat", "replace", "reverse", "right", "round", "row_number", "rpad", "rtrim",
    "second", "sha2", "sign", "size", "some", "split", "sqrt", "startswith", "stddev", "stddev_pop", "stddev_samp", "string", "struct",
    "substr", "substring", "sum", "timestamp", "to_date", "to_timestamp", "translate", "trim", "trunc", "try_cast",
    "try_divide", "try_to_date", "typeof", "upper", "var_pop", "var_samp", "variance", "weekday", "weekofyear", "when", "year",
))


class Refused(ValueError):
    """A query text that uses what is not listed."""

    def __init__(self, what: str):
        super().__init__(f"not allowed in a query text: {what}")


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _each(items) -> Iterator:
    """The members of a Scala sequence."""
    for at in range(items.size()):
        yield items.apply(at)


def _check_expression(expression) -> None:
    kind = _kind(expression)
    if kind == "UnresolvedFunction":
        name = list(_each(expression.nameParts()))
        if len(name) != 1 or name[0].lower() not in FUNCTIONS:
            raise Refused(".".join(name))
    elif kind.endswith("UnresolvedIdentifier") or kind == "UnresolvedGenerator" or "Reflection" in kind:
        raise Refused(kind)
    for child in _each(expression.children()):
        _check_expression(child)


def _check_plan(plan, views: frozenset[str]) -> None:
    kind = _kind(plan)
    if kind == "UnresolvedWith":
        for relation in _each(plan.cteRelations()):
            # A common table expression sees those before it.
            _check_plan(relation._2(), views)
            views |= {relation._1().lower()}
    elif kind == "UnresolvedRelation":
        name = list(_each(plan.multipartIdentifier()))
        if len(name) != 1 or name[0].lower() not in views or plan.isStreaming():
            raise Refused(".".join(name))
    elif kind not in NODES:
        raise Refused(kind)
    for expression in _each(plan.expressions()):
        _check_expression(expression)
    for inner in _each(plan.subqueries()):
        _check_plan(inner, views)
    for child in _each(plan.children()):
        _check_plan(child, views)


def run_query_text(spark: SparkSession, text: str) -> DataFrame:
    """The query over the temporary views of the session; `Refused` if it uses anything else.

    What is parsed, checked and run is one and the same text, the query in parentheses.
    """
    query = "SELECT * FROM (\n" + text.strip().rstrip(";") + "\n)"
    views = frozenset(t.name.lower() for t in spark.catalog.listTables() if t.isTemporary and not t.namespace)
    _check_plan(spark._jsparkSession.sessionState().sqlParser().parseQuery(query), views)
    return spark.sql(query)
