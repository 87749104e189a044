"""Which SQL may run for readers: an allow-list of plan nodes, expressions and functions, looked up in the parsed and in the analysed plan.

The parsed plan is checked before anything is resolved, so nothing of a refused statement runs: names that are computed (``identifier(...)``), compound
bodies, commands and table options aren't on the list. The analysed plan is checked again, with names bound to what would really run: a function that someone
registered under the name of a known one is no listed class. What a view of the catalog does inside is its owner's matter. A class that isn't
listed is refused, whatever a later version of Spark adds.
"""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

#: Plan nodes.
PARSED = set("""
Aggregate Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin LimitAll LocalLimit LocalRelation Offset OneRowRelation Pivot Project RepartitionByExpression
ResolvedInlineTable Sample Sort SubqueryAlias Union Unpivot UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases
UnresolvedTableValuedFunction UnresolvedWith WithWindowDefinition
""".split())
ANALYSED = set("""
Aggregate CTERelationDef CTERelationRef Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation
Project Range RepartitionByExpression ResolvedInlineTable Sample Sort SubqueryAlias Union View Window WithCTE
""".split())
#: What a table of the catalog turns into; each must belong to one.
TABLES = {"LogicalRelation", "HiveTableRelation", "DataSourceV2Relation", "DataSourceV2ScanRelation"}
#: Expressions that syntax gives, without the name of a function, and those of functions that Spark's registry names by a builder.
SYNTAX = set("""
Add Alias And AttributeReference Between BitwiseAnd BitwiseNot BitwiseOr BitwiseXor CaseWhen Cast Coalesce Collate CommonExpressionDef CommonExpressionRef Concat
CreateArray CreateMap CreateNamedStruct CurrentRow$ Divide EqualNullSafe EqualTo Exists Extract ExtractANSIIntervalDays GetArrayItem GetArrayStructFields GetMapValue GetStructField
GreaterThan GreaterThanOrEqual GroupingID GroupingSets Cube Rollup ILike In InSubquery IntegralDivide IsNaN IsNotNull IsNull LambdaFunction LateralSubquery LessThan LessThanOrEqual Like LikeAll LikeAny
ListQuery Literal Multiply NamedLambdaVariable Not NotLikeAll NotLikeAny Or OuterReference RLike Remainder ResolvedCollation ScalarSubquery ShiftLeft ShiftRight ShiftRightUnsigned SortOrder
SpecifiedWindowFrame StringLocate StringTrim StringTrimLeft StringTrimRight Substring Subtract TypedNullLiteral UnaryMinus UnaryPositive UnboundedFollowing$ UnboundedPreceding$ UnspecifiedFrame$
UnresolvedAlias UnresolvedAttribute UnresolvedCollation UnresolvedExtractValue UnresolvedFunction UnresolvedGenerator UnresolvedNamedLambdaVariable UnresolvedOrdinal UnresolvedStar
UnresolvedStarExceptOrReplace UnresolvedStarWithColumns UnresolvedWindowExpression With WindowExpression WindowSpecDefinition AggregateExpression First Last PivotFirst
DateAdd DateSub DateAddInterval DatetimeSub TimestampAdd TimestampAddInterval TimestampAddYMInterval DateAddYMInterval SubtractDates SubtractTimestamps MakeDTInterval MakeYMInterval MultiplyDTInterval MultiplyYMInterval
Ceil Contains EndsWith EulerNumber Explode Floor GeneratorOuter Hour Inline Minute Mode PercentileCont PercentileDisc PosExplode RoundCeil RoundFloor Second SecondWithFraction StartsWith StringLPad StringRPad
""".split())
#: Functions by name: what they run comes from Spark's own registry.
FUNCTIONS = set("""
abs ceil ceiling exp floor greatest least ln log log10 log2 mod negative pi pmod pow power round bround sign signum sqrt cbrt sin cos tan degrees radians try_add try_subtract try_multiply try_divide try_mod width_bucket div
ascii btrim char char_length character_length chr concat concat_ws contains endswith format_number initcap instr lcase left length levenshtein like ilike locate lower lpad ltrim octet_length overlay position regexp regexp_count
regexp_extract regexp_extract_all regexp_instr regexp_like regexp_replace regexp_substr repeat replace reverse right rlike rpad rtrim soundex space split split_part startswith string substr substring substring_index translate trim ucase upper
add_months current_date current_timestamp date date_add date_diff date_format date_part date_sub date_trunc datediff day decode dayofmonth dayofweek dayofyear extract from_unixtime hour last_day make_date minute month months_between next_day now
quarter second timestamp to_date to_timestamp trunc try_to_date try_to_timestamp unix_timestamp weekday weekofyear window year
any any_value approx_count_distinct approx_percentile array_agg avg bool_and bool_or collect_list collect_set corr count count_if covar_pop covar_samp every first first_value last last_value listagg max max_by mean median min min_by mode
percentile percentile_approx percentile_cont percentile_disc some std stddev stddev_pop stddev_samp string_agg sum try_avg try_sum var_pop var_samp variance grouping grouping_id
cume_dist dense_rank lag lead nth_value ntile percent_rank rank row_number
array array_contains array_distinct array_join array_max array_min array_position array_sort cardinality element_at exists explode explode_outer filter flatten forall inline map map_keys map_values named_struct posexplode sequence size slice sort_array struct transform aggregate try_element_at zip_with
bigint between boolean coalesce decimal double float if ifnull int isnan isnotnull isnull nanvl nullif nvl nvl2 typeof when zeroifnull nullifzero crc32 md5 sha2 xxhash64 hex unhex base64 get_json_object from_json to_json json_array_length rand stack range values
""".split())


class NotAllowed(ValueError):
    pass


def _each(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _kind(x) -> str:
    """The name of a node's class; of one without a name that of the class it extends."""
    kind = x.getClass()
    return kind.getSimpleName() or kind.getSuperclass().getSimpleName()


_classes: dict[frozenset[str], frozenset[str]] = {}


def _function_classes(spark: SparkSession, names: frozenset[str]) -> frozenset[str]:
    """Classes that Spark's registry of built-in functions runs for the names; they're looked up once."""
    if names in _classes:
        return _classes[names]
    registry = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    tables = spark._jvm.org.apache.spark.sql.catalyst.analysis.TableFunctionRegistry.builtin()
    out = set()
    for name in names:
        ident = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name)
        for r in (registry, tables):
            info = r.lookupFunction(ident)
            if info.isDefined():
                out.add(info.get().getClassName().rpartition(".")[2])
    _classes[names] = frozenset(out)
    return _classes[names]


class Guard:
    """Checks statements over the tables and views named in ``tables`` (lower case)."""

    def __init__(self, spark: SparkSession, tables: set[str], functions: set[str] = frozenset(FUNCTIONS), own: set[str] = frozenset()):
        """``own``: SQL functions of the session that readers may call beside the built-in ones."""
        self.spark, self.tables, self.functions, self.own = spark, tables, functions | own, own
        self.state = spark._jsparkSession.sessionState()
        self.expressions = SYNTAX | _function_classes(spark, frozenset(functions)) | ({"SQLFunctionExpression", "SQLScalarFunction"} if own else set())

    def check(self, sql: str) -> None:
        plan = self.state.sqlParser().parsePlan(sql)
        self._parsed(plan)
        self._analysed(self.state.analyzer().execute(plan))

    # --- parsed ---------------------------------------------------------------------------------------------------
    def _parsed(self, plan, common: frozenset = frozenset()) -> None:
        """``common``: names of the common tables in reach, which are no tables of the catalog."""
        kind = _kind(plan)
        if kind not in PARSED:
            raise NotAllowed(f"{kind} isn't allowed")
        if kind == "UnresolvedWith":
            if plan.allowRecursion():
                raise NotAllowed("recursive common tables aren't allowed")
            for pair in _each(plan.cteRelations()):
                self._parsed(pair.productElement(1), common)
                common |= {pair.productElement(0).lower()}
        elif kind == "UnresolvedRelation":
            self._relation(plan, common)
        elif kind == "UnresolvedTableValuedFunction":
            self._function([*_each(plan.name())])
        for e in _each(plan.expressions()):
            self._expression(e, lambda p: self._parsed(p, common))
        for child in _each(plan.children()):
            self._parsed(child, common)

    def _relation(self, plan, common: frozenset) -> None:
        parts = [*_each(plan.multipartIdentifier())]
        if len(parts) == 1 and parts[0].lower() in common:
            return
        if not plan.options().isEmpty() or len(parts) > 2 or ".".join(parts).lower().removeprefix("default.") not in self.tables:
            raise NotAllowed(f"no such table: {'.'.join(parts)}")

    def _function(self, parts: list[str]) -> None:
        if len(parts) != 1 or parts[0].lower() not in self.functions:
            raise NotAllowed(f"the function {'.'.join(parts)} isn't allowed")

    def _expression(self, e, inner) -> None:
        """``inner`` checks the plan of a subquery."""
        kind = _kind(e)
        if kind not in self.expressions:
            raise NotAllowed(f"{kind} isn't allowed")
        if kind == "UnresolvedFunction":
            self._function([*_each(e.nameParts())])
        elif kind == "UnresolvedGenerator":
            self._function([e.name().funcName()])
        elif kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
            inner(e.plan())
        for child in _each(self._inputs(e)):
            self._expression(child, inner)

    @staticmethod
    def _inputs(e):
        """What a function was given, not what it is replaced by."""
        if e.getClass().getName().startswith("org.apache.spark.sql.catalyst.expressions."):
            try:
                return e.parameters()
            except Py4JError:
                pass
        return e.children()

    # --- analysed -------------------------------------------------------------------------------------------------
    def _analysed(self, plan) -> None:
        kind = _kind(plan)
        if kind in TABLES:
            if kind == "LogicalRelation" and not plan.catalogTable().isDefined():
                raise NotAllowed("only tables of the catalog can be read")
            return
        if kind not in ANALYSED:
            raise NotAllowed(f"{kind} isn't allowed")
        if kind == "View":
            return
        for e in _each(plan.expressions()):
            self._expression(e, self._analysed)
        for child in _each(plan.children()):
            self._analysed(child)
