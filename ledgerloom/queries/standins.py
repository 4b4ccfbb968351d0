"""The benchmark tables in the shape of the aid and trade sources.

Orders stand in for activities, line items for transactions, sectors, budgets and
locations, suppliers for activities that only the second source has. Each view keeps the
irregularities of real data: missing, unreadable and zero shares, unknown codes, blanks
around identifiers, a second source that lags behind. They follow from attributes of the
rows, and every view covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SECOND_SOURCE_UNTIL = "2001-01-01"
USD_PER_EUR = 1.0823


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; the schema is given, so no job is spent on finding it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# share of the country in an order, as text
SHARE = """CASE
  WHEN o_orderpriority = '2-HIGH' THEN NULL
  WHEN o_orderpriority = '3-MEDIUM' THEN '40'
  WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '0'
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'n/a'
  ELSE '100' END"""

LINE_ORDER = "shiftleft(cast(l_linenumber AS bigint), 40)"


def stored_identifier(key: str) -> str:
    """Identifier as the second source stores it, for some with a blank behind."""
    return f"concat({key}, CASE WHEN {key} % 3 = 0 THEN ' ' ELSE '' END)"


# ------------------------------------------------------------------ first source

def act(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return joined.selectExpr(
        "o_orderkey AS ord",
        "cast(o_orderkey AS string) AS aid",
        """concat(CASE c_mktsegment WHEN 'BUILDING' THEN 'Agence' WHEN 'FURNITURE' THEN 'Red Cross'
           WHEN 'HOUSEHOLD' THEN 'World Bank' WHEN 'MACHINERY' THEN 'Ministry' END, ' ', n_name) AS reporting""",
        """concat(CASE n_regionkey WHEN 0 THEN 'FR' WHEN 1 THEN 'us' WHEN 2 THEN 'XM-DAC' WHEN 3 THEN 'JP'
           ELSE 'ZZ' END, '-', c_custkey) AS reporting_ref""",
        "c_name AS funder_ref",
        "concat('Order ', o_orderkey) AS title",
        "concat(o_orderpriority, ' / ', c_name) AS description",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN concat('ORD-', o_orderkey) END AS slug",
        "CASE o_orderstatus WHEN 'O' THEN '2' WHEN 'F' THEN '4' ELSE 'x' END AS status_code",
        "cast(unix_date(date(o_orderdate)) AS string) AS day_start",
        "CASE WHEN o_orderstatus = 'F' THEN cast(unix_date(date(o_orderdate)) + 100 AS string) END AS day_end",
        "CASE WHEN o_orderstatus = 'F' THEN '100' END AS day_length",
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large orders are translated, some without a title."""
    return table(spark, sf_dir, "orders").where("o_totalprice > 250000").selectExpr(
        "o_orderkey AS ord",
        "cast(o_orderkey AS string) AS aid",
        "CASE WHEN o_orderpriority <> '1-URGENT' THEN concat('Commande ', o_orderkey) END AS title",
        "concat('Commande de priorité ', o_orderpriority) AS description",
    )


# the country rows of an order: one of the country, and one of another for shared orders
COUNTRY_ROWS = f"""transform(
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN array('KM', 'XX') ELSE array('KM') END,
  code -> named_struct('aid', cast(o_orderkey AS string), 'country_code', code,
    'country_percent', CASE WHEN code = 'XX' THEN '60' ELSE {SHARE} END))"""


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"posexplode({COUNTRY_ROWS})").selectExpr(
        "o_orderkey * 2 + pos AS ord", "col.aid", "col.country_code", "col.country_percent"
    )


def trans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{LINE_ORDER} + l_partkey AS ord",
        "cast(l_orderkey AS string) AS aid",
        """CASE WHEN l_tax < 0.08 THEN year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)
           END AS trans_day""",
        "CASE WHEN l_quantity < 50 THEN l_extendedprice END AS trans_usd",
        f"CASE WHEN l_quantity < 50 THEN l_extendedprice / {USD_PER_EUR}D END AS trans_eur",
        "l_extendedprice AS trans_value",
        "'USD' AS trans_currency",
        "CASE l_returnflag WHEN 'A' THEN 'D' WHEN 'N' THEN 'E' WHEN 'R' THEN 'C' END AS trans_code",
        "CASE l_linestatus WHEN 'O' THEN '10' ELSE '99' END AS trans_flow_code",
        """CASE l_linenumber WHEN 1 THEN '110' WHEN 2 THEN '421' WHEN 3 THEN '510' WHEN 4 THEN '110'
           END AS trans_finance_code""",
    )


def sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as sectors; one of them is unknown and so is its group."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey).selectExpr(
        f"{LINE_ORDER} + l_partkey AS ord",
        "cast(l_orderkey AS string) AS aid",
        """CASE p_type WHEN 'ECONOMY' THEN '111' WHEN 'STANDARD' THEN '121' WHEN 'SMALL' THEN '140'
           WHEN 'MEDIUM' THEN '311' WHEN 'PROMO' THEN p_brand END AS sector_group""",
        """CASE p_type WHEN 'ECONOMY' THEN '11110' WHEN 'STANDARD' THEN '12110' WHEN 'SMALL' THEN '14030'
           WHEN 'MEDIUM' THEN '31110' WHEN 'LARGE' THEN '99810' ELSE p_type END AS sector_code""",
        "'100' AS sector_percent",
    )


def budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced items, some without a converted amount."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{LINE_ORDER} + l_partkey AS ord",
        "cast(l_orderkey AS string) AS aid",
        "l_extendedprice AS budget_value",
        "CASE l_returnflag WHEN 'R' THEN 'EUR' ELSE 'USD' END AS budget_currency",
        "CASE WHEN l_linenumber < 7 THEN l_extendedprice END AS budget_usd",
        f"CASE WHEN l_linenumber < 7 THEN l_extendedprice / {USD_PER_EUR}D END AS budget_eur",
    )


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier places; those of nation 0 are nameless."""
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).selectExpr(
        f"{LINE_ORDER} + l_suppkey AS ord",
        "cast(l_orderkey AS string) AS aid",
        "CASE WHEN s_nationkey > 0 THEN s_name END AS location_name",
        "cast(s_nationkey AS string) AS location_latitude",
        "cast(-s_nationkey AS string) AS location_longitude",
    )


class Views:
    """Tables by attribute, each built when a plan first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str, **views) -> None:
        self._spark, self._sf_dir, self._views = spark, sf_dir, views

    def __getattr__(self, name: str) -> DataFrame:
        views = self.__dict__.get("_views", {})
        if name not in views:
            raise AttributeError(name)
        self.__dict__[name] = views[name](self._spark, self._sf_dir)
        return self.__dict__[name]


def aid_tables(spark: SparkSession, sf_dir: str) -> Views:
    """The views in the place of :class:`ledgerloom.plans.aid.AidTables`."""
    return Views(
        spark, sf_dir, act=act, translation=translation, country=country, sector=sector, budget=budget,
        trans=trans, location=location,
    )


# ------------------------------------------------------------------ second source

def second_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders and suppliers; the second source names newer orders in its own way."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    known = orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(
        "concat('L', o_orderkey) AS _link",
        f"""CASE WHEN o_orderdate < timestamp_ntz '{SECOND_SOURCE_UNTIL}' THEN {stored_identifier('o_orderkey')}
            ELSE concat('NEW-', o_orderkey) END AS iatiidentifier""",
        "concat('Order ', o_orderkey) AS title_narrative",
        "o_orderpriority AS description",
        "c_mktsegment AS reportingorg_narrative",
        "c_name AS reportingorg_ref",
        "o_orderstatus AS activitystatus_code",
        "CASE o_orderstatus WHEN 'O' THEN 'Implementation' WHEN 'F' THEN 'Closed' END AS activitystatus_codename",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS actualstart",
        "cast(NULL AS string) AS actualend",
    )
    alone = table(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) AS _link",
        "concat('EXT-', s_suppkey) AS iatiidentifier",
        "s_name AS title_narrative",
        "cast(NULL AS string) AS description",
        "s_name AS reportingorg_narrative",
        "cast(NULL AS string) AS reportingorg_ref",
        "'O' AS activitystatus_code",
        "'Implementation' AS activitystatus_codename",
        "'2000-01-01' AS actualstart",
        "cast(NULL AS string) AS actualend",
    )
    return known.unionByName(alone)


def second_recipient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the country rows; some orders repeat the row of the country."""
    here = f"named_struct('code', 'KM', 'percentage', {SHARE})"
    there = "named_struct('code', 'XX', 'percentage', '60')"
    known = table(spark, sf_dir, "orders").selectExpr(
        "concat('L', o_orderkey) AS _link_activity",
        f"""inline(CASE WHEN o_orderpriority = '3-MEDIUM' THEN array({here}, {there})
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN array({here}, {here})
            ELSE array({here}) END)""",
    )
    alone = table(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) AS _link_activity", "'KM' AS code", "cast(NULL AS string) AS percentage"
    )
    return known.unionByName(alone)


def second_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items after discount, by shipping day, and one amount per supplier."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        f"{stored_identifier('l_orderkey')} AS iatiidentifier",
        "concat('L', l_orderkey) AS _link_activity",
        "CASE l_returnflag WHEN 'A' THEN '3' WHEN 'N' THEN '4' WHEN 'R' THEN '2' END AS transactiontype_code",
        """CASE l_returnflag WHEN 'A' THEN 'Disbursement' WHEN 'N' THEN 'Expenditure'
           WHEN 'R' THEN 'Outgoing Commitment' END AS transactiontype_codename""",
        "CASE WHEN l_tax < 0.08 THEN date_format(l_shipdate, 'yyyy-MM-dd') END AS transactiondate_isodate",
        "l_extendedprice * (1 - l_discount) AS value_usd",
        "'USD' AS value_currency",
        "l_extendedprice AS value",
        "cast(NULL AS string) AS value_valuedate",
        "cast(NULL AS string) AS sector_code",
        "cast(NULL AS string) AS sector_codename",
        "'KM' AS recipientcountry_code",
        "100D AS percentage_used",
    )
    alone = table(spark, sf_dir, "supplier").selectExpr(
        "concat('EXT-', s_suppkey) AS iatiidentifier",
        "concat('S', s_suppkey) AS _link_activity",
        "'3' AS transactiontype_code",
        "'Disbursement' AS transactiontype_codename",
        "'2000-01-01' AS transactiondate_isodate",
        "s_acctbal AS value_usd",
        "'USD' AS value_currency",
        "s_acctbal AS value",
        "'KM' AS recipientcountry_code",
        "100D AS percentage_used",
    )
    return lines.unionByName(alone, allowMissingColumns=True)


def second_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('L', o_orderkey) AS _link_activity",
        "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS value",
        "CASE o_orderstatus WHEN 'O' THEN 'USD' ELSE 'EUR' END AS value_currency",
        f"{stored_identifier('o_orderkey')} AS iatiidentifier",
    )


def second_tables(spark: SparkSession, sf_dir: str) -> Views:
    """The views in the place of :class:`ledgerloom.plans.second_source.SecondTables`."""
    return Views(
        spark, sf_dir, activity=second_activity, recipient=second_recipient, breakdown=second_breakdown,
        budget=second_budget,
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of an identifier registry in which some identifiers were never asked for."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS identifier",
        "CASE WHEN o_orderpriority <> '2-HIGH' THEN 1 END AS occurrences",
        "o_orderpriority <> '4-NOT SPECIFIED' AS checked",
    )


# ------------------------------------------------------------------ trade

def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly trade in thousand USD by flow, part type and nation.

    Nations are joined after the grouping, when one row per published cell is left.
    """
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    per_nation = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .join(orders.join(customer, orders.o_custkey == customer.c_custkey), lines.l_orderkey == orders.o_orderkey)
        .groupBy(
            F.year("l_shipdate").alias("annee"),
            F.expr("CASE l_returnflag WHEN 'R' THEN 'M' ELSE 'X' END").alias("flux"),
            "p_type", "c_nationkey",
        )
        .agg((F.sum("l_extendedprice") / 1000).alias("thousands"))
    )
    return per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).selectExpr(
        "flux",
        """CASE p_type WHEN 'ECONOMY' THEN '01-05_Animal' WHEN 'STANDARD' THEN '27-27_Fuels'
           WHEN 'SMALL' THEN '84-85_MachElec' ELSE p_type END AS section_code""",
        "CASE n_nationkey WHEN 0 THEN 'WLD' WHEN 1 THEN 'FRA' WHEN 2 THEN 'ARE' ELSE n_name END AS PARTNER",
        "annee AS TIME_PERIOD",
        "CASE WHEN n_nationkey = 5 THEN 0D WHEN n_nationkey <> 6 THEN thousands END AS OBS_VALUE",
    )


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as releases of their user; failed ones have no file."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS ord",
        "user_id AS reporterCode",
        "date_format(ts, 'yyyyMMdd') AS period",
        "CASE WHEN event_type <> 'error' THEN concat('file-', event_id) END AS fileUrl",
        "event_type",
    )


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest: periods with a purchase are loaded."""
    return releases(spark, sf_dir).where("event_type = 'purchase'").select("reporterCode", "period")


def code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("cast(p_partkey AS string) AS id", "p_name AS text")
