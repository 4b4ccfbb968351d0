"""Input schemas.

Raw fields are text, as the sources publish JSON without types; the clean step gives
them types. ``ord`` is the arrival order of a row and carries every "first seen" rule.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*text_columns: str, order: bool = False) -> T.StructType:
    fields = [T.StructField("ord", T.LongType())] if order else []
    return T.StructType(fields + [T.StructField(name, T.StringType()) for name in text_columns])


# first source: rows are objects
ACT = _table(
    "aid", "reporting", "reporting_ref", "funder_ref", "title", "description",
    "slug", "status_code", "day_start", "day_end", "day_length", order=True,
)
ACT_TRANSLATION = _table("aid", "title", "description", order=True)
COUNTRY = _table("aid", "country_code", "country_percent", order=True)
SECTOR = _table("aid", "sector_group", "sector_code", "sector_percent", order=True)
BUDGET = _table("aid", "budget_value", "budget_currency", "budget_usd", "budget_eur", order=True)
TRANS = _table(
    "aid", "trans_day", "trans_usd", "trans_eur", "trans_value", "trans_currency",
    "trans_code", "trans_flow_code", "trans_finance_code", order=True,
)
LOCATION = _table("aid", "location_name", "location_latitude", "location_longitude", order=True)

# second source: rows are arrays, named by a separate list of columns
T_ACTIVITY = _table(
    "_link", "iatiidentifier", "title_narrative", "description", "reportingorg_narrative",
    "reportingorg_ref", "activitystatus_code", "activitystatus_codename", "actualstart", "actualend",
)
T_RECIPIENT = _table("_link_activity", "code", "percentage")
T_BREAKDOWN = _table(
    "iatiidentifier", "_link_activity", "transactiontype_code", "transactiontype_codename",
    "transactiondate_isodate", "value_usd", "value_currency", "value", "value_valuedate",
    "sector_code", "sector_codename", "recipientcountry_code", "percentage_used",
)
T_BUDGET = _table("_link_activity", "value", "value_currency", "iatiidentifier")

# trade
RELEASES = T.StructType([
    T.StructField("reporterCode", T.IntegerType()),
    T.StructField("period", T.StringType()),
    T.StructField("fileUrl", T.StringType()),
])
RECORDS = T.StructType([
    T.StructField(name, T.StringType()) for name in ("period", "reporterCode", "cmdCode", "flowCode", "primaryValue")
])
AVAILABILITY = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("reporterISO", T.StringType()),
    T.StructField("reporterDesc", T.StringType()),
    T.StructField("totalRecords", T.LongType()),
    T.StructField("lastReleased", T.StringType()),
])
CODE_LIST = _table("id", "text")
REGISTRY = T.StructType([
    T.StructField("identifier", T.StringType()),
    T.StructField("occurrences", T.IntegerType()),
    T.StructField("checked", T.BooleanType()),
])
