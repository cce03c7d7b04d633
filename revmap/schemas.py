"""Schemas and file options shared by every source, operator and sink."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the account-mapping file.
MAPPING_COLS = [
    "ID",
    "Oracle_Customer_Name",
    "Oracle_Customer_Name_ID",
    "Oracle_Invoice_Group",
    "Oracle_Invoice_Name",
    "Oracle_GL_Account",
]
MAPPING_ATTRS = MAPPING_COLS[1:]
MAPPING = T.StructType([T.StructField(c, T.StringType()) for c in MAPPING_COLS])

# Column names and order of the monthly revenue relation.
REVENUE_COLS = [
    "id",
    "data_month",
    "business_unit_name",
    "business_unit_detail_name",
    "product_line_id",
    "product_line_name",
    "parent_partner_id",
    "parent_partner_name",
    "partner_id",
    "partner_name",
    "drid",
    "contract_id",
    "contract_name",
    "gam_advertiser_level1",
    "gam_advertiser_level2",
    "network_name_id",
    "network_name",
    "network_classification_name",
    "network_classification_subtype",
    "network_feed_id",
    "markup_percent",
    "net_percent",
    "revshare_percent",
    "bad_debt_percent",
    "management_percent",
    "impressions",
    "clicks",
    "network_gross_revenue",
    "network_revshare",
    "s1_gross_revenue",
    "managment_fee",
    "partner_revshare",
    "holdback_revenue",
    "partner_gross_revenue",
    "commission_amount",
    "aggregation_source",
]

# The sixteen numeric measures; every other column but
# aggregation_source identifies a row.
MEASURES = [
    "parent_partner_id",
    "markup_percent",
    "net_percent",
    "revshare_percent",
    "bad_debt_percent",
    "management_percent",
    "impressions",
    "clicks",
    "network_gross_revenue",
    "network_revshare",
    "s1_gross_revenue",
    "managment_fee",
    "partner_revshare",
    "holdback_revenue",
    "partner_gross_revenue",
    "commission_amount",
]
KEYS = [c for c in REVENUE_COLS if c not in MEASURES and c != "aggregation_source"]


def _revenue_type(name: str) -> T.DataType:
    if name == "data_month":
        return T.DateType()
    return T.DoubleType() if name in MEASURES else T.StringType()


REVENUE = T.StructType([T.StructField(c, _revenue_type(c)) for c in REVENUE_COLS])

# Names of the two Y/N columns of the flagged mapped view.
GL_FLAG = "Oracle_mapped_record_flag"
ID_FLAG = "ID_mapped_record_flag"

# The exported file: mapping attributes, flags, then the revenue columns.
EXPORT_COLS = MAPPING_ATTRS + [GL_FLAG, ID_FLAG] + REVENUE_COLS
EXPORT_HEADER = [c.upper() for c in EXPORT_COLS]

# Texts that stand for NULL in a file.
NULL_TOKENS = ["NULL", "null", ""]

# One named file format. Reader and writer must agree on the escape character:
# with the default backslash a doubled quote would not survive a round trip.
# Spaces are content on both sides; Spark's writer would strip them.
CSV_OPTS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def string_schema(names: list[str]) -> T.StructType:
    """A schema of nullable strings with the given names."""
    return T.StructType([T.StructField(c, T.StringType()) for c in names])
