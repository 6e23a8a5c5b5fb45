"""The canonical building schema and the shapes of the feeds."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "t": T.TimestampType()}
#: name:kind, by category; * marks required fields. Kinds: s text, d number, i whole number, t time.
_FIELDS = """
unique_id*:s source*:s source_unique_id:s campus_id*:s campus_name*:s building_designation:s record_level:s latitude*:d longitude*:d gold_lat:d gold_lon:d company_clean*:s company_source:s
address:s city*:s state:s state_abbr:s postal_code:s county:s country*:s region*:s market:s commissioned_power_mw:d uc_power_mw:d planned_power_mw:d planned_plus_uc_mw:d full_capacity_mw:d available_power_kw:d
mw_2023:d mw_2024:d mw_2025:d mw_2026:d mw_2027:d mw_2028:d mw_2029:d mw_2030:d mw_2031:d mw_2032:d facility_sqft:d whitespace_sqft:d pue:d substation_count:i onsite_substation:i power_provider:s power_grid:s
tier_design:s feed_config:s type_category:s owned_leased:s building_type:s purpose:s ecosystem_ixps:i ecosystem_cloud:i ecosystem_children:i ecosystem_networkproviders:i ecosystem_networkpresence:i
ecosystem_serviceproviders:i date_reported:t announced:t land_acquisition:t permitting:t construction_started:t cod:t actual_live_date:t ingest_date*:t facility_status:s cancelled:i status_rank_tmp:i
total_cost_usd_million:d land_cost_usd_million:d total_site_acres:d data_center_acres:d additional_references:s notes:s
"""
#: Fields that feeds add to the declared ones.
_ADDED = """
ucid:s building_ucid:s is_essential:i company_clean_filter:s data_vintage:t construction_start_date:t end_user:s tenant:s gpu_cloud:s workload_type:s transmission_owner:s power_source_confidence:s status_detail:s
cooling_type:s energy_source:s finance_partner:s disclosed_date:t land_acquisition_date:t permitting_date:t cancelled_date:t dc_acres:d development_cost_usd_million:d grid_zone:s
"""


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n.rstrip("*"), _KINDS[k]) for n, k in (f.split(":") for f in text.split())])


DECLARED = _struct(_FIELDS)
REQUIRED = tuple(f.split("*")[0] for f in _FIELDS.split() if "*" in f)
CANONICAL = T.StructType([*DECLARED.fields, *_struct(_ADDED).fields])
