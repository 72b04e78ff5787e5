"""Table registries.

``REFERENCE_BATCH_TABLES`` / ``REFERENCE_BASIC_TABLES`` declare the TPC-DS
shaped tables of the batch and one-time programs this library replaces;
``DRIVER_TABLES`` maps the same roles onto the TPC-H shaped tables used by
the tests and the bench.
"""

from __future__ import annotations

from ..specs import APPEND, FULL, SCD, TRUNCATE, Registry, TableSpec

# --- Fixed values: table schemas, strategies, keys and change columns of the
# --- reference's batch and one-time loads (must stay exactly as declared).
_CUSTOMER = (
    "c_customer_sk int, c_customer_id string, c_current_cdemo_sk int, c_current_hdemo_sk int, "
    "c_current_addr_sk int, c_first_shipto_date_sk int, c_first_sales_date_sk int, c_salutation string, "
    "c_first_name string, c_last_name string, c_preferred_cust_flag string, c_birth_day int, "
    "c_birth_month int, c_birth_year int, c_birth_country string, c_login string, c_email_address string, "
    "c_last_review_date string"
)
_CUSTOMER_ADDRESS = (
    "ca_address_sk int, ca_address_id string, ca_street_number string, ca_street_name string, "
    "ca_street_type string, ca_suite_number string, ca_city string, ca_county string, ca_state string, "
    "ca_zip string, ca_country string, ca_gmt_offset double, ca_location_type string"
)
_CUSTOMER_DEMOGRAPHICS = (
    "cd_demo_sk int, cd_gender string, cd_marital_status string, cd_education_status string, "
    "cd_purchase_estimate int, cd_credit_rating string, cd_dep_count int, cd_dep_employed_count int, "
    "cd_dep_college_count int"
)
_DATE_DIM = (
    "d_date_sk int, d_date_id string, d_date string, d_month_seq int, d_week_seq int, d_quarter_seq int, "
    "d_year int, d_dow int, d_moy int, d_dom int, d_qoy int, d_fy_year int, d_fy_quarter_seq int, "
    "d_fy_week_seq int, d_day_name string, d_quarter_name string, d_holiday string, d_weekend string, "
    "d_following_holiday string, d_first_dom int, d_last_dom int, d_same_day_ly int, d_same_day_lq int, "
    "d_current_day string, d_current_week string, d_current_month string, d_current_quarter string, "
    "d_current_year string"
)
_HOUSEHOLD_DEMOGRAPHICS = (
    "hd_demo_sk int, hd_income_band_sk int, hd_buy_potential string, hd_dep_count int, hd_vehicle_count int"
)
_ITEM = (
    "i_item_sk int, i_item_id string, i_rec_start_date string, i_rec_end_date string, i_item_desc string, "
    "i_current_price double, i_wholesale_cost double, i_brand_id int, i_brand string, i_class_id int, "
    "i_class string, i_category_id int, i_category string, i_manufact_id int, i_manufact string, "
    "i_size string, i_formulation string, i_color string, i_units string, i_container string, "
    "i_manager_id int, i_product_name string"
)
_PROMOTION = (
    "p_promo_sk int, p_promo_id string, p_start_date_sk int, p_end_date_sk int, p_item_sk int, p_cost double, "
    "p_response_target int, p_promo_name string, p_channel_dmail string, p_channel_email string, "
    "p_channel_catalog string, p_channel_tv string, p_channel_radio string, p_channel_press string, "
    "p_channel_event string, p_channel_demo string, p_channel_details string, p_purpose string, "
    "p_discount_active string"
)
_STORE = (
    "s_store_sk int, s_store_id string, s_rec_start_date string, s_rec_end_date string, s_closed_date_sk int, "
    "s_store_name string, s_number_employees int, s_floor_space int, s_hours string, s_manager string, "
    "s_market_id int, s_geography_class string, s_market_desc string, s_market_manager string, "
    "s_division_id int, s_division_name string, s_company_id int, s_company_name string, "
    "s_street_number string, s_street_name string, s_street_type string, s_suite_number string, "
    "s_city string, s_county string, s_state string, s_zip string, s_country string, s_gmt_offset double, "
    "s_tax_precentage double"
)
_STORE_SALES = (
    "ss_sold_date_sk int, ss_sold_time_sk int, ss_item_sk int, ss_customer_sk int, ss_cdemo_sk int, "
    "ss_hdemo_sk int, ss_addr_sk int, ss_store_sk int, ss_promo_sk int, ss_ticket_number int, "
    "ss_quantity int, ss_wholesale_cost double, ss_list_price double, ss_sales_price double, "
    "ss_ext_discount_amt double, ss_ext_sales_price double, ss_ext_wholesale_cost double, "
    "ss_ext_list_price double, ss_ext_tax double, ss_coupon_amt double, ss_net_paid double, "
    "ss_net_paid_inc_tax double, ss_net_profit double"
)
_TIME_DIM = (
    "t_time_sk int, t_time_id string, t_time int, t_hour int, t_minute int, t_second int, t_am_pm string, "
    "t_shift string, t_sub_shift string, t_meal_time string"
)

REFERENCE_BATCH_TABLES = (
    TableSpec("customer", _CUSTOMER, SCD, "c_customer_sk",
              ("c_salutation", "c_first_name", "c_preferred_cust_flag", "c_login", "c_email_address", "c_last_review_date")),
    TableSpec("customer_address", _CUSTOMER_ADDRESS, SCD, "ca_address_sk",
              ("ca_street_number", "ca_street_name", "ca_street_type", "ca_suite_number", "ca_city", "ca_county",
               "ca_state", "ca_zip", "ca_location_type", "ca_gmt_offset")),
    TableSpec("date_dim", _DATE_DIM, TRUNCATE),
    TableSpec("household_demographics", _HOUSEHOLD_DEMOGRAPHICS, SCD, "hd_demo_sk",
              ("hd_income_band_sk", "hd_buy_potential", "hd_dep_count", "hd_vehicle_count")),
    TableSpec("item", _ITEM, TRUNCATE),
    TableSpec("promotion", _PROMOTION, TRUNCATE),
    TableSpec("store", _STORE, TRUNCATE),
    TableSpec("store_sales", _STORE_SALES, APPEND),
    TableSpec("time_dim", _TIME_DIM, TRUNCATE),
)

# One-time load: files <name>.dat, full load; the customer file is published
# as "customers" by the one-time program.
REFERENCE_BASIC_TABLES = (
    TableSpec("customer", _CUSTOMER, FULL, file_name="customer.dat", target_table="customers"),
    TableSpec("customer_address", _CUSTOMER_ADDRESS, FULL, file_name="customer_address.dat"),
    TableSpec("customer_demographics", _CUSTOMER_DEMOGRAPHICS, FULL, file_name="customer_demographics.dat"),
)
REFERENCE_FACT_TABLE = "store_sales"
# --- end of fixed values


def reference_batch_registry() -> Registry:
    return Registry.of(REFERENCE_BATCH_TABLES)


def reference_basic_registry() -> Registry:
    return Registry.of(REFERENCE_BASIC_TABLES)


# Driver tables in the same roles (SCD dimension, truncate dimension,
# appended fact).  Dates are loaded as ``date``.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate date, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate date",
}
DRIVER_FACT_TABLE = "orders"


def driver_registry() -> Registry:
    s = DRIVER_SCHEMAS
    return Registry.of(
        [
            TableSpec("customer", s["customer"], SCD, "c_custkey", ("c_name", "c_mktsegment")),
            TableSpec("supplier", s["supplier"], SCD, "s_suppkey", ("s_name", "s_nationkey", "s_acctbal")),
            TableSpec("part", s["part"], TRUNCATE),
            TableSpec("nation", s["nation"], TRUNCATE),
            TableSpec("region", s["region"], TRUNCATE),
            TableSpec("orders", s["orders"], APPEND),
            TableSpec("lineitem", s["lineitem"], APPEND),
        ]
    )


def driver_basic_registry() -> Registry:
    s = DRIVER_SCHEMAS
    return Registry.of(
        [
            TableSpec("customer", s["customer"], FULL, file_name="customer.dat", target_table="customers"),
            TableSpec("nation", s["nation"], FULL, file_name="nation.dat"),
            TableSpec("region", s["region"], FULL, file_name="region.dat"),
        ]
    )
