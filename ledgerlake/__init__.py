"""ledgerlake: load, clean, check and analyse sales data as lazy Spark DataFrames.

Every public operator takes DataFrames and returns a DataFrame; planning is left
to Catalyst/AQE and the heavy work runs on the executors. The most used entry
points are re-exported here.
"""

from ledgerlake.functions.naming import (choose_clustering_columns, normalize_column_name, normalize_columns,
                                         normalize_table_name)
from ledgerlake.operators.analytics import (business_summary, customer_analytics, dashboard_summary, first_orders,
                                            product_analytics, revenue_by_customer, revenue_by_product,
                                            revenue_over_time, sales_analytics, share_of_max)
from ledgerlake.operators.cleaning import (clean_customers, clean_dataframe, clean_orders, clean_products,
                                           clean_strings, dedupe_by_key, drop_duplicate_rows, reject_orders)
from ledgerlake.operators.quality import (check_duplicates, check_nulls, check_positive_values,
                                          check_required_columns, generate_customer_quality_report,
                                          generate_order_quality_report, generate_product_quality_report,
                                          generate_quality_report, report_as_dict)
from ledgerlake.plans.pipeline import load_all_tables, run_pipeline
from ledgerlake.sinks.warehouse import load_table, save_as_csv, verify_tables
from ledgerlake.sources.catalog import find_selected_file, list_input_files
from ledgerlake.sources.files import load_csv, load_file, load_json, load_xml, load_xml_dynamic

__version__ = "0.1.0"

__all__ = [
    "business_summary", "check_duplicates", "check_nulls", "check_positive_values", "check_required_columns",
    "choose_clustering_columns", "clean_customers", "clean_dataframe", "clean_orders", "clean_products",
    "clean_strings", "customer_analytics", "dashboard_summary", "dedupe_by_key", "drop_duplicate_rows",
    "find_selected_file", "first_orders", "generate_customer_quality_report", "generate_order_quality_report",
    "generate_product_quality_report", "generate_quality_report", "list_input_files", "load_all_tables",
    "load_csv", "load_file", "load_json", "load_table", "load_xml", "load_xml_dynamic",
    "normalize_column_name", "normalize_columns", "normalize_table_name", "product_analytics", "reject_orders",
    "report_as_dict", "revenue_by_customer", "revenue_by_product", "revenue_over_time", "run_pipeline",
    "sales_analytics", "save_as_csv", "share_of_max", "verify_tables",
]
