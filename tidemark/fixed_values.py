"""Fixed values.

Names, labels, windows and word lists that results must agree on.  Data only.
"""

from datetime import date

# Hand-mapped lead-time tables, (period, table, first etd, end etd).
HISTORICAL_PERIODS = [
    ("2023", "shipment_lead_time_2023_data", None, date(2023, 11, 1)),
    ("2024_Q1", "shipment_lead_time_2024_q1_data", date(2023, 11, 1), date(2024, 4, 1)),
    ("2024_Q2", "shipment_lead_time_2024_q2_data", date(2024, 4, 1), date(2024, 6, 1)),
    ("2024_Q3", "shipment_lead_time_2024_q3_data", date(2024, 6, 1), date(2024, 9, 1)),
    ("2024_Q4", "shipment_lead_time_2024_q4_data", date(2024, 9, 1), date(2024, 12, 1)),
    ("2025_Q1", "shipment_lead_time_2025_q1_data", date(2024, 12, 1), date(2025, 3, 1)),
    ("2025_Q2", "shipment_lead_time_2025_q2_data", date(2025, 3, 1), date(2025, 7, 1)),
]

# How discovered tables are named, where discovery starts, what it skips.
TABLE_KEYWORD = "lead_time"
PERIOD_PATTERN = r"shipment_lead_time_(\d{4})_q([1-4])"
DYNAMIC_START = (2025, 3)
SKIPPED_PREFIX = "copy_of_"
SKIPPED_TEXT = "old_version_do_not_use"
SKIPPED_SUFFIXES = ["_summary", "_port_table", "_whr_code", "_2024_air", "_2024_ocean"]

# Port spellings and the name each stands for (lower case).
PORT_SYNONYMS = {
    "xiangang": "xingang",
    "sekou": "shekou",
    "hochiminh": "ho chi minh",
    "nhava sheva, in": "nhava sheva",
    "phnom penh, kh": "phnom penh",
    "chattogram": "chittagong",
    "haiphong, vn": "haiphong",
    "santos, brazil": "santos",
    "sines portugal": "sines",
    "vung tau, vn": "vung tau",
}

# Columns that identify a shipment leg.
LEG_KEY = ["wh", "asn", "folio", "b_l", "container", "etd"]

# Columns pinned to text when a workbook tab is landed.
TEXT_COLUMNS = ["asn", "folio", "p_u"]

# Fixed values: (file, tab, column, value) of rows to drop when nothing else is filled.
STRAY_ROWS = [("Shipment Lead Time 2025 Q3.xlsx", "q3_2025", "region", "VIETNAM")]

# Fact id columns, (Silver name, display name).
FACT_IDS = [
    ("wh", "WH"),
    ("asn", "ASN#"),
    ("folio", "Folio"),
    ("port", "Port"),
    ("asn_receive", "ASN RECEIVE"),
    ("region", "COUNTRY"),
]

# Phase columns, (Silver name, phase label).
FACT_PHASES = [
    ("avg_xfty_to_received", "Avg XFTY to Received"),
    ("min_xft_to_received", "Min XFT to Received"),
    ("max_xft_to_received", "Max XFT to Received"),
    ("delivery_to_received", "Delivery to Received"),
    ("eta_to_delivery", "ETA to Delivery"),
    ("etd_to_eta", "ETD to ETA"),
    ("gate_in_to_etd", "Gate In to ETD"),
    ("pos_consolidation_to_gate_in", "POS Consolidation to Gate In"),
    ("xfty_range", "Max-Min XFTY"),
]

# Order, separator and NULL mark of the fact row key.
FACT_KEY = ["ASN RECEIVE", "ASN#", "Folio", "COUNTRY", "Phase", "Port", "WH"]
KEY_SEPARATOR = "|"
KEY_NULL = "<NULL>"

# Phase master (label, alias, order, group, benchmark days, assumption).
PHASE_SCHEMA = (
    "Phase string, phase_alias string, phase_order int, phase_group string, "
    "benchmark_days int, is_assumption boolean"
)
PHASES = [
    ("POS Consolidation to Gate In", "Gate in", 1, "Transit Leg", 3, True),
    ("Gate In to ETD", "Gate in to ETD", 2, "Transit Leg", None, False),
    ("ETD to ETA", "ETD to ETA", 3, "Transit Leg", None, False),
    ("ETA to Delivery", "ETA to Delivery", 4, "Transit Leg", None, False),
    ("Delivery to Received", "Deli. to rec.", 5, "Transit Leg", None, False),
    ("Max-Min XFTY", "Max-Min xfty", 6, "Summary", None, False),
    ("Min XFT to Received", "min xft to received.", 7, "Summary", None, False),
    ("Max XFT to Received", "max xft to received.", 8, "Summary", None, False),
    ("Avg XFTY to Received", "Avg total", 9, "Summary", None, False),
]

# Calendar bounds, both included.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)

# Constants in the ERP joins.
CASE_UNIT = "CA"
UNIT_FLAG, UNIT_TYPE = 1, 2
ALIAS_TYPE, ALIAS_QUALIFIER = 2, "UPC"
BRAND_TABLE = "ITCL"
CATEGORY_LEVEL, SUB_CATEGORY_LEVEL = 1, 3

# Schema of the ERP base tables.
ERP_SCHEMA = "MVXJDTA"

# ERP base tables and the columns read from each; company column first.
ERP_COLUMNS = {
    "MITMAS": [
        "MMCONO", "MMITNO", "MMITNE", "MMITCL", "MMITDS", "MMSPE4", "MMCFI1",
        "MMUNMS", "MMSPAC", "MMGRP1", "MMGRP3", "MMSAPR", "MMPUPR",
    ],
    "MITAUN": ["MUCONO", "MUITNO", "MUAUS9", "MUAUTP", "MUCOFA"],
    "MITMAH": ["HMCONO", "HMITNO", "HMSTYN", "HMOPTX", "HMOPTY"],
    "MITPOP": ["MPCONO", "MPITNO", "MPALWT", "MPALWQ", "MPPOPN"],
    "CSYTAB": ["CTCONO", "CTSTCO", "CTSTKY", "CTTX15"],
    "MITSCH": ["SGCONO", "SGGLVL", "SGSGP0", "SGTX40"],
}

# Item columns, (Silver name, display name), in dimension order.
ITEM_COLUMNS = [
    ("sku", "SKU"),
    ("brand_name", "Brand Name"),
    ("brand", "Brand"),
    ("style_name", "STYLE NAME"),
    ("style", "STYLE"),
    ("color_name", "Color Name"),
    ("year_season", "YEAR/SEASON"),
    ("size", "Size"),
    ("width", "WIDTH"),
    ("category", "Category"),
    ("sub_category", "Sub Category"),
    ("pair_per_unit", "Pair per Unit"),
    ("package", "Package"),
    ("upc", "UPC"),
    ("sales_price", "SALES PRICE"),
    ("purchase_price", "PURCHASE PRICE"),
    ("unit_of_measure", "Unit of Measure"),
]

# Item columns that must be numbers, and their types.
ITEM_NUMBERS = {
    "pair_per_unit": "decimal(18,4)",
    "sales_price": "decimal(17,2)",
    "purchase_price": "decimal(17,2)",
}

# Item columns that decide which of several rows of a SKU is kept.
ITEM_PREFERENCE = ["brand_name", "pair_per_unit", "upc"]

# Cell texts a workbook reader treats as empty (pandas' documented list).
EMPTY_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
