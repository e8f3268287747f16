"""Small Bronze lead-time tables."""

from datetime import datetime

SCHEMA = """
    wh string, asn string, folio string, div string, container_size string, vessel string,
    b_l string, port string, container string, min_of_po_head_req_delivery_date timestamp_ntz,
    max_of_po_head_req_delivery_date timestamp_ntz, max_min_xfty double,
    xfty_to_container_consolidation timestamp_ntz, pos_consolidation_to_gate_in double,
    gate_in timestamp_ntz, gate_in_to_etd double, etd timestamp_ntz, etd_to_eta double,
    current_eta_port timestamp_ntz, eta_to_delivery double, p_u string,
    delivery_to_received double, asn_receive timestamp_ntz, max_xft_to_received double,
    min_xft_to_received double, avg_xfty_to_received double, customer string, region string,
    asn_qty double, _bronze_insert_ts timestamp, _source_file_name string
"""

BASE = dict(
    wh="E1", asn="A1", folio="F1", div="d", container_size="40h", vessel="V1", b_l="BL1",
    port="Hochiminh", container="C1", min_of_po_head_req_delivery_date=datetime(2024, 1, 1),
    max_of_po_head_req_delivery_date=datetime(2024, 2, 1), max_min_xfty=2.0,
    xfty_to_container_consolidation=datetime(2024, 1, 3), pos_consolidation_to_gate_in=1.0,
    gate_in=datetime(2024, 1, 4), gate_in_to_etd=1.0, etd=datetime(2024, 1, 5), etd_to_eta=20.0,
    current_eta_port=datetime(2024, 1, 25), eta_to_delivery=5.0, p_u="2024-01-30",
    delivery_to_received=2.0, asn_receive=datetime(2024, 2, 1), max_xft_to_received=30.0,
    min_xft_to_received=28.0, avg_xfty_to_received=29.0, customer="c", region="China ",
    asn_qty=10.0, _bronze_insert_ts=datetime(2025, 8, 1), _source_file_name="f.xlsx",
)


def bronze_row(**changes):
    assert set(changes) <= set(BASE)
    return tuple({**BASE, **changes}.values())


def bronze_table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def renamed(df, **names):
    return df.toDF(*[names.get(c, c) for c in df.columns])
