"""The call-record table: declared schema and a derived view of ``events``.

Real call records arrive as headered CSV, one directory per UTC day (see
``gridtally.sources.scan``). The driver's test tables carry no coordinates, so
``calls_from_events`` derives a call-record-shaped view from ``events`` with
arithmetic that Spark and DuckDB evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# ---- fixed values: the 85 source columns in file order --------------------
CALL_COLUMNS = [
    "tac", "call_duration", "call_end_timestamp", "call_start_timestamp",
    "current_cell_id", "current_dl_earfcn", "current_enodeb_id",
    "current_nr_measurement_arfcn", "current_nr_measurement_cell",
    "current_nr_measurement_pci", "current_nr_rrc_report_time",
    "dl_mac_volume_bytes", "dl_pdcp_volume_bytes", "dl_tti_ue_scheduled",
    "drb_mean_pdcp_dl_kbps", "drb_mean_pdcp_ul_kbps", "end_latitude",
    "end_longitude", "endc_downlink_bytes", "endc_duration",
    "endc_duration_rate", "endc_sgnb_addition_attempts_count",
    "endc_sgnb_addition_failures_count", "endc_sgnb_drops_count",
    "endc_uplink_bytes", "indoor_outdoor_indicator_name", "initial_cell_id",
    "initial_dl_earfcn", "initial_enodeb_id", "pucch_sinr_db", "pusch_sinr_db",
    "rsrp_dbm", "rsrq_db", "n1_rsrp_dbm", "n1_rsrq_db", "n2_rsrp_dbm",
    "n2_rsrq_db", "n3_rsrp_dbm", "n3_rsrq_db", "mac_mean_dl_kbps",
    "mac_mean_ul_kbps", "nr_dl_sinr_db", "nr_rsrp_dbm", "nr_rsrq_db",
    "nr_serving_arfcn", "nr_serving_pci", "nr_sgnb_x2_release_cause_code",
    "rlc_pdu_dl_bytes_count", "rlc_pdu_ul_bytes_count", "service_type_name",
    "serving_nr_cell_id", "session_data_lost_flag", "subscriber_id",
    "ul_mac_volume_bytes", "ul_sinr_db", "userequipment_imeisv", "vendor_name",
    "nr_sa_data_volume_dl", "nr_sa_data_volume_ul", "nr_sa_throughput_dl",
    "nr_sa_throughput_ul", "nr_cqi", "rlc_dl_throughput", "rlc_ul_throughput",
    "ul_pdcp_volume_bytes", "volte_erab_attempt_count",
    "volte_erab_call_drop_count", "volte_erab_duration",
    "volte_erab_emergency_arp_count", "volte_erab_failed_attempt_count",
    "volte_erab_release_attempt_count", "vonr_attempts_count",
    "vonr_drops_count", "vonr_duration_ms", "vonr_failed_attempts_count",
    "vonr_failed_attempts_mobility_count", "vonr_release_attempts_count",
    "vonr_setup_time_ms", "qci_mean", "ue_mean_rank_indicator",
    "rlc_pdu_dl__retransmitted_bytes_count", "rlc_pdu_dl_retransmit_rate",
    "rlc_sdu_ul_bytes_count", "userequipment_manufacturer_name",
    "userequipment_model_name",
]
# Columns the KPI job keeps as text; every other column is read as a number.
STRING_COLUMNS = [
    "tac", "current_cell_id", "current_dl_earfcn", "current_enodeb_id",
    "current_nr_measurement_arfcn", "current_nr_measurement_cell",
    "current_nr_measurement_pci", "indoor_outdoor_indicator_name",
    "initial_cell_id", "initial_dl_earfcn", "initial_enodeb_id",
    "nr_serving_arfcn", "nr_serving_pci", "nr_sgnb_x2_release_cause_code",
    "service_type_name", "serving_nr_cell_id", "session_data_lost_flag",
    "subscriber_id", "userequipment_imeisv", "vendor_name",
    "userequipment_manufacturer_name", "userequipment_model_name", "submkt",
]
DATE_COLUMNS = ["call_end_timestamp", "call_start_timestamp", "current_nr_rrc_report_time"]
# ---------------------------------------------------------------------------


def calls_from_events(events: DataFrame) -> DataFrame:
    """Call-record-shaped rows derived from ``events`` (one row per event).

    Coordinates fall on a small lattice around 21N 158W so that grid cells hold
    several base stations; some rows are unlocated (NULL latitude) or out of
    range (latitude 95), and some 5G cell ids are NULL. Averaged measures
    are multiples of 1/16 and summed ones are whole numbers, so aggregates are
    exact in any summation order and two engines agree bit for bit.
    """

    def vol(mult: int, mod: int, unit: float) -> str:
        return f"((event_id * {mult}) % {mod}) * {unit!r}D"

    return events.selectExpr(
        "event_id",
        "ts",
        "CAST(user_id AS STRING) AS subscriber_id",
        "CAST(((event_id * 7 + user_id) % 23) + 7000 AS STRING) AS current_enodeb_id",
        "CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING)"
        " ELSE CAST((user_id * 13 + event_id) % 19 AS STRING) END AS serving_nr_cell_id",
        "CASE WHEN event_type = 'click' THEN 'Indoor' WHEN event_type = 'error'"
        " THEN CAST(NULL AS STRING) ELSE 'Outdoor' END AS indoor_outdoor_indicator_name",
        "CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 101 = 0 THEN 95.0D"
        " ELSE 21.0D + (user_id % 40) * 0.0131D + (event_id % 5) * 0.0007D END AS end_latitude",
        "-158.2D + (user_id % 30) * 0.0173D + (event_id % 3) * 0.0009D AS end_longitude",
        "-80.0D - floor(value * 4.0D) / 8.0D AS rsrp_dbm",
        "-5.0D - floor(value * 2.0D) / 16.0D AS rsrq_db",
        "25.0D - floor(value) / 4.0D AS ul_sinr_db",
        "(event_id % 9) + 1.0D AS qci_mean",
        f"{vol(37, 1000, 1500.0)} AS rlc_pdu_dl_bytes_count",
        f"{vol(11, 700, 300.0)} AS rlc_pdu_ul_bytes_count",
        "CAST(floor(value * 150.0D) AS DOUBLE) AS rlc_dl_throughput",
        "CAST(floor(value * 30.0D) AS DOUBLE) AS rlc_ul_throughput",
        f"{vol(13, 900, 1600.0)} AS dl_mac_volume_bytes",
        f"{vol(17, 500, 400.0)} AS ul_mac_volume_bytes",
        "CAST(floor(value * 25.0D) AS DOUBLE) AS mac_mean_ul_kbps",
        "CAST(floor(value * 120.0D) AS DOUBLE) AS mac_mean_dl_kbps",
        "CAST(floor(value * 110.0D) AS DOUBLE) AS drb_mean_pdcp_dl_kbps",
        "CAST(floor(value * 22.0D) AS DOUBLE) AS drb_mean_pdcp_ul_kbps",
        f"{vol(19, 800, 1400.0)} AS dl_pdcp_volume_bytes",
        f"{vol(23, 600, 350.0)} AS ul_pdcp_volume_bytes",
        f"{vol(29, 400, 250.0)} AS rlc_sdu_ul_bytes_count",
        f"CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE {vol(31, 50, 100.0)} END"
        " AS rlc_pdu_dl__retransmitted_bytes_count",
        "CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE 20.0D - floor(value) / 8.0D END"
        " AS pusch_sinr_db",
        "date_format(ts, 'yyyyMMdd') AS UTC_date",
    )
