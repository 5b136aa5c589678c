"""The queries of ``fault_queries`` as SQL for an independent engine."""

from __future__ import annotations

from massloom.fixtures.oracle import _BIN, _NO_PEAKS, ORACLE, _scan_eav, _sql

_GAPS = """gaps AS (SELECT CASE WHEN event_id % 17 <> 4 THEN basename END AS basename,
 CASE WHEN event_id % 13 <> 5 THEN event_id END AS scan_seq, scan_number, ms_level FROM v_scans WHERE ms_level IS NOT NULL)"""
_SIZE = "CASE WHEN length(remote_path) % 9 <> 4 THEN size_bytes END"
_TIME = "CASE WHEN length(remote_path) % 9 <> 5 THEN '2024-01-01 00:00:00' END"


def _fault(check: str, column: str, count: str, sample: str = "NULL") -> str:
    return f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", ({count})::BIGINT AS n_bad, {sample}::VARCHAR AS sample FROM v_files"


def _broken(rest: int, sample: str, column: str) -> str:
    bad = f"length(remote_path) % 9 = {rest}"
    return _fault("cast", column, f"count(*) FILTER ({bad})", f"max(CASE WHEN {bad} THEN '{sample}' END)")


FAULT_ORACLE: dict[str, str] = {
    "stream_withdraw": _sql(
        ["v_replicates"],
        """SELECT r.* EXCLUDE (s) REPLACE ('S' || s AS accession, CASE WHEN s IN (2, 5) THEN 'fixed' ELSE condition END AS condition), way
 FROM (SELECT *, substr(accession, 3)::INTEGER % 7 AS s FROM v_replicates) r,
 (VALUES ('one by one'), ('at once'), ('file by file')) AS ways(way) WHERE s IN (2, 5, 6)""",
    ),
    "batch_splits_even": ORACLE["batch_splits"].replace(
        "f.size_bytes FROM v_replicates r",
        "CASE WHEN length(remote_path) % 11 <> 3 THEN f.size_bytes // 134217728 * 134217728 END AS size_bytes FROM v_replicates r",
    ),
    "mzml_arrays": _sql(["v_spectra_cv"], "") + """
SELECT basename, scan_number, sum_mz, log_sum, peaks, params FROM (
 SELECT 'run_' || label AS basename, vec_id AS scan_number, len(mz)::INTEGER AS peaks, round(coalesce(list_sum(mz), 0), 3) AS sum_mz,
 round(log10(2 + coalesce(list_sum(i), 0)), 2) AS log_sum FROM (
 SELECT label, vec_id, CASE WHEN vec_id % 50 = 7 THEN [] ELSE list_transform(e, lambda x, k: 400::DOUBLE + (k - 1) * 10::DOUBLE + x) END AS mz,
 CASE WHEN vec_id % 50 = 7 THEN [] ELSE list_transform(e, lambda x, k: CASE WHEN vec_id % 50 = 9 AND k = 4 THEN -1
 ELSE pow(10::DOUBLE, abs(x) * 18::DOUBLE) END) END AS i FROM (SELECT label, vec_id, embedding::DOUBLE[] AS e FROM embeddings)))
 JOIN (SELECT basename, scan_number, string_agg(accession || '=' || coalesce(value, '-'), ';' ORDER BY pos) AS params
 FROM v_spectra_cv GROUP BY ALL) USING (basename, scan_number)""",
    "mzml_param_groups": _sql(["v_spectra", "v_spectra_cv"], "") + """
SELECT basename, scan_number, s.ms_level, len(mz)::INTEGER AS peaks, params FROM v_spectra s
 JOIN (SELECT basename, scan_number, string_agg(accession || '=' || coalesce(value, '-'), ';' ORDER BY pos) AS params
 FROM v_spectra_cv GROUP BY ALL) USING (basename, scan_number)
 UNION ALL SELECT DISTINCT basename, NULL, NULL, NULL, 'instrument serial number;owner;instrument model' FROM v_spectra""",
    "mzml_numpress": _sql(
        ["v_spectra"],
        """SELECT basename, scan_number AS scan_seq, len(mz)::INTEGER AS peaks, len(mz)::INTEGER AS intensities,
 true AS mz_fits, true AS intensity_fits FROM v_spectra""",
    ),
    "mzml_faults": """WITH s AS (SELECT 'run_' || label AS basename, CASE WHEN label = 1 AND vec_id % 7 = 3 THEN 'spectrum is no XML'
 WHEN label = 2 AND vec_id % 11 = 4 THEN 'spectrum without end' ELSE 'none' END AS fault FROM embeddings)
SELECT basename, fault, count(*) AS n FROM s GROUP BY ALL
 UNION ALL SELECT DISTINCT basename, 'spectra missing', 1 FROM s WHERE fault <> 'none' OR basename = 'run_4'
 UNION ALL SELECT DISTINCT basename, 'file without end', 1 FROM s WHERE basename = 'run_3'""",
    "union_relaxed_types": """SELECT p_partkey::VARCHAR AS key, p_size::DOUBLE AS amount, p_brand AS brand, p_partkey::BIGINT AS a,
 NULL::VARCHAR AS b, NULL::INTEGER AS nation, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey || '+' || (p_partkey % 7) END AS tags,
 (p_partkey % 2 = 0)::BIGINT AS flag FROM part
 UNION ALL SELECT s_name, s_suppkey::DOUBLE, NULL, s_suppkey, s_name, s_nationkey, s_suppkey::VARCHAR, s_nationkey FROM supplier
 UNION ALL SELECT n_nationkey::VARCHAR, n_nationkey / 2.0::DOUBLE, NULL, NULL, NULL, NULL, NULL, NULL FROM nation""",
    "parent_ms1_gaps": _sql(["v_scans"], "") + f""", {_GAPS}
SELECT basename, scan_seq, scan_number, ms_level, CASE WHEN scan_seq IS NULL THEN 1 ELSE coalesce(
 last_value(CASE WHEN ms_level = 1 AND scan_seq IS NOT NULL THEN scan_number END IGNORE NULLS)
 OVER (PARTITION BY basename ORDER BY scan_seq NULLS LAST ROWS UNBOUNDED PRECEDING), 1) END AS parent_scan FROM gaps""",
    "histogram_repeated_scans": _sql(
        ["v_spectra"],
        f"""SELECT basename, scan_number, bin, round(1 + 0.08::DOUBLE * bin, 4) AS lo, round(1 + 0.08::DOUBLE * bin + 0.08::DOUBLE, 4) AS hi,
 n::INTEGER AS n FROM (SELECT basename, scan_number, {_BIN} AS bin, count(*) AS n
 FROM (SELECT basename, scan_number // 2 AS scan_number, unnest(logs) AS x FROM v_spectra
 QUALIFY row_number() OVER (PARTITION BY basename, scan_number // 2 ORDER BY scan_number) = 1) WHERE x >= 1 AND x < 9 GROUP BY ALL)""",
    ),
    "scan_eav_values": _sql(["v_scans_cv", "v_parents"], "") + f"""
SELECT *, CASE WHEN accession IN ('peak_count', 'parent:ms1') THEN value::DOUBLE END AS value_num, 1 AS ms_level
 FROM ({_scan_eav("v_scans_cv", 1, _NO_PEAKS.format(1), "v_parents")})
 UNION ALL SELECT *, CASE WHEN accession IN ('peak_count', 'parent:ms1') THEN value::DOUBLE END, 2
 FROM ({_scan_eav("v_scans_cv", 2, _NO_PEAKS.format(2), "v_parents")})""",
    "typed_ingest": _sql(
        ["v_files"], f"SELECT id, repository_id, remote_path, {_SIZE} AS size_bytes, {_TIME} AS scan_timestamp FROM v_files"
    ),
    "typed_ingest_faults": _sql(
        ["v_files"],
        " UNION ALL ".join(
            [
                _fault("no_rows", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
                *[_fault(check, column, "count(*) FILTER (false)") for column in ("repository_id", "remote_path") for check in ("null", "blank")],
                _broken(4, "12 MB", "size_bytes"),
                _broken(5, "soon", "scan_timestamp"),
                _fault("duplicate_row", "*", "count(*) FILTER (false)"),
            ]
        ),
    ),
    "cut_labels": r"""SELECT p_partkey, label, translate(label, '/\ :', '____') AS file_name
 FROM (SELECT p_partkey, p_type || '/' || p_size || ':' || p_brand || '/' || replace(p_name, 'e', '\') AS label FROM part)""",
    "stored_order": _sql(
        ["v_scans"],
        """SELECT o_orderstatus AS part, count(*) AS n_rows, 0::BIGINT AS n_behind FROM orders GROUP BY 1
 UNION ALL SELECT basename, count(*), 0 FROM v_scans GROUP BY 1""",
    ),
    "manifest_table": _sql(["v_repositories"], "SELECT * FROM v_repositories"),
}
