"""The queries as SQL for an independent engine, over the same test tables.

Each query is a list of view names it needs and a final SELECT. Views state
the rules of ``views.py`` and the jobs a second time, in set-oriented SQL.
"""

from __future__ import annotations

from statistics import NormalDist

from massloom.fixtures.views import HEADER_GROUPS, ORGANISMS, SUFFIXES

# Fixed values, stated here a second time so that the jobs' own are checked.
# What is reported of a run: group, measure: the statistics, as accession group:measure_statistic.
_PLAIN_REPORTS = """
summary spectra sum spectrum_count total_spectrum_count
ms1 spectra sum spectrum_count ms1_spectrum_count
ms2 spectra sum spectrum_count ms2_spectrum_count
summary scan_time min first_scan_time_minutes first_scan_time_minutes
summary scan_time max last_scan_time_minutes last_scan_time_minutes
summary scan_time seconds total_run_time_seconds total_run_time_seconds
ms1 mz_low min mz_low_min ms1_mz_low_min
ms1 mz_high max mz_high_max ms1_mz_high_max
ms1 mz_window avg mz_window_avg ms1_mz_window_avg
ms2 mz_low min mz_low_min ms2_mz_low_min
ms2 mz_high max mz_high_max ms2_mz_high_max
ms2 mz_window avg mz_window_avg ms2_mz_window_avg
ms2 isolation_lower min isolation_lower_offset_min ms2_isolation_lower_offset_min
ms2 isolation_upper max isolation_upper_offset_max ms2_isolation_upper_offset_max
summary peak_separation_min min peak_separation_min peak_separation_min
summary peak_separation_max max peak_separation_max peak_separation_max
summary peak_separation_avg avg peak_separation_avg peak_separation_avg
summary peak_separation_median avg peak_separation_median peak_separation_median
summary peak_intensity_min min peak_intensity_min peak_intensity_min
summary peak_intensity_max max peak_intensity_max peak_intensity_max
summary peak_intensity_avg avg peak_intensity_avg peak_intensity_avg
summary peak_intensity_median avg peak_intensity_median peak_intensity_median
"""
# Measures of which least, greatest, mean and deviation are all reported.
_SPREAD_REPORTS = """
summary tic
ms1 tic
ms2 tic
summary precursor_mz
ms2 collision_energy
ms2 isolation_target_mz
ms2 isolation_window
summary peak_count
ms1 peak_count
ms2 peak_count
"""
_REPORTS = [
    (group, measure, stat, f"{group}:{accession}", name)
    for group, measure, stat, accession, name in (line.split() for line in _PLAIN_REPORTS.split("\n") if line)
] + [
    (group, measure, stat, f"{group}:{measure}_{stat}", f"{measure}_{stat}")
    for group, measure in (line.split() for line in _SPREAD_REPORTS.split("\n") if line)
    for stat in ("min", "max", "avg", "std")
]
# Terms about the encoding of arrays and the kind of file, never reported for a scan.
_TECHNICAL = "MS:1000514 MS:1000515 MS:1000521 MS:1000574 MS:1000579 MS:1000580 MS:1000795".split()
# Percentages of the quantile profile: the normal distribution at 101 points from -3 to 3 deviations.
_PERCENTAGES = [100.0 * NormalDist().cdf(0.06 * i) for i in range(-50, 51)]

R3 = "round({0}::DOUBLE::VARCHAR::DECIMAL(38,12), 3)::DOUBLE"


def r3(x: str) -> str:
    """Three digits, half up on the shortest decimal form."""
    return R3.format(f"({x})")


def text3(x: str) -> str:
    return f"regexp_replace(({x})::DECIMAL(38,3)::VARCHAR, '0{{1,2}}$', '')"


_KINDS = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUFFIXES))
_ORGANISM = " ".join(f"WHEN o % 1000 < {bound} THEN '{name}'" for bound, name in ORGANISMS)
_STEM = "'/data/' || l_suppkey || '/' || l_orderkey || '/run_' || l_orderkey || '_' || l_partkey || '_' || l_linenumber"
_SAMPLE = r"\.(raw|d|mgf|mzml|wiff|wiff2)(\.(gz|zip|7z|bz2|xz))?$"
_HUMAN = """CASE WHEN {0} IS NULL THEN ''
 WHEN {0} < 1024 THEN printf('%.1f B', {0}::DOUBLE)
 WHEN {0} < 1048576 THEN printf('%.1f KB', {0} / 1024.0::DOUBLE)
 WHEN {0} < 1073741824 THEN printf('%.1f MB', {0} / 1048576.0::DOUBLE)
 WHEN {0} < 1099511627776 THEN printf('%.1f GB', {0} / 1073741824.0::DOUBLE)
 WHEN {0} < 1125899906842624 THEN printf('%.1f TB', {0} / 1099511627776.0::DOUBLE)
 ELSE printf('%.1f PB', {0} / 1125899906842624.0::DOUBLE) END"""


def human(x: str) -> str:
    return _HUMAN.format(f"({x})")


# name -> (needed views, body)
VIEWS: dict[str, tuple[list[str], str]] = {
    "v_repositories": (
        [],
        """SELECT printf('PX%06d', s_suppkey) AS id,
 'ftp://' || CASE WHEN s_suppkey % 4 = 0 THEN 'user:p@w@' ELSE '' END
 || CASE WHEN s_suppkey % 10 = 3 THEN 'massive-ftp.ucsd.edu' ELSE 'FTP' || (s_suppkey % 3) || '.example.org' END
 || CASE WHEN s_suppkey % 5 = 0 THEN ':2121' ELSE '' END
 || CASE WHEN s_suppkey % 11 = 7 THEN '' ELSE '/data/' || s_suppkey END
 || CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END AS url,
 '10.1000/' || s_name AS doi FROM supplier""",
    ),
    "v_raw_listing": (
        [],
        f"""SELECT printf('PX%06d', l_suppkey) AS repository_id, '/data/' || l_suppkey AS root_path,
 {_STEM} || CASE l_partkey % 8 {_KINDS} END AS path, false AS is_dir,
 round(l_extendedprice * 100)::BIGINT * 40 AS size_bytes FROM lineitem
 UNION ALL SELECT printf('PX%06d', l_suppkey), '/data/' || l_suppkey, {_STEM} || '.wiff.scan', false,
 (round(l_extendedprice * 100)::BIGINT * 40) // 10 FROM lineitem WHERE l_partkey % 8 = 4 AND l_orderkey % 2 = 0
 UNION ALL SELECT printf('PX%06d', l_suppkey), '/data/' || l_suppkey, {_STEM} || '.d/AcqData/part.bin', false,
 (round(l_extendedprice * 100)::BIGINT * 40) // 3 FROM lineitem WHERE l_partkey % 8 = 3 AND l_orderkey % 2 = 0
 UNION ALL SELECT printf('PX%06d', s_suppkey), '/data/' || s_suppkey, '/data/' || s_suppkey || '/incoming', true,
 NULL FROM supplier""",
    ),
    "v_listing": (
        ["v_raw_listing"],
        """SELECT repository_id, min(rtrim(root_path, '/')) AS root_path, path, bool_or(is_dir) AS is_dir,
 max(size_bytes) AS size_bytes FROM v_raw_listing GROUP BY repository_id, path""",
    ),
    "v_dirs": (
        ["v_listing"],
        """SELECT repository_id, root_path, remote_path, sum(size_bytes)::BIGINT AS size_bytes FROM (
 SELECT repository_id, root_path, size_bytes,
 unnest(list_transform(range(1, len(p)), lambda k: root_path || '/' || array_to_string(p[1:k], '/'))) AS remote_path
 FROM (SELECT *, string_split(substr(path, length(root_path) + 2), '/') AS p FROM v_listing WHERE NOT is_dir)
 UNION ALL SELECT repository_id, root_path, 0, path FROM v_listing WHERE is_dir) GROUP BY ALL""",
    ),
    "v_items": (
        ["v_dirs"],
        r"""SELECT repository_id, remote_path, size_bytes, is_dir FROM (
 SELECT repository_id, root_path, path AS remote_path, size_bytes, is_dir FROM v_listing WHERE NOT is_dir
 UNION ALL SELECT repository_id, root_path, remote_path, size_bytes, true FROM v_dirs)
 WHERE NOT regexp_matches(substr(remote_path, length(root_path) + 2), '(?i)\.d/')""",
    ),
    "v_fused": (
        ["v_items"],
        """SELECT i.repository_id, i.remote_path, (i.size_bytes + coalesce(s.extra, 0))::BIGINT AS size_bytes FROM v_items i
 LEFT JOIN (SELECT repository_id, left(remote_path, length(remote_path) - 5) AS remote_path, sum(size_bytes) AS extra
 FROM v_items WHERE lower(remote_path) LIKE '%.wiff.scan' GROUP BY ALL) s USING (repository_id, remote_path)
 WHERE lower(i.remote_path) NOT LIKE '%.wiff.scan'""",
    ),
    "v_files": (
        ["v_fused"],
        rf"""SELECT CASE WHEN size_bytes > 157286400 AND regexp_matches(name, '{_SAMPLE}') THEN repository_id || '_' ||
 regexp_replace(regexp_replace(name, '\.(gz|zip|7z|bz2|xz)$', ''), '\.(raw|d|mgf|mzml|wiff|wiff2)$', '') END AS id,
 repository_id, remote_path, size_bytes
 FROM (SELECT *, lower(string_split(remote_path, '/')[-1]) AS name FROM v_fused)""",
    ),
    "v_replicates": (
        ["v_files"],
        f"""SELECT id, CASE {_ORGANISM} END AS organism, coalesce(c_mktsegment, 'unknown') AS source_type,
 coalesce(p_type, 'unknown') AS material, coalesce(o_orderpriority, 'unknown') AS condition,
 printf('sample-%04d', n) AS sample_group, accession
 FROM (SELECT id, repository_id AS accession,
 regexp_extract(remote_path, 'run_([0-9]+)_([0-9]+)_([0-9]+)', 1)::BIGINT AS o,
 regexp_extract(remote_path, 'run_([0-9]+)_([0-9]+)_([0-9]+)', 2)::BIGINT AS p,
 regexp_extract(remote_path, 'run_([0-9]+)_([0-9]+)_([0-9]+)', 3)::BIGINT AS n
 FROM v_files WHERE id IS NOT NULL)
 LEFT JOIN orders ON o = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON p = p_partkey""",
    ),
    "v_data": (
        ["v_replicates"],
        "SELECT r.*, f.repository_id, f.size_bytes FROM v_replicates r JOIN v_files f USING (id)",
    ),
    "v_annotations": (
        [],
        r"""SELECT * EXCLUDE (times, copy) FROM (SELECT *, unnest(range(times)) AS copy FROM (
 SELECT 's_' || CASE WHEN o_orderkey % 101 = 5 THEN o_orderkey - 5 ELSE o_orderkey END AS id,
 CASE WHEN o_orderkey % 53 <> 1 THEN o_orderstatus END AS organism,
 CASE WHEN o_orderkey % 59 = 2 THEN chr(9) || ' ' ELSE 'tissue' END AS source_type,
 CASE WHEN o_orderkey % 61 = 3 THEN chr(160) ELSE 'plasma' END AS material,
 o_orderpriority AS condition, printf('sample-%04d', o_orderkey) AS sample_group,
 CASE WHEN o_orderkey % 103 = 4 THEN 2 ELSE 1 END AS times FROM orders))""",
    ),
    "v_manifest": (
        [],
        r"""SELECT * EXCLUDE (times, copy) FROM (SELECT *, unnest(range(times)) AS copy FROM (
 SELECT 'PX' || CASE WHEN s_suppkey % 17 = 1 THEN s_suppkey - 1 ELSE s_suppkey END AS id,
 CASE WHEN s_suppkey % 13 <> 2 THEN 'ftp://host/' || s_suppkey END AS url,
 CASE WHEN s_suppkey % 19 = 3 THEN ' ' ELSE s_name END AS doi,
 CASE WHEN s_suppkey % 23 = 4 THEN 3 ELSE 1 END AS times FROM supplier))""",
    ),
    "v_spectra": (
        [],
        """SELECT 'run_' || label AS basename, vec_id AS scan_number, CASE WHEN vec_id % 5 = 0 THEN 1 ELSE 2 END AS ms_level,
 CASE WHEN vec_id % 50 = 7 THEN []::DOUBLE[] ELSE
 list_transform(e, lambda x, i: 400::DOUBLE + (i - 1) * 10::DOUBLE + x) END AS mz,
 CASE WHEN vec_id % 50 IN (7, 9) THEN []::DOUBLE[] ELSE
 list_transform(e, lambda x: log10(1::DOUBLE + pow(10::DOUBLE, abs(x) * 18::DOUBLE))) END AS logs
 FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)""",
    ),
    "v_peak_stats": (
        ["v_spectra"],
        """SELECT basename, scan_number, ms_level, len(logs) AS peak_count, list_min(logs) AS int_min, list_max(logs) AS int_max,
 list_avg(logs) AS int_avg, list_median(logs) AS int_median, len(g) AS n_gaps,
 list_min(g) AS sep_min, list_max(g) AS sep_max, list_avg(g) AS sep_avg, list_median(g) AS sep_median
 FROM (SELECT *, list_transform(range(1, len(s)), lambda i: s[i + 1] - s[i]) AS g
 FROM (SELECT *, list_sort(mz) AS s FROM v_spectra))""",
    ),
    # Parameters of a spectrum in document order.
    "v_spectra_cv": (
        [],
        """SELECT 'run_' || label AS basename, vec_id AS scan_number, CASE WHEN vec_id % 5 = 0 THEN 1 ELSE 2 END AS ms_level,
 unnest([
 {'pos': 1, 'accession': 'MS:1000511', 'name': 'ms level', 'value': CASE WHEN vec_id % 5 = 0 THEN '1' ELSE '2' END},
 {'pos': 2, 'accession': 'MS:1000285', 'name': 'total ion current', 'value': (vec_id * 3 + 1)::VARCHAR},
 {'pos': 3, 'accession': 'MS:1000501', 'name': 'scan window lower limit', 'value': (400 + vec_id % 7)::VARCHAR},
 {'pos': 4, 'accession': 'MS:1000500', 'name': 'scan window upper limit', 'value': (1200 + vec_id % 11)::VARCHAR},
 {'pos': 5, 'accession': 'MS:1000574', 'name': 'zlib compression', 'value': ''},
 {'pos': 6, 'accession': 'MS:1000285', 'name': 'total ion current', 'value': (vec_id * 3 + 2)::VARCHAR},
 {'pos': 7, 'accession': 'MS:1000523', 'name': '64-bit float', 'value': NULL}], recursive := true)
 FROM embeddings""",
    ),
    "v_scans": (
        [],
        """SELECT 'user_' || user_id AS basename, event_id, event_id + 1 AS scan_number,
 CASE WHEN event_type = 'view' THEN 1 WHEN event_type <> 'signup' THEN 2 END AS ms_level,
 event_id * 0.5::DOUBLE AS minutes, round(value * 100)::BIGINT AS cents,
 CASE WHEN event_id % 9 <> 0 THEN 100 + event_id % 5 END AS low,
 CASE WHEN event_id % 7 <> 0 THEN 900 + event_id % 8 END AS high,
 json_extract_string(props, '$.k') AS k FROM events""",
    ),
    "v_scans_cv": (
        ["v_scans"],
        """SELECT basename, scan_number, ms_level, unnest([
 {'pos': 1, 'accession': 'MS:1000285', 'name': 'total ion current', 'value': cents::VARCHAR},
 {'pos': 2, 'accession': 'MS:1000579', 'name': 'MS1 spectrum', 'value': ''},
 {'pos': 3, 'accession': 'MS:1000927', 'name': 'ion injection time', 'value': k},
 {'pos': 4, 'accession': 'MS:1000285', 'name': 'total ion current', 'value': (cents + 1)::VARCHAR},
 {'pos': 5, 'accession': 'MS:1000501', 'name': 'scan window lower limit', 'value': low::VARCHAR},
 {'pos': 6, 'accession': 'MS:1000500', 'name': 'scan window upper limit', 'value': high::VARCHAR},
 {'pos': 7, 'accession': NULL, 'name': 'no accession', 'value': 'x'}], recursive := true) FROM v_scans""",
    ),
    "v_parents": (
        ["v_scans"],
        """SELECT basename, scan_number, ms_level, coalesce(last_value(CASE WHEN ms_level = 1 THEN scan_number END IGNORE NULLS)
 OVER (PARTITION BY basename ORDER BY event_id ROWS UNBOUNDED PRECEDING), 1) AS parent
 FROM v_scans WHERE ms_level IS NOT NULL""",
    ),
    "v_isolations": (
        [],
        """SELECT 'run_' || l_suppkey AS basename, floor(l_extendedprice) AS target,
 CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE floor(l_quantity) END AS lower_offset,
 CASE WHEN l_linenumber % 5 <> 0 THEN l_linenumber END AS upper_offset,
 floor(l_extendedprice) + 1 AS selected, round(l_tax * 100) AS energy FROM lineitem""",
    ),
    "v_headers": (
        [],
        f"""SELECT p_brand AS basename, p_partkey AS seq,
 {HEADER_GROUPS!r}[p_partkey % 4 + 1] AS "group",
 CASE WHEN p_partkey % 5 = 0 THEN 'user' ELSE 'cv' END AS kind,
 CASE WHEN p_partkey % 29 <> 1 THEN printf('MS:%07d', p_size) END AS accession,
 CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS name,
 CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS value FROM part""",
    ),
    # Worklist
    "v_worklist": (
        ["v_data", "v_repositories", "v_listing"],
        r"""SELECT w.*, lower(CASE WHEN s % 10 = 3 THEN 'massive-ftp.ucsd.edu' ELSE 'ftp' || (s % 3) || '.example.org' END) AS host,
 CASE WHEN s % 5 = 0 THEN 2121 ELSE 21 END AS port, CASE WHEN s % 4 = 0 THEN 'user' ELSE 'anonymous' END AS user,
 CASE WHEN s % 4 = 0 THEN 'p@w' ELSE '' END AS password, s % 10 = 3 AS tls
 FROM (
 SELECT f.id AS sample_id, f.repository_id, f.remote_path AS sample_path, l.path AS remote_path, l.size_bytes,
 'raw/' || f.id || '.d' || substr(l.path, length(f.remote_path) + 1) AS output_path
 FROM v_files f JOIN v_listing l ON l.repository_id = f.repository_id AND NOT l.is_dir
 AND f.remote_path = regexp_extract(l.path, '^(.*?\.d)/', 1)
 WHERE f.id IS NOT NULL AND f.remote_path LIKE '%.d'
 UNION ALL
 SELECT f.id, f.repository_id, f.remote_path, f.remote_path, l.size_bytes,
 'raw/' || f.id || regexp_extract(lower(f.remote_path), '\.(raw|mgf|mzml|wiff|wiff2)(\.(gz|zip))?$')
 FROM v_files f JOIN v_listing l ON l.repository_id = f.repository_id AND l.path = f.remote_path
 WHERE f.id IS NOT NULL AND f.remote_path NOT LIKE '%.d'
 UNION ALL
 SELECT f.id, f.repository_id, f.remote_path, l.path, l.size_bytes, 'raw/' || f.id || '.wiff.scan'
 FROM v_files f JOIN v_listing l ON l.repository_id = f.repository_id AND l.path = f.remote_path || '.scan'
 WHERE f.id IS NOT NULL AND f.remote_path LIKE '%.wiff') w
 JOIN (SELECT printf('PX%06d', s_suppkey) AS repository_id, s_suppkey AS s FROM supplier) USING (repository_id)""",
    ),
    # Packing: loads as a list, one recursion step per row and accession.
    "v_ordered": (
        ["v_data"],
        """SELECT accession, id, size_bytes, row_number() OVER (PARTITION BY accession
 ORDER BY organism || '|' || source_type || '|' || material || '|' || condition COLLATE "binary",
 size_bytes DESC NULLS FIRST, id) AS rn FROM v_data""",
    ),
    "v_packed": (
        ["v_ordered"],
        """SELECT accession, rn, split_id FROM packing WHERE rn > 0""",
    ),
}

_PACKING = """packing AS (
 SELECT accession, 0::BIGINT AS rn, [0]::BIGINT[] AS loads, -1 AS split_id FROM (SELECT DISTINCT accession FROM v_ordered)
 UNION ALL
 SELECT accession, rn,
 CASE WHEN opens THEN list_append(loads, size) ELSE list_transform(loads, lambda x, i: CASE WHEN i = slot THEN x + size ELSE x END) END,
 (CASE WHEN opens THEN len(loads) ELSE slot - 1 END)::INTEGER
 FROM (SELECT accession, o.rn, coalesce(o.size_bytes, 0) AS size, loads, list_position(loads, list_min(loads)) AS slot,
 list_min(loads) > 0 AND list_min(loads) + coalesce(o.size_bytes, 0) > 10737418240 AS opens
 FROM packing p JOIN v_ordered o USING (accession) WHERE o.rn = p.rn + 1))"""


def _sql(needs: list[str], select: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for inner in VIEWS[name][0]:
            visit(inner)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = []
    for name in order:
        if name == "v_packed":
            parts.append(_PACKING)
        parts.append(f"{name} AS MATERIALIZED ({VIEWS[name][1]})")
    if not parts:
        return select
    return ("WITH RECURSIVE " if "v_packed" in order else "WITH ") + ",\n".join(parts) + "\n" + select


def _shares(source: str, cut: str, threshold: str = "0.005::DOUBLE") -> str:
    """Fold and rank ``source`` (cut columns, label, value); ends in view ``ranked``."""
    return f"""known AS (SELECT * FROM ({source}) WHERE label IS NOT NULL),
tagged AS (SELECT *, sum(value) OVER (PARTITION BY {cut}) AS total, count(*) OVER (PARTITION BY {cut}) AS n_groups FROM known),
marked AS (SELECT *, total > 0 AND value::DOUBLE / total::DOUBLE < {threshold} AS small FROM tagged WHERE n_groups > 1),
counted AS (SELECT *, count(*) FILTER (small) OVER (PARTITION BY {cut}) AS n_small FROM marked),
folded AS (SELECT {cut}, CASE WHEN small AND n_small > 1 THEN 'Other (' || n_small || ' groups)' ELSE label END AS label,
 small AND n_small > 1 AS is_other, sum(value)::BIGINT AS value, any_value(total) AS total FROM counted GROUP BY ALL),
ranked AS (SELECT {cut}, label, value, round(100::DOUBLE * value::DOUBLE / total::DOUBLE, 6) AS pct,
 label || ' (' || printf('%.1f', 100::DOUBLE * value::DOUBLE / total::DOUBLE) || '%)' AS legend,
 (row_number() OVER (PARTITION BY {cut} ORDER BY is_other, value DESC, label))::INTEGER AS rank FROM folded)"""


def _one_cut(column: str, value: str) -> str:
    base = _sql(["v_data"], "")
    source = f"SELECT 'all' AS cut, {column} AS label, {value} AS value FROM v_data GROUP BY {column}"
    return base + ",\n" + _shares(source, "cut") + "\nSELECT label, value, pct, legend, rank FROM ranked"


def _olap() -> str:
    base = _sql(["v_data"], "")
    source = """SELECT 'global' AS scope, '' AS organism, 'repository_id' AS cut_column, 'replicates' AS measure, repository_id AS label, count(*) AS value FROM v_data GROUP BY ALL
 UNION ALL SELECT 'global', '', 'repository_id', 'size_bytes', repository_id, sum(size_bytes) FROM v_data GROUP BY ALL
 UNION ALL SELECT 'global', '', 'organism', 'replicates', organism, count(*) FROM v_data GROUP BY ALL
 UNION ALL SELECT 'global', '', 'organism', 'size_bytes', organism, sum(size_bytes) FROM v_data GROUP BY ALL"""
    for column in ("source_type", "material", "condition"):
        source += f"\n UNION ALL SELECT 'organism', organism, '{column}', 'replicates', {column}, count(*) FROM v_data GROUP BY ALL"
    return (
        base + ",\n" + _shares(source, "scope, organism, cut_column, measure")
        + "\nSELECT *, organism AS slug FROM ranked"
    )


def _quality(view: str, columns: list[str], whole_rows: bool, per: str = "") -> str:
    """One SELECT per check over ``view``."""
    key = f"{per} AS accession, " if per else ""
    group = f" GROUP BY {per}" if per else ""
    blank = r"regexp_matches({0}, '^[\s\x{{A0}}]*$')"

    def line(check: str, column: str, count: str, source: str = view, sample: str = "NULL") -> str:
        return (
            f"SELECT {key}'{check}' AS \"check\", '{column}' AS \"column\", ({count})::BIGINT AS n_bad, "
            f"{sample}::VARCHAR AS sample FROM {source}{group}"
        )

    parts = [line("no_rows", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END")]
    for c in columns:
        parts.append(line("null", c, f"count(*) FILTER ({c} IS NULL)"))
        parts.append(line("blank", c, f"count(*) FILTER ({blank.format(c)})"))
    names = ", ".join(columns)
    if whole_rows:
        parts.append(line("duplicate_row", "*", "sum(n - 1)", f"(SELECT {names}, count(*) AS n FROM {view} GROUP BY {names})"))
    by = f"{per} AS p, " if per else ""
    repeated = f"(SELECT {by}id FROM {view} WHERE id IS NOT NULL GROUP BY {'p, ' if per else ''}id HAVING count(*) > 1)"
    if per:
        parts.append(
            f"SELECT p AS accession, 'duplicate_key', 'id', count(*), min(id) FROM {repeated} GROUP BY p"
        )
    else:
        parts.append(line("duplicate_key", "id", "count(*)", repeated, "min(id)"))
    return _sql([view], " UNION ALL ".join(parts))


# Run statistics as EAV rows

def _measures_to_rows(source: str) -> str:
    """``source``: (basename, grp, measure, x). Ends in view ``eav``."""
    wanted = ", ".join(str(report) for report in _REPORTS)
    return f"""measures AS (SELECT basename, grp, measure, count(*) AS n, sum(x) AS s, min(x) AS lo, max(x) AS hi, avg(x) AS mean,
 stddev_samp(x) AS std FROM ({source}) WHERE x IS NOT NULL AND grp IS NOT NULL GROUP BY ALL),
wanted(grp, measure, stat, accession, name) AS (VALUES {wanted}),
numbers AS (SELECT basename, accession, name, grp, stat, CASE stat WHEN 'sum' THEN s WHEN 'min' THEN lo WHEN 'max' THEN hi
 WHEN 'avg' THEN mean WHEN 'std' THEN std WHEN 'seconds' THEN (hi - lo) * 60 END AS v
 FROM measures JOIN wanted USING (grp, measure)),
eav AS (SELECT basename, accession, name,
 CASE WHEN stat = 'sum' THEN v::BIGINT::VARCHAR ELSE {text3(r3("v"))} END AS value, grp AS "group", {r3("v")} AS value_num
 FROM numbers WHERE v IS NOT NULL
 UNION ALL SELECT basename, 'acquisition:type', 'Heuristic adquisition',
 CASE WHEN n >= 10 AND mean >= 4 THEN 'DIA' ELSE 'DDA' END, 'acquisition', NULL
 FROM measures WHERE grp = 'ms2' AND measure = 'isolation_window')"""


_LEVEL = "CASE ms_level WHEN 1 THEN 'ms1' WHEN 2 THEN 'ms2' END"


def _pairs(*pairs: tuple[str, str, str]) -> str:
    items = ", ".join(f"{{'grp': {g}, 'measure': '{m}', 'x': ({x})::DOUBLE}}" for g, m, x in pairs)
    return f"unnest([{items}], recursive := true)"


_COUNTS = [
    ("'summary'", "spectra", "1"),
    ("'ms1'", "spectra", "(ms_level IS NOT DISTINCT FROM 1)::INTEGER"),
    ("'ms2'", "spectra", "(ms_level IS NOT DISTINCT FROM 2)::INTEGER"),
]
_SCAN_MEASURES = "SELECT basename, " + _pairs(
    *_COUNTS,
    ("'summary'", "scan_time", "minutes"),
    ("'summary'", "tic", "cents + 1"),
    (_LEVEL, "tic", "cents + 1"),
    (_LEVEL, "mz_low", "low"),
    (_LEVEL, "mz_high", "high"),
    (_LEVEL, "mz_window", "high - low"),
    ("'summary'", "peak_count", "0"),
    (_LEVEL, "peak_count", "0"),
) + " FROM v_scans"
_ISOLATION_MEASURES = "SELECT basename, " + _pairs(
    ("'summary'", "spectra", "1"),
    ("'ms1'", "spectra", "0"),
    ("'ms2'", "spectra", "1"),
    ("'summary'", "peak_count", "0"),
    ("'ms2'", "peak_count", "0"),
    ("'ms2'", "isolation_target_mz", "target"),
    ("'ms2'", "isolation_lower", "lower_offset"),
    ("'ms2'", "isolation_upper", "upper_offset"),
    ("'ms2'", "isolation_window", "lower_offset + upper_offset"),
    ("'summary'", "precursor_mz", "selected"),
    ("'ms2'", "collision_energy", "energy"),
) + " FROM v_isolations"


def _spectra_measures(basename: str = "basename") -> str:
    """Measures of the spectra view, run by run."""
    peaks = f"SELECT {basename} AS basename, " + _pairs(
        *_COUNTS,
        ("'summary'", "scan_time", "scan_number * 0.125"),
        ("'summary'", "tic", "scan_number * 3 + 2"),
        (_LEVEL, "tic", "scan_number * 3 + 2"),
        (_LEVEL, "mz_low", "400 + scan_number % 7"),
        (_LEVEL, "mz_high", "1200 + scan_number % 11"),
        (_LEVEL, "mz_window", "(1200 + scan_number % 11) - (400 + scan_number % 7)"),
        ("'summary'", "peak_count", "peak_count"),
        (_LEVEL, "peak_count", "peak_count"),
        *[("'summary'", f"peak_intensity_{s}", f"int_{s}") for s in ("min", "max", "avg", "median")],
        *[("'summary'", f"peak_separation_{s}", f"sep_{s}") for s in ("min", "max", "avg", "median")],
    ) + " FROM v_peak_stats"
    precursors = f"SELECT {basename} AS basename, " + _pairs(
        ("'ms2'", "isolation_target_mz", "400 + shift + scan_number % 300"),
        ("'ms2'", "isolation_lower", "1 + scan_number % 4"),
        ("'ms2'", "isolation_upper", "2.5"),
        ("'ms2'", "isolation_window", "1 + scan_number % 4 + 2.5"),
        ("'summary'", "precursor_mz", "401 + shift + scan_number % 300"),
        ("'ms2'", "collision_energy", "20 + scan_number % 15"),
    ) + """ FROM (SELECT *, unnest(CASE WHEN scan_number % 3 = 0 THEN [0, 50] ELSE [0] END) AS shift
 FROM v_spectra WHERE ms_level = 2)"""
    return f"{peaks} UNION ALL {precursors}"


def _run_rows(needs: list[str], source: str, select: str) -> str:
    return _sql(needs, "") + ",\n" + _measures_to_rows(source) + "\n" + select


def _scan_eav(cv: str, level: int, stats: str, parents: str) -> str:
    technical = ", ".join(f"'{t}'" for t in _TECHNICAL)
    given = f"""SELECT basename, scan_number, accession, arg_min(name, pos) AS name, arg_min(CASE WHEN value IS NULL THEN '<null>' ELSE value END, pos) AS value
 FROM {cv} WHERE ms_level = {level} AND accession IS NOT NULL AND accession NOT IN ({technical}) GROUP BY ALL"""
    given = f"SELECT basename, scan_number, accession, name, nullif(value, '<null>') AS value FROM ({given})"
    parts = [given, stats]
    if level == 2:
        parts.append(
            f"SELECT basename, scan_number, 'parent:ms1', 'Parent MS1 scan', parent::VARCHAR FROM {parents} WHERE ms_level = 2"
        )
    return " UNION ALL ".join(parts)


_NO_PEAKS = (
    "SELECT basename, scan_number, 'peak_count', 'Number of peaks on the scan', '0' FROM v_scans WHERE ms_level = {0}"
)


def _peak_rows(level: int) -> str:
    lines = [
        ("peak_intensity:min", "Min Intensity", "int_min"),
        ("peak_intensity:max", "Max Intensity", "int_max"),
        ("peak_intensity:avg", "Average Intensity", "int_avg"),
        ("peak_intensity:median", "Median Intensity", "CASE WHEN peak_count > 3 THEN int_median END"),
        ("peak_separation:min", "Min Separantion of peaks", "sep_min"),
        ("peak_separation:max", "Max Separantion of peaks", "sep_max"),
        ("peak_separation:avg", "Avg Separantion of peaks", "sep_avg"),
        ("peak_separation:median", "Median Separantion of peaks", "CASE WHEN n_gaps > 3 THEN sep_median END"),
    ]
    rows = ", ".join(
        f"{{'accession': '{a}', 'name': '{n}', 'value': {text3(r3(x))}}}" for a, n, x in lines
    )
    return (
        f"SELECT * FROM (SELECT basename, scan_number, unnest([{{'accession': 'peak_count', "
        f"'name': 'Number of peaks on the scan', 'value': peak_count::VARCHAR}}, {rows}], recursive := true) "
        f"FROM v_peak_stats WHERE ms_level = {level}) WHERE value IS NOT NULL"
    )


_BIN = "least(floor((x - 1::DOUBLE) / 0.08::DOUBLE)::INTEGER, 99)"
_PERCENT_LIST = "[" + ", ".join(f"{p!r}::DOUBLE" for p in _PERCENTAGES) + "]"
_LINEITEM = [
    ("l_orderkey", "bigint", "INT64"), ("l_partkey", "bigint", "INT64"), ("l_suppkey", "bigint", "INT64"),
    ("l_linenumber", "int", "INT32"), ("l_quantity", "double", "DOUBLE"), ("l_extendedprice", "double", "DOUBLE"),
    ("l_discount", "double", "DOUBLE"), ("l_tax", "double", "DOUBLE"), ("l_returnflag", "string", "BYTE_ARRAY"),
    ("l_linestatus", "string", "BYTE_ARRAY"), ("l_shipdate", "timestamp_ntz", "INT64"),
]
_INSERT_REPLICATES = """'INSERT INTO replicates (id, organism, source_type, material, condition, sample_group) VALUES (''' || id || ''', '''
 || organism || ''', ''' || source_type || ''', ''' || material || ''', ''' || condition || ''', ''' || sample_group || ''');'"""
_INSERT_REPOSITORIES = (
    "'INSERT INTO repositories (id, url, doi) VALUES (''' || id || ''', ''' || url || ''', ''' || doi || ''');'"
)
_TABLE_TEXT = {
    "repositories": "    id TEXT NOT NULL,\n    url TEXT NOT NULL,\n    doi TEXT NOT NULL",
    "files": (
        "    id TEXT,\n    repository_id TEXT NOT NULL,\n    remote_path TEXT NOT NULL,\n"
        "    size_bytes BIGINT,\n    scan_timestamp TIMESTAMP"
    ),
    "replicates": (
        "    id TEXT NOT NULL,\n    organism TEXT NOT NULL,\n    source_type TEXT NOT NULL,\n"
        "    material TEXT NOT NULL,\n    condition TEXT NOT NULL,\n    sample_group TEXT NOT NULL"
    ),
}


def _frame_lines(names: tuple[str, ...] = ("repositories", "replicates")) -> str:
    rows = [(-1, 0, "-- generated by massloom"), (-1, 1, "BEGIN;"), (-1, 3, "")]
    for at, name in enumerate(names):
        body = _TABLE_TEXT[name]
        create = f"CREATE TABLE IF NOT EXISTS {name} (\n{body}\n);\n"
        rows += [(at, 0, f"-- table: {name}"), (at, 1, create), (at, 3, "")]
    rows.append((len(names), 0, "COMMIT;"))
    values = ", ".join(f"({t}, {s}, '{line}')" for t, s, line in rows)
    return f"SELECT * FROM (VALUES {values}) AS t(table_ord, section, line)"


def _metrics() -> str:
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    parts = ["SELECT 'orders' AS dataset_id, 'row_count' AS metric_name, count(*)::VARCHAR AS metric_value, 'count' AS metric_type FROM orders"]
    for c in columns:
        for stat, call in (("min", "min"), ("max", "max"), ("mean", "avg")):
            parts.append(
                f"SELECT 'orders', '{c}:{stat}', {text3(r3(f'{call}({c}::DOUBLE)'))}, '{stat}' FROM orders"
            )
    return " UNION ALL ".join(parts)


def _mzml_run_metadata() -> str:
    run = "basename"
    runs = f"SELECT DISTINCT {run} AS basename FROM v_spectra"
    header = [
        ("'info:id'", "'id'", "basename", "'file_metadata'"),
        ("'info:version'", "'version'", "'1.1.0'", "'file_metadata'"),
        ("'info:startTimeStamp'", "'startTimeStamp'", "'2024-01-01T00:00:00Z'", "'file_metadata'"),
        ("'MS:1000580'", "'MSn spectrum'", "''", "'file_description'"),
        ("'user:file_description:origin'", "'origin'", "'fixture'", "'file_description'"),
        ("'MS:1000031'", "'instrument model'", "'instrument model'", "'instrument'"),
        ("'user:instrument:user_param'", "'user_param'", "'anonymous'", "'instrument'"),
        ("'MS:1000544'", "'MS:1000544'", "'to mzML'", "'data_processing'"),
    ]
    lines = " UNION ALL ".join(
        f"SELECT basename, {a} AS accession, {n} AS name, {v} AS value, {g} AS \"group\" FROM ({runs})"
        for a, n, v, g in header
    )
    return _run_rows(
        ["v_peak_stats"], _spectra_measures(run),
        f'SELECT basename, accession, name, value, "group" FROM eav UNION ALL {lines}',
    )


ORACLE: dict[str, str] = {
    "organism_size_share": _one_cut("organism", "sum(size_bytes)::BIGINT"),
    "organism_count_share": _one_cut("organism", "count(*)"),
    "repo_size_share": _one_cut("repository_id", "sum(size_bytes)::BIGINT"),
    "repo_count_share": _one_cut("repository_id", "count(*)"),
    "olap_cuts": _olap(),
    "dir_rollup": _sql(["v_items"], "SELECT * FROM v_items"),
    "wiff_fused_sizes": _sql(["v_fused"], "SELECT * FROM v_fused"),
    "files_inventory": _sql(["v_files"], "SELECT * FROM v_files"),
    "samples_summary": _sql(
        ["v_files"],
        f"""SELECT repository_id, id, NULL::VARCHAR AS organism, NULL::VARCHAR AS source_type, NULL::VARCHAR AS material,
 NULL::VARCHAR AS condition, printf('sample-%04d', row_number() OVER (PARTITION BY repository_id ORDER BY remote_path)) AS sample_group,
 size_bytes, {human("size_bytes")} AS size, remote_path FROM v_files WHERE id IS NOT NULL""",
    ),
    "other_summary": _sql(
        ["v_files"],
        f"SELECT repository_id, {human('size_bytes')} AS size, size_bytes, remote_path FROM v_files WHERE id IS NULL",
    ),
    "human_sizes": _sql(["v_listing"], f"SELECT path, {human('size_bytes * size_bytes')} AS size FROM v_listing"),
    "sample_names": _sql(
        ["v_listing"],
        rf"""SELECT path, regexp_matches(name, '{_SAMPLE}') AS is_sample, repository_id || '_' ||
 regexp_replace(regexp_replace(name, '\.(gz|zip|7z|bz2|xz)$', ''), '\.(raw|d|mgf|mzml|wiff|wiff2)$', '') AS sample_id,
 'x' || CASE WHEN regexp_matches(name, '{_SAMPLE}') THEN regexp_extract(name, '{_SAMPLE}')
 ELSE regexp_extract(name, '\.(gz|zip|7z|bz2|xz)$') END AS output_name,
 regexp_replace(string_split(path, '/')[-1], '\.mz(ML|ml)(\.gz)?$', '') AS run_name
 FROM (SELECT *, lower(string_split(path, '/')[-1]) AS name FROM v_listing)""",
    ),
    "ftp_url_parts": """SELECT printf('PX%06d', s) AS id,
 CASE WHEN s % 10 = 3 THEN 'massive-ftp.ucsd.edu' ELSE 'ftp' || (s % 3) || '.example.org' END AS host,
 CASE WHEN s % 5 = 0 THEN 2121 ELSE 21 END AS port, CASE WHEN s % 4 = 0 THEN 'user' ELSE 'anonymous' END AS user,
 CASE WHEN s % 4 = 0 THEN 'p@w' ELSE '' END AS password,
 CASE WHEN s % 11 = 7 THEN '/' ELSE '/data/' || s END AS path, s % 10 = 3 AS tls FROM (SELECT s_suppkey AS s FROM supplier)""",
    "dq_replicates": _quality(
        "v_annotations", ["id", "organism", "source_type", "material", "condition", "sample_group"], False
    ),
    "dq_repositories": _quality("v_manifest", ["id", "url", "doi"], True),
    "dq_by_file": _quality(
        "v_annotations", ["id", "organism", "source_type", "material", "condition", "sample_group"], False,
        "coalesce(organism, 'none')",
    ),
    "duplicate_ids": _sql(
        ["v_annotations"], "SELECT id, count(*) AS n FROM v_annotations GROUP BY id HAVING count(*) > 1"
    ),
    "replicates_missing_size": _sql(
        ["v_data"],
        """SELECT id || '_absent' AS id, 0::BIGINT AS n_files FROM v_replicates WHERE sample_group LIKE '%7'
 UNION ALL SELECT id, count(*) FROM v_files WHERE id IN (SELECT id FROM v_replicates WHERE sample_group NOT LIKE '%7')
 GROUP BY id HAVING count(*) > 1""",
    ),
    "replicate_id_list": _sql(["v_annotations"], "SELECT id FROM v_annotations WHERE id IS NOT NULL"),
    "sample_worklist": _sql(["v_worklist"], "SELECT * FROM v_worklist"),
    "worklist_status": _sql(
        ["v_worklist"],
        """SELECT sample_id, remote_path, output_path, size_bytes,
 CASE length(remote_path) % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'done' WHEN 2 THEN 'restart' ELSE 'resume' END AS status,
 CASE WHEN length(remote_path) % 4 = 3 THEN size_bytes // 2 ELSE 0 END AS "offset" FROM v_worklist""",
    ),
    "filtered_replicates": _sql(
        ["v_replicates"],
        "SELECT * FROM v_replicates WHERE organism IN ('human', 'mouse', 'yeast') AND source_type = 'BUILDING'",
    ),
    "union_relaxed_tables": """SELECT p_partkey AS key, p_size::DOUBLE AS amount, p_name AS name, NULL::INTEGER AS nation FROM part
 UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier""",
    "incremental_new_files": _sql(
        ["v_files", "v_repositories"],
        """SELECT repository_id, remote_path, size_bytes FROM v_files
 WHERE repository_id NOT IN (SELECT id FROM v_repositories WHERE url LIKE '%2121%')""",
    ),
    "batch_splits": _sql(
        ["v_packed"],
        """SELECT accession, id, size_bytes, split_id, printf('%s_%03d', accession, split_id) AS split
 FROM v_packed JOIN v_ordered USING (accession, rn)""",
    ),
    "split_totals": _sql(
        ["v_packed"],
        """SELECT accession, split_id, count(*) AS n_rows, sum(size_bytes)::BIGINT AS total_bytes
 FROM v_packed JOIN v_ordered USING (accession, rn) GROUP BY ALL""",
    ),
    "split_fill": _sql(
        ["v_ordered"],
        """SELECT accession, id, size_bytes, split_id, printf('%s_%03d', accession, split_id) AS split FROM (SELECT *,
 ((sum(size_bytes) OVER (PARTITION BY accession ORDER BY rn) - size_bytes) // 10737418240)::INTEGER AS split_id FROM v_ordered)""",
    ),
    "sql_insert_lines": _sql(
        ["v_replicates", "v_repositories"],
        f"""SELECT 0 AS table_ord, 2 AS section, {_INSERT_REPOSITORIES} AS line FROM v_repositories
 UNION ALL SELECT 1, 2, 'INSERT INTO files (id, repository_id, remote_path, size_bytes, scan_timestamp) VALUES ('
 || coalesce('''' || id || '''', 'NULL') || ', ''' || repository_id || ''', ''' || remote_path || ''', ' || size_bytes
 || ', ''2024-01-01 00:00:00'');' FROM v_files
 UNION ALL SELECT 2, 2, {_INSERT_REPLICATES} FROM v_replicates
 UNION ALL {_frame_lines(("repositories", "files", "replicates"))}""",
    ),
    "sql_dump_filtered": _sql(
        ["v_replicates", "v_repositories"],
        f"""SELECT 0 AS table_ord, 2 AS section, {_INSERT_REPOSITORIES} AS line FROM v_repositories
 UNION ALL SELECT 1, 2, {_INSERT_REPLICATES} FROM v_replicates WHERE organism IN ('pig', 'rat') AND condition = '1-URGENT'
 UNION ALL {_frame_lines()}""",
    ),
    "dump_requests": _sql(
        ["v_replicates", "v_repositories"],
        f"""SELECT 'first' AS request, {_INSERT_REPOSITORIES} AS line FROM v_repositories
 UNION ALL SELECT 'first', {_INSERT_REPLICATES} FROM v_replicates WHERE organism IN ('pig', 'rat') AND condition = '1-URGENT'
 UNION ALL SELECT 'second', id || '|' || url || '|' || doi FROM v_repositories""",
    ),
    "sql_typed_literals": """SELECT 0 AS table_ord, 2 AS section,
 'INSERT INTO orders (o_orderkey, o_custkey, note, done, half, stamp) VALUES (' || o_orderkey || ', ' || o_custkey || ', '
 || CASE WHEN o_orderkey % 3 <> 0 THEN '''it''''s ''''' || o_orderpriority || '''' ELSE 'NULL' END || ', '
 || CASE WHEN o_orderstatus = 'F' THEN 'TRUE' ELSE 'FALSE' END || ', '
 || CASE WHEN o_orderkey % 5 = 0 THEN '''NaN''' ELSE (o_orderkey * 0.5::DOUBLE)::VARCHAR END || ', '''
 || CASE WHEN o_orderkey % 2 = 0 THEN strftime(make_timestamp(o_orderkey * 1500000), '%Y-%m-%d %H:%M:%S')
 ELSE strftime(make_timestamp(o_orderkey * 1500000), '%Y-%m-%d %H:%M:%S.%f') END || ''');' AS line FROM orders""",
    "run_metadata_stats": _run_rows(["v_scans"], _SCAN_MEASURES, "SELECT * FROM eav"),
    "precursor_stats": _run_rows(
        ["v_isolations"], _ISOLATION_MEASURES, "SELECT * FROM eav WHERE accession <> 'acquisition:type'"
    ),
    "acquisition_type": _run_rows(
        ["v_isolations"], _ISOLATION_MEASURES, "SELECT basename, value FROM eav WHERE accession = 'acquisition:type'"
    ),
    "run_peak_stats": _run_rows(["v_peak_stats"], _spectra_measures(), "SELECT * FROM eav"),
    "header_eav_dedupe": _sql(
        ["v_headers"],
        """SELECT basename, accession, name, value, "group" FROM (SELECT *, row_number() OVER (PARTITION BY basename, accession
 ORDER BY "group", seq) AS rn FROM (SELECT basename, seq, "group",
 CASE kind WHEN 'cv' THEN h.accession ELSE 'user:' || "group" || ':' || coalesce(name, 'user_param') END AS accession,
 CASE kind WHEN 'cv' THEN coalesce(name, term, h.accession) ELSE coalesce(name, 'user_param') END AS name,
 CASE kind WHEN 'cv' THEN coalesce(value, name) ELSE value END AS value
 FROM v_headers h LEFT JOIN (SELECT DISTINCT printf('MS:%07d', p_size) AS accession, 'term ' || p_size AS term FROM part
 WHERE p_size <= 25) t ON h.accession = t.accession WHERE kind <> 'cv' OR h.accession IS NOT NULL)) WHERE rn = 1""",
    ),
    "scan_eav_ms1": _sql(["v_scans_cv"], _scan_eav("v_scans_cv", 1, _NO_PEAKS.format(1), "v_parents")),
    "scan_eav_ms2": _sql(["v_scans_cv", "v_parents"], _scan_eav("v_scans_cv", 2, _NO_PEAKS.format(2), "v_parents")),
    "parent_ms1": _sql(
        ["v_parents"], "SELECT basename, scan_number, parent AS parent_scan FROM v_parents WHERE ms_level = 2"
    ),
    "scan_peak_stats": _sql(
        ["v_peak_stats"],
        "SELECT basename, scan_number, peak_count::INTEGER AS peak_count, "
        + ", ".join(
            f"{r3(x)} AS {name}"
            for name, x in {
                "int_min": "int_min", "int_max": "int_max", "int_avg": "int_avg",
                "int_median": "CASE WHEN peak_count > 3 THEN int_median END",
                "sep_min": "sep_min", "sep_max": "sep_max", "sep_avg": "sep_avg",
                "sep_median": "CASE WHEN n_gaps > 3 THEN sep_median END",
            }.items()
        )
        + " FROM v_peak_stats",
    ),
    "scan_metadata_ms2": _sql(
        ["v_spectra_cv", "v_peak_stats"],
        _scan_eav(
            "v_spectra_cv", 2, _peak_rows(2),
            """(SELECT basename, scan_number, ms_level, coalesce(last_value(CASE WHEN ms_level = 1 THEN scan_number END IGNORE NULLS)
 OVER (PARTITION BY basename ORDER BY scan_number ROWS UNBOUNDED PRECEDING), 1) AS parent FROM v_spectra)""",
        ),
    ),
    "intensity_histogram": _sql(
        ["v_spectra"],
        f"""SELECT basename, scan_number, bin, round(1 + 0.08::DOUBLE * bin, 4) AS lo, round(1 + 0.08::DOUBLE * bin + 0.08::DOUBLE, 4) AS hi,
 n::INTEGER AS n FROM (SELECT basename, scan_number, {_BIN} AS bin, count(*) AS n
 FROM (SELECT basename, scan_number, unnest(logs) AS x FROM v_spectra) WHERE x >= 1 AND x < 9 GROUP BY ALL)""",
    ),
    "intensity_histogram_wide": _sql(
        ["v_spectra"],
        """SELECT basename, scan_number, ms_level, len(logs)::INTEGER AS peaks, round(list_min(mz), 5) AS min_mz, round(list_max(mz), 5) AS max_mz,
 round(coalesce(list_min(logs), 0), 5) AS min_int, round(coalesce(list_max(logs), 0), 5) AS max_int,
 len(list_filter(logs, lambda x: x < 1))::INTEGER AS under, len(list_filter(logs, lambda x: x >= 9))::INTEGER AS over, """
        + ", ".join(f"len(list_filter(bins, lambda b: b = {b}))::INTEGER AS ibin_{b:02d}" for b in range(100))
        + " FROM (SELECT *, list_transform(list_filter(logs, lambda x: x >= 1 AND x < 9), lambda x: "
        + _BIN + ") AS bins FROM v_spectra)",
    ),
    "intensity_quantiles": _sql(
        ["v_spectra"],
        f"""SELECT basename, scan_number, quantile, round(percent, 6) AS percent,
 round(CASE WHEN slot + 1 < n THEN (1 - share) * s[slot + 1] + share * s[slot + 2] ELSE s[n] END, 6) AS value
 FROM (SELECT *, floor(pos)::INTEGER AS slot, pos - floor(pos) AS share FROM (SELECT *, (n - 1) / 100.0::DOUBLE * percent AS pos
 FROM (SELECT basename, scan_number, list_sort(logs) AS s, len(logs) AS n,
 unnest(range(101))::INTEGER AS quantile, unnest({_PERCENT_LIST}) AS percent FROM v_spectra WHERE len(logs) > 0)))""",
    ),
    "column_profile": " UNION ALL ".join(
        f"SELECT 'lineitem' AS dataset_id, '{c}' AS column_name, {i} AS ordinal_position, '{t}' AS logical_type, "
        f"'{p}' AS physical_type, count(DISTINCT {c}) AS distinct_count, count(*) - count({c}) AS null_count FROM lineitem"
        for i, (c, t, p) in enumerate(_LINEITEM, 1)
    ),
    "dataset_metrics": _metrics(),
    "mzml_scan": _sql(
        ["v_spectra"],
        """SELECT basename, scan_number AS scan_seq, scan_number, ms_level,
 round(scan_number * 0.125::DOUBLE, 4) AS scan_time_min, len(mz)::INTEGER AS peaks,
 round(coalesce(list_min(mz), 0), 5) AS min_mz, round(coalesce(list_max(mz), 0), 5) AS max_mz,
 round(coalesce(list_sum(mz), 0), 3) AS sum_mz, len(mz)::INTEGER AS intensities,
 (CASE WHEN ms_level = 1 THEN 14 WHEN scan_number % 3 = 0 THEN 24 ELSE 19 END)::INTEGER AS n_params,
 (CASE WHEN ms_level = 1 THEN 0 WHEN scan_number % 3 = 0 THEN 2 ELSE 1 END)::INTEGER AS n_precursors
 FROM (SELECT * REPLACE (CASE WHEN scan_number % 5 = 3 THEN list_transform(mz, lambda x: floor(x)) ELSE mz END AS mz)
 FROM v_spectra)""",
    ),
    "mzml_run_metadata": _mzml_run_metadata(),
    "table_shapes": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset_id, '{name}.parquet' AS bronze_path, 'parquet' AS format, count(*) AS row_count, "
        f"{columns} AS column_count FROM {name}"
        for name, columns in (("orders", 6), ("lineitem", 11), ("events", 6))
    ),
    "stored_files": "SELECT o_orderstatus AS status, count(*) AS n_rows, true AS described FROM orders GROUP BY 1",
    "stream_ingest": _sql(["v_replicates"], "SELECT * FROM v_replicates"),
    "annotations_mixed_headers": _sql(
        ["v_replicates"], "SELECT * EXCLUDE (accession) FROM v_replicates WHERE ascii(right(id, 1)) % 4 <> 3"
    ),
    "annotations_header_faults": "SELECT 'missing_column' AS check, 'material' AS column, 3 AS n_files",
    "sink_split_files": _sql(
        ["v_packed", "v_replicates"],
        """SELECT id, organism, printf('%s_%03d', accession, split_id) AS split
 FROM v_packed JOIN v_ordered USING (accession, rn) JOIN v_replicates USING (accession, id)""",
    ),
    "stream_replace": _sql(
        ["v_replicates"],
        """SELECT t.* EXCLUDE (s, kind) REPLACE (CASE WHEN kind = 'A' AND s % 3 = 0 THEN 'fixed' ELSE condition END AS condition),
 way FROM (
 SELECT *, substr(accession, 3)::INTEGER AS s, 'A' AS kind FROM v_replicates UNION ALL
 SELECT * REPLACE ('B_' || accession AS accession), substr(accession, 3)::INTEGER, 'B' FROM v_replicates
 WHERE substr(accession, 3)::INTEGER % 2 = 1) t, (VALUES ('one by one'), ('at once')) AS ways(way)""",
    ),
    "stream_runs": _sql(["v_spectra"], "SELECT basename, scan_number, ms_level, len(mz)::INTEGER AS peaks FROM v_spectra"),
    "sink_runs": _sql(
        ["v_scans"],
        """SELECT basename, event_id AS scan_seq, scan_number, CASE WHEN basename LIKE '%1%' THEN 9 ELSE ms_level END AS ms_level
 FROM v_scans""",
    ),
    "sink_append_new": _sql(
        ["v_scans"],
        "SELECT basename, event_id AS scan_seq, CASE WHEN basename LIKE '%1%' THEN ms_level ELSE 9 END AS ms_level FROM v_scans",
    ),
    "sink_partitioned": _sql(
        ["v_replicates"],
        """SELECT * REPLACE (CASE WHEN substr(accession, 3)::INTEGER % 3 = 0 THEN 'fixed' ELSE condition END AS condition)
 FROM v_replicates""",
    ),
    "worklist_faults": _sql(
        ["v_replicates", "v_files", "v_repositories"],
        """SELECT 'file' AS lookup, id AS key, n AS n_rows FROM (
 SELECT DISTINCT CASE WHEN right(sample_group, 1) = '7' THEN id || '_absent' ELSE id END AS id FROM v_replicates) w
 LEFT JOIN (SELECT id, sum(CASE WHEN right(id, 2) = '_5' THEN 2 ELSE 1 END)::BIGINT AS m FROM v_files GROUP BY id) f USING (id),
 LATERAL (SELECT coalesce(m, 0) AS n) WHERE n <> 1
 UNION ALL
 SELECT 'repository', repository_id, CASE k % 6 WHEN 1 THEN 0 ELSE 2 END FROM (
 SELECT DISTINCT repository_id, substr(repository_id, 3)::INTEGER AS k FROM v_files JOIN (
 SELECT id FROM v_replicates WHERE right(sample_group, 1) <> '7') USING (id)) WHERE k % 6 IN (1, 2)""",
    ),
    "csv_ingest": _sql(["v_repositories"], "SELECT * FROM v_repositories"),
}
ORACLE["batch_splits_chained"] = ORACLE["batch_splits"]
