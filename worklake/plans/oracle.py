"""Independent DuckDB SQL for every query key.

Written from the relational test tables directly — flat columns are computed
from orders/customer/lineitem without building or flattening nested works —
so the Spark side and this side share no logic.
"""

from __future__ import annotations

from worklake.plans import derived as D
from worklake.schema import FLAT_COLUMNS

_LOAD = f"TIMESTAMP '{D.LOAD_TS:%Y-%m-%d %H:%M:%S}'"
_LOAD2 = f"TIMESTAMP '{D.LOAD2_TS:%Y-%m-%d %H:%M:%S}'"
_SUB_URL = "https://openalex.org/subfields/"


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


# Relational base: one row per order with its customer geography and
# line-item aggregates, then the planted copies (k % 19 = 0, copy 1).
_BASE = """
li AS (
  SELECT l_orderkey, COUNT(*) AS n_auth, CAST(SUM(l_quantity) AS INTEGER) AS qty,
         LIST_SORT(LIST(DISTINCT n_name)) AS countries
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         c.c_custkey, c.c_name, c.c_mktsegment, n.n_nationkey, n.n_name, r.r_name,
         li.n_auth, li.qty, li.countries
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
raw AS (
  SELECT 'part-0' AS _src, k AS _pos, 0 AS cp, * FROM base
  UNION ALL
  SELECT 'part-1' AS _src, k AS _pos, 1 AS cp, * FROM base WHERE k % 19 = 0),
rawf AS (
  SELECT *,
    CASE WHEN k % 211 = 0 THEN NULL WHEN k % 223 = 0 THEN 'https://openalex.org/X' || k
         ELSE 'https://openalex.org/W' || k END AS raw_id,
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN ''
         ELSE c_name || ' / ' || k || CASE WHEN cp = 1 THEN ' (dup)' ELSE '' END END AS raw_title,
    CASE WHEN k % 303 = 0 THEN NULL ELSE 'Order ' || k END AS raw_display_name,
    CASE WHEN k % 307 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS pub_date
  FROM raw)"""


def _page(where: str, start, end) -> str:
    """All tables of a report page as (report, label, measure, value)."""
    def counts(report, label, source, limit=""):
        return (f"SELECT * FROM (SELECT '{report}' AS report, CAST({label} AS VARCHAR) AS label, 'papers' AS measure, "
                f"CAST(COUNT(*) AS DOUBLE) AS value FROM {source} GROUP BY 2 ORDER BY 4 DESC, 2 {limit})")

    def measures(report, source, label, **columns):
        return [f"SELECT '{report}', {label}, '{name}', ROUND(CAST({sql} AS DOUBLE), 4) FROM {source}" for name, sql in columns.items()]

    parts = [
        counts("by_date", "publication_date", "p"),
        counts("topics", "primary_topic_name", "(SELECT * FROM p WHERE primary_topic_name IS NOT NULL)", "LIMIT 10"),
        counts("oa_status", "COALESCE(oa_status, 'unknown')", "p"),
        counts("venues", "COALESCE(source_name, 'Unknown')", "p", "LIMIT 10"),
        counts("countries", "country", "p, UNNEST(COALESCE(country_codes, [])) AS t(country)", "LIMIT 10"),
        *measures("kpis", "p", "''", publications="COUNT(*)", oa_pct="COALESCE(AVG(CAST(is_oa AS INTEGER)) * 100, 0)",
                  median_citations="COALESCE(MEDIAN(cited_by_count), 0)", topics="COUNT(DISTINCT primary_topic_name)",
                  avg_authors="COALESCE(AVG(author_count), 0)"),
        *measures("trend", "s", "CAST(publication_date AS VARCHAR)", daily_papers="n",
                  avg_7d="round_even((SELECT AVG(n) FROM s b WHERE b.publication_date BETWEEN s.publication_date - 6 AND s.publication_date), 1)"),
        *[m + " HAVING SUM(n) > 0" for m in measures(
            "trend_kpis", "s", "''", total="SUM(n)", avg_per_day="AVG(n)", peak_count="MAX(n)",
            peak_day="(SELECT publication_date - DATE '1970-01-01' FROM s ORDER BY n DESC, publication_date LIMIT 1)")]]
    return f""",
p AS (SELECT * FROM papers WHERE {where}),
s AS (SELECT CAST(d AS DATE) AS publication_date, (SELECT COUNT(*) FROM p WHERE p.publication_date = CAST(d AS DATE)) AS n
      FROM generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY) AS t(d))
""" + "\nUNION ALL ".join(parts)


def _flat_select(snapshot: int = 1) -> str:
    doi = "'https://doi.org/10.5555/' || k" if snapshot == 1 else "CAST(NULL AS VARCHAR)"
    cited = ("CASE WHEN k % 113 = 0 THEN -1 ELSE COALESCE(qty, 0) END" if snapshot == 1
             else "CASE WHEN k % 113 = 0 THEN 0 ELSE COALESCE(qty + 1, 0) END")
    return f"""
  SELECT _src, _pos,
    CASE WHEN k % 211 = 0 THEN NULL WHEN k % 223 = 0 THEN 'X' || k ELSE 'W' || k END AS openalex_id,
    {doi} AS doi,
    COALESCE(NULLIF(raw_title, ''), raw_display_name) AS title,
    CASE WHEN k % 59 <> 0 THEN 'https://example.org/' || k END AS landing_page_url,
    CASE WHEN o_orderstatus = 'F' THEN 'https://oa.example.org/' || k END AS oa_url,
    pub_date AS publication_date,
    CAST(YEAR(o_orderdate) + CASE WHEN k % 97 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS publication_year,
    CASE k % 4 WHEN 0 THEN 'article' WHEN 1 THEN 'review' WHEN 2 THEN 'preprint' ELSE 'dataset' END AS work_type,
    CASE WHEN n_nationkey % 5 <> 0 THEN 'l' || n_nationkey END AS language,
    o_orderstatus <> 'O' AS is_oa,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'gold' WHEN '2' THEN 'green'
         WHEN '3' THEN 'hybrid' WHEN '5' THEN 'closed' END AS oa_status,
    k % 29 = 0 AS is_retracted,
    k % 5 <> 0 AND k % 2 = 0 AS has_fulltext,
    CASE WHEN k % 61 = 0 THEN '' ELSE 'T' || n_nationkey END AS primary_topic_id,
    CASE WHEN k % 53 = 0 THEN NULL ELSE n_name END AS primary_topic_name,
    CAST(CAST(k % 1000 AS DECIMAL(9,5)) / 1000 AS DECIMAL(6,5)) AS primary_topic_score,
    c_mktsegment AS subfield_id,
    c_mktsegment AS subfield_name,
    r_name AS field_name,
    CASE WHEN n_nationkey % 2 = 0 THEN 'Domain ' || r_name END AS domain_name,
    CASE WHEN k % 59 <> 0 THEN 'S' || c_custkey END AS source_id,
    CASE WHEN k % 59 <> 0 AND k % 31 <> 0 THEN c_name END AS source_name,
    CASE WHEN k % 59 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'journal' ELSE 'repository' END END AS source_type,
    CASE WHEN k % 59 <> 0 THEN r_name END AS host_organization,
    CASE WHEN k % 59 <> 0 AND k % 3 <> 1 THEN k % 3 = 0 END AS is_core_source,
    CAST({cited} AS INTEGER) AS cited_by_count,
    CASE WHEN k % 401 <> 0 THEN CAST(FLOOR(o_totalprice / 10) / 10000 AS DECIMAL(8,4)) END AS fwci,
    CAST(FLOOR(o_totalprice / 2) / 200000 AS DECIMAL(8,6)) AS citation_percentile,
    o_totalprice > 480000 AS is_top_1_percent,
    CASE WHEN k % 7 = 0 THEN NULL ELSE o_totalprice > 450000 END AS is_top_10_percent,
    CAST(k % 50 AS INTEGER) AS referenced_works_count,
    CAST(COALESCE(n_auth, 0) AS SMALLINT) AS author_count,
    CAST(COALESCE(LEN(countries), 0) + CASE WHEN k % 89 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS countries_count,
    CAST(k % 9 AS SMALLINT) AS institutions_count,
    CAST(k % 5 AS SMALLINT) AS locations_count,
    countries AS country_codes,
    CASE WHEN k % 37 <> 0 THEN CAST(o_orderdate AS DATE) + INTERVAL 750 MINUTE END AS openalex_updated_at,
    CASE WHEN (k % 211 = 0) THEN 'missing_id'
         WHEN COALESCE(NULLIF(raw_title, ''), raw_display_name) IS NULL THEN 'missing_title'
         WHEN pub_date IS NULL THEN 'missing_date'
         WHEN k % 401 = 0 THEN 'out_of_range:fwci' END AS reject_reason
  FROM rawf"""


def _dedup(src: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY openalex_id "
            f"ORDER BY _src, _pos) AS rn FROM {src} WHERE reject_reason IS NULL) WHERE rn = 1")


_RUNS = f"""
runs AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY y) AS INTEGER) AS id,
         make_timestamp(y + 1, 1, 1, 0, 0, 0) AS fetched_at,
         make_date(y, 1, 1) AS from_date, make_date(y, 12, 31) AS to_date,
         '{_SUB_URL}{D.EXPECTED_SUBFIELD}' AS subfield_id,
         CAST(paper_count AS BIGINT) AS paper_count,
         make_timestamp(y + 1, 1, 1, 0, 0, 0) AS created_at
  FROM (SELECT YEAR(pub_date) AS y, COUNT(*) AS paper_count FROM rawf
        WHERE pub_date IS NOT NULL GROUP BY 1))"""

_WITH = ("WITH " + _BASE + ",\nflat AS (" + _flat_select(1) + "),\n"
         "papers AS (SELECT * EXCLUDE (_src, _pos, reject_reason), " + _LOAD + " AS ingested_at FROM ("
         + _dedup("flat") + ")),\n" + _RUNS + "\n")


# Records whose text is spoilt before it is read (see ``plans.derived.spoilt_lines``).
_DIRT = ("CASE WHEN k % 131 = 0 THEN 'malformed' WHEN k % 137 = 0 THEN 'date' WHEN k % 139 = 0 THEN 'word' "
         "WHEN k % 149 = 0 THEN 'overflow' WHEN k % 151 = 0 THEN 'fraction' WHEN k % 157 = 0 THEN 'flag' "
         "WHEN k % 163 = 0 THEN 'text_flag' END")


def _txt(col: str, sep: str = ",") -> str:
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE array_to_string({col}, '{sep}') END"


def _flat_cols(prefix: str = "") -> str:
    return ", ".join(_txt(prefix + c) + f" AS {c}" if c == "country_codes" else prefix + c
                     for c in FLAT_COLUMNS)


_FULL = f"publication_date BETWEEN {_d(D.FULL_FROM)} AND {_d(D.FULL_TO)}"
_FILTERED = ("publication_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' "
             "AND primary_topic_name IN ('NATION_1', 'NATION_7', 'NATION_19') AND is_oa")

_LIST_COLS = ("openalex_id, doi, title, landing_page_url, oa_url, publication_date, publication_year, "
              "work_type, language, is_oa, oa_status, is_retracted, has_fulltext, primary_topic_name, "
              "primary_topic_score, subfield_name, field_name, source_name, source_type, "
              "host_organization, cited_by_count, fwci, author_count, countries_count, "
              "institutions_count, " + _txt("country_codes") + " AS country_codes, ingested_at")

# What each check must find, from the dirt that the binding plants: conditions on the
# order's own columns (``b``), not on the flat columns that the checks test. Then the
# columns shown.
_PLANTED = {
    "openalex_id_format": ("b.k % 223 = 0", "openalex_id, title"),
    "publication_year_matches_date": ("b.k % 97 = 0", "openalex_id, publication_date, publication_year"),
    "ai_subfield": (f"b.c_mktsegment <> '{D.EXPECTED_SUBFIELD}'", "openalex_id, title, subfield_name, subfield_id"),
    "publication_date_sanity": (f"b.o_orderdate >= {_d(D.AS_OF)} + INTERVAL 1 DAY", "openalex_id, publication_date"),
    # Priorities 1 to 3 get an open status, 4 none, 5 'closed'; status O is not open access.
    "oa_flag_status_consistency": (
        "(b.o_orderstatus = 'O') = (substr(b.o_orderpriority, 1, 1) IN ('1', '2', '3'))",
        "openalex_id, is_oa, oa_status"),
    "citation_percentile_hierarchy": (
        "b.o_totalprice > 480000 AND b.k % 7 = 0",
        "openalex_id, is_top_1_percent, is_top_10_percent, citation_percentile"),
    "non_negative_metrics": (
        "b.k % 113 = 0 OR b.o_totalprice >= 400002",
        "openalex_id, cited_by_count, referenced_works_count, author_count, fwci, "
        "citation_percentile, primary_topic_score"),
    "countries_count_matches_array": (
        "b.k % 89 = 0 AND b.n_auth IS NOT NULL",
        "openalex_id, countries_count, " + _txt("country_codes") + " AS country_codes, "
        "CAST(len(country_codes) AS INTEGER) AS array_len"),
    "missing_topic_hierarchy": ("b.k % 53 = 0", "openalex_id, title, primary_topic_name, subfield_name, field_name"),
}


def _found(check: str) -> str:
    """The stored papers that a check must find, as a table ``p``."""
    return (f"(SELECT p.* FROM papers p JOIN base b ON b.k = CAST(substr(p.openalex_id, 2) AS BIGINT) "
            f"WHERE {_PLANTED[check][0]}) p")


_SEVERITY = {"duplicate_openalex_id": "error", "missing_topic_hierarchy": "warning",
             "ingest_count_reconciliation": "warning"}

_RECONCILE = """
latest AS (SELECT * FROM runs ORDER BY id DESC LIMIT 1),
recon AS (
  SELECT l.paper_count AS expected_from_export,
         (SELECT COUNT(*) FROM papers p WHERE p.publication_date BETWEEN l.from_date AND l.to_date)
           AS rows_in_date_window,
         (SELECT COUNT(*) FROM papers) AS total_rows
  FROM latest l),
recon_v AS (
  SELECT * FROM recon
  WHERE rows_in_date_window = 0
     OR ABS(rows_in_date_window - expected_from_export) > GREATEST(expected_from_export * 0.05, 1))"""


def _summary_cte() -> str:
    parts = ["SELECT 'duplicate_openalex_id' AS chk, (SELECT COUNT(*) FROM (SELECT openalex_id FROM papers "
             "GROUP BY openalex_id HAVING COUNT(*) > 1)) AS violations"]
    parts += [f"SELECT '{name}', (SELECT COUNT(*) FROM {_found(name)})" for name in _PLANTED]
    parts.append("SELECT 'ingest_count_reconciliation', (SELECT COUNT(*) FROM recon_v)")
    sev = " ".join(f"WHEN '{n}' THEN '{s}'" for n, s in _SEVERITY.items())
    return (",\ncounts AS (" + "\nUNION ALL ".join(parts) + "),\n"
            "summary AS (SELECT chk AS \"check\", CASE chk " + sev + " ELSE 'error' END AS severity, "
            "CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status, "
            "CAST(violations AS BIGINT) AS violations FROM counts)")


def _batch(snapshot: int, window) -> str:
    return (f"SELECT * EXCLUDE (_src, _pos, reject_reason) FROM ({_dedup('(' + _flat_select(snapshot) + ')')}) "
            f"WHERE publication_date BETWEEN {_d(window[0])} AND {_d(window[1])}")


def _merge_sql() -> str:
    cols = ["COALESCE(b2.openalex_id, b1.openalex_id) AS openalex_id"]
    for c in FLAT_COLUMNS[1:]:
        expr = f"CASE WHEN b2.openalex_id IS NOT NULL THEN b2.{c} ELSE b1.{c} END"
        cols.append((_txt(expr) if c == "country_codes" else expr) + f" AS {c}")
    cols.append(f"CASE WHEN b1.openalex_id IS NOT NULL THEN {_LOAD} ELSE {_LOAD2} END AS ingested_at")
    return (_WITH + f", b1 AS ({_batch(1, D.BATCH1)}), b2 AS ({_batch(2, D.BATCH2)})\n"
            "SELECT " + ", ".join(cols) + " FROM b1 FULL OUTER JOIN b2 ON b1.openalex_id = b2.openalex_id")


def oracle_sql() -> dict[str, str]:
    W = _WITH
    q: dict[str, str] = {}
    q["flatten_papers"] = W + f"SELECT _src, _pos, {_flat_cols()}, reject_reason FROM flat"
    q["flatten_rejects"] = W + "SELECT _src, _pos, openalex_id, reject_reason FROM flat WHERE reject_reason IS NOT NULL"
    q["first_wins_fetch"] = W + """
SELECT raw_id AS id, _src, _pos, raw_title AS title FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY raw_id ORDER BY _src, _pos) AS rn FROM rawf WHERE raw_id IS NOT NULL)
WHERE rn = 1
UNION ALL SELECT raw_id, _src, _pos, raw_title FROM rawf WHERE raw_id IS NULL"""
    q["envelope_records"] = W + """
SELECT CAST(k // 2000 AS BIGINT) AS envelope, COUNT(*) OVER (PARTITION BY k // 2000) AS count,
       ROW_NUMBER() OVER (PARTITION BY k // 2000 ORDER BY _src, _pos) - 1 AS place, raw_id AS id, raw_title AS title
FROM rawf"""
    q["first_wins_batch"] = W + f"SELECT openalex_id, _src, _pos, title FROM ({_dedup('flat')})"
    q["ingest_counters"] = W + """
SELECT COUNT(*) AS papers,
       COUNT(DISTINCT CASE WHEN reject_reason IS NULL THEN openalex_id END) AS upserted,
       COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS skipped_invalid,
       COUNT(*) FILTER (WHERE reject_reason IS NULL)
         - COUNT(DISTINCT CASE WHEN reject_reason IS NULL THEN openalex_id END) AS duplicates_in_file
FROM flat"""
    # Each nation's segment name under 30 longer ones that contain it and sort before it.
    names = ("SELECT DISTINCT '" + _SUB_URL + "' || c_mktsegment AS id, c_mktsegment AS display_name FROM rawf "
             "UNION ALL SELECT id || '/' || i, 'A' || lpad(CAST(i AS VARCHAR), 2, '0') || ' ' || display_name || ' and more' "
             "FROM (SELECT DISTINCT '" + _SUB_URL + "' || c_mktsegment AS id, c_mktsegment AS display_name FROM rawf), range(30) r(i)")
    q["subfield_lookup"] = W + f"""
SELECT id, display_name FROM ({names}) WHERE lower(display_name) = 'building'"""
    q["source_filter"] = W + f"""
SELECT raw_id AS id, strftime(pub_date, '%Y-%m-%d') AS publication_date, raw_title AS title, _src, _pos
FROM rawf WHERE c_mktsegment = 'BUILDING' AND pub_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
ORDER BY pub_date DESC, _src, _pos"""
    q["classification_mismatches"] = W + """
SELECT raw_id AS id, raw_title AS title, c_mktsegment AS primary_subfield, _src, _pos
FROM rawf WHERE lower(COALESCE(c_mktsegment, '')) <> 'building'"""
    q["papers_list"] = W + f"""
SELECT {_LIST_COLS} FROM papers WHERE {_FULL}
ORDER BY publication_date DESC, cited_by_count DESC, openalex_id"""
    q["papers_filtered_topics_oa"] = W + f"""
SELECT {_LIST_COLS} FROM papers WHERE {_FILTERED}
ORDER BY publication_date DESC, cited_by_count DESC, openalex_id"""
    q["papers_display"] = W + f"""
SELECT title, 'https://openalex.org/works/' || openalex_id AS openalex_url, publication_date,
       primary_topic_name, source_name, CASE WHEN is_oa THEN 'Yes' ELSE 'No' END AS oa,
       cited_by_count, author_count, COALESCE({_txt('country_codes', ', ')}, '') AS countries
FROM papers WHERE {_FULL}"""
    q["papers_by_date"] = W + f"""
SELECT publication_date, COUNT(*) AS papers FROM papers WHERE {_FULL} GROUP BY 1 ORDER BY 1"""
    q["top_topics"] = W + f"""
SELECT primary_topic_name AS topic, COUNT(*) AS papers FROM papers
WHERE {_FULL} AND primary_topic_name IS NOT NULL GROUP BY 1 ORDER BY papers DESC, topic LIMIT 10"""
    q["oa_status_breakdown"] = W + f"""
SELECT COALESCE(oa_status, 'unknown') AS oa_status, COUNT(*) AS papers FROM papers
WHERE {_FULL} GROUP BY 1 ORDER BY papers DESC, oa_status"""
    q["top_venues"] = W + f"""
SELECT COALESCE(source_name, 'Unknown') AS venue, COUNT(*) AS papers FROM papers
WHERE {_FULL} GROUP BY 1 ORDER BY papers DESC, venue LIMIT 10"""
    q["top_countries"] = W + f"""
SELECT country, COUNT(*) AS papers FROM papers, UNNEST(COALESCE(country_codes, [])) AS t(country)
WHERE {_FULL} GROUP BY 1 ORDER BY papers DESC, country LIMIT 10"""
    q["date_bounds"] = W + f"""
SELECT COALESCE(MIN(publication_date), {_d(D.AS_OF)}) AS min_date,
       COALESCE(MAX(publication_date), {_d(D.AS_OF)}) AS max_date FROM papers"""
    q["topic_list"] = W + """
SELECT DISTINCT primary_topic_name FROM papers WHERE primary_topic_name IS NOT NULL ORDER BY 1"""
    q["kpis"] = W + f"""
SELECT COUNT(*) AS publications,
       ROUND(COALESCE(AVG(CAST(is_oa AS INTEGER)) * 100, 0.0), 4) AS oa_pct,
       COALESCE(CAST(MEDIAN(cited_by_count) AS DOUBLE), 0.0) AS median_citations,
       COUNT(DISTINCT primary_topic_name) AS topics,
       ROUND(COALESCE(AVG(author_count), 0.0), 4) AS avg_authors
FROM papers WHERE {_FULL}"""
    trend = W + f""",
cal AS (SELECT CAST(d AS DATE) AS publication_date
        FROM generate_series({_d(D.FULL_FROM)}, {_d(D.FULL_TO)}, INTERVAL 1 DAY) AS t(d)),
cnt AS (SELECT publication_date, COUNT(*) AS n FROM papers WHERE {_FULL} GROUP BY 1),
series AS (
  SELECT c.publication_date, CAST(COALESCE(n, 0) AS BIGINT) AS daily_papers
  FROM cal c LEFT JOIN cnt USING (publication_date)),
trend AS (
  SELECT publication_date, daily_papers,
         round_even(AVG(daily_papers) OVER (ORDER BY publication_date
                    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 1) AS avg_7d
  FROM series)"""
    q["trend_7d"] = trend + "\nSELECT * FROM trend ORDER BY publication_date"
    q["trend_kpis"] = trend + """
SELECT CAST(SUM(daily_papers) AS BIGINT) AS total, ROUND(AVG(daily_papers), 4) AS avg_per_day,
       (SELECT publication_date FROM trend ORDER BY daily_papers DESC, publication_date LIMIT 1) AS peak_day,
       MAX(daily_papers) AS peak_count
FROM trend HAVING SUM(daily_papers) > 0"""
    q["stored_date_bounds"] = q["date_bounds"]
    q["page_view"] = W + _page(_FULL, D.FULL_FROM, D.FULL_TO)
    q["page_view_filtered"] = W + _page(_FILTERED, "1998-01-01", "1998-12-31")
    q["recent_runs"] = W + """
SELECT id, fetched_at, from_date, to_date, paper_count, created_at FROM runs ORDER BY id DESC LIMIT 5"""
    q["dq_duplicate_key"] = W + """
SELECT openalex_id, COUNT(*) AS cnt FROM flat WHERE reject_reason IS NULL
GROUP BY openalex_id HAVING COUNT(*) > 1"""
    names = {"openalex_id_format": "dq_id_format", "publication_year_matches_date": "dq_year_matches_date",
             "ai_subfield": "dq_subfield", "publication_date_sanity": "dq_date_sanity",
             "oa_flag_status_consistency": "dq_oa_consistency",
             "citation_percentile_hierarchy": "dq_percentile_hierarchy",
             "non_negative_metrics": "dq_metric_ranges",
             "countries_count_matches_array": "dq_countries_count",
             "missing_topic_hierarchy": "dq_missing_hierarchy"}
    for check, key in names.items():
        q[key] = W + f"SELECT {_PLANTED[check][1]} FROM {_found(check)}"
    q["dq_ingest_reconciliation"] = W + "," + _RECONCILE + "\nSELECT * FROM recon_v"
    q["dq_reconcile_runs"] = W + """,
counted AS (SELECT r.id, COUNT(p.openalex_id) AS n FROM runs r
            LEFT JOIN papers p ON p.publication_date BETWEEN r.from_date AND r.to_date GROUP BY r.id)
SELECT r.id, from_date, to_date, CAST(paper_count AS BIGINT) AS expected_from_export, n AS rows_in_date_window,
       n = 0 OR ABS(n - paper_count) > GREATEST(paper_count * 0.05, 1) AS violated
FROM runs r JOIN counted c ON c.id = r.id"""
    q["landing_window"] = q["source_filter"]
    q["trend_by_topic"] = trend + """,
topics AS (SELECT DISTINCT primary_topic_name AS topic FROM papers WHERE primary_topic_name IS NOT NULL AND """ + _FULL + """),
daily AS (SELECT primary_topic_name AS topic, publication_date, COUNT(*) AS n FROM papers WHERE """ + _FULL + """ GROUP BY 1, 2)
SELECT t.topic, c.publication_date, COALESCE(n, 0) AS daily_papers,
       round_even(AVG(COALESCE(n, 0)) OVER (PARTITION BY t.topic ORDER BY c.publication_date
                  RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 1) AS avg_7d
FROM topics t CROSS JOIN cal c LEFT JOIN daily d ON d.topic = t.topic AND d.publication_date = c.publication_date"""
    summary = W + "," + _RECONCILE + _summary_cte()
    q["dq_summary"] = summary + "\nSELECT * FROM summary"
    samples = "\nUNION ALL ".join(
        [f"SELECT '{n}' AS \"check\", openalex_id FROM {_found(n)}" for n in _PLANTED]
        + ["SELECT 'duplicate_openalex_id', openalex_id FROM papers GROUP BY openalex_id HAVING COUNT(*) > 1",
           "SELECT 'ingest_count_reconciliation', NULL FROM recon_v"])
    q["dq_samples"] = W + "," + _RECONCILE + f""", v AS ({samples})
SELECT "check", openalex_id, CAST(sample_rank AS INTEGER) AS sample_rank FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY "check" ORDER BY openalex_id) AS sample_rank FROM v)
WHERE sample_rank <= 5"""
    q["dq_gate"] = summary + """,
flags AS (SELECT * FROM (VALUES (TRUE, FALSE), (TRUE, TRUE), (FALSE, TRUE), (FALSE, FALSE))
          AS t(fail_on_errors, fail_on_warnings))
SELECT fail_on_errors, fail_on_warnings, "check" FROM summary, flags
WHERE violations > 0 AND (fail_on_errors OR fail_on_warnings)
  AND (severity = 'error' OR fail_on_warnings)"""
    q["upsert_merge"] = _merge_sql()
    q["upsert_idempotent"] = W + f"SELECT {_flat_cols()}, ingested_at FROM papers"
    dirty = W + f""", dirty AS (
  SELECT *, CASE
      WHEN dirt = 'malformed' THEN 'malformed'
      WHEN base IN ('missing_id', 'missing_title', 'missing_date') THEN base
      WHEN dirt = 'date' THEN 'bad_date'
      WHEN dirt = 'word' THEN 'bad_value:cited_by_count'
      WHEN base IS NOT NULL THEN base
      WHEN dirt = 'overflow' THEN 'out_of_range:cited_by_count'
      WHEN dirt = 'flag' THEN 'bad_value:is_retracted' END AS reason
  FROM (SELECT flat.* EXCLUDE (reject_reason), reject_reason AS base, {_DIRT} AS dirt
        FROM (SELECT *, _pos AS k FROM flat) flat))"""
    q["landing_verdicts"] = q["envelope_verdicts"] = dirty + """
SELECT CASE WHEN reason IS DISTINCT FROM 'malformed' THEN openalex_id END AS openalex_id, reason AS reject_reason,
       CASE WHEN reason IS NULL THEN CASE WHEN dirt = 'fraction' THEN 3 ELSE cited_by_count END END AS cited_by_count,
       CASE WHEN reason IS NULL THEN is_retracted AND dirt IS DISTINCT FROM 'text_flag' END AS is_retracted,
       COUNT(*) AS n
FROM dirty GROUP BY ALL"""
    q["landing_counters"] = dirty + """
SELECT COUNT(*) AS papers, COUNT(DISTINCT CASE WHEN reason IS NULL THEN openalex_id END) AS upserted,
       COUNT(reason) AS skipped_invalid,
       COUNT(*) - COUNT(reason) - COUNT(DISTINCT CASE WHEN reason IS NULL THEN openalex_id END) AS duplicates_in_file
FROM dirty"""
    window = f"c_mktsegment = '{D.EXPECTED_SUBFIELD}' AND pub_date BETWEEN {_d(D.JOB_FROM)} AND {_d(D.JOB_TO)}"
    fetched = (f"(SELECT raw_id, _src, _pos FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY COALESCE(raw_id, _src || '#' || _pos) "
               f"ORDER BY _src, _pos) AS rn FROM rawf WHERE {window}) WHERE rn = 1)")
    job = W + f""", fetched AS {fetched},
loaded AS ({_dedup("(SELECT flat.* FROM flat JOIN fetched USING (_src, _pos))")})"""
    q["job_run_batch"] = job + f"\nSELECT {_flat_cols()}, {_LOAD} AS ingested_at FROM loaded"
    q["job_manifest"] = job + f"""
SELECT '{_SUB_URL}{D.EXPECTED_SUBFIELD}' AS subfield_id, '{D.JOB_FROM}' AS from_date, '{D.JOB_TO}' AS to_date,
       (SELECT COUNT(*) FROM fetched) AS "count",
       (SELECT COUNT(*) FROM rawf WHERE {window} AND raw_id IS NOT NULL)
         - (SELECT COUNT(*) FROM fetched WHERE raw_id IS NOT NULL) AS duplicates_skipped"""
    q["job_from_export"] = job + f"""
SELECT 1 AS id, '{_SUB_URL}{D.EXPECTED_SUBFIELD}' AS subfield_id, {_d(D.JOB_FROM)} AS from_date, {_d(D.JOB_TO)} AS to_date,
       (SELECT COUNT(*) FROM fetched) AS paper_count, (SELECT COUNT(*) FROM loaded) AS stored"""
    q["run_log_append"] = W + f"""
SELECT * FROM runs
UNION ALL
SELECT CAST((SELECT MAX(id) FROM runs) + 1 AS INTEGER), {_LOAD}, {_d(D.FULL_FROM)}, {_d(D.FULL_TO)},
       '{_SUB_URL}{D.EXPECTED_SUBFIELD}', (SELECT COUNT(*) FROM rawf), {_LOAD}"""
    q["export_round_trip"] = q["flatten_papers"]
    q["incremental_ingest"] = W + f"SELECT {_flat_cols()}, ingested_at FROM papers"
    return q
