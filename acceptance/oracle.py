"""The acceptance queries in SQL, on the given tables.

``PRELUDE`` states the values that the rendered pages carry (see ``render.py``).
"""

from __future__ import annotations

PRELUDE = """
WITH org AS (
  SELECT c_custkey AS k, c_custkey // 100 AS page_no, c_custkey % 100 AS row_ord,
         CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name END AS name,
         CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE r_name END AS provinces,
         c_mktsegment AS sectors,
         CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS requests,
         CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS projects,
         CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS enabled,
         CASE WHEN c_custkey % 11 = 0 THEN 'Not Found' ELSE 'https://portal.example/Org/' || c_custkey END AS manage_url,
         CASE WHEN c_custkey % 13 = 0 THEN 9 ELSE 10 END AS n_cells
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
org_ok AS (SELECT * FROM org WHERE n_cells >= 10 AND name <> ''),
fac AS (
  SELECT p_partkey AS k, n_nationkey AS g, n_regionkey AS region, n_name AS institution, p_brand AS branch,
         p_name AS facility_name, p_type AS facility_type,
         CASE WHEN p_partkey % 9 = 0 THEN 'Not Found' ELSE 'https://portal.example/Fac/' || p_partkey END AS manage_url
  FROM part JOIN nation ON n_nationkey = p_partkey % 22),
ex AS (
  SELECT s_suppkey AS k, n_name AS institution, n_nationkey AS g, s_name AS name,
         CASE WHEN s_acctbal > 5000 THEN 'Academic' ELSE 'Industry' END AS expert_type,
         'Position ' || (s_suppkey % 7) AS position, 'Facility ' || (s_suppkey % 10) AS facility,
         CAST(s_suppkey AS VARCHAR) AS expert_id,
         CASE WHEN s_suppkey % 6 = 0 THEN 'Not Found' ELSE 'https://portal.example/Exp/' || s_suppkey END AS manage_url,
         CASE WHEN s_suppkey % 4 = 0 THEN 'Not Found' ELSE 'https://portal.example/Pub/' || s_suppkey END AS profile_url,
         s_suppkey % 10 <> 1 AS ready
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
prof AS (SELECT * FROM ex WHERE manage_url <> 'Not Found' AND ready),
expertise AS (
  -- a page that shows its no-records line has no expertise rows
  SELECT prof.k, p_partkey, CAST(p_partkey AS VARCHAR) AS sred_code, p_brand AS area, p_type AS discipline,
         CAST(p_size AS VARCHAR) AS field
  FROM prof JOIN part ON p_partkey // 20 = prof.k WHERE prof.k % 3 <> 0),
polls AS (SELECT user_id AS page, ts, event_id, CAST(floor(value) AS INTEGER) % 3 AS n FROM events),
empties AS (SELECT n_nationkey AS idx, n_name AS name FROM nation WHERE n_nationkey NOT IN (SELECT g FROM fac)),
registry AS (
  SELECT n_nationkey AS g, phase, name, depends_on FROM nation, (VALUES
    (1, 'Experts Metadata', NULL), (2, 'Experts Details', 1), (3, 'Facilities Metadata', NULL),
    (4, 'Facilities Details', 3), (5, 'Organizations Metadata', NULL), (6, 'Organizations Details', 5)
  ) r(phase, name, depends_on)),
counts AS (
  SELECT g, 1 AS phase, count(*) AS records FROM ex GROUP BY g
  UNION ALL SELECT g, 2, count(*) FROM prof GROUP BY g
  UNION ALL SELECT g, 3, count(*) FROM fac GROUP BY g
  UNION ALL SELECT c_nationkey, 5, count(*) FROM customer GROUP BY c_nationkey),
progress AS (
  SELECT g, 2 AS phase, count(*) FILTER (ready AND manage_url <> 'Not Found') AS processed, count(*) AS total FROM ex GROUP BY g
  UNION ALL
  SELECT g, 4, count(*) FILTER (facility_type = 'SMALL' AND manage_url <> 'Not Found'), count(*) FROM fac GROUP BY g)
"""

BODIES = {
    "page_links": """
SELECT page_id, count(*) AS n_links
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) GROUP BY page_id""",
    "page_tag_counts": """
SELECT page_id, len(regexp_extract_all(html, '<li>')) AS n_li, len(regexp_extract_all(html, '<h1>')) AS n_h1,
       len(regexp_extract_all(html, '<p>')) AS n_p FROM pages""",
    "page_head": r"""
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
       trim(regexp_replace(regexp_replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&quot;', '"'),
            '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS title FROM pages""",
    "page_nav": """
SELECT page_id, pos, href FROM (SELECT page_id, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS href
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS l FROM pages))""",
    "page_hosts": """
SELECT host, n FROM (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1)""",
    "page_ready": "SELECT k AS page_id, ready FROM ex WHERE manage_url <> 'Not Found'",
    "dim_options": """
SELECT s_suppkey // 25 AS page_id, CAST(s_suppkey % 25 AS INTEGER) AS idx, s_name AS name FROM supplier""",
    "organizations_listing": """
SELECT name AS "Organization_Name", provinces AS "Provinces", sectors AS "Sectors", requests AS "Requests",
       projects AS "Projects", enabled AS "Enabled", manage_url AS "Manage_URL" FROM org_ok""",
    "facilities_listing": """
SELECT institution AS "Institution", branch AS "Branch", facility_name AS "Facility_Name",
       facility_type AS "Facility_Type", manage_url AS "Manage_URL" FROM fac""",
    "experts_listing": """
SELECT institution AS "Institution", name AS "Name", expert_type AS "Expert_Type", position AS "Position",
       facility AS "Facility", expert_id AS "Expert_ID", manage_url AS "Manage_URL", profile_url AS "Profile_URL" FROM ex""",
    "arity_reject": """
SELECT CASE WHEN n_cells < 10 THEN 'too_few_cells' ELSE 'blank_name' END AS reason, count(*) AS n
FROM org WHERE n_cells < 10 OR name = '' GROUP BY 1""",
    "mapping_preview": """
SELECT k // 100 AS page_no, substr(name, 1, 50) AS td_4, substr(provinces, 1, 50) AS td_5, substr(sectors, 1, 50) AS td_6
FROM org WHERE row_ord = 0""",
    "listing_pages": """
SELECT g, count(*) AS total, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages_ceil,
       greatest(1, count(*) // 50 + 1) AS pages_est FROM fac GROUP BY g""",
    "pager_parse": """
SELECT page_no, page_no * 100 + 1 AS first_item, page_no * 100 + count(*) AS last_item,
       (SELECT count(*) FROM org) AS total, page_no * 100 + count(*) >= (SELECT count(*) FROM org) AS is_last
FROM org GROUP BY page_no""",
    "json_roundtrip": "SELECT name, provinces, manage_url FROM org_ok",
    "snapshot_explode": "SELECT page_no, count(*) AS n_records FROM org_ok GROUP BY page_no",
    "flat_export": "SELECT name, provinces, sectors, enabled FROM org_ok",
    "profile_meta": """
SELECT manage_url AS "Source_URL", institution AS "Institution", name AS "Name_From_List", expert_id AS "Expert_ID",
       profile_url AS "Profile_URL" FROM prof""",
    "error_reasons": """
SELECT name, CASE WHEN manage_url = 'Not Found' THEN 'No valid Manage URL' ELSE 'Extraction failed' END AS reason
FROM ex WHERE manage_url = 'Not Found' OR NOT ready""",
    "append_new": """
SELECT manage_url, min(k) AS k FROM org_ok
WHERE manage_url NOT IN (SELECT manage_url FROM org_ok WHERE enabled = 'Yes') GROUP BY manage_url""",
    "keep_first": "SELECT manage_url, min(page_no * 100 + row_ord) AS first_pos FROM org_ok GROUP BY manage_url",
    "resolve_option": """
, opt AS (SELECT s_nationkey AS g, s_suppkey AS idx, 'Lab ' || s_name AS name FROM supplier),
cust AS (SELECT c_nationkey AS g, c_custkey, replace(c_name, 'Customer', 'Supplier') AS named FROM customer),
tgt AS (SELECT DISTINCT g, CASE WHEN c_custkey % 2 = 0 THEN 'Lab ' || named || ' (main)' ELSE named END AS target FROM cust)
SELECT tgt.g, target, arg_min(name, idx) AS chosen FROM tgt LEFT JOIN opt
  ON opt.g = tgt.g AND (contains(name, target) OR contains(target, name)) GROUP BY tgt.g, target""",
    "pending": "SELECT k FROM ex WHERE manage_url <> 'Not Found' AND expert_type <> 'Academic' AND ready",
    "replace_groups": """
SELECT institution, count(*) AS n FROM fac WHERE region <> 0 OR manage_url <> 'Not Found' GROUP BY institution""",
    "removed_rows": "SELECT institution, count(*) AS removed FROM fac WHERE region = 0 GROUP BY institution",
    "still_empty": """
SELECT idx, name FROM empties
WHERE idx NOT IN (SELECT c_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 3)""",
    "empty_groups": """
SELECT idx, name, CASE WHEN idx < 24 THEN 'no_data' ELSE 'selection_failed' END AS reason FROM empties""",
    "empty_selection": """
, asks AS (SELECT o_orderkey, unnest([o_orderkey % 3 + 22, o_orderkey % 3 + 24]) AS no FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, CAST(no AS INTEGER) AS display_no, name, name IS NULL AS unknown
FROM asks LEFT JOIN empties ON idx = no - 1""",
    "ready_datasets": """
SELECT r.g, r.phase, r.depends_on IS NULL OR coalesce(c.records, 0) > 0 AS ready
FROM registry r LEFT JOIN counts c ON c.g = r.g AND c.phase = r.depends_on""",
    "status_board": """
SELECT r.g, r.phase, r.name,
       CASE WHEN c.records IS NOT NULL THEN CASE WHEN p.processed < p.total THEN 'Partial' ELSE 'Complete' END
            WHEN p.total IS NOT NULL THEN 'Paused' ELSE 'Pending' END AS status,
       coalesce(c.records, p.processed, 0) AS records
FROM registry r LEFT JOIN counts c ON c.g = r.g AND c.phase = r.phase
                LEFT JOIN progress p ON p.g = r.g AND p.phase = r.phase""",
    "completeness": """
SELECT n_nationkey AS g, CASE WHEN n_nationkey % 7 <> 3 THEN n_nationkey % 5 + coalesce(c, 0) END AS claimed,
       coalesce(c, 0) AS seen,
       CASE WHEN n_nationkey % 7 = 3 THEN 'unparsed'
            WHEN coalesce(c, 0) = 0 AND n_nationkey % 5 = 0 THEN 'empty' WHEN coalesce(c, 0) = 0 THEN 'suspicious'
            WHEN n_nationkey % 5 > 0 THEN 'short' ELSE 'complete' END AS verdict
FROM nation LEFT JOIN (SELECT g, count(*) AS c FROM fac GROUP BY g) ON g = n_nationkey""",
    "snapshot_batches": """
SELECT batch_id, n, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS processed, (SELECT count(*) FROM fac) AS total
FROM (SELECT CAST(k % 4 AS INTEGER) AS batch_id, count(*) AS n FROM fac WHERE k % 4 <> 3 GROUP BY 1)""",
    "partial_result": """
SELECT institution AS "Institution", branch AS "Branch", facility_name AS "Facility_Name",
       facility_type AS "Facility_Type", manage_url AS "Manage_URL" FROM fac WHERE k // 1100 % 3 <> 2""",
    "is_complete": """
, runs AS (SELECT g, count(*) FILTER (manage_url <> 'Not Found' AND ready AND (g % 5 <> 0 OR k % 2 = 0)) AS processed,
       count(*) FILTER (manage_url <> 'Not Found' AND (ready OR g % 3 <> 0)) AS total,
       count(*) FILTER (manage_url <> 'Not Found' AND NOT ready AND g % 3 <> 0) AS errors FROM ex GROUP BY g)
SELECT g, processed, total, errors, errors = 0 AND processed = total AS is_complete, errors = 0 AS no_errors FROM runs""",
    "errors_roundtrip": """
SELECT k AS index, name, institution, CASE WHEN manage_url = 'Not Found' THEN 'No valid Manage URL' ELSE 'Extraction failed' END AS reason
FROM ex WHERE manage_url = 'Not Found' OR NOT ready""",
    "newest_capture": "SELECT url, max(page_id) + CASE WHEN max(page_id) % 2 = 0 THEN 1000000000 ELSE 0 END AS page_id FROM pages GROUP BY url",
    "facility_profiles": """
SELECT k, institution, facility_name AS name, facility_type AS type, manage_url AS source
FROM fac WHERE manage_url <> 'Not Found'""",
    "organization_profiles": """
SELECT k, name, provinces, sectors, manage_url AS source FROM org_ok WHERE manage_url <> 'Not Found'""",
    "activity_union": """
SELECT o_custkey // 15 AS k, 'Order ' || o_orderkey AS project_name,
       CASE WHEN o_orderkey % 2 = 0 THEN 'https://portal.example/Project/' || o_orderkey ELSE '' END AS project_url,
       o_orderpriority AS type, o_orderstatus AS current_status FROM orders""",
    "count_by_group": """
SELECT institution, count(*) AS n FROM ex GROUP BY institution ORDER BY n DESC, institution LIMIT 10""",
    "group_remainder": "SELECT CAST(greatest(count(DISTINCT institution) - 10, 0) AS BIGINT) AS n_more FROM ex",
    "flag_counts": """
SELECT count(*) AS total, count(*) FILTER (requests = 'Yes') AS requests_yes,
       count(*) FILTER (projects = 'Yes') AS projects_yes, count(*) FILTER (enabled = 'Yes') AS enabled_yes FROM org_ok""",
    "top_values": """
SELECT provinces, n FROM (SELECT provinces, count(*) AS n FROM org_ok GROUP BY provinces ORDER BY n DESC, provinces LIMIT 5)
WHERE provinces <> ''""",
    "section_presence": """
SELECT (SELECT count(*) FROM prof) AS profiles, count(DISTINCT k) AS with_expertise, count(*) AS expertise_entries
FROM expertise""",
    "section_sizes": """
SELECT prof.k, count(e.k) AS n_expertise FROM prof LEFT JOIN expertise e ON e.k = prof.k GROUP BY prof.k""",
    "harvest_totals": """
SELECT (SELECT count(*) FROM fac) AS records, (SELECT count(DISTINCT g) FROM fac) AS groups_seen,
       (SELECT count(*) FROM empties) AS groups_empty,
       (SELECT count(*) FROM fac WHERE manage_url = 'Not Found') AS no_link""",
    "run_summary": """
SELECT user_id AS run, count(*) FILTER (event_type <> 'error') AS completed, count(*) FILTER (event_type = 'error') AS failed,
       count(DISTINCT CASE WHEN event_type <> 'error' THEN event_type END) AS phases,
       CAST(date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS BIGINT) AS seconds
FROM events GROUP BY user_id""",
    "running_total": """
SELECT page_no, count(*) AS n_new, CAST(sum(count(*)) OVER (ORDER BY page_no) AS BIGINT) AS running
FROM org_ok GROUP BY page_no""",
    "first_stable": """
SELECT page, arg_min(event_id, (ts, event_id)) AS stable_at FROM (
  SELECT page, ts, event_id, n, lag(n, 1) OVER w AS n1, lag(n, 2) OVER w AS n2 FROM polls
  WINDOW w AS (PARTITION BY page ORDER BY ts, event_id)) WHERE n > 0 AND n = n1 AND n = n2 GROUP BY page""",
    "attempt_outcome": """
SELECT page, CASE WHEN min(a) FILTER (n > 0) IS NULL THEN 'empty' WHEN min(a) FILTER (n > 0) = 1 THEN 'ok'
       ELSE 'ok_after_retry' END AS outcome, coalesce(min(a) FILTER (n > 0) - 1, 3) AS retries
FROM (SELECT page, n, row_number() OVER (PARTITION BY page ORDER BY ts, event_id) AS a FROM polls)
WHERE a <= 4 GROUP BY page""",
    "batch_ids": """
SELECT institution, batch, count(*) AS n FROM (
  SELECT institution, (row_number() OVER (PARTITION BY institution ORDER BY k) - 1) // 50 AS batch FROM fac)
GROUP BY institution, batch""",
    "progress_percent": """
SELECT g, CAST(count(*) AS BIGINT) AS processed, CAST(max(k) + 1 AS BIGINT) AS total,
       round(count(*)::DOUBLE / (max(k) + 1)::DOUBLE * 100.0::DOUBLE, 2) AS percent, false AS is_complete FROM fac GROUP BY g""",
    "latest_progress": """
, saves AS (SELECT user_id AS run, event_id % 4 AS processed, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 7 END AS total,
            event_id % 3 AS cursor, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM events),
latest AS (SELECT run, arg_max(s, s.timestamp) AS s FROM (SELECT run, saves AS s FROM saves) GROUP BY run)
SELECT run, coalesce(s.processed, 0) AS processed, coalesce(s.total, 0) AS total,
       CASE WHEN coalesce(s.total, 0) > 0 THEN round(s.cursor::DOUBLE / s.total::DOUBLE * 100.0::DOUBLE, 2) ELSE 0.0::DOUBLE END AS percent,
       s.timestamp AS timestamp FROM latest""",
    "run_id_format": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS run_id, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS shown
FROM orders""",
    "expertise": """
SELECT k, sred_code AS "SRED_Code", area AS "Area", discipline AS "Discipline", field AS "Field" FROM expertise""",
    "affiliation": """
SELECT k, n_name AS "Facility_Name", CASE WHEN n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Is_Primary_Facility"
FROM prof JOIN nation ON n_regionkey = k % 5""",
    "web_presence": """
SELECT k, 'Site ' || i AS "Name", CASE WHEN i % 2 = 0 THEN 'Social' ELSE 'Home' END AS "Type",
       CASE WHEN i % 2 = 0 THEN 'https://site.example/' || k || '/' || i ELSE 'site.example ' || i END AS "URL"
FROM prof, range(0, 3) r(i) WHERE i < k % 4""",
    "price_flags": """
SELECT k, '$' || (100 + k) AS "Daily_Rate", CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Can_Initiate_Innovation_Challenge",
       CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Available_for_Scoping",
       CASE WHEN k % 5 = 0 THEN 'Yes' ELSE 'No' END AS "Available_for_Projects",
       CASE WHEN k % 7 = 0 THEN 'Yes' ELSE 'No' END AS "Can_be_Principal_Investigator" FROM prof""",
    "expert_general": """
SELECT k, institution || ' > ' || facility AS "Academic_Unit", CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Enabled",
       'e' || k || '@example.com' AS "Email", '555-' || k AS "Phone",
       CASE WHEN k % 3 = 0 THEN 'Not Rated' ELSE CAST(k % 5 AS VARCHAR) END AS "Reputation_Score" FROM prof""",
    "breadcrumb": "SELECT k, institution || ' > ' || branch AS path FROM fac",
    "kv_pairs": """
SELECT k, unnest(['Facility_Name', 'Site', 'Site_URL', 'Email', 'Hall', 'Rating', 'Notes']) AS key,
       unnest([facility_name, 'Visit', 'https://fac.example/' || k, 'f' || k || '@example.com', 'H' || (k % 4),
               CASE WHEN k % 5 = 0 THEN 'Not Rated' ELSE CAST(k % 5 AS VARCHAR) END, '']) AS value FROM fac""",
    "grid_rows": """
SELECT p_partkey // 20 AS k, p_partkey % 20 AS item_ord, CAST(p_partkey AS VARCHAR) AS "Code", p_brand AS "Research_Area",
       'https://portal.example/P/' || p_partkey AS "Code_URL" FROM part""",
    "section_items": """
SELECT k, CASE k % 3 WHEN 0 THEN 'grid' WHEN 1 THEN 'items' ELSE 'text' END AS stage, r_name AS item
FROM fac JOIN region ON r_regionkey <= k % 5""",
    "contacts": """
SELECT o_custkey AS k, 'Contact ' || o_orderkey AS "Name", 'o' || o_orderkey || '@example.com' AS "Email",
       '555-' || o_orderkey AS "Phone" FROM orders""",
    "locations": """SELECT k, k || ' Main Street, ' || sectors AS "Address", sectors AS "City" FROM org""",
    "descriptors": "SELECT k, branch AS descriptor_brand, facility_type AS tag, 2 AS n_list_rows FROM fac",
    "link_kinds": """
SELECT kind, count(*) AS n FROM (SELECT CASE k % 5 WHEN 0 THEN 'mailto' WHEN 1 THEN 'tel' WHEN 2 THEN 'javascript'
  WHEN 3 THEN 'fragment' ELSE 'web' END AS kind FROM fac) GROUP BY kind""",
    "expert_facts": """
, kv AS (
  SELECT k, unnest(['Academic_Unit', 'Enabled', 'Email', 'Phone', 'Reputation_Score', 'Expert_Type', 'Photo_URL']) AS key,
         unnest([institution || ' > ' || facility, CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END, 'e' || k || '@example.com',
                 '555-' || k, CASE WHEN k % 3 = 0 THEN 'Not Rated' ELSE CAST(k % 5 AS VARCHAR) END, expert_type,
                 '/img/' || k || '.png']) AS value, 'General_Information' AS section FROM prof
  UNION ALL SELECT k, unnest(['Position', 'Bio_Text']), unnest([position, '']), 'Details' FROM prof
  UNION ALL SELECT k, 'Age_Group', 'Group ' || (k % 4), 'Expert_Demographics' FROM prof
  UNION ALL SELECT k, unnest(['Daily_Rate', 'Can_Initiate_Innovation_Challenge', 'Available_for_Scoping',
                 'Available_for_Projects', 'Can_be_Principal_Investigator']),
         unnest(['$' || (100 + k)] || [CASE WHEN k % x = 0 THEN 'Yes' ELSE 'No' END for x in [2, 3, 5, 7]]),
         'Price_Availability' FROM prof
  UNION ALL SELECT k, 'CreatedOn', 'Day ' || k, 'Audit_Trail' FROM prof),
lists AS (
  SELECT k, p_partkey % 20 AS item_ord, unnest(['SRED_Code', 'Area', 'Discipline', 'Field']) AS key,
         unnest([sred_code, area, discipline, field]) AS value, 'Expertise' AS section FROM expertise
  UNION ALL SELECT k, row_number() OVER (PARTITION BY k ORDER BY n_nationkey) - 1, unnest(['Facility_Name', 'Is_Primary_Facility']),
         unnest([n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END]), 'Facility_Affiliation'
         FROM prof JOIN nation ON n_regionkey = k % 5
  UNION ALL SELECT k, i, unnest(['Name', 'Type', 'URL']), unnest(['Site ' || i, CASE WHEN i % 2 = 0 THEN 'Social' ELSE 'Home' END,
         CASE WHEN i % 2 = 0 THEN 'https://site.example/' || k || '/' || i ELSE 'site.example ' || i END]), 'Web_Presence'
         FROM prof, range(0, 3) r(i) WHERE i < k % 4
  UNION ALL SELECT k, 0, unnest(['Project_Name', 'Project_URL', 'Type', 'Organization', 'Current_Status']),
         unnest(['P', '', 'T', 'O', 'S']), 'Activity' FROM prof)
SELECT k, section, CAST(NULL AS INTEGER) AS item_ord, key, value FROM kv
UNION ALL SELECT k, section, CAST(item_ord AS INTEGER), key, value FROM lists""",
    "facility_facts": """
, kv AS (
  SELECT k, unnest(['Facility_Name', 'Site', 'Site_URL', 'Email', 'Hall', 'Rating', 'Notes', 'Academic_Unit_Path', 'Image_URL']) AS key,
         unnest([facility_name, 'Visit', 'https://fac.example/' || k, 'f' || k || '@example.com', 'H' || (k % 4),
                 CASE WHEN k % 5 = 0 THEN 'Not Rated' ELSE CAST(k % 5 AS VARCHAR) END, '', institution || ' > ' || branch,
                 '/img/' || k || '.png']) AS value, 'General_Information' AS section FROM fac
  UNION ALL SELECT k, 'Is_Lab', CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END, 'Academic_Unit_Details' FROM fac
  UNION ALL SELECT k, 'Brand', branch, 'Facility_Descriptors.fields' FROM fac
  UNION ALL SELECT k, 'Created', 'Day ' || k, 'Audit_Trail' FROM fac),
lists AS (
  SELECT k, r_regionkey AS item_ord, CASE WHEN k % 3 = 0 THEN 'Province' ELSE '' END AS key, r_name AS value,
         CASE WHEN k % 3 = 0 THEN 'Provinces_Served.rows' ELSE 'Provinces_Served.items' END AS section
         FROM fac JOIN region ON r_regionkey <= k % 5
  UNION ALL SELECT k, unnest([0, 1]), '', unnest([branch, facility_type]), 'Activities_Offered.items' FROM fac
  UNION ALL SELECT k, 0, '', facility_type, 'Sectors_Served.items' FROM fac
  UNION ALL SELECT k, 0, unnest(['Name', 'Email', 'Phone', 'Role']),
         unnest([facility_name, 'c' || k || '@example.com', '555-' || k, 'Lead']), 'Contacts' FROM fac
  UNION ALL SELECT k, 0, 'Address', k || ' Main Street ' || branch, 'Locations' FROM fac
  UNION ALL SELECT k, unnest([0, 0, 1, 1]), unnest(['Item', 'Level', 'Item', 'Level']),
         unnest(['One', facility_type, 'Two', 'low']), 'Facility_Descriptors.rows' FROM fac
  UNION ALL SELECT k, 0, '', facility_type, 'Facility_Descriptors.tags' FROM fac
  UNION ALL SELECT k, unnest([0, 1]), '', unnest(['English', 'French']), 'Languages_Serviced.items' FROM fac
  UNION ALL SELECT k, unnest([0, 0, 1, 1, 2, 2]), unnest(['Name', 'URL', 'Name', 'URL', 'Name', 'URL']),
         unnest(['Section 10', '#', 'Home', 'https://fac.example/' || k, 'Link', 'https://fac.example/more']), 'Web_Presence' FROM fac
  UNION ALL SELECT k, 0, 'Project', 'P' || k, 'Activity' FROM fac)
SELECT k, section, CAST(NULL AS INTEGER) AS item_ord, key, value FROM kv
UNION ALL SELECT k, section, CAST(item_ord AS INTEGER), key, value FROM lists""",
    "organization_facts": """
, kv AS (
  SELECT k, 'Legal_Name' AS key, name AS value, 'General_Information' AS section FROM org WHERE name <> ''
  UNION ALL SELECT k, unnest(['Email', 'Phone', 'Path', 'Image_URL']),
         unnest(['b' || k || '@example.com', '555-' || k, CASE WHEN provinces = '' THEN '' ELSE provinces || ' > ' END || sectors,
                 '/logo/' || k || '.png']), 'General_Information' FROM org
  UNION ALL SELECT k, 'Description', rtrim(repeat(sectors || ' ', 9)), 'General_Information' FROM org
         WHERE k % 2 = 0 AND length(rtrim(repeat(sectors || ' ', 9))) > 50
  UNION ALL SELECT k, 'Segment', sectors, 'Organization_Information.fields' FROM org
  UNION ALL SELECT k, 'Created', 'Day ' || k, 'Audit_Trail.fields' FROM org),
annual AS (SELECT o_custkey AS k, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL),
lists AS (
  SELECT k, 0 AS item_ord, unnest(['Field', 'Value']) AS key,
         unnest(['Requests', CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END]) AS value, 'Organization_Information.rows' AS section FROM org
  UNION ALL SELECT k, row_number() OVER (PARTITION BY k ORDER BY y) - 1, unnest(['Year', 'Orders']),
         unnest([CAST(y AS VARCHAR), CAST(n AS VARCHAR)]), 'Annual_Information.rows' FROM annual
  UNION ALL SELECT k, unnest([0, 1]), '', unnest([sectors, 'Code ' || (k % 7)]), 'NAICS_Sectors.items' FROM org WHERE k % 3 < 2
  UNION ALL SELECT k, 0, unnest(['Name', 'Email', 'Phone']), unnest(['Desk ' || k, 'd' || k || '@example.com', '555-' || k]),
         'Contacts' FROM org
  UNION ALL SELECT k, 0, unnest(['Address', 'City']), unnest([k || ' Main Street, ' || sectors, sectors]), 'Locations' FROM org
  UNION ALL SELECT k, 0, '', 'English', 'Languages_Serviced.items' FROM org
  UNION ALL SELECT k, unnest([0, 0, 1, 1]), unnest(['Name', 'URL', 'Name', 'URL']),
         unnest(['Home', 'https://org.example/' || k, 'Link', 'https://org.example/blank']), 'Web_Presence' FROM org
  UNION ALL SELECT k, unnest([0, 1, 1]), unnest(['Requests', 'Project_Name', 'Project_URL']),
         unnest([requests, 'Project ' || k, '/Project/' || k]), 'Activity' FROM org
  UNION ALL SELECT k, 0, unnest(['When', 'Who']), unnest(['Day ' || k, 'system']), 'Audit_Trail.rows' FROM org)
SELECT k, section, CAST(NULL AS INTEGER) AS item_ord, key, value FROM kv
UNION ALL SELECT k, section, CAST(item_ord AS INTEGER), key, value FROM lists""",
    "clean_text": r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents",
    "parse_flag": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE o_orderpriority END AS flag FROM orders""",
    "normalize_key": """
SELECT DISTINCT o_orderpriority, replace(replace(replace(o_orderpriority || ' Level: ok?', ' ', '_'), ':', ''), '?', '') AS key
FROM orders""",
    "split_list": """
SELECT k, pos, item FROM (SELECT k, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS item FROM (
  SELECT k, [trim(x) for x in string_split(branch || ', ,' || facility_type, ',') if trim(x) <> ''] AS l FROM fac))""",
    "streamed_facilities": """
SELECT institution, arg_min(facility_name, k) AS name, manage_url FROM fac
WHERE region <> 0 OR manage_url <> 'Not Found' GROUP BY institution, manage_url""",
    "streamed_experts": "SELECT institution, arg_min(name, k) AS name, manage_url FROM ex GROUP BY institution, manage_url",
    "stream_progress": "SELECT count(DISTINCT manage_url) AS processed, 3 AS batches FROM org_ok",
    "streamed_listing": """
SELECT manage_url, arg_min(provinces, k) AS "Provinces" FROM org_ok GROUP BY manage_url""",
}

SQL = {name: PRELUDE.strip() + "\n" + body.strip() for name, body in BODIES.items()}
