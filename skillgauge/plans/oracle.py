"""The queries of ``registry`` as SQL for an independent check."""

from skillgauge.plans.views import TERMS, VARIANT_TERMS
from skillgauge.sources.seed import seed_rows


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join(
        f"({_text(name)}, {_text(category)}, [{', '.join(map(_text, more))}])"
        for name, category, more in rows
    )


# Each single non-word character becomes a word of its own, so that a term stands
# between blanks. The one phrase is joined first: its words are then used up.
def _padded(text: str) -> str:
    return (
        r"replace(' ' || regexp_replace(lower(" + text + r"), '([^\p{L}\p{N}_])', "
        r"' \1 ', 'g') || ' ', ' of   the ', ' ofthe~ ')"
    )


_HAS = (
    "contains(t, CASE WHEN skill_name = 'of the' THEN ' ofthe~ ' "
    "ELSE ' ' || lower(skill_name) || ' ' END)"
)

_CATALOG = f"""cat AS (
  SELECT *, sha256(length(skill_name) || ':' || skill_name) AS skill_id
  FROM (VALUES {_values(TERMS)}) v(skill_name, category, tags))"""

_PAIRS = f"""{_CATALOG}, norm AS (
  SELECT doc_id::VARCHAR AS job_id, source || ' ' || lang AS job_title,
         source, {_padded('text')} AS t
  FROM documents),
pairs AS (
  SELECT job_id, job_title, source, skill_name, skill_id, category, tags
  FROM norm, cat WHERE {_HAS}),
counts AS (
  SELECT skill_name, count(DISTINCT job_id) AS job_count FROM pairs GROUP BY 1)"""

_DONE = """done AS (
  SELECT doc_id::VARCHAR AS job_id, CASE WHEN quality = 1
    THEN TIMESTAMP '2024-02-01 10:30:00' ELSE TIMESTAMP '2024-02-02 11:45:30'
    END AS skill_extraction_date
  FROM labels)"""

_NOW = "TIMESTAMP '2024-03-01 08:00:00'"

_COOCCURRING = f"""WITH {_PAIRS}
SELECT b.skill_name, count(DISTINCT b.job_id) AS job_count
FROM pairs a JOIN pairs b ON a.job_id = b.job_id
WHERE a.skill_name = 'of' AND b.skill_name <> 'of'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""

_PARTS = """parts AS (
  SELECT p_name || ' ' || p_partkey AS skill_name, p_type, p_brand, p_size,
         CASE WHEN p_type <> 'PROMO' THEN p_brand END AS category
  FROM part)"""

_PAGE_JOBS = r"""page_jobs AS (
  SELECT page_id, 'web' AS source, regexp_extract(url, '/(\d+)', 1) AS job_source_id,
         regexp_extract(url, '^[^?#]+') AS job_url
  FROM pages)"""

_STATUS = f"""{_PAIRS}, batch AS (
  SELECT job_id, job_title, source, skill_name, skill_id FROM pairs
  UNION ALL
  SELECT job_id, job_title, source, skill_name, skill_id FROM pairs
  WHERE job_id IN (SELECT doc_id::VARCHAR FROM labels WHERE toxic = 1)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY job_id, skill_name) AS copy FROM batch),
statuses AS (
  SELECT job_id, job_title,
    CASE WHEN skill_name <> 'rest' THEN skill_id END AS skill_id, skill_name,
    CASE WHEN skill_name = 'rest' OR source = 'src0' THEN 'failed'
         WHEN job_id IN (SELECT doc_id::VARCHAR FROM labels) THEN 'duplicate'
         WHEN copy > 1 THEN 'duplicate' ELSE 'inserted' END AS status
  FROM numbered)"""

_DAYS = """days AS (
  SELECT d.doc_id, d.text, d.lang, d.source, o.o_orderdate::DATE AS day, l.quality,
         l.toxic
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

_POSTINGS = rf"""{_DAYS}, postings AS (
  SELECT *, format('{{:x}}', doc_id) AS number,
    CASE WHEN source = 'src0' THEN 'no_json_ld' WHEN quality = 0 THEN 'bad_json'
         WHEN toxic = 1 THEN 'bad_shape' END AS error_reason,
    CASE WHEN quality IS NOT NULL THEN upper(lang) END AS country
  FROM days),
parsed AS (
  SELECT CASE WHEN lang = 'en' THEN 'job_' || number || '.html'
              ELSE 'viewjob?jk=' || number || '&from=x.html' END AS file_name,
    error_reason, lang, day,
    CASE WHEN error_reason IS NULL THEN 'indeed' END AS source,
    CASE WHEN error_reason IS NULL THEN number END AS job_source_id,
    CASE WHEN error_reason IS NULL THEN country END AS country,
    CASE WHEN error_reason IS NULL THEN source || ' ' || lang END AS job_title,
    CASE WHEN error_reason IS NULL THEN source END AS company_name,
    CASE WHEN error_reason IS NULL THEN 'https://'
      || coalesce(lower(country) || '.', '') || 'indeed.com/viewjob?jk=' || number
      END AS job_url,
    CASE WHEN error_reason IS NULL
      THEN trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))
      END AS job_description,
    CASE WHEN error_reason IS NULL THEN CASE WHEN lang = 'de'
      THEN strftime(day, '%d.%m.%Y') ELSE strftime(day, '%Y-%m-%d') END
      END AS posted_date
  FROM postings)"""

# Entities that occur in the pages; some lost their semicolon.
def _decoded(text: str) -> str:
    for name, character in (
        ("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")
    ):
        text = f"regexp_replace({text}, '&{name};?', '{character}', 'g')"
    return text


_NODES = (
    r"list_filter(list_transform(string_split(regexp_replace(regexp_replace(html, "
    r"'<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', chr(1), 'gs'), "
    r"'<[^>]+>', chr(1), 'g'), chr(1)), lambda x: trim("
    + _decoded("x")
    + r", ' ' || chr(9) || chr(10) || chr(13) || chr(160))), lambda x: x <> '')"
)

_PAGE_TEXT = f"""page_texts AS (
  SELECT page_id, array_to_string({_NODES}, ' ') AS job_description FROM pages)"""

_DAILY = """SELECT {key} AS package_id, ts::DATE AS date, count(*) AS downloads
  FROM events {where} GROUP BY 1, 2"""

_USER_DAILY = _DAILY.format(key="user_id::VARCHAR", where="")


def oracle_sql() -> dict[str, str]:
    sql = {}

    # Matching.
    sql["skill_pairs"] = f"WITH {_PAIRS} SELECT job_id, job_title, skill_name FROM pairs"
    sql["unprocessed_pairs"] = f"""WITH {_PAIRS} SELECT job_id, job_title, skill_name
FROM pairs WHERE job_id NOT IN (SELECT doc_id::VARCHAR FROM labels)"""
    sql["variant_pairs"] = f"""WITH cat AS (
  SELECT * FROM (VALUES {_values(VARIANT_TERMS)}) v(skill_name, category, forms)),
norm AS (SELECT doc_id, source, lang, {_padded('text')} AS t FROM documents),
forms AS (SELECT skill_name, unnest(forms) AS form FROM cat)
SELECT DISTINCT doc_id::VARCHAR AS job_id, source || ' ' || lang AS job_title, skill_name
FROM norm, forms
WHERE contains(replace(t, ' ofthe~ ', ' of   the '), ' ' || form || ' ')"""
    singles = [row for row in seed_rows() if row[0].isalnum()]
    sql["seed_skill_counts"] = f"""WITH cat AS (
  SELECT * FROM (VALUES {_values(singles)}) v(skill_name, category, tags)),
norm AS (SELECT doc_id, {_padded('text')} AS t FROM documents)
SELECT skill_name, count(*) AS job_count FROM norm, cat
WHERE contains(t, ' ' || lower(skill_name) || ' ') GROUP BY 1"""
    words = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))"
    sql["word_counts"] = f"""WITH
names AS (SELECT DISTINCT {words} AS skill_name FROM benchmark),
found AS (SELECT DISTINCT doc_id, {words} AS skill_name FROM documents)
SELECT skill_name, count(*) AS job_count FROM found JOIN names USING (skill_name)
GROUP BY 1"""
    sql["page_skill_counts"] = f"""WITH {_CATALOG}, {_PAGE_TEXT},
norm AS (SELECT page_id, {_padded('job_description')} AS t FROM page_texts)
SELECT skill_name, count(*) AS job_count FROM norm, cat WHERE {_HAS} GROUP BY 1"""

    sql["word_counts_by_grams"] = sql["word_counts"]

    # Analytics.
    sql["extraction_metadata"] = f"""WITH {_DONE}
SELECT count(DISTINCT d.doc_id) AS total_jobs,
       max(skill_extraction_date) AS last_ingestion
FROM documents d JOIN done ON done.job_id = d.doc_id::VARCHAR"""
    sql["status_line"] = f"""WITH {_DONE}, meta AS (
  SELECT count(DISTINCT d.doc_id) AS total_jobs,
    coalesce(strftime(max(skill_extraction_date), '%Y-%m-%d %H:%M'), 'Never')
      AS last_ingestion
  FROM documents d JOIN done ON done.job_id = d.doc_id::VARCHAR)
SELECT *, 'Data source: Documents | Jobs ingested: ' || total_jobs
  || ' | Last ingestion: ' || last_ingestion AS status FROM meta"""
    sql["top_skills"] = f"""WITH {_PAIRS} SELECT * FROM counts
ORDER BY job_count DESC, skill_name LIMIT 10"""
    sql["skill_counts"] = f"WITH {_PAIRS} SELECT * FROM counts"
    sql["all_skills"] = f"WITH {_PAIRS} SELECT DISTINCT skill_name FROM pairs"
    sql["all_categories"] = f"""WITH {_PARTS}
SELECT DISTINCT category FROM parts WHERE category IS NOT NULL"""
    sql["all_tags"] = """SELECT DISTINCT unnest([p_type, 'size-' || p_size]) AS tag
FROM part"""
    sql["cooccurring_skills"] = _COOCCURRING
    sql["skills_by_category"] = f"""WITH {_PAIRS}
SELECT p.skill_name, count(DISTINCT job_id) AS job_count
FROM pairs p JOIN cat c ON p.skill_id = c.skill_id WHERE c.category = 'prep'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""
    sql["tag_cooccurrence"] = f"""WITH {_PAIRS}, expanded AS (
  SELECT p.job_id, unnest(c.tags) AS tag
  FROM pairs p JOIN cat c ON p.skill_id = c.skill_id
  WHERE list_has_any(c.tags, ['de', 'common']))
SELECT tag, count(DISTINCT job_id) AS co_occurrence_count FROM expanded
WHERE tag NOT IN ('de', 'common') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""
    sql["skill_hierarchy"] = f"""WITH {_PAIRS}
SELECT 'Skills' AS label, '' AS parent, 1::BIGINT AS value
UNION ALL SELECT skill_name, 'Skills', job_count FROM counts"""
    sql["median_count"] = f"""WITH {_PAIRS}
SELECT median(job_count)::DOUBLE AS median_count FROM counts"""
    sql["cooccurring_bottom_up"] = f"""SELECT * FROM ({_COOCCURRING})
ORDER BY job_count, skill_name DESC"""

    # Merge.
    sql["batch_dedup"] = f"""WITH {_PAGE_JOBS}
SELECT source, job_source_id, job_url, page_id FROM page_jobs
QUALIFY row_number() OVER (PARTITION BY job_source_id ORDER BY page_id) = 1"""
    sql["new_jobs"] = f"""WITH {_PAGE_JOBS}
SELECT sha256('3:web' || length(job_source_id) || ':' || job_source_id || '0:') AS job_id,
  source, job_source_id, job_url, page_id, {_NOW} AS created_at,
  NULL::TIMESTAMP AS skill_extraction_date
FROM page_jobs p
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id::VARCHAR = p.job_source_id)
QUALIFY row_number() OVER (PARTITION BY source, job_source_id ORDER BY page_id) = 1"""
    sql["new_jobs_by_url"] = f"""WITH {_PAGE_JOBS}
SELECT source, job_source_id, job_url, page_id FROM page_jobs
WHERE NOT contains(job_url, '/fr/')
QUALIFY row_number() OVER (PARTITION BY job_url ORDER BY page_id) = 1"""
    sql["catalog_upsert"] = f"""WITH {_PARTS},
old AS (SELECT skill_name, category, p_type || ',size-' || p_size AS tags
        FROM parts WHERE p_size <= 30),
new AS (SELECT skill_name, p_type AS category, p_brand AS tags
        FROM parts WHERE p_size > 20)
SELECT sha256(length(skill_name) || ':' || skill_name) AS skill_id, skill_name,
  CASE WHEN n.tags IS NULL THEN o.category ELSE n.category END AS category,
  coalesce(n.tags, o.tags) AS tags,
  CASE WHEN n.tags IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE {_NOW} END
    AS created_at
FROM old o FULL JOIN new n USING (skill_name)"""
    sql["pair_load_status"] = f"""WITH {_STATUS}
SELECT job_id, job_title, skill_id, skill_name, status, count(*) AS n_rows
FROM statuses GROUP BY ALL"""
    sql["inserted_pairs"] = f"""WITH {_STATUS}
SELECT sha256(length(job_id) || ':' || job_id || '64:' || skill_id) AS job_skill_id,
  job_id, job_title, skill_id, skill_name, 'regex' AS extraction_method,
  {_NOW} AS created_at
FROM statuses WHERE status = 'inserted'"""
    sql["pair_load_summary"] = f"""WITH {_STATUS}
SELECT count(*) FILTER (status = 'inserted') AS inserted,
  count(*) FILTER (status = 'duplicate') AS duplicates,
  count(*) FILTER (status = 'failed') AS failed, count(*) AS total FROM statuses"""
    sql["mark_processed"] = f"""WITH {_STATUS}, {_DONE}
SELECT d.doc_id::VARCHAR AS job_id, CASE WHEN d.doc_id::VARCHAR IN
    (SELECT job_id FROM statuses WHERE status = 'inserted') THEN {_NOW}
  ELSE done.skill_extraction_date END AS skill_extraction_date
FROM documents d LEFT JOIN done ON done.job_id = d.doc_id::VARCHAR"""
    sql["cascade_delete_jobs"] = f"""WITH {_PAIRS} SELECT job_id, skill_name FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM labels l
  WHERE l.toxic = 1 AND l.doc_id::VARCHAR = p.job_id)"""
    sql["cascade_delete_skills"] = f"""WITH {_PAIRS}
SELECT job_id, skill_name FROM pairs WHERE category <> 'prep'"""
    sql["orphan_pairs"] = f"""WITH {_PAIRS} SELECT job_id, skill_name FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id::VARCHAR = p.job_id)"""
    sql["row_quality"] = f"""WITH {_DAYS}, rows AS (
  SELECT doc_id::VARCHAR AS job_source_id, split_part(text, chr(10), 1) AS job_title,
    CASE lang WHEN 'de' THEN strftime(day, '%d.%m.%Y')
      WHEN 'fr' THEN strftime(day, '%Y%m%d')
      ELSE strftime(day, '%Y-%m-%d') END AS posted_date, lang
  FROM days)
SELECT job_source_id, job_title, posted_date,
  CASE WHEN length(rtrim(job_title, ' ')) > 255 THEN 'too_long:job_title'
       WHEN lang = 'de' THEN 'bad_date:posted_date' END AS error_reason
FROM rows"""

    # Extraction.
    sql["jsonld_jobs"] = f"""WITH {_POSTINGS}
SELECT file_name, source, job_source_id, country, job_title, company_name, job_url,
  job_description, posted_date, error_reason FROM parsed"""
    sql["jsonld_metrics"] = f"""WITH {_POSTINGS}
SELECT count(*) AS files, count(DISTINCT job_source_id) AS saved,
  count(job_source_id) - count(DISTINCT job_source_id) AS duplicates,
  count(error_reason) AS failed FROM parsed"""
    page_id = r"regexp_replace(url, '^.*/', '')"
    sql["page_source_id"] = f"""WITH named AS (
  SELECT page_id, replace({page_id}, '.html', '') AS job_source_id,
         regexp_extract(url, '/([a-z]{{2}})/', 1) AS country FROM pages)
SELECT page_id, job_source_id, 'https://' || CASE WHEN country = '' THEN ''
  ELSE country || '.' END || 'indeed.com/viewjob?jk=' || job_source_id AS job_url
FROM named"""
    sql["page_text"] = f"WITH {_PAGE_TEXT} SELECT page_id, job_description FROM page_texts"

    def inside(pattern):
        return f"trim({_decoded(f'regexp_extract(html, {_text(pattern)}, 1)')})"

    sql["page_selectors"] = f"""SELECT page_id::VARCHAR AS file_name, 'indeed' AS source,
  {inside('<h1>([^<]*)</h1>')} AS job_title, NULL::VARCHAR AS company_name,
  {inside('<footer>([^<]*)</footer>')} AS location,
  'https://indeed.com/viewjob?jk=' || page_id AS job_url,
  {inside('<div class="ad">([^<]*)</div>')} AS job_description,
  NULL::DATE AS posted_date, NULL::VARCHAR AS job_type FROM pages"""
    link = r"""'<a href="/([^"]*)">([^<]*)</a>'"""
    sql["listing_cards"] = f"""WITH links AS (
  SELECT page_id, unnest(regexp_extract_all(html, {link})) AS link,
    generate_subscripts(regexp_extract_all(html, {link}), 1) - 1 AS card_no
  FROM pages),
cards AS (
  SELECT page_id, card_no, regexp_extract(link, {link}, 1) AS key,
         regexp_extract(link, {link}, 2) AS title FROM links)
SELECT page_id::VARCHAR AS file_name, card_no::INTEGER AS card_no, 'indeed' AS source,
  {_decoded('key')} AS job_id,
  CASE WHEN key = 'the' THEN 'Unknown' ELSE {_decoded('title')} END AS job_title,
  CASE WHEN key <> 'the' THEN '/v/' || {_decoded('key')} END AS job_url,
  'TBD' AS company_name, 'Argentina' AS location, 'TBD' AS job_description,
  NULL::DATE AS posted_date, NULL::VARCHAR AS job_type,
  DATE '2024-01-31' AS scraped_date
FROM cards"""

    # Exports, tables, stream.
    sql["export_roundtrip"] = sql["skill_pairs"]
    sql["csv_roundtrip"] = """SELECT doc_id::VARCHAR AS job_id, lang AS country,
  text AS job_description FROM documents"""
    sql["repeated_load"] = f"""WITH {_PAIRS}
SELECT CASE WHEN skill_name IN ('of', 'in', 'for') THEN '1' ELSE '2' END AS load_id,
  skill_name, count(*) AS n_pairs FROM pairs GROUP BY 1, 2"""
    sql["stream_jobs"] = f"""WITH {_POSTINGS}
SELECT source, job_source_id, country, job_title, company_name, job_url,
  job_description, day AS posted_date, {_NOW} AS created_at,
  NULL::TIMESTAMP AS skill_extraction_date
FROM parsed WHERE error_reason IS NULL AND lang <> 'de'"""

    sql["loaded_job_skills"] = f"""WITH {_POSTINGS}, {_CATALOG}, norm AS (
  SELECT sha256('6:indeed' || length(job_source_id) || ':' || job_source_id || '0:')
    AS job_id, job_title, {_padded('job_description')} AS t
  FROM parsed WHERE error_reason IS NULL AND lang <> 'de')
SELECT sha256('64:' || job_id || '64:' || skill_id) AS job_skill_id, job_id, job_title,
  skill_id, skill_name, 'regex' AS extraction_method, {_NOW} AS created_at
FROM norm, cat WHERE {_HAS}"""

    # Trends.
    daily = _DAILY.format(key="event_type", where="")
    sql["downloads_daily"] = f"""SELECT sha256(length(package_id) || ':' || package_id
  || '10:' || date) AS download_id, *, {_NOW} AS created_at FROM ({daily})"""
    old = _DAILY.format(key="user_id::VARCHAR", where="WHERE event_type = 'view'")
    new = _DAILY.format(key="user_id::VARCHAR", where="WHERE event_type <> 'error'")
    sql["downloads_load"] = f"""SELECT package_id, date,
  coalesce(n.downloads, o.downloads) AS downloads,
  CASE WHEN n.downloads IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE {_NOW} END
    AS created_at
FROM ({old}) o FULL JOIN ({new}) n USING (package_id, date)"""
    sql["downloads_rolling7"] = f"""SELECT package_id, date, downloads,
  sum(downloads) OVER (PARTITION BY package_id ORDER BY date
    RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)::BIGINT AS rolling,
  downloads - lag(downloads) OVER (PARTITION BY package_id ORDER BY date) AS change
FROM ({_USER_DAILY})"""
    sql["downloads_by_category"] = """SELECT c_mktsegment AS category,
  count(*) AS downloads
FROM events JOIN customer ON c_custkey = user_id GROUP BY 1"""
    for period in ("week", "month"):
        sql[f"demand_by_{period}"] = f"""WITH {_PAIRS}
SELECT date_trunc('{period}', o_orderdate)::DATE AS period_start, skill_name,
  count(DISTINCT job_id) AS job_count
FROM pairs JOIN orders ON o_orderkey::VARCHAR = job_id GROUP BY 1, 2"""
    sql["skill_lift"] = f"""WITH {_PAIRS}, n AS (SELECT count(*) AS total FROM documents),
both_ AS (SELECT b.skill_name, count(DISTINCT b.job_id) AS job_count
  FROM pairs a JOIN pairs b ON a.job_id = b.job_id
  WHERE a.skill_name = 'of' AND b.skill_name <> 'of' GROUP BY 1)
SELECT skill_name, b.job_count, round(b.job_count / total, 6) AS support,
  round(b.job_count::DOUBLE * total
    / (c.job_count * (SELECT job_count FROM counts WHERE skill_name = 'of')), 6) AS lift
FROM both_ b JOIN counts c USING (skill_name), n"""
    sql["filtered_jobs"] = f"""WITH {_PAIRS}
SELECT doc_id::VARCHAR AS job_id, lang AS country, source AS company_name
FROM documents WHERE lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3')
AND doc_id::VARCHAR IN
  (SELECT job_id FROM pairs WHERE skill_name IN ('with', 'von'))"""
    sql["searched_jobs"] = r"""WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w
  FROM documents),
tf AS (SELECT doc_id, count(*) FILTER (w = 'the') AS a, count(*) FILTER (w = 'rest') AS b
  FROM words GROUP BY 1),
idf AS (SELECT (SELECT count(*) FROM documents) AS n,
  count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM tf)
SELECT doc_id::VARCHAR AS job_id,
  round(b * ln(n / db) + a * ln(n / da), 6) AS score
FROM tf, idf WHERE a > 0 AND b > 0"""

    # Loads.
    sql["html_folder_jobs"] = f"""WITH {_POSTINGS}
SELECT CASE WHEN lang = 'en' THEN '9' ELSE '10' END AS run, file_name, 'moved' AS status,
  job_source_id, job_url, CASE WHEN error_reason IS NULL AND lang <> 'de' THEN day END
  AS posted_date, error_reason, error_reason IS NULL AND lang <> 'de' AS loaded FROM parsed"""
    sql["replayed_loads"] = f"""WITH {_PAIRS}, loads AS (
  SELECT CASE WHEN skill_name IN ('of', 'was') THEN '9' ELSE '10' END AS load_id,
    skill_name FROM pairs WHERE skill_name IN ('of', 'was', 'with', 'The'))
SELECT load_id, skill_name, count(*) AS n_pairs,
  CASE load_id WHEN '9' THEN 1 ELSE 2 END::BIGINT AS sequence,
  sum(count(*)) OVER (PARTITION BY load_id)::BIGINT AS n_rows
FROM loads GROUP BY load_id, skill_name"""
    sql["compacted_loads"] = f"""WITH {_PAIRS}
SELECT category AS load_id, skill_name, count(*) AS n_pairs, 3::BIGINT AS n_moved,
  3::BIGINT AS n_folders
FROM pairs WHERE category IN ('article', 'prep', 'verb', 'conj') AND skill_name <> 'of'
GROUP BY 1, 2"""
    sql["null_key_loads"] = f"""WITH {_PAIRS}, loads AS (
  SELECT '1' AS load_id, doc_id FROM documents
  UNION ALL SELECT '2', doc_id FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
sizes AS (SELECT job_id, count(*) AS n FROM pairs GROUP BY 1)
SELECT load_id, lang AS country, count(*) AS n_jobs, count(*) AS n_ids,
  coalesce(sum(n), 0)::BIGINT AS n_pairs, coalesce(sum(n), 0)::BIGINT AS n_pair_keys
FROM loads JOIN documents USING (doc_id) LEFT JOIN sizes ON job_id = doc_id::VARCHAR
GROUP BY 1, 2"""
    sql["catalog_quality"] = """WITH batch AS (
  SELECT CASE WHEN p_type = 'PROMO' THEN NULL
    WHEN p_size > 40 THEN rpad(p_name || ' ' || p_partkey, 101, '.')
    ELSE p_name || ' ' || p_partkey END AS skill_name,
    CASE WHEN p_size < 5 THEN repeat(p_brand, 10) ELSE p_brand END AS category
  FROM part)
SELECT *, CASE WHEN skill_name IS NULL THEN 'missing:skill_name'
  WHEN length(skill_name) > 100 THEN 'too_long:skill_name'
  WHEN length(category) > 50 THEN 'too_long:category' END AS error_reason FROM batch"""
    # Leftmost hits that do not overlap: a fold over the hits of a text in order.
    parts = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]')"
    sql["phrase_counts"] = rf"""WITH
b AS (SELECT {parts} AS p FROM benchmark),
names AS (
  SELECT DISTINCT p[i] || ' ' || p[i + 2] AS skill_name
  FROM b, unnest(range(1, len(p) - 1)) t(i)
  WHERE p[i + 1] = ' ' AND regexp_matches(p[i], '^[\p{{L}}\p{{N}}_]')
    AND regexp_matches(p[i + 2], '^[\p{{L}}\p{{N}}_]')),
d AS (SELECT doc_id, {parts} AS p FROM documents),
found AS (
  SELECT doc_id, i, p[i] || ' ' || p[i + 2] AS skill_name
  FROM d, unnest(range(1, len(p) - 1)) t(i) WHERE p[i + 1] = ' '),
hits AS (SELECT doc_id, i, skill_name FROM found JOIN names USING (skill_name)),
folded AS (
  SELECT doc_id, list_reduce(list({{'s': i, 'e': i + 3, 'n': [skill_name]}} ORDER BY i),
    lambda a, h: CASE WHEN h.s >= a.e THEN {{'s': a.s, 'e': h.e, 'n': list_concat(a.n, h.n)}}
      ELSE a END).n AS kept FROM hits GROUP BY 1),
kept AS (SELECT DISTINCT doc_id, unnest(kept) AS skill_name FROM folded)
SELECT skill_name, count(*) AS job_count FROM kept GROUP BY 1"""
    sql["phrase_counts_by_grams"] = sql["phrase_counts"]
    sql["array_export_pairs"] = sql["skill_pairs"]
    sql["legacy_jobs"] = f"""WITH cards AS ({sql['listing_cards']}),
kept AS (
  SELECT '1' AS load_id, job_url, min(job_title) AS job_title FROM cards
  WHERE job_url IS NOT NULL GROUP BY 2
  UNION ALL SELECT load_id, NULL, job_title FROM cards, (VALUES ('1'), ('2')) v(load_id)
  WHERE job_url IS NULL)
SELECT load_id, job_url, job_title, 'Argentina' AS location, DATE '2024-01-31' AS scraped_date,
  count(*) AS n FROM kept GROUP BY ALL"""

    # Streams.
    sql["stream_dedup"] = f"""WITH {_PAGE_JOBS}
SELECT source, job_source_id, job_url, page_id FROM page_jobs
QUALIFY row_number() OVER (PARTITION BY job_source_id ORDER BY
  CASE WHEN contains(job_url, '/fr/') THEN 0 WHEN contains(job_url, '/de/') THEN 1 ELSE 2 END,
  page_id) = 1"""
    sql["downloads_stream"] = sql["downloads_daily"]
    errors = _DAILY.format(key="user_id::VARCHAR", where="WHERE event_type = 'error'")
    sql["downloads_filled"] = f"""WITH days AS ({errors}), dates AS (
  SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM days),
packages AS (SELECT DISTINCT package_id FROM days)
SELECT package_id, date, coalesce(downloads, 0) AS downloads
FROM packages CROSS JOIN dates LEFT JOIN days USING (package_id, date)"""

    # State kept between reports.
    sql["top_skills_incremental"] = sql["top_skills"]
    sql["frequent_pairs"] = f"""WITH {_PAIRS}, n AS (SELECT count(*) AS total FROM documents),
both_ AS (SELECT a.skill_name AS skill_a, b.skill_name AS skill_b, count(*) AS job_count
  FROM pairs a JOIN pairs b ON a.job_id = b.job_id AND a.skill_name < b.skill_name GROUP BY 1, 2)
SELECT skill_a, skill_b, both_.job_count, round(both_.job_count / total, 6) AS support,
  round(both_.job_count::DOUBLE * total / (x.job_count * y.job_count), 6) AS lift
FROM both_ JOIN counts x ON x.skill_name = skill_a JOIN counts y ON y.skill_name = skill_b, n
WHERE both_.job_count / total >= 0.01"""
    sql["indexed_search"] = f"""SELECT * FROM ({sql['searched_jobs']})
ORDER BY score DESC, job_id LIMIT 20"""
    sql["cascade_packages"] = f"""SELECT package_id, date, downloads FROM ({_USER_DAILY})
WHERE package_id NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_mktsegment = 'BUILDING')
  AND day(date) <> 1"""
    return sql
