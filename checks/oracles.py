"""DuckDB SQL that gives the result each query must give, written independently of it."""

from __future__ import annotations

from checks.views import CAPPED_RUN, MANY_KEYWORDS, ORDERS_RUN_TS, RUN, TEST_RULES, duck_listing, duck_registry
from handbill.config import KNOWN_CITIES, STREAMS
from handbill.functions.dates import POLISH_MONTHS, POLISH_SHORT_MONTHS
from handbill.operators import digest as texts
from handbill.sources.pages import STUB_PREFIX

_REASONS = ("no_category", "excluded:sports_or_league_match", "geo:ai_digital_outside_tricity_not_large",
            "geo:culture_family_outside_tricity", "geo:concert_outside_tricity_not_world_class", "date:past",
            "date:beyond_window")
RUN_DATE = f"DATE '{RUN.run_ts:%Y-%m-%d}'"
RUN_TIME = f"TIMESTAMP '{RUN.run_ts:%Y-%m-%d %H:%M:%S}'"
ORDERS_DATE = f"DATE '{ORDERS_RUN_TS:%Y-%m-%d}'"
STREAM_LIST = "[" + ", ".join(f"'{s}'" for s in STREAMS) + "]"
_SPACE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '\\s+', ' ', 'g'))"


def hits(text: str, words) -> str:
    return "(" + " + ".join(f"contains({text}, {quote(w)})::INT" for w in words) + ")"


def any_hit(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {quote(w)})" for w in words) + ")"


def first_hit(text: str, words, prefix: str) -> str:
    cases = " ".join(f"WHEN contains({text}, {quote(w)}) THEN {quote(prefix + w)}" for w in words)
    return f"CASE {cases} END"


def city(x: str) -> str:
    cases = " ".join(f"WHEN contains({norm(x)}, '{c}') THEN '{c}'" for c in KNOWN_CITIES)
    return f"CASE {cases} ELSE {norm(x)} END"


def in_list(x: str, words) -> str:
    return f"{x} IN ({', '.join(quote(w) for w in words)})"


def trust(source: str) -> str:
    cases = " ".join(f"WHEN {quote(s)} THEN {t}" for s, t in TEST_RULES["source_trust"].items())
    return f"CAST(CASE {source} {cases} ELSE 0.5 END AS DOUBLE)"


def content_hash(prefix: str = "") -> str:
    p = prefix
    when = "coalesce(strftime({}, '%Y-%m-%dT%H:%M:%S'), '')"
    money = "CASE WHEN {0} IS NULL THEN 'None' ELSE printf('%.2f', {0}) END"
    parts = [
        when.format(p + "start_datetime"), when.format(p + "end_datetime"), p + "city_norm",
        norm(p + "venue_name"), money.format(p + "price_min"), money.format(p + "price_max"),
        f"coalesce({p}ticket_url, '')",
    ]
    return f"substr(sha1(concat_ws('|', {', '.join(parts)})), 1, 16)"


# --- the run as a chain of common table expressions ------------------------------------

EVENTS = f"""
l AS ({duck_listing()}),
reg AS ({duck_registry()}),
ev AS (
  SELECT seq, source, source_url, trim(title, {_SPACE}) AS title, start_datetime, end_datetime,
    city, venue_name, CAST(NULL AS VARCHAR) AS address,
    nullif(trim(description, {_SPACE}), '') AS description, price_min,
    CAST(NULL AS DOUBLE) AS price_max,
    coalesce(is_free, CASE WHEN price_min = 0 THEN TRUE END) AS is_free, ticket_url, artist,
    subcategory
  FROM l)"""

WITH_TEXT = EVENTS + f""",
t0 AS (
  SELECT *, {norm('title')} AS title_norm, {norm('subcategory')} AS subcategory_norm,
    {norm('venue_name')} AS venue_norm, {city('city')} AS city_norm,
    {norm('description')} AS description_norm, {norm('artist')} AS artist_norm
  FROM ev),
t AS (
  SELECT *, title_norm || ' ' || subcategory_norm || ' ' || description_norm AS class_text,
    title_norm || ' ' || subcategory_norm || ' ' || description_norm || ' ' || venue_norm
      || '  ' || artist_norm AS match_text,
    city_norm IN ('gdansk', 'gdynia', 'sopot', 'trojmiasto') AS is_tricity,
    replace(title_norm, ' ', '-') || '|' || coalesce(strftime(start_datetime, '%Y-%m-%d'), 'no-date')
      || '|' || coalesce(nullif(city_norm, ''), venue_norm) AS dedup_key
  FROM t0)"""

_POINTS = {s: hits("class_text", TEST_RULES["classify"][s]) for s in STREAMS}
_POINTS["concert"] += " + CASE WHEN coalesce(artist, '') <> '' THEN 2 ELSE 0 END"


def classified(with_registry: bool) -> str:
    """Category column, with the serving sources' streams or with all of them."""
    if with_registry:
        source = f"""
  SELECT t.*, list_filter(streams, lambda s: list_contains({STREAM_LIST}, s)) AS st,
    force_category AS force
  FROM t JOIN reg ON reg.source_id = t.source
  WHERE enabled AND list_has_any(streams, {STREAM_LIST})"""
    else:
        source = f"SELECT t.*, {STREAM_LIST} AS st, CAST(NULL AS VARCHAR) AS force FROM t"
    points = ", ".join(f"{_POINTS[s]} AS p_{s}" for s in STREAMS)
    values = ", ".join(f"('{s}', p_{s})" for s in STREAMS)
    return WITH_TEXT + f""",
c0 AS (SELECT *, {points} FROM ({source})),
c1 AS (
  SELECT c0.seq, v.s, row_number() OVER (
      PARTITION BY c0.seq ORDER BY v.p DESC, list_position(st, v.s)) AS n
  FROM c0, LATERAL (VALUES {values}) v(s, p)
  WHERE list_contains(st, v.s) AND v.p > 0),
c AS (
  SELECT c0.*, coalesce(force, c1.s) AS category
  FROM c0 LEFT JOIN c1 ON c1.seq = c0.seq AND c1.n = 1)"""


_R = TEST_RULES
_DAYS = "date_diff('day', CAST(start_datetime AS DATE), CAST(end_datetime AS DATE)) + 1"
LARGE = f"""coalesce({first_hit('match_text', _R['large_event']['known_brands'], 'known_brand:')},
  CASE WHEN {_DAYS} >= {_R['large_event']['min_days']}
       THEN 'multiday:' || ({_DAYS}) || 'd' END)"""
WORLD = f"""coalesce(
  CASE WHEN {in_list('source', _R['world_class']['trusted_sources'])}
       THEN 'trusted_source:' || source END,
  {first_hit('match_text', _R['world_class']['allowlist'], 'allowlist:')},
  {first_hit('match_text', _R['world_class']['large_venues'], 'large_venue:')})"""
FAMILY = f"""CASE WHEN {any_hit('match_text', _R['exclusions']['adult_only'])} THEN FALSE
  WHEN {any_hit('match_text', _R['family']['kids_keywords'])} THEN TRUE END"""
SPORTS = f"""({any_hit('match_text', _R['exclusions']['keywords'])}
  OR {in_list('subcategory_norm', _R['exclusions']['subcategories'])})"""


def judged(with_registry: bool = False) -> str:
    return classified(with_registry) + f""",
g AS (
  SELECT *,
    CASE WHEN category = 'ai_digital' AND NOT near AND major THEN {LARGE} END AS large,
    CASE WHEN category = 'concert' AND NOT is_tricity THEN {WORLD} END AS world,
    category = 'culture_family' AND {SPORTS} AS sport
  FROM (SELECT *, {in_list('city_norm', _R['tricity_surroundings'])} AS near,
          {in_list('city_norm', _R['major_cities'])} AS major FROM c)),
g2 AS (
  SELECT *,
    CASE WHEN category = 'culture_family' THEN {FAMILY} END AS family_raw,
    CASE WHEN category = 'culture_family' AND NOT sport THEN {FAMILY} END AS family_suitable,
    (large IS NOT NULL OR world IS NOT NULL) AS national_scope,
    coalesce('large_event:' || large, 'world_class:' || world, '') AS scope_reason,
    CASE WHEN category = 'ai_digital' THEN
           CASE WHEN NOT near AND large IS NULL THEN 'geo:ai_digital_outside_tricity_not_large' END
         WHEN category = 'culture_family' THEN
           CASE WHEN NOT is_tricity THEN 'geo:culture_family_outside_tricity' END
         WHEN category = 'concert' THEN
           CASE WHEN NOT is_tricity AND world IS NULL
                THEN 'geo:concert_outside_tricity_not_world_class' END
         ELSE 'no_category' END AS geo_drop
  FROM g),
g3 AS (
  SELECT *, {RUN_TIME} + to_days(CASE
      WHEN category = 'concert' AND national_scope THEN {_R['national_concert_window_days']}
      WHEN category = 'concert' THEN {_R['concert_window_days']}
      ELSE {_R['date_window_days']} END) AS last_start
  FROM g2),
j AS (
  SELECT *,
    CASE WHEN start_datetime IS NULL THEN NULL
         WHEN CAST(coalesce(end_datetime, start_datetime) AS DATE) < {RUN_DATE} THEN 'date:past'
         WHEN start_datetime > last_start THEN 'date:beyond_window' END AS date_drop,
    CASE WHEN category IS NULL THEN 'no_category'
         WHEN sport THEN 'excluded:sports_or_league_match'
         WHEN geo_drop IS NOT NULL THEN geo_drop
         WHEN start_datetime IS NULL THEN NULL
         WHEN CAST(coalesce(end_datetime, start_datetime) AS DATE) < {RUN_DATE} THEN 'date:past'
         WHEN start_datetime > last_start THEN 'date:beyond_window' END AS drop_reason
  FROM g3)"""


def _merged_fields() -> str:
    text = (
        "source_url title city venue_name address description ticket_url artist category "
        "subcategory scope_reason"
    ).split()
    columns = ["arg_min(seq, ord) AS seq", "arg_min(source, ord) AS source",
               "count(*) AS n_copies"]
    columns += [
        f"coalesce(arg_min({c}, ord) FILTER (WHERE {c} <> ''), arg_min_null({c}, ord)) AS {c}"
        for c in text
    ]
    columns += [
        f"coalesce(arg_min({c}, ord) FILTER (WHERE {c} <> 0), max(CASE WHEN {c} = 0 THEN 0.0e0 END)) AS {c}"
        for c in ("price_min", "price_max")
    ]
    columns += [f"bool_or({c}) AS {c}" for c in ("is_free", "national_scope", "family_suitable")]
    columns += [
        f"arg_min({c}, ord) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("start_datetime", "end_datetime")
    ]
    return ", ".join(columns)


def deduped(with_registry: bool = False, extra: str = "") -> str:
    """Kept rows merged by key (``m``) with texts of the merged fields (``d``)."""
    where = f"WHERE drop_reason IS NULL {extra}"
    return judged(with_registry) + f""",
k AS (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY {trust('source')} DESC, seq) AS ord
  FROM j {where}),
m AS (SELECT dedup_key, {_merged_fields()} FROM k GROUP BY dedup_key),
d0 AS (
  SELECT *, {city('city')} AS city_norm,
    {norm('title')} || ' ' || {norm('subcategory')} || ' ' || {norm('description')} AS class_text
  FROM m),
d AS (SELECT *, {content_hash()} AS content_hash FROM d0)"""


_OWN_HITS = "CASE category " + " ".join(
    f"WHEN '{s}' THEN {hits('class_text', _R['classify'][s])}" for s in STREAMS
) + " ELSE 0 END"
SCORE = f"""floor((
    CASE WHEN start_datetime IS NULL THEN 0.3e0
      ELSE 1.0e0 / (1.0e0 + greatest(date_diff('day', {RUN_DATE}, CAST(start_datetime AS DATE)), 0)) END
    * 1.0e0 + least({_OWN_HITS} / 3.0e0, 1.0e0) * 1.0e0 + {trust('source')} * 0.5e0)
  * 10000 + 0.5e0) / 10000.0e0"""


def ranked(source: str = "d", status: str = "'new'") -> str:
    """CTEs ``r``: scored and numbered rows of ``source``."""
    return f""",
r0 AS (SELECT *, {SCORE} AS relevance_score, {status} AS delivery_state,
         list_position({STREAM_LIST}, category) AS stream_no FROM {source}),
r AS (SELECT *, row_number() OVER (
        PARTITION BY category ORDER BY relevance_score DESC, start_datetime ASC NULLS LAST, seq)
        AS rank
      FROM r0 WHERE stream_no > 0)"""


LINE = f"""'- *' || title || '*'
  || CASE WHEN national_scope THEN {quote(texts.MARK_NATIONAL)} ELSE '' END
  || CASE WHEN family_suitable THEN {quote(texts.MARK_FAMILY)} ELSE '' END
  || CASE WHEN delivery_state = 'updated' THEN {quote(texts.MARK_UPDATED)} ELSE '' END
  || ' · ' || CASE
      WHEN CAST(start_datetime AS DATE) < {RUN_DATE} AND {RUN_DATE} <= CAST(end_datetime AS DATE)
        THEN 'trwa do ' || strftime(end_datetime, '%d %b')
      WHEN start_datetime IS NOT NULL THEN strftime(start_datetime, '%a %d %b %H:%M')
      ELSE 'termin ?' END
  || ' · ' || CASE
      WHEN coalesce(city, '') <> '' AND coalesce(venue_name, '') <> '' THEN city || ', ' || venue_name
      WHEN coalesce(city, '') <> '' THEN city
      WHEN coalesce(venue_name, '') <> '' THEN venue_name ELSE '?' END
  || ' · ' || CASE WHEN is_free THEN 'free'
      WHEN coalesce(price_min, 0) <> 0 THEN CAST(trunc(price_min) AS BIGINT) || ' zl+'
      ELSE '?' END
  || ' · <' || coalesce(nullif(ticket_url, ''), nullif(source_url, ''), '') || '|Info>'"""

# --- prior state of the two-run queries ------------------------------------------------

_EARLIER = deduped() + f""",
lab AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
p0 AS (
  SELECT d.* REPLACE (CASE WHEN lab.toxic = 1 THEN coalesce(d.price_min, 0) + 1 ELSE d.price_min END
      AS price_min), lab.quality = 1 AS delivered
  FROM d JOIN lab ON lab.doc_id = d.seq),
prior AS (
  SELECT * REPLACE ({content_hash()} AS content_hash),
    CASE WHEN delivered THEN {RUN_TIME} - to_days(7) END AS delivered_at FROM p0),
st AS (
  SELECT d.*, CASE WHEN NOT coalesce(prior.delivered, FALSE) THEN 'new'
      WHEN prior.content_hash = d.content_hash THEN 'unchanged' ELSE 'updated' END AS status
  FROM d LEFT JOIN prior USING (dedup_key))"""

_STATE_COLUMNS = (
    "id, dedup_key, source, title, category, price_min, is_free, national_scope, content_hash, "
    "relevance_score, delivered, delivered_at"
)
_UPSERTED = _EARLIER + f""",
u AS (
  SELECT substr(sha1(coalesce(d.dedup_key, prior.dedup_key)), 1, 16) AS id,
    coalesce(d.dedup_key, prior.dedup_key) AS dedup_key,
    {', '.join(f"CASE WHEN d.dedup_key IS NOT NULL THEN d.{c} ELSE prior.{c} END AS {c}" for c in
               "source title category price_min is_free national_scope content_hash".split())},
    0.0e0 AS relevance_score, coalesce(prior.delivered, FALSE) AS delivered, prior.delivered_at
  FROM prior FULL JOIN d ON d.dedup_key = prior.dedup_key)"""


def _digest_sql(cte: str, sources: str, skipped: str) -> str:
    """The digest with line numbers over a chain that ends in ``r``."""
    title = texts.TITLE + RUN.window_label
    parts, offset = [], "3"
    frame = [f"SELECT 1 AS line_no, CAST(NULL AS VARCHAR) AS category, {quote(title)} AS line"]
    for s in STREAMS:
        n = f"n_{s}"
        head = quote("### " + texts.SECTION_TITLES[s])
        frame.append(f"SELECT {offset} + 1, '{s}', {head} FROM sizes WHERE {n} > 0")
        frame.append(f"SELECT {offset} + 2, '{s}', '' FROM sizes WHERE {n} > 0")
        frame.append(f"SELECT {offset} + 3 + {n}, '{s}', '' FROM sizes WHERE {n} > 0")
        parts.append(
            f"SELECT {offset} + 2 + rank, category, {LINE} FROM r, sizes WHERE category = '{s}'"
        )
        offset = f"({offset} + CASE WHEN {n} > 0 THEN {n} + 3 ELSE 0 END)"
    total = " + ".join(f"n_{s}" for s in STREAMS)
    run_line = quote(f"_run {RUN.run_ts:%Y-%m-%d %H:%M}_")
    frame += [
        f"SELECT 2, NULL, {run_line} FROM sizes WHERE {total} > 0",
        f"SELECT 3, NULL, '' FROM sizes WHERE {total} > 0",
        f"SELECT {offset} + 1, NULL, '---' FROM sizes WHERE {total} > 0",
        f"SELECT {offset} + 2, NULL, '_' || ({total}) || ' wydarzen · ' || ({sources}) || "
        f"' zrodel · ' || ({skipped}) || ' pominietych · 0 kredytow Firecrawl_' "
        f"FROM sizes WHERE {total} > 0",
        f"SELECT 2, NULL, '' FROM sizes WHERE {total} = 0",
        f"SELECT 3, NULL, {quote(texts.NOTHING_NEW)} FROM sizes WHERE {total} = 0",
    ]
    counts = ", ".join(f"count(*) FILTER (WHERE category = '{s}') AS n_{s}" for s in STREAMS)
    body = "\nUNION ALL ".join(frame + parts)
    return (
        f"WITH {cte}, sizes AS (SELECT {counts} FROM r) "
        f"SELECT CAST(line_no AS BIGINT) AS line_no, category, line FROM ({body})"
    )


_MARKS = "replace(replace({0}, '**', chr(1) || chr(1)), chr(1) || '*', chr(1) || chr(1))"


def _markdown(x: str) -> str:
    """Links, then bold, without lookaround: stars in runs of two or more are set aside."""
    linked = f"regexp_replace({x}, '<([^|>]+)\\|([^>]+)>', '[\\2](\\1)', 'g')"
    bold = (
        f"regexp_replace({_MARKS.format(linked)}, '\\*([^*' || chr(1) || '\\n]+)\\*', "
        f"'**\\1**', 'g')"
    )
    return f"replace({bold}, chr(1), '*')"


def _decode(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                         ("&nbsp;", " "), ("&ndash;", "–"), ("&middot;", "·"), ("&copy;", "©"),
                         ("&oacute;", "ó"), ("&amp;", "&")):
        x = f"replace({x}, {quote(entity)}, {quote(char)})"
    return x


def _text_of(x: str) -> str:
    pieces = f"list_transform(regexp_split_to_array({x}, '<[^>]*>'), lambda p: trim({_decode('p')}, {_SPACE} || chr(160)))"
    return f"array_to_string(list_filter({pieces}, lambda p: p <> ''), ' ')"


_VISIBLE = (
    r"trim(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>"
    r"|<!--.*?-->|<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
)
_BASE = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_DOMAIN = r"regexp_extract(url, '^https?://([^/?#]+)', 1)"
_PAGE_TITLE = r"regexp_extract(html, '<title>([^<]*)</title>', 1)"


def _case_months(number: str, names: dict[str, int]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {n} THEN '{m}'" for m, n in names.items()) + " END"


ORACLES: dict[str, str] = {}

# --- sources ---------------------------------------------------------------------------

_START_TEXT = """CASE seq % 4 WHEN 0 THEN strftime(start_datetime, '%Y-%m-%d')
    WHEN 1 THEN strftime(start_datetime, '%Y-%m-%d %H:%M')
    WHEN 2 THEN strftime(start_datetime, '%d.%m.%Y')
    ELSE strftime(start_datetime - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') END"""
_PRICE_TEXT = "CAST(CAST(price_min AS DECIMAL(12,2)) AS VARCHAR)"
ORACLES["read_listings"] = f"""WITH l AS ({duck_listing()})
SELECT seq, source,
  CASE WHEN seq % 3 = 0 THEN '  ' || title || chr(9) || ' ' ELSE title END AS title,
  CASE WHEN seq % 2 = 0 THEN source_url END AS url,
  CASE WHEN seq % 2 = 1 THEN source_url END AS source_url,
  CASE WHEN seq % 5 = 0 THEN '' ELSE {_START_TEXT} END AS start, city,
  CASE seq % 3 WHEN 0 THEN replace({_PRICE_TEXT}, '.', ',')
    WHEN 1 THEN {_PRICE_TEXT} || ' zl' ELSE {_PRICE_TEXT} END AS price_min,
  is_free, md5(chr(10) || ' ' || description || ' ' || chr(10)) AS description_md5
FROM l"""
for _layout in ("read_array", "read_wrapped", "read_array_ranges"):
    ORACLES[_layout] = ORACLES["read_listings"]
ORACLES["select_sources"] = f"""WITH l AS ({duck_listing()}), reg AS ({duck_registry()})
SELECT seq, source FROM l WHERE source IN (
  SELECT source_id FROM reg WHERE enabled AND list_contains(streams, 'culture_family'))"""
ORACLES["attach_source"] = f"""WITH l AS ({duck_listing()}), reg AS ({duck_registry()})
SELECT seq, source, coalesce(array_to_string(
    list_filter(streams, lambda s: s IN ('culture_family', 'concert')), ','), '') AS streams,
  force_category
FROM l LEFT JOIN reg ON source_id = source"""
ORACLES["union_sources"] = f"""WITH l AS ({duck_listing()})
SELECT seq, source, CASE WHEN seq % 3 = 0 THEN '  ' || title || chr(9) || ' ' ELSE title END AS title,
  city, NULL AS url, NULL AS subcategory FROM l
UNION ALL SELECT page_id, {_DOMAIN}, {_PAGE_TITLE}, NULL, url, NULL FROM pages
UNION ALL SELECT conv_id * 1000 + turn, 'talks', text, NULL, NULL, role FROM conversations"""
ORACLES["landed_pages"] = f"""SELECT page_id, url, {_BASE} AS base_url, {_DOMAIN} AS domain,
  length(html) AS n_chars FROM pages"""
ORACLES["page_stub"] = f"""SELECT page_id, {quote(STUB_PREFIX)} || {_DOMAIN} AS title, url,
  substr({_VISIBLE}, 1, 2000) AS description, TRUE AS needs_extraction
FROM pages WHERE length({_VISIBLE}) > 0"""
ORACLES["digest_sink"] = f"""WITH {deduped()}{ranked()}
SELECT category, {LINE} AS line FROM r"""
ORACLES["run_report"] = f"""WITH {deduped()}{ranked()}
SELECT '{RUN.run_ts:%Y-%m-%dT%H:%M:%S}' AS run_at, '{','.join(STREAMS)}' AS streams,
  {RUN.date_window_days} AS window_days, (SELECT count(*) FROM j) AS events_found,
  (SELECT count(*) FROM d) AS events_kept,
  (SELECT count(*) FROM r WHERE rank <= {CAPPED_RUN.cap}) AS events_delivered,
  (SELECT string_agg(drop_reason || '=' || n, ';' ORDER BY drop_reason) FROM (
     SELECT drop_reason, count(*) AS n FROM j WHERE drop_reason IS NOT NULL GROUP BY 1)) AS drop_reasons,
  (SELECT string_agg(source || '=' || n, ';' ORDER BY source) FROM (
     SELECT source, count(*) AS n FROM j GROUP BY 1)) AS sources,
  0 AS status"""

# --- extraction: expected rows computed from the page columns ---------------------------

_LD = f"""ld AS (
  SELECT page_id, url, {_DOMAIN} AS domain, {_PAGE_TITLE} || ' ' || page_id AS name,
    strftime(DATE '2024-01-01' + CAST(page_id % 60 AS INT), '%Y-%m-%d') AS day,
    CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS broken
  FROM pages)"""
ORACLES["jsonld_blocks"] = f"""WITH {_LD}
SELECT page_id, broken AS block_no, NULL AS kind FROM ld
UNION ALL SELECT page_id, broken + 1, 'ItemList' FROM ld
UNION ALL SELECT page_id, broken + 2, 'ItemList' FROM ld"""
ORACLES["jsonld_walk"] = f"""WITH {_LD}
SELECT page_id, name AS title, day || 'T19:00' AS start,
  CASE WHEN page_id % 3 = 0 THEN 'Trojmiasto' ELSE 'Gdynia' END AS city,
  'Sala ' || (page_id % 5) AS venue, url, 'meetup' AS subcategory FROM ld
UNION ALL SELECT page_id, name || ' deep', day, 'Trojmiasto', NULL, NULL, 'meetup' FROM ld
UNION ALL SELECT page_id, name, day, 'Gdańsk , Sopot', NULL, url, 'meetup' FROM ld WHERE FALSE"""
ORACLES["jsonld_itemlist"] = f"""WITH {_LD}
SELECT page_id, name AS title, day AS start, 'Gdańsk' AS city, CAST(NULL AS VARCHAR) AS venue, url,
  url AS ticket_url, name AS artist, 'koncert' AS subcategory FROM ld
UNION ALL SELECT page_id, name || ' bis', NULL, 'Kraków', NULL, NULL, NULL, name || ' bis', 'koncert'
FROM ld"""
ORACLES["source_outcomes"] = f"""WITH {_LD}
SELECT domain AS source, CAST(3 * count(*) AS BIGINT) AS found, sum(broken) = 0 AS ok,
  CASE WHEN sum(broken) > 0 THEN 'invalid_json' END AS error FROM ld GROUP BY domain"""
ORACLES["listing_dedup"] = f"""WITH l AS ({duck_listing()})
SELECT seq, source, subcategory, title, start_datetime FROM l
QUALIFY row_number() OVER (PARTITION BY subcategory, title,
  coalesce(strftime(start_datetime, '%Y-%m-%d'), '') ORDER BY seq) = 1"""
ORACLES["html_rows"] = f"""
WITH b AS (SELECT page_id, regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1) AS blocks FROM pages),
x AS (SELECT page_id, unnest(blocks) AS block, unnest(range(len(blocks))) AS row_no FROM b)
SELECT page_id, CAST(row_no AS INT) AS row_no,
  {_text_of("regexp_extract(block, '(?is)<a [^>]*>(.*?)</a>', 1)")} AS title,
  regexp_extract(block, '(?is)<a href="([^"]*)"', 1) AS href
FROM x WHERE regexp_extract(block, '(?is)<a href="([^"]*)"', 1) <> ''"""
_ROWS = """rows AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="(/[^"]*)">([^<]*)</a></li>', 1)) AS path,
    unnest(regexp_extract_all(html, '<li><a href="(/[^"]*)">([^<]*)</a></li>', 2)) AS label,
    unnest(range(len(regexp_extract_all(html, '<li><a href="(/[^"]*)">([^<]*)</a></li>', 1)))) AS row_no,
    DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS day
  FROM pages)"""
_ROLLED = f"strftime(CASE WHEN day < {RUN_DATE} THEN day + INTERVAL 1 YEAR ELSE day END, '%Y-%m-%d')"
ORACLES["html_table_rows"] = f"""WITH {_ROWS}
SELECT page_id, CAST(row_no AS INT) AS row_no,
  array_to_string(list_filter([{_text_of('label')}, '& go'], lambda p: p <> ''), ' ') AS title,
  {_BASE} || '/wydarzenia' || path AS url, {_ROLLED} AS start,
  CASE WHEN page_id % 2 = 0 THEN 'Gdynia' END AS city, 'meetup | AI, Data' AS subcategory,
  'AI, Data' AS description, page_id % 3 = 0 AS is_free
FROM rows"""
ORACLES["html_rows_nested"] = f"""WITH {_ROWS}
SELECT page_id, CAST(row_no AS INT) AS row_no,
  array_to_string(list_filter([{_text_of('label')}, 'Róża'], lambda p: p <> ''), ' ') AS title,
  {_BASE} || '/wydarzenia' || path || '?a=1&b=2' AS url, 'Sopot' AS city,
  'meet&greet | X' AS subcategory, 'X' AS description, page_id % 3 = 0 AS is_free
FROM rows"""
ORACLES["html_cards"] = f"""WITH {_ROWS}
SELECT page_id, {_text_of('label')} AS title, {_BASE} || '/imprezy' || path AS url,
  CASE WHEN page_id % 4 = 0 THEN '2024-06-19' ELSE {_ROLLED} || 'T18:30' END AS start,
  CASE WHEN page_id % 4 = 0 THEN '2024-06-28' END AS "end",
  CASE WHEN page_id % 5 = 0 THEN 'Trojmiasto' ELSE 'Sopot' END AS city,
  CASE WHEN page_id % 5 = 0 THEN '' ELSE 'Molo' END AS venue,
  CASE WHEN page_id % 3 = 0 THEN '45' END AS price_min, page_id % 3 <> 0 AS is_free
FROM rows WHERE {_text_of('label')} <> ''"""
ORACLES["json_events"] = f"""
WITH e AS (
  SELECT *, event_type || ' ' || user_id AS name, json_extract_string(props, '$.k') AS venue,
    CASE WHEN CAST(ts AS DATE) < {RUN_DATE} THEN ts + INTERVAL 1 YEAR ELSE ts END AS moved
  FROM events)
SELECT event_id, 0 AS entry_no, name AS title, strftime(moved, '%Y-%m-%dT%H:%M:%S') AS start,
  CASE WHEN user_id % 2 = 0 THEN 'Sopot' ELSE 'Online' END AS city, venue, name AS artist,
  'koncert' AS subcategory, 'https://x.example/' || event_id AS url FROM e
UNION ALL SELECT event_id, 2, name || ' b', strftime(moved, '%Y-%m-%dT00:00:00'), 'Sopot', venue,
  name || ' b', 'koncert', 'https://base.example' FROM e"""
ORACLES["absolute_links"] = f"""
WITH b AS (SELECT page_id, {_BASE} AS base, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages),
x AS (SELECT page_id, base, unnest(links) AS href, unnest(range(len(links))) AS link_no FROM b)
SELECT page_id, CAST(link_no AS INT) AS link_no, CASE WHEN starts_with(href, 'http') THEN href
  ELSE rtrim(base, '/') || '/' || ltrim(href, '/') END AS url FROM x"""
ORACLES["discover_candidates"] = f"""
WITH known AS (SELECT {_DOMAIN} AS domain FROM pages GROUP BY 1 HAVING count(*) >= 5)
SELECT {_PAGE_TITLE} AS name, url, substr({_VISIBLE}, 1, 160) AS why,
  {STREAM_LIST}[page_id % 3 + 1] AS suggested_stream
FROM pages WHERE {_DOMAIN} NOT IN (SELECT domain FROM known)"""

# --- scalar functions -------------------------------------------------------------------

ORACLES["text_norm"] = f"""SELECT doc_id, md5({norm('text')}) AS norm_md5,
  length({norm('text')}) AS n_norm FROM documents"""
ORACLES["norm_city"] = f"""WITH l AS ({duck_listing()})
SELECT seq, {city('city')} AS city_norm,
  {city('city')} IN ('gdansk', 'gdynia', 'sopot', 'trojmiasto') AS is_tricity FROM l"""
ORACLES["dedup_key"] = f"""WITH {WITH_TEXT}
SELECT seq, dedup_key, substr(sha1(dedup_key), 1, 16) AS id FROM t"""
ORACLES["content_hash"] = f"""WITH {WITH_TEXT}
SELECT seq, {content_hash()} AS content_hash FROM t"""
ORACLES["parse_dates"] = """SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 1 THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) + to_minutes(CAST(o_custkey % 60 AS INT))
    WHEN 4 THEN NULL ELSE o_orderdate END AS parsed
FROM orders"""
ORACLES["parse_price"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber % 4 IN (0, 1)
       THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) END AS price
FROM lineitem"""
ORACLES["normalize"] = f"""WITH {EVENTS}
SELECT seq, source, source_url, title, start_datetime, end_datetime, city, venue_name, price_min,
  is_free, ticket_url, artist, subcategory, md5(description) AS description_md5,
  FALSE AS national_scope, '' AS scope_reason FROM ev"""
_SAME = "TRY_CAST(printf('{0}-%02d-%02d', month(o_orderdate), day(o_orderdate)) AS DATE)"
_Y0, _Y1 = (_SAME.format(ORDERS_RUN_TS.year + i) for i in (0, 1))
_NEXT = f"CASE WHEN {_Y0} < {ORDERS_DATE} THEN {_Y1} ELSE {_Y0} END"
ORACLES["roll_year"] = f"""SELECT o_orderkey, strftime({_NEXT}, '%Y-%m-%d') AS from_text,
  strftime({_NEXT}, '%Y-%m-%d') || CASE WHEN o_custkey % 2 = 0 THEN 'T18:05' ELSE 'T00:00' END AS from_icon
FROM orders"""
ORACLES["parse_date_range"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d1,
             CAST(o_orderdate AS DATE) + CAST(o_custkey % 20 AS INT) AS d2 FROM orders)
SELECT o_orderkey, printf('%d-%02d-%02d', year(d2), month(d1), day(d1)) AS first_day,
  strftime(d2, '%Y-%m-%d') AS last_day FROM o"""
ORACLES["fix_year"] = f"""SELECT o_orderkey, CASE
    WHEN o_orderkey % 5 = 4 THEN 'kiedys ' || o_orderkey
    WHEN CAST(o_orderdate AS DATE) >= {ORDERS_DATE} THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00')
    WHEN {_NEXT} IS NULL THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime({_NEXT}, '%Y-%m-%dT00:00:00') END AS repaired
FROM orders"""

# --- classification and rules -----------------------------------------------------------

_HIT_COLUMNS = ", ".join(
    f"{hits('class_text', TEST_RULES['classify'][s])} AS hits_{s}" for s in STREAMS
)
ORACLES["keyword_hits"] = f"WITH {WITH_TEXT} SELECT seq, {_HIT_COLUMNS} FROM t"
ORACLES["keyword_hits_large"] = f"""
SELECT doc_id, len(held) AS hits, held[1] AS first FROM (
  SELECT doc_id, list_filter({MANY_KEYWORDS}, lambda k: contains(lower(text), k)) AS held FROM documents)"""
ORACLES["classify"] = f"WITH {classified(True)} SELECT seq, source, category FROM c"
ORACLES["exclusions"] = f"WITH {WITH_TEXT} SELECT seq, {SPORTS} AS excluded FROM t"
ORACLES["large_event"] = f"WITH {WITH_TEXT} SELECT seq, {LARGE} AS reason FROM t"
ORACLES["world_class"] = f"WITH {WITH_TEXT} SELECT seq, {WORLD} AS reason FROM t"
ORACLES["family_flag"] = f"WITH {WITH_TEXT} SELECT seq, {FAMILY} AS family_suitable FROM t"
ORACLES["geo_rule"] = f"""WITH {judged()}
SELECT seq, category, geo_drop, national_scope, scope_reason, family_raw AS family_suitable FROM j"""
ORACLES["time_window"] = f"""WITH {judged()}
SELECT seq, last_start AS window_end, date_drop FROM j"""
ORACLES["apply_filters"] = f"""WITH {judged()}
SELECT seq, category, drop_reason, national_scope, scope_reason, family_suitable FROM j"""

# --- dedup, state, aggregation ----------------------------------------------------------

ORACLES["within_run_dedup"] = f"WITH {deduped()} SELECT dedup_key, seq, source, n_copies FROM d"
ORACLES["merge_fill"] = f"""WITH {deduped()}
SELECT dedup_key, seq, source, source_url, title, start_datetime, end_datetime, city, venue_name,
  price_min, is_free, ticket_url, artist, category, subcategory, national_scope, scope_reason,
  family_suitable, md5(description) AS description_md5, content_hash FROM d"""
ORACLES["lineitem_dedup"] = """
WITH x AS (
  SELECT l_partkey || '|' || l_suppkey AS dedup_key, l_orderkey * 8 + l_linenumber AS seq,
    l_returnflag AS source, CASE WHEN l_linestatus = 'F' THEN '' ELSE l_linestatus END AS title,
    CASE WHEN l_discount > 0.02 THEN l_discount END AS price_min, l_tax > 0.04 AS is_free,
    CASE WHEN l_quantity > 25 THEN l_shipdate END AS start_datetime
  FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY
        CASE source WHEN 'A' THEN 0.9 WHEN 'N' THEN 0.7 ELSE 0.5 END DESC, seq) AS ord FROM x)
SELECT dedup_key, arg_min(seq, ord) AS seq, count(*) AS n_copies, arg_min(source, ord) AS source,
  coalesce(arg_min(title, ord) FILTER (WHERE title <> ''), arg_min_null(title, ord)) AS title,
  coalesce(arg_min(price_min, ord) FILTER (WHERE price_min <> 0),
    max(CASE WHEN price_min = 0 THEN 0.0e0 END)) AS price_min,
  bool_or(is_free) AS is_free,
  arg_min(start_datetime, ord) FILTER (WHERE start_datetime IS NOT NULL) AS start_datetime
FROM o GROUP BY dedup_key"""
ORACLES["delivery_status"] = f"WITH {_EARLIER} SELECT dedup_key, status AS delivery_state FROM st"
ORACLES["delivery_status_pruned"] = f"""WITH {_EARLIER}
SELECT dedup_key, status AS delivery_state FROM st WHERE source <= 'src2'"""
ORACLES["suppress_unchanged"] = f"""WITH {_EARLIER}
SELECT dedup_key, seq, status AS delivery_state FROM st WHERE status <> 'unchanged'"""
ORACLES["state_upsert"] = f"WITH {_UPSERTED} SELECT {_STATE_COLUMNS} FROM u"
ORACLES["mark_delivered"] = f"""WITH {_UPSERTED},
shown AS (SELECT dedup_key FROM st WHERE status <> 'unchanged')
SELECT dedup_key, delivered OR dedup_key IN (SELECT dedup_key FROM shown) AS delivered,
  CASE WHEN dedup_key IN (SELECT dedup_key FROM shown) THEN {RUN_TIME} ELSE delivered_at END
    AS delivered_at
FROM u"""
ORACLES["drop_report"] = f"""WITH {judged()}
SELECT drop_reason, count(*) AS n FROM j WHERE drop_reason IS NOT NULL GROUP BY 1"""
ORACLES["source_drop_matrix"] = f"""WITH {judged()}
SELECT source, count(*) AS found, count(*) FILTER (WHERE drop_reason IS NULL) AS kept,
  {", ".join(f"count(*) FILTER (WHERE drop_reason = '{r}') AS {r.replace(':', '_')}" for r in _REASONS)}
FROM j GROUP BY source"""
ORACLES["fuzzy_dedup"] = f"""
WITH RECURSIVE e AS (
  SELECT doc_id AS seq, source, lang, split_part(text, chr(10), 1) AS title,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'u' || doc_id END AS source_url, {trust("source")} AS trust,
    list_distinct(regexp_extract_all({norm("split_part(text, chr(10), 1)")}, '[\\p{{L}}\\p{{N}}]+')) AS ws FROM documents
), w AS (SELECT seq, lang, len(ws) AS n, unnest(ws) AS word FROM e),
p AS (SELECT a.seq AS u, b.seq AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS same
      FROM w a JOIN w b ON a.lang = b.lang AND a.word = b.word GROUP BY 1, 2),
l AS (SELECT u, v FROM p WHERE same >= 0.8 * (n + m - same)),
reach AS (SELECT u, v FROM l UNION SELECT reach.u, l.v FROM reach JOIN l ON reach.v = l.u),
g AS (SELECT e.*, coalesce((SELECT min(v) FROM reach WHERE u = seq), seq) AS root FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY trust DESC, seq) AS place FROM g)
SELECT min(seq) FILTER (WHERE place = 1) AS seq, count(*) AS n_copies,
  coalesce(arg_min(source, place) FILTER (WHERE source <> ''), arg_min(source, place)) AS source,
  coalesce(arg_min(title, place) FILTER (WHERE title <> ''), arg_min(title, place)) AS title,
  coalesce(arg_min(source_url, place) FILTER (WHERE source_url <> ''), arg_min(source_url, place)) AS source_url
FROM o GROUP BY root"""
ORACLES["source_break"] = """
WITH e AS (SELECT event_type || '|' || user_id AS source, CAST(least((day(ts) - 1) // 10, 2) AS INT) AS run FROM events),
r AS (SELECT DISTINCT run FROM e WHERE run < 2),
s AS (SELECT DISTINCT source FROM e WHERE run < 2),
every AS (SELECT s.source, r.run, (SELECT count(*) FROM e WHERE e.source = s.source AND e.run = r.run) AS found FROM s, r)
SELECT source, min(found) AS least_found, count(*) AS runs FROM every
WHERE source NOT IN (SELECT source FROM e WHERE run = 2) AND (SELECT count(*) FROM e WHERE run = 2) > 0
GROUP BY source HAVING min(found) >= 1"""
ORACLES["source_report"] = f"""WITH l AS ({duck_listing()}), reg AS ({duck_registry()})
SELECT source_id, enabled, count(seq) AS found,
  count(*) FILTER (WHERE length(description) < 1000) AS stubs
FROM reg LEFT JOIN l ON source = source_id GROUP BY 1, 2"""
ORACLES["funnel"] = f"""WITH {deduped()}{ranked()}
SELECT (SELECT count(*) FROM j) AS events_found, (SELECT count(*) FROM d) AS events_kept,
  (SELECT count(*) FROM r WHERE rank <= {CAPPED_RUN.cap}) AS events_delivered"""
ORACLES["trust_lookup"] = f"SELECT doc_id, source, {trust('source')} AS trust FROM documents"
ORACLES["budget_admission"] = """
WITH w AS (SELECT *, l_returnflag = 'A' OR (l_discount = 0 AND l_linestatus = 'F') AS wants FROM lineitem),
g AS (SELECT *, wants AND sum(CASE WHEN wants THEN 1 ELSE 0 END) OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= 2 AS granted FROM w)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, wants, granted,
  CASE WHEN granted OR l_returnflag = 'A' THEN 'metered' ELSE 'direct' END AS method,
  CASE WHEN wants AND NOT granted AND l_returnflag = 'A' THEN 'budget_exceeded' END AS error
FROM g"""

# --- ranking and digest -----------------------------------------------------------------

ORACLES["relevance_score"] = f"WITH {deduped()} SELECT dedup_key, {SCORE} AS relevance_score FROM d"
ORACLES["rank_streams"] = f"""WITH {deduped()}{ranked()}
SELECT category, stream_no, rank, seq, relevance_score FROM r"""
ORACLES["cap_streams"] = f"""WITH {deduped()}{ranked()}
SELECT category, rank, seq FROM r WHERE rank <= {CAPPED_RUN.cap}"""
_ORDERS_RANKED = """SELECT o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY o_totalprice DESC, o_orderdate ASC NULLS LAST, o_orderkey) AS rank, o_orderkey FROM orders"""
ORACLES["cap_orders"] = f"SELECT * FROM ({_ORDERS_RANKED}) WHERE rank <= 100"
ORACLES["cap_orders_large"] = f"SELECT * FROM ({_ORDERS_RANKED}) WHERE rank <= 5000"
ORACLES["rank_orders"] = _ORDERS_RANKED
ORACLES["digest_lines"] = f"""WITH {_EARLIER},
fresh AS (SELECT * FROM st WHERE status <> 'unchanged'){ranked('fresh', 'status')}
SELECT category, rank, {LINE} AS line FROM r"""
ORACLES["digest"] = _digest_sql(
    deduped(True) + ranked(), "SELECT count(DISTINCT source) FROM j", "SELECT 0"
)
ORACLES["to_markdown"] = f"""WITH {deduped()}{ranked()}
SELECT seq, md5({_markdown('line')}) AS markdown_md5 FROM (
  SELECT seq, {LINE} AS line FROM r UNION ALL SELECT doc_id, text FROM documents)"""
ORACLES["pack_lines"] = """
WITH f AS (
  SELECT doc_id, list_reduce(list_transform(string_split(text, chr(10)), lambda x: [x]), lambda acc, x:
    CASE WHEN acc[-1] <> '' AND length(acc[-1]) + length(x[1]) + 1 > 500
         THEN list_append(acc, x[1] || chr(10))
         ELSE list_append(acc[:-2], acc[-1] || x[1] || chr(10)) END, ['']) AS chunks
  FROM documents),
c AS (SELECT doc_id, unnest(chunks) AS chunk, unnest(range(len(chunks))) AS chunk_no,
        unnest(list_transform(range(len(chunks)), lambda i: i = len(chunks) - 1)) AS is_last FROM f)
SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, md5(rtrim(chunk, chr(10))) AS chunk_md5,
  length(rtrim(chunk, chr(10))) AS n_chars
FROM c WHERE NOT is_last OR trim(chunk, ' ' || chr(10) || chr(9) || chr(13)) <> ''"""
ORACLES["pack_digest"] = f"""WITH RECURSIVE d AS ({ORACLES['digest']}),
l AS (SELECT line_no, line, sum(length(line) + 1) OVER (ORDER BY line_no) AS stop,
        sum(length(line) + 1) OVER (ORDER BY line_no) - length(line) - 1 AS pos FROM d),
n AS (SELECT l.pos, greatest(l.stop, e.stop) AS nxt FROM l ASOF JOIN (SELECT stop FROM l UNION SELECT 0) e ON l.pos + 500 >= e.stop),
m(message_no, pos, nxt) AS (
  SELECT CAST(0 AS BIGINT), pos, nxt FROM n WHERE pos = 0
  UNION ALL SELECT message_no + 1, n.pos, n.nxt FROM m JOIN n ON n.pos = m.nxt),
t AS (SELECT message_no, rtrim(string_agg(line, chr(10) ORDER BY line_no), chr(10)) AS text
      FROM m JOIN l ON l.pos >= m.pos AND l.pos < m.nxt GROUP BY 1)
SELECT message_no, md5(text) AS text_md5, length(text) AS n_chars FROM t"""
ORACLES["full_run"] = f"""WITH {deduped(True)}{ranked()}
SELECT category, rank, seq, source, title, start_datetime, city, venue_name, price_min, is_free,
  national_scope, scope_reason, family_suitable, relevance_score, n_copies FROM r"""

# --- streaming --------------------------------------------------------------------------

_DROP = "CASE WHEN event_type = 'error' THEN 'error' WHEN value < 1 THEN 'small' END"
ORACLES["stream_filter"] = f"""SELECT event_id, event_type || ' oz ' || user_id AS title_norm,
  event_type || '|' || strftime(ts, '%Y-%m-%d') || '|' || user_id AS dedup_key,
  {_DROP} AS drop_reason FROM events"""
ORACLES["stream_dedup"] = "SELECT DISTINCT user_id, event_type FROM events"
ORACLES["stream_drop_report"] = f"""
SELECT date_trunc('day', ts) AS period_start, {_DROP} AS drop_reason, count(*) AS n
FROM events WHERE {_DROP} IS NOT NULL
GROUP BY 1, 2"""
ORACLES["stream_judge"] = ORACLES["apply_filters"]
ORACLES["stream_status"] = """
WITH e AS (SELECT *, event_type || '|' || user_id AS dedup_key,
             CAST(least((day(ts) - 1) // 10, 2) AS INT) AS batch_id FROM events),
n AS (SELECT * FROM e QUALIFY row_number() OVER (
        PARTITION BY dedup_key, batch_id ORDER BY ts DESC, event_id DESC) = 1),
p AS (SELECT *, floor(value / 20) AS content,
        lag(floor(value / 20)) OVER (PARTITION BY dedup_key ORDER BY batch_id) AS earlier FROM n)
SELECT batch_id, dedup_key, event_id, CASE WHEN earlier IS NULL THEN 'new'
  WHEN earlier = content THEN 'unchanged' ELSE 'updated' END AS delivery_state FROM p"""

ORACLES["stream_live_status"] = ORACLES["stream_status"]
ORACLES["stream_merge"] = """
WITH RECURSIVE e AS (
  SELECT CAST(user_id AS VARCHAR) AS dedup_key, event_type AS source, event_id AS seq, ts,
    CASE event_type WHEN 'click' THEN 0.9 WHEN 'error' THEN 0.2 ELSE 0.5 END AS trust,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE 't' || event_id END AS title,
    CASE WHEN event_id % 4 = 0 THEN 0.0e0 WHEN event_id % 4 < 3 THEN value END AS price_min,
    CASE WHEN event_id % 5 > 0 THEN event_id % 5 = 1 END AS is_free,
    CASE WHEN event_id % 2 = 0 THEN ts END AS end_datetime FROM events
), w(k, opened) AS (
  SELECT dedup_key, min(ts) FROM e GROUP BY 1
  UNION ALL SELECT w.k, min(e.ts) FROM w JOIN e ON e.dedup_key = w.k AND e.ts >= w.opened + INTERVAL 3 DAYS
  GROUP BY w.k, w.opened
), c AS (
  SELECT e.*, opened, row_number() OVER (PARTITION BY k, opened ORDER BY trust DESC, seq) AS place
  FROM w JOIN e ON e.dedup_key = w.k AND ts >= opened AND ts < opened + INTERVAL 3 DAYS
  WHERE opened + INTERVAL 3 DAYS <= (SELECT max(ts) FROM events)
)
SELECT dedup_key, opened, arg_min(source, place) AS source, arg_min(seq, place) AS seq, count(*) AS n_copies,
  coalesce(arg_min(title, place) FILTER (WHERE title <> ''), arg_min(title, place)) AS title,
  coalesce(arg_min(price_min, place) FILTER (WHERE price_min <> 0), max(price_min) FILTER (WHERE price_min = 0)) AS price_min,
  bool_or(is_free) AS is_free, arg_min(end_datetime, place) FILTER (WHERE end_datetime IS NOT NULL) AS end_datetime,
  arg_min(ts, place) AS scraped_at
FROM c GROUP BY 1, 2"""
