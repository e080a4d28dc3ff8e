"""SQL texts of the adapter views, for the comparison queries."""

from __future__ import annotations

from stepforge import domains as D
from stepforge.functions import personal as PD
from stepforge.sources.adapters import SAMPLE_ACTIONS, TASKS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def any_of(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def count_of(x: str, words) -> str:
    return "(" + " + ".join(f"contains({x}, {lit(w)})::INT" for w in words) + ")"


CLICKS = inlist(D.CLICK_FAMILY)

STEPS = f"""steps_v AS (
  SELECT 'u' || user_id || '_' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS session_id,
    event_id, ts, user_id, event_id AS step_index, k, action_type,
    CASE WHEN event_type = 'click' THEN [value / 200::DOUBLE, k / 100::DOUBLE] END AS coordinates,
    CASE WHEN event_type = 'signup' THEN k::VARCHAR END AS text,
    {strings(TASKS)}[(user_id % 8 + 1)::INT] AS task
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'scroll' WHEN 'signup' THEN 'type'
      WHEN 'purchase' THEN 'key' ELSE 'fail' END AS action_type FROM events))"""

_W = "OVER (PARTITION BY session_id ORDER BY ts, event_id)"
PLACED = STEPS + f""",
placed_v AS (
  SELECT *, row_number() {_W} - 1 AS pos, count(*) OVER (PARTITION BY session_id) AS n_session,
    {", ".join(f"lead(action_type, {i}) {_W} AS t{i}" for i in range(1, 8))},
    lead(coordinates) {_W} AS next_coordinates, lead(text) {_W} AS next_text
  FROM steps_v),
flagged_v AS (
  SELECT *, coalesce(action_type = t2 AND t1 = t3, false) AS loop_2,
    coalesce(action_type = t3 AND t1 = t4 AND t2 = t5, false) AS loop_3,
    coalesce(action_type = t4 AND t1 = t5 AND t2 = t6 AND t3 = t7, false) AS loop_4,
    coalesce(action_type = t1 AND CASE WHEN action_type = 'key' THEN false
      WHEN action_type = 'click' THEN coalesce(coordinates = next_coordinates, false)
      WHEN action_type = 'type' THEN text IS NOT DISTINCT FROM next_text ELSE true END, false) AS redundant,
    coalesce(action_type = 'click' AND NOT (coordinates[1] BETWEEN 0 AND 1 AND coordinates[2] BETWEEN 0 AND 1), false) AS impossible
  FROM placed_v)"""

REPORT = PLACED + """,
typed_v AS (
  SELECT session_id, action_type, count(*) AS n FROM steps_v GROUP BY ALL),
diverse_v AS (
  SELECT session_id, count(*) AS n_low_diversity FROM (
    SELECT session_id, n, sum(n) OVER (PARTITION BY session_id) AS total
    FROM typed_v WHERE action_type NOT IN ('done', 'fail')) WHERE n / total::DOUBLE > 0.8::DOUBLE GROUP BY session_id),
counted_v AS (
  SELECT f.session_id, min_by(task, pos) AS task, count(*) AS total_steps,
    (max(loop_2::INT) + max(loop_3::INT) + max(loop_4::INT))::BIGINT AS n_loops,
    sum(redundant::INT)::BIGINT AS n_redundant, sum(impossible::INT)::BIGINT AS n_impossible
  FROM flagged_v f GROUP BY f.session_id),
report_v AS (
  SELECT c.*, coalesce(n_low_diversity, 0)::BIGINT AS n_low_diversity, n_impossible AS n_errors,
    n_loops + n_redundant + coalesce(n_low_diversity, 0) AS n_warnings,
    greatest(0, 10 - 3 * n_impossible - (n_loops + n_redundant + coalesce(n_low_diversity, 0))) / 10::DOUBLE AS quality_score
  FROM counted_v c LEFT JOIN diverse_v USING (session_id))"""

SAMPLES = f"""samples_v AS (
  SELECT doc_id, 's_' || doc_id AS sample_id, source AS session_id, (doc_id % 20)::INT AS step_index,
    'human_demo' AS source_type, {strings(TASKS)}[((doc_id // 3) % 8 + 1)::INT] AS task, action_type, n_chars,
    text AS document, quality, toxic, lang AS doc_lang,
    CASE WHEN action_type IN {CLICKS} AND doc_id % 16 <> 0
      THEN [(n_chars % 1000) / 900::DOUBLE, (doc_id % 100) / 100::DOUBLE] END AS coordinates,
    CASE WHEN action_type = 'type' THEN string_split(text, chr(10))[1] END AS text,
    CASE WHEN action_type = 'key' THEN 'ctrl+s' END AS key,
    CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Use ' || action_type || ' on item ' || doc_id END AS description,
    text AS ocr_text_raw, '/shots/' || (doc_id // 3) || '.png' AS screenshot_path,
    list_transform(string_split(text, chr(10)), lambda line, i: {{
      'text': line,
      'bbox': [(length(line) % 10) / 20::DOUBLE, ((i - 1) % 20) / 20::DOUBLE,
               (length(line) % 10) / 20::DOUBLE + 0.3::DOUBLE, ((i - 1) % 20) / 20::DOUBLE + 0.04::DOUBLE],
      'confidence': (length(line) % 50 + 50) / 100::DOUBLE}}) AS regions,
    sha256(text) AS sha256, CASE WHEN quality IS NOT NULL THEN text ELSE '' END AS reasoning,
    CASE WHEN quality = 1 THEN {strings(TASKS)}[((doc_id // 3) % 8 + 1)::INT] ELSE '' END AS intent,
    coalesce(quality = 1, false) AS reasoning_verified, coalesce(toxic = 1, false) AS is_error_step
  FROM (SELECT d.*, l.quality, l.toxic, {strings(SAMPLE_ACTIONS)}[(d.doc_id % 8 + 1)::INT] AS action_type
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))"""


def tags(task: str, action: str) -> str:
    cats = ", ".join(
        f"CASE WHEN {any_of(f'lower({task})', keys)} THEN {lit(tag)} END" for tag, keys in D.TAG_KEYWORDS.items()
    )
    return f"list_filter([{cats}, 'action:' || {action}], lambda z: z IS NOT NULL)"


def clean_token(x: str) -> str:
    t = strip(x)
    return f"""coalesce(CASE WHEN length({t}) <= 1 THEN false
      WHEN length({t}) = 2 THEN lower({t}) IN {inlist(D.SHORT_TOKENS)}
      WHEN NOT regexp_matches({t}, '[\\p{{L}}\\p{{Nd}}]') THEN false
      WHEN regexp_matches({t}, '[\\p{{Cc}}\\p{{Co}}]') THEN false
      WHEN length({t}) BETWEEN 3 AND 6
        AND len(regexp_extract_all({t}, '\\p{{Lu}}')) / length({t})::DOUBLE >= 0.5
        AND NOT regexp_matches(lower({t}), '[{D.SHORT_TOKEN_VOWELS}]') THEN false
      ELSE true END, false)"""


def keep_region(text: str, confidence: str) -> str:
    t = strip(text)
    return f"""({confidence} >= 0.5 AND length({t}) >= 3 AND NOT regexp_matches({t}, '^\\p{{N}}+$')
      AND NOT contains({t}, '{{') AND NOT contains({t}, '$') AND len(regexp_extract_all({t}, '\\p{{L}}')) > 1)"""


def clean_regions(regions: str) -> str:
    return f"""list_filter(list_filter({regions}, lambda r: {keep_region('r.text', 'r.confidence')})[1:100],
      lambda r: {clean_token('r.text')})"""


def share(x: str, cls: str) -> str:
    return f"len(regexp_extract_all({x}, '{cls}')) / greatest(length({x}), 1)::DOUBLE"


def language(x: str) -> str:
    """Only the branches a Latin-script table can reach."""
    return f"""CASE WHEN {strip(x)} = '' THEN 'unknown' WHEN {share(x, '[A-Za-z]')} > 0.3 THEN 'en' ELSE 'unknown' END"""


def language_tags(tag_list: str, text: str, lang: str) -> str:
    multi = f"CASE WHEN list_contains({tag_list}, 'multilingual') THEN {tag_list} ELSE list_append({tag_list}, 'multilingual') END"
    return f"CASE WHEN {strip(text)} = '' OR {lang} = 'en' THEN {tag_list} ELSE list_append({multi}, 'lang:' || {lang}) END"


FACTS = """facts_v AS (
  SELECT '/shots/' || page_id || '.png' AS path, octet_length(encode(html))::BIGINT * 4 AS length,
    CASE WHEN page_id % 13 <> 0 THEN 380 + (page_id % 9) * 40 END AS width,
    CASE WHEN page_id % 13 <> 0 THEN 280 + (page_id % 7) * 40 END AS height,
    CASE WHEN page_id % 13 <> 0 THEN (page_id % 31) * 10::DOUBLE END AS variance,
    sha256(html) AS file_sha, left(sha256('family:' || page_id // 24), 62) || printf('%02x', page_id % 24) AS phash FROM pages)"""

SCHEMA_REASON = f"""CASE
    WHEN length({strip('task')}) < 5 THEN 'Task instruction too short: ''' || task || ''''
    WHEN description = '' THEN 'Required raw field ''description'' is missing'
    WHEN action_type NOT IN {inlist(D.ACTION_TYPES)} THEN 'Unknown action_type: ''' || action_type || '''. Valid: [{", ".join("''" + a + "''" for a in sorted(D.ACTION_TYPES))}]' END"""

COORD_REASON = f"""CASE WHEN action_type NOT IN {CLICKS} THEN NULL
    WHEN coordinates IS NULL THEN 'Action type ''' || action_type || ''' requires coordinates but none found'
    WHEN NOT coordinates[1] BETWEEN 0 AND 1 THEN printf('Coordinate x=%.4f is outside [0.0, 1.0]. This sample cannot produce valid click positions.', coordinates[1])
    WHEN NOT coordinates[2] BETWEEN 0 AND 1 THEN printf('Coordinate y=%.4f is outside [0.0, 1.0]. This sample cannot produce valid click positions.', coordinates[2]) END"""

IMAGE_REASON = """CASE WHEN path IS NULL THEN 'Screenshot not found: ' || screenshot_path
    WHEN length / 1024::DOUBLE < 5 THEN printf('Screenshot too small: %.1fKB (minimum 5.0KB). Likely blank or corrupted.', length / 1024::DOUBLE)
    WHEN width IS NULL THEN 'Cannot read screenshot: ' || screenshot_path
    WHEN width < 400 OR height < 300 THEN printf('Screenshot resolution %dx%d below minimum 400x300. Too small for reliable OCR.', width, height)
    WHEN variance < 50 THEN printf('Screenshot appears blank (pixel variance=%.1f). Likely a failed capture.', variance) END"""

GATED = SAMPLES + ",\n" + FACTS + f""",
pre_v AS (
  SELECT s.*, f.path, f.length, f.file_sha, {SCHEMA_REASON} AS r_schema, {COORD_REASON} AS r_coords, {IMAGE_REASON} AS r_image
  FROM samples_v s LEFT JOIN facts_v f ON s.screenshot_path = f.path),
firsts_v AS (
  SELECT sha256 AS first_sha, min(doc_id) AS first_doc FROM pre_v
  WHERE r_schema IS NULL AND r_coords IS NULL AND path IS NOT NULL GROUP BY 1),
gated_v AS (
  SELECT *, CASE WHEN r_schema IS NOT NULL THEN 'schema' WHEN r_coords IS NOT NULL THEN 'coordinates'
      WHEN original_id IS NOT NULL THEN 'dedup' END AS failed_gate,
    coalesce(r_schema, r_coords, 'Duplicate of ' || original_id) AS gate_reason,
    CASE WHEN r_schema IS NULL AND r_coords IS NULL AND r_image IS NOT NULL THEN ['image: ' || r_image] ELSE [] END AS warnings,
    CASE WHEN r_schema IS NOT NULL OR r_coords IS NOT NULL OR original_id IS NOT NULL THEN 'rejected'
      WHEN r_image IS NOT NULL THEN 'quarantined' ELSE 'enriching' END AS gate_status
  FROM (SELECT *, CASE WHEN path IS NOT NULL AND first_doc <> doc_id THEN 's_' || first_doc END AS original_id
    FROM pre_v LEFT JOIN firsts_v ON sha256 = first_sha))"""

ENRICHED = GATED + f""",
enriched_v AS (
  SELECT *, {language('all_text')} AS language FROM (
    SELECT *, CASE WHEN len(cleaned) > 0 THEN array_to_string(list_transform(cleaned, lambda r: {strip('r.text')}), ' ')
        ELSE ocr_text_raw END AS all_text, len(cleaned) AS n_regions,
      list_reduce(list_transform(cleaned, lambda r: r.confidence), lambda a, b: a + b, 0::DOUBLE) / nullif(len(cleaned), 0) AS mean_conf
    FROM (SELECT *, CASE WHEN path IS NULL THEN [] ELSE {clean_regions('regions')} END AS cleaned,
        {tags('task', 'action_type')} AS base_tags FROM gated_v WHERE gate_status <> 'rejected')))"""

def personal(text: str) -> dict[str, str]:
    """One test per kind of personal data, see ``functions.personal``."""
    runs = lambda pattern: f"regexp_extract_all({text}, {lit(pattern)})"
    some = lambda x: f"coalesce(len({x}) > 0, false)"
    groups = "string_split_regex(run, '[ -]')"
    sized = lambda n, sizes: f"""list_transform(list_filter(range(1, len({groups}) + 1), lambda i:
        list_transform({groups}[i:i + {n - 1}], lambda p: length(p))::BIGINT[] = {sizes}::BIGINT[]), lambda i: array_to_string({groups}[i:i + {n - 1}], ''))"""
    cards = f"""flatten(list_transform({runs(PD.DIGITS)}, lambda run: list_concat(list_concat(
        list_filter({groups}, lambda p: length(p) BETWEEN 13 AND 19), {sized(4, '[4, 4, 4, 4]')}), {sized(3, '[4, 6, 5]')})))"""
    luhn = """list_sum(list_transform(string_split(reverse(x), ''), lambda d, i: CASE WHEN i % 2 = 1 THEN d::INT
        ELSE d::INT * 2 - CASE WHEN d::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
    accounts = f"""flatten(list_transform({runs(PD.ACCOUNT)}, lambda run: [replace(run, ' ', ''), replace(regexp_replace(run, ' [A-Z0-9]{{1,4}}$', ''), ' ', '')]))"""
    mod97 = """list_reduce(list_transform(string_split(x[5:] || x[1:4], ''), lambda d: ascii(d)::BIGINT),
        lambda a, d: CASE WHEN d < 65 THEN a * 10 + d - 48 ELSE a * 100 + d - 55 END % 97, 0::BIGINT) = 1"""
    parts = "string_split(run, '.')"
    return {
        "has_email": f"coalesce(regexp_matches({text}, {lit(PD.EMAIL)}), false)",
        "has_phone": f"coalesce(regexp_matches({text}, {lit(PD.PHONE)}), false)",
        "has_card": some(f"list_filter({cards}, lambda x: regexp_matches(x, '^[2-6]') AND {luhn})"),
        "has_account": some(f"list_filter({accounts}, lambda x: length(x) BETWEEN 15 AND 34 AND {mod97})"),
        "has_address": some(f"list_filter({runs(PD.DOTTED)}, lambda run: len({parts}) = 4 AND len(list_filter({parts}, lambda p: length(p) > 3 OR try_cast(p AS BIGINT) > 255)) = 0)"),
        "has_secret": f"coalesce(regexp_matches({text}, {lit(PD.SECRET)}), false)",
    }


SCORE_TAIL = f""",
scored_v AS (
  SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, 0.30::DOUBLE * validation_score + 0.35::DOUBLE * reasoning_score
      + 0.20::DOUBLE * ocr_score + 0.15::DOUBLE * diversity_score)) AS composite
  FROM (SELECT *,
    (CASE WHEN gate_status = 'enriching' THEN 5 ELSE 3 END - CASE WHEN {' OR '.join(personal('pii_text').values())} THEN 1 ELSE 0 END) / 5::DOUBLE AS validation_score,
    CASE WHEN reasoning = '' THEN CASE WHEN length({strip('description')}) > 5 THEN 0.25::DOUBLE ELSE 0::DOUBLE END
      ELSE least(1::DOUBLE, CASE WHEN length({strip('description')}) > 5 THEN 0.25::DOUBLE ELSE 0::DOUBLE END
        + CASE WHEN length({strip('reasoning')}) > 10 THEN 0.25::DOUBLE ELSE 0::DOUBLE END
        + CASE WHEN length(reasoning) >= 200 THEN 0.25::DOUBLE WHEN length(reasoning) >= 100 THEN 0.15::DOUBLE
            WHEN length(reasoning) >= 50 THEN 0.08::DOUBLE ELSE 0::DOUBLE END
        + CASE WHEN reasoning_verified THEN 0.15::DOUBLE ELSE 0::DOUBLE END
        + CASE WHEN length({strip('intent')}) > 5 THEN 0.10::DOUBLE ELSE 0::DOUBLE END) END AS reasoning_score,
    least(1::DOUBLE, CASE WHEN n_regions > 0 THEN 0.4::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN n_regions >= 5 THEN 0.3::DOUBLE WHEN n_regions >= 2 THEN 0.1::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN mean_conf >= 0.85::DOUBLE THEN 0.3::DOUBLE WHEN mean_conf >= 0.70::DOUBLE THEN 0.2::DOUBLE
          WHEN mean_conf >= 0.50::DOUBLE THEN 0.1::DOUBLE ELSE 0::DOUBLE END) AS ocr_score,
    least(1::DOUBLE, 0.5::DOUBLE + CASE WHEN language IN ('ur','ps','ar','hi') THEN 0.3::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN is_error_step THEN 0.2::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN len({language_tags('base_tags', 'all_text', 'language')}) >= 3 THEN 0.1::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN action_type IN ('type','right_click','key','scroll') THEN 0.1::DOUBLE ELSE 0::DOUBLE END) AS diversity_score,
    {language_tags('base_tags', 'all_text', 'language')} AS tags
  FROM (SELECT *, concat_ws(chr(10), task, description, text, reasoning, all_text) AS pii_text FROM enriched_v))),
routed_v AS (
  SELECT *, round(composite, 4) AS quality_score, composite >= 0.65::DOUBLE AS approved,
    CASE WHEN composite < 0.65::DOUBLE THEN ''
      WHEN round(composite, 4) >= 0.80::DOUBLE AND step_index >= 5 AND length(reasoning) >= 150 AND reasoning_verified AND length(intent) > 10 THEN 'stage3_planning'
      WHEN round(composite, 4) >= 0.62::DOUBLE AND (length({strip('reasoning')}) >= 20 OR length({strip('description')}) >= 5) THEN 'stage2_action'
      WHEN round(composite, 4) >= 0.60::DOUBLE AND coordinates IS NOT NULL AND action_type IN {CLICKS} AND n_regions >= 2 THEN 'stage1_grounding'
      ELSE '' END AS training_stage
  FROM scored_v)"""

SCORED = ENRICHED + SCORE_TAIL


def difficulty() -> str:
    complexity = " ".join(f"WHEN {lit(a)} THEN {n}" for a, n in D.ACTION_COMPLEXITY.items())
    hard, medium = count_of("lower(task)", D.HARD_KEYWORDS), count_of("lower(task)", D.MEDIUM_KEYWORDS)
    return f"""greatest(1, least(5, 1 + CASE WHEN {hard} >= 3 THEN 3 WHEN {hard} >= 1 THEN 2 WHEN {medium} >= 2 THEN 1 ELSE 0 END
      + CASE WHEN step_index >= 15 THEN 2 WHEN step_index >= 8 THEN 1 ELSE 0 END
      + CASE WHEN n_regions >= 50 THEN 2 WHEN n_regions >= 25 THEN 1 ELSE 0 END
      + CASE action_type {complexity} ELSE 1 END - 1
      + CASE WHEN language IN ('ur','ps','ar') THEN 1 ELSE 0 END))"""


LINES = STEPS + """,
lines_v AS (
  SELECT *, CASE WHEN k % 23 = 0 THEN 'blank' WHEN k % 29 = 0 THEN 'corrupt' ELSE 'parsed' END AS line_kind,
    CASE WHEN k % 53 = 0 THEN 'not_an_object' WHEN k % 47 = 0 THEN 'bad_step_index' WHEN k % 31 = 0 THEN 'missing_task'
      WHEN k % 37 = 0 THEN 'action_not_an_object' WHEN k % 41 = 0 THEN 'missing_action_type' END AS ingest_error
  FROM steps_v)"""

HISTORY = STEPS + """,
history_v AS (
  SELECT 't' || user_id AS task_id, event_id, event_id AS step_index, task,
    CASE WHEN k % 10 = 0 THEN NULL WHEN action_type = 'key' AND k % 3 = 0 THEN 'done' ELSE action_type END AS action_type,
    k % 4 <> 0 AS success, CASE WHEN k % 7 = 0 THEN 'error ' || k END AS error,
    CASE WHEN k % 5 <> 0 THEN '/shots/' || event_id || '.png' ELSE '' END AS screenshot_path,
    'step at ' || k AS description FROM steps_v)"""
STATUS = """CASE WHEN action_type = 'done' THEN 'completed' WHEN action_type = 'fail' THEN 'failed'
    WHEN coalesce(error, '') <> '' THEN 'failed' ELSE 'running' END"""

WORDS = "list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')"
HASHES = f"""tokens_v AS (
  SELECT doc_id, lang, text, {WORDS} AS tokens FROM documents),
votes_v AS (
  SELECT doc_id, b.i AS i, sum(CASE WHEN (('0x' || substr(h, 1 + b.i // 4, 1))::INT >> (3 - b.i % 4)) & 1 = 1 THEN 1 ELSE -1 END) AS v
  FROM (SELECT doc_id, sha256(w) AS h FROM (SELECT doc_id, unnest(list_distinct(tokens)) AS w FROM tokens_v)),
    (SELECT unnest(range(0, 256)) AS i) b GROUP BY ALL),
bits_v AS (
  SELECT doc_id, string_agg(CASE WHEN v > 0 THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS bits FROM votes_v GROUP BY doc_id),
hashes_v AS (
  SELECT t.doc_id, lang, sha256(text) AS sha, list_distinct(tokens[1:20]) AS words,
    coalesce(bits, repeat('0', 256)::BIT) AS bits FROM tokens_v t LEFT JOIN bits_v USING (doc_id)),
close_v AS (
  SELECT b.doc_id AS later, a.doc_id AS earlier, bit_count(xor(a.bits, b.bits))::BIGINT AS distance,
    a.lang = b.lang AS same_action, a.sha = b.sha AS same_sha,
    CASE WHEN len(list_distinct(list_concat(a.words, b.words))) = 0 THEN 1::DOUBLE
      ELSE len(list_intersect(a.words, b.words)) / len(list_distinct(list_concat(a.words, b.words)))::DOUBLE END AS jaccard
  FROM hashes_v a JOIN hashes_v b ON a.doc_id < b.doc_id AND bit_count(xor(a.bits, b.bits)) <= 16)"""


PAGE_REGIONS = """page_regions_v AS (
  SELECT '/shots/' || page_id || '.png' AS region_path, list_transform(string_split(html, '<'), lambda line, i: {
      'text': line,
      'bbox': [(length(line) % 10) / 20::DOUBLE, ((i - 1) % 20) / 20::DOUBLE,
               (length(line) % 10) / 20::DOUBLE + 0.3::DOUBLE, ((i - 1) % 20) / 20::DOUBLE + 0.04::DOUBLE],
      'confidence': (length(line) % 50 + 50) / 100::DOUBLE}) AS page_regions FROM pages)"""


def quoted(x: str) -> str:
    return f"""regexp_extract_all({x}, '"([^"]{{2,40}})"', 1)"""


def verified(reasoning: str, screen: str) -> str:
    q = quoted(reasoning)
    return f"""CASE WHEN coalesce({reasoning}, '') = '' OR {strip(f"coalesce({screen}, '')")} = '' THEN false WHEN len({q}) = 0 THEN true
      ELSE len(list_filter({q}, lambda p: contains({screen}, lower(p)))) / len({q})::DOUBLE >= 0.5 END"""


# which provider answers with something parseable, see adapters.responses
RESPONSES = f"""answers_v AS (
  SELECT doc_id AS answered_doc, CASE WHEN silent OR length({strip('answer')}) < 30 THEN NULL WHEN toxic = 0 THEN 'groq' WHEN quality = 1 THEN 'google' ELSE 'openrouter' END AS provider,
    {strip('answer')} AS answer, 'Serve item ' || doc_id AS answer_intent
  FROM (SELECT d.doc_id, coalesce(toxic, d.doc_id % 2) AS toxic, coalesce(quality, (d.doc_id % 5 = 0)::INT) AS quality, quality IS NULL AND d.doc_id % 3 = 0 AS silent,
    translate(text, '{{}}', '()') AS answer FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))"""

_BITS = " + ".join(
    f"bit_count(xor(('0x' || substr(a.phash, {1 + 8 * i}, 8))::BIGINT, ('0x' || substr(b.phash, {1 + 8 * i}, 8))::BIGINT))::INT" for i in range(8)
)
_TASK_WORDS = lambda t: f"list_distinct(string_split(lower({t}.task), ' '))"

# the sequential scan: a row is dropped iff it matches an earlier row that was kept
DROPPED = f"""alike_v AS (SELECT a.path AS path_a, b.path AS path_b FROM facts_v a, facts_v b WHERE {_BITS} <= {D.NEAR_DISTANCE}),
cand_v AS (SELECT * FROM pre_v WHERE r_schema IS NULL AND r_coords IS NULL AND path IS NOT NULL),
conflict_v AS (
  SELECT b.doc_id AS later, a.doc_id AS earlier FROM cand_v a JOIN cand_v b ON a.file_sha = b.file_sha AND a.doc_id < b.doc_id
  UNION SELECT b.doc_id, a.doc_id FROM cand_v a JOIN alike_v ON a.path = path_a JOIN cand_v b ON b.path = path_b AND a.doc_id < b.doc_id
  WHERE a.action_type = b.action_type
    AND len(list_intersect({_TASK_WORDS('a')}, {_TASK_WORDS('b')})) / len(list_distinct(list_concat({_TASK_WORDS('a')}, {_TASK_WORDS('b')})))::DOUBLE >= {D.NEAR_TASK_JACCARD}::DOUBLE
    AND (a.action_type NOT IN {CLICKS} OR coalesce(abs(a.coordinates[1] - b.coordinates[1]) <= {D.NEAR_COORDINATE}::DOUBLE
      AND abs(a.coordinates[2] - b.coordinates[2]) <= {D.NEAR_COORDINATE}::DOUBLE, true))),
before_v AS (SELECT later, list(earlier) AS earlier FROM conflict_v GROUP BY later),
node_v AS (
  SELECT id, coalesce(earlier, []) AS earlier, row_number() OVER (ORDER BY id) AS i
  FROM (SELECT later AS id FROM before_v UNION SELECT unnest(earlier) FROM before_v) LEFT JOIN before_v ON id = later),
walk_v AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS kept
  UNION ALL
  SELECT n.i, CASE WHEN list_has_any(s.kept, n.earlier) THEN s.kept ELSE list_append(s.kept, n.id) END FROM walk_v s JOIN node_v n ON n.i = s.i + 1),
dropped_v AS (SELECT id AS dropped_doc FROM node_v WHERE NOT list_contains((SELECT kept FROM walk_v ORDER BY i DESC LIMIT 1), id))"""

FULL_RUN = SAMPLES + ",\n" + FACTS + ",\n" + PAGE_REGIONS + ",\n" + RESPONSES + f""",
pre_v AS (
  SELECT s.* EXCLUDE (regions, reasoning, intent, reasoning_verified, is_error_step), f.path, f.length, f.file_sha, page_regions,
    {SCHEMA_REASON} AS r_schema, {COORD_REASON} AS r_coords, {IMAGE_REASON} AS r_image
  FROM samples_v s LEFT JOIN facts_v f ON s.screenshot_path = f.path LEFT JOIN page_regions_v ON path = region_path),
""" + DROPPED + f""",
gated_v AS (
  SELECT *, CASE WHEN r_schema IS NOT NULL THEN 'schema' WHEN r_coords IS NOT NULL THEN 'coordinates'
      WHEN dropped_doc IS NOT NULL THEN 'dedup' END AS failed_gate,
    CASE WHEN r_schema IS NOT NULL OR r_coords IS NOT NULL OR dropped_doc IS NOT NULL THEN 'rejected'
      WHEN r_image IS NOT NULL THEN 'quarantined' ELSE 'enriching' END AS gate_status
  FROM pre_v LEFT JOIN dropped_v ON doc_id = dropped_doc),
cleaned_v AS (
  SELECT *, len(cleaned) AS n_regions,
    CASE WHEN len(cleaned) > 0 THEN array_to_string(list_transform(cleaned, lambda r: {strip('r.text')}), ' ') ELSE ocr_text_raw END AS all_text,
    lower(array_to_string(list_transform(cleaned, lambda r: {strip('r.text')}), ' ')) AS screen,
    list_reduce(list_transform(cleaned, lambda r: r.confidence), lambda a, b: a + b, 0::DOUBLE) / nullif(len(cleaned), 0) AS mean_conf
  FROM (SELECT *, CASE WHEN path IS NULL THEN [] ELSE {clean_regions('page_regions')} END AS cleaned,
      {tags('task', 'action_type')} AS base_tags FROM gated_v WHERE gate_status <> 'rejected')),
enriched_v AS (
  SELECT *, {language('all_text')} AS language, false AS is_error_step,
    CASE WHEN provider IS NOT NULL THEN answer WHEN length(description) >= 5
      THEN 'Looking at the current screen for the task: ' || task || '. The next action is to ' || lower(description) || '.' ELSE '' END AS reasoning,
    CASE WHEN provider IS NOT NULL THEN answer_intent WHEN length(description) >= 5 THEN task ELSE '' END AS intent,
    coalesce(provider IS NOT NULL AND {verified('answer', 'screen')}, false) AS reasoning_verified
  FROM cleaned_v LEFT JOIN answers_v ON doc_id = answered_doc)""" + SCORE_TAIL


def with_view(view: str, body: str) -> str:
    return f"WITH RECURSIVE {view}\n{body}"
