"""SQL counterparts of the registered queries, written for DuckDB.

The statements are assembled from common table expressions, which state the
same results in relational terms: entity positions unrolled instead of folded,
vocabularies as CASE chains, boundaries spelled out where RE2 has none.
"""

from __future__ import annotations

from lexiloom.catalog.tables import SETTINGS, VOCABULARY
from lexiloom.functions.text import DIACRITICS

_S = SETTINGS
WS = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"[^a-zA-Z0-9_\p{L}\p{N}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda t: t <> '')"


def listing(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]::VARCHAR[]"


def drawn(method: str, slot: str, key: str = "sample_id") -> str:
    return f"(('0x' || substr(md5('{_S.seed}|' || {key} || '|{method}|{slot}'), 1, 8))::BIGINT)"


def pick(options, method: str, slot: str) -> str:
    return f"({listing(options)})[({drawn(method, slot)} % {len(options)}) + 1]"


def replace_first(s: str, old: str, new: str) -> str:
    return (f"CASE WHEN position({old} IN {s}) > 0 THEN substr({s}, 1, position({old} IN {s}) - 1) || {new} "
            f"|| substr({s}, position({old} IN {s}) + length({old})) ELSE {s} END")


def flat(entities: str) -> str:
    return f"array_to_string(list_transform({entities}, lambda e: e.type || '=' || e.filler), ';')"


def entity_list(w: str, n: str, group: str) -> str:
    mid = f"{w}[{n} // 2 + 1]"
    return f"""list_filter([
      CASE WHEN {n} >= 1 THEN {{'type': CASE WHEN length({w}[1]) <= 4 THEN 'device' ELSE 'device_' || {group} END, 'filler': {w}[1]}} END,
      CASE WHEN {n} >= 3 THEN {{'type': CASE WHEN length({mid}) <= 3 THEN 'time_at' WHEN length({mid}) <= 6 THEN 'target_number'
        WHEN length({mid}) <= 9 THEN 'duration' ELSE 'changing_value_' || length({mid}) END, 'filler': {mid}}} END,
      CASE WHEN {n} >= 2 THEN {{'type': 'living_space', 'filler': {w}[{n}]}} END], lambda e: e IS NOT NULL)"""


UTT = f"""pieces AS (
  SELECT doc_id, lang, unnest(string_split_regex(text, '[.!?\n]+')) AS piece,
         generate_subscripts(string_split_regex(text, '[.!?\n]+'), 1) - 1 AS sent_no FROM documents),
sentences AS (SELECT doc_id, lang, sent_no, {strip('piece')} AS sentence FROM pieces),
tokens AS (SELECT *, {words('sentence')} AS w FROM sentences WHERE sentence <> ''),
utt AS (
  SELECT doc_id || '-' || sent_no AS sample_id, doc_id, sent_no, sentence, w, len(w) AS n,
         lang || '/' || CASE WHEN len(w) <= 2 THEN 'short' WHEN len(w) <= 6 THEN 'medium' ELSE 'long' END AS intent,
         {entity_list('w', 'len(w)', 'lang')} AS entities
  FROM tokens)"""

TURNS = f"""said AS (SELECT conv_id, turn, role, text, {words('text')} AS w FROM conversations),
turns AS (
  SELECT conv_id || '-' || turn AS sample_id, conv_id, turn, text AS sentence, role AS intent,
         {entity_list('w', 'len(w)', 'role')} AS entities FROM said)"""

PAIRS = TURNS + """,
pairs AS (
  SELECT a.sample_id, a.sentence AS os, a.intent AS oi, a.entities AS oe,
         b.sentence AS s, b.intent AS i, b.entities AS e
  FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


# --- rewriting -------------------------------------------------------------

def _synonym_of(low: str, terms: dict, slot: str) -> str:
    arms = "".join(
        f" WHEN contains({low}, {q(t)}) THEN {pick(s, 'synonym_replacement', slot)}"
        f" WHEN {low} IN ({', '.join(q(x) for x in s)}) THEN {q(t)}"
        for t, s in terms.items())
    return f"CASE{arms} END"


def _entity_synonym(e: str, slot: str) -> str:
    low, kind = f"lower({e}.filler)", f"lower({e}.type)"
    places = " OR ".join(f"contains({kind}, '{k}')" for k in ("space", "location", "room"))
    return (f"coalesce(CASE WHEN contains({kind}, 'device') THEN {_synonym_of(low, VOCABULARY.devices, slot)} END, "
            f"CASE WHEN {places} THEN {_synonym_of(low, VOCABULARY.locations, slot)} END)")


def _folded(source: str, replacement, applies, name: str) -> str:
    """Entities one after another: r1, s1, r2, s2, r3, s3."""
    steps = [f"{name}0 AS (SELECT *, sentence AS s0 FROM {source})"]
    for i in (1, 2, 3):
        e, prev = f"entities[{i}]", f"s{i - 1}"
        steps.append(
            f"{name}{i}r AS (SELECT *, CASE WHEN len(entities) >= {i} THEN {replacement(e, f'entity{i - 1}')} END AS c{i} "
            f"FROM {name}{i - 1})")
        steps.append(
            f"{name}{i}f AS (SELECT *, coalesce({applies(e, f'c{i}', prev)}, false) AS f{i} FROM {name}{i}r)")
        steps.append(
            f"{name}{i} AS (SELECT *, CASE WHEN f{i} THEN {replace_first(prev, e + '.filler', f'c{i}')} ELSE {prev} END AS s{i} "
            f"FROM {name}{i}f)")
    kept = ", ".join(
        f"CASE WHEN len(entities) >= {i} THEN {{'type': entities[{i}].type, "
        f"'filler': CASE WHEN f{i} THEN c{i} ELSE entities[{i}].filler END}} END" for i in (1, 2, 3))
    steps.append(f"{name} AS (SELECT sample_id, doc_id, sent_no, sentence, intent, entities, n, s3, "
                 f"list_filter([{kept}], lambda x: x IS NOT NULL) AS ae FROM {name}3)")
    return ",\n".join(steps)


_ACTION_AT = f"list_position(list_transform(sw, lambda x: lower(x) IN ({', '.join(q(a) for a in VOCABULARY.actions)})), true)"
_ACTION = "CASE lower(sw[spot])" + "".join(
    f" WHEN {q(a)} THEN {pick(s, 'synonym_replacement', 'action')}" for a, s in VOCABULARY.actions.items()) + " END"

SYN = _folded(
    "utt", _entity_synonym,
    lambda e, c, s: f"{c} <> {e}.filler AND contains({s}, {c})", "syn") + f""",
synw AS (SELECT *, {words('s3')} AS sw FROM syn),
syna AS (SELECT *, coalesce({_ACTION_AT}, 0) AS spot FROM synw),
m_synonym AS (SELECT sample_id, doc_id, sent_no, sentence, intent, entities, n, 0 AS method_no, 'synonym_replacement' AS method,
  array_to_string(CASE WHEN spot = 0 THEN sw ELSE list_concat(list_concat(sw[1:spot - 1], [{_ACTION}]), sw[spot + 1:]) END, ' ') AS a, ae FROM syna)"""


def _gate(slot: str, p: float) -> str:
    return f"{drawn('politeness_addition', slot + '_gate')} / 4294967296.0 < {p}"


POLITE = f"""m_polite AS (SELECT sample_id, doc_id, sent_no, sentence, intent, entities, n, 1 AS method_no, 'politeness_addition' AS method,
  CASE WHEN {_gate('prefix', 0.4)} THEN {pick(VOCABULARY.prefixes, 'politeness_addition', 'prefix')} || ' ' ELSE '' END
  || sentence ||
  CASE WHEN {_gate('suffix', 0.6)} THEN ' ' || {pick(VOCABULARY.suffixes, 'politeness_addition', 'suffix')} ELSE '' END AS a,
  entities AS ae FROM utt)"""


def _restructured(markers) -> tuple[str, str]:
    one = "|".join(markers)
    blank = WS[1:-1]
    pattern = rf"(.*?)({one}) ([^,{blank}]+(?:{WS}+[^,{blank}]+)*?)({WS}|$|,)"
    g = lambda i: f"regexp_extract(sentence, '{pattern}', {i})"
    return (f"regexp_matches(sentence, '{pattern}')",
            f"{g(2)} || ' ' || {g(3)} || ', ' || {strip(g(1))} || {g(4)}")


_T, _P = _restructured(_S.time_markers), _restructured(_S.place_markers)
MOVED = f"""m_moved AS (SELECT sample_id, doc_id, sent_no, sentence, intent, entities, n, 2 AS method_no, 'sentence_restructuring' AS method,
  CASE WHEN {_T[0]} THEN {_T[1]} WHEN {_P[0]} THEN {_P[1]} ELSE sentence END AS a, entities AS ae FROM utt)"""


def _time_of(e: str, slot: str) -> str:
    low, kind = f"lower({e}.filler)", f"lower({e}.type)"
    timed = " OR ".join(f"contains({kind}, '{k}')" for k in ("time", "duration", "delay"))
    arms = "".join(f" WHEN contains({low}, {q(t)}) THEN {pick(s, 'time_variation', slot)}"
                   for t, s in VOCABULARY.times.items())
    return f"CASE WHEN {timed} THEN CASE{arms} END END"


def _general_time(s: str) -> str:
    arms = "".join(
        f" WHEN contains(lower({s}), {q(t)}) THEN regexp_replace({s}, '(^|{NOT_WORD})({t})({NOT_WORD}|$)', "
        f"'\\1' || {pick(v, 'time_variation', 'general')} || '\\3', 'i')"
        for t, v in VOCABULARY.times.items())
    return f"CASE{arms} ELSE {s} END"


TIMED = _folded("utt", _time_of, lambda e, c, s: f"{c} IS NOT NULL", "tim") + f""",
m_time AS (SELECT sample_id, doc_id, sent_no, sentence, intent, entities, n, 3 AS method_no, 'time_variation' AS method,
  {_general_time('s3')} AS a, ae FROM tim)"""

DIA = DIACRITICS
RULE = f"""CASE WHEN {strip('a')} = '' THEN 'blank' WHEN a = sentence THEN 'unchanged'
  WHEN an::DOUBLE / n < 0.7 OR an::DOUBLE / n > 2.0 THEN 'length_ratio'
  WHEN len(ae) <> len(entities) THEN 'entity_count'
  WHEN list_sort(list_transform(ae, lambda e: e.type)) <> list_sort(list_transform(entities, lambda e: e.type)) THEN 'entity_types'
  WHEN NOT regexp_matches(lower(a), '[aeiouy{DIA}]') THEN 'vietnamese_characters'
  WHEN an > 20 OR (an > 3 AND list_max(list_transform(list_distinct(lw), lambda x: len(list_filter(lw, lambda y: y = x)))) > an // 2)
    THEN 'coherence' END"""


def variants(n_methods: int) -> str:
    """Candidates of the first methods, each with the first rule it breaks."""
    blocks = [SYN, POLITE, MOVED, TIMED][:n_methods]
    names = ["m_synonym", "m_polite", "m_moved", "m_time"][:n_methods]
    union = " UNION ALL ".join(f"SELECT * FROM {m}" for m in names)
    return ",\n".join([UTT, *blocks]) + f""",
tried AS ({union}),
counted AS (SELECT *, len({words('a')}) AS an, {words('lower(a)')} AS lw FROM tried),
variants AS (SELECT *, {RULE} AS failed_rule FROM counted)"""


CAND = variants(3)
CAND4 = variants(4)
EXTRA = f"""extra AS (
  SELECT doc_id, sent_no, method_no, a AS sentence, intent, ae AS entities FROM variants WHERE failed_rule IS NULL)"""


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


# --- review ----------------------------------------------------------------

_ENT = """'[{"type": "' || source || '", "filler": "' || lang || '"}]'"""
REVIEW = f"""review AS (
  SELECT doc_id, doc_id::VARCHAR AS sid, text AS os, lang AS oi, {_ENT} AS oe, 'Please ' || text AS s, lang AS i,
    CASE doc_id % 8 WHEN 0 THEN {_ENT} WHEN 1 THEN '[{{"type": "cut' WHEN 2 THEN '' WHEN 4 THEN '{{"type": "bare", "filler": "object"}}'
      WHEN 5 THEN 'null' WHEN 6 THEN '[{{type: ' || source || ', filler: ' || lang || '}}]' WHEN 7 THEN {_ENT} END AS e,
    CASE WHEN lang = 'en' THEN 'synonym_replacement' ELSE 'politeness_addition' END AS m,
    CASE doc_id % 7 WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN 'NaN' WHEN 4 THEN ' 4 ' WHEN 5 THEN '4.5'
      WHEN 6 THEN (quality * 4 + 1)::VARCHAR END AS qs,
    CASE doc_id % 5 WHEN 0 THEN '5' WHEN 2 THEN '3.0' WHEN 3 THEN (5 - toxic * 3)::VARCHAR WHEN 4 THEN '4d' END AS ns,
    source AS comments,
    CASE doc_id % 6 WHEN 0 THEN ' YES ' WHEN 1 THEN 'no' WHEN 3 THEN '' WHEN 4 THEN 'yes' WHEN 5 THEN 'maybe' END AS ap
  FROM labels JOIN documents USING (doc_id)),
scored AS (SELECT *, CASE WHEN isnan(try_cast(qs AS DOUBLE)) THEN NULL ELSE try_cast(qs AS DOUBLE) END AS qn,
  CASE WHEN isnan(try_cast(ns AS DOUBLE)) THEN NULL ELSE try_cast(ns AS DOUBLE) END AS nn FROM review),
masks AS (SELECT *, coalesce(trim(lower(ap)) = 'yes', false) AS yes, coalesce(trim(lower(ap)) = 'no', false) AS no,
  coalesce(qn >= 3 AND nn >= 3, false) AS ok FROM scored),
decided AS (SELECT *, yes OR (ok AND NOT no) AS approved, no OR (NOT ok AND NOT yes) AS rejected FROM masks)"""

FINAL = REVIEW + f""",
final AS (SELECT *, CASE WHEN doc_id % 8 IN (0, 7) THEN source_entity ELSE '' END AS ef FROM (
  SELECT *, comments || '=' || oi AS source_entity FROM decided) WHERE doc_id % 8 NOT IN (1, 6))"""


def counted(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in pairs)


def label_counts(source: str) -> str:
    return f"""
  SELECT 'intent' AS dimension, intent AS label, NULL::VARCHAR AS intent, count(*) AS n FROM {source} GROUP BY 2
  UNION ALL SELECT 'entity_type', t, NULL, count(*) FROM (SELECT unnest(list_transform(entities, lambda e: e.type)) AS t FROM {source}) GROUP BY 2
  UNION ALL SELECT 'entity_type_intent', t, i, count(*) FROM (SELECT unnest(list_transform(entities, lambda e: e.type)) AS t, intent AS i FROM {source}) GROUP BY 2, 3"""
